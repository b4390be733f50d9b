"""File sources and sinks.

Scans declare their schema (no inference on big inputs) and select only the
needed columns, so Parquet/CSV readers prune at the scan.  Path probing and
recursive lookup go through the Hadoop FileSystem of the session, so they
work on any storage the cluster mounts.
"""

from __future__ import annotations

import json
import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw incident file layout (22 columns; the location text column is dropped
# at the scan).
RAW_SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()), T.StructField("Case Number", T.StringType()),
    T.StructField("Date", T.StringType()), T.StructField("Block", T.StringType()),
    T.StructField("IUCR", T.StringType()), T.StructField("Primary Type", T.StringType()),
    T.StructField("Description", T.StringType()), T.StructField("Location Description", T.StringType()),
    T.StructField("Arrest", T.StringType()), T.StructField("Domestic", T.StringType()),
    T.StructField("Beat", T.DoubleType()), T.StructField("District", T.DoubleType()),
    T.StructField("Ward", T.DoubleType()), T.StructField("Community Area", T.DoubleType()),
    T.StructField("FBI Code", T.StringType()), T.StructField("X Coordinate", T.DoubleType()),
    T.StructField("Y Coordinate", T.DoubleType()), T.StructField("Year", T.DoubleType()),
    T.StructField("Updated On", T.StringType()), T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()), T.StructField("Location", T.StringType()),
])
RAW_KEEP = [f.name for f in RAW_SCHEMA.fields if f.name != "Location"]
PROFILE_COLUMNS = ["ID", "Date", "IUCR", "Primary Type", "Description", "Arrest", "Latitude",
                   "Longitude", "Year"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """CSV scan with a declared schema and column pruning.  Columns are bound
    by the header's names, so one absent from the file moves no other; only
    those present are returned, with their declared types."""
    opts = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    header = spark.read.options(**opts).csv(path).columns     # reads the first line only
    types = {f.name: f.dataType for f in schema.fields}
    declared = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    df = spark.read.schema(declared).options(**opts).option("mode", "PERMISSIVE").csv(path)
    cols = [c for c in (columns or types) if c in header]
    return df.select(*[F.col(f"`{c}`") for c in cols])


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) or bool(fs.globStatus(p))


def first_existing(spark: SparkSession, candidates: list[str], schema: T.StructType | None = None) -> tuple[DataFrame, str]:
    """Parquet at the first existing candidate path, else the same names as
    CSV (second choice) with the declared ``schema``."""
    for c in candidates:
        if exists(spark, c):
            return spark.read.parquet(c), c
    for c in candidates:
        alt = c[:-len(".parquet")] + ".csv" if c.endswith(".parquet") else c + ".csv"
        if exists(spark, alt):
            if schema is None:
                raise ValueError(f"{alt} is CSV: a schema has to be declared")
            return read_csv(spark, alt, schema), alt
    raise FileNotFoundError(f"none of {candidates} exists (parquet or csv)")


def find_recursive(spark: SparkSession, root: str, pattern: str, fmt: str = "parquet") -> DataFrame:
    """Recursive lookup: every file under ``root`` matching ``pattern``."""
    return (spark.read.format(fmt).option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(root))


def read_params(spark: SparkSession, path: str, defaults: dict | None = None) -> DataFrame:
    """One-row parameter table from a JSON document (multi-line), with
    defaults for absent keys."""
    if exists(spark, path):
        df = spark.read.option("multiLine", True).json(path)
    else:
        df = spark.createDataFrame([{"_empty": True}])
    for k, v in (defaults or {}).items():
        if k not in df.columns:
            value = F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(json.dumps(v) if isinstance(v, dict) else v)
            df = df.withColumn(k, value)
    return df.drop("_empty") if "_empty" in df.columns else df


def hash_sample(df: DataFrame, key: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """Reproducible fraction sample: keep rows whose md5 bucket of the key
    falls under the fraction (same rows in any engine); fraction outside
    (0, 1) keeps everything."""
    from cellrisk.operators.splits import seeded_unit
    if not 0 < fraction < 1:
        return df
    return df.filter(seeded_unit(seed, *key) < fraction)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Table sink (overwrite) as Parquet, or CSV when ``fmt`` asks for it,
    optionally partitioned (e.g. by period so later month filters prune
    directories).  A failed write is an error, never another format."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def sanitize_doubles(df: DataFrame) -> DataFrame:
    """NaN and +-Infinity -> null in every double/float column (JSON has no
    token for them)."""
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f"`{f.name}`")
            cols[f.name] = F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)
    return df.withColumns(cols) if cols else df


def write_json(df: DataFrame, path: str) -> str:
    sanitize_doubles(df).write.mode("overwrite").json(path)
    return path


def export_sample(df: DataFrame, key: list[str], n: int, seed: int = 42) -> DataFrame:
    """Fixed-size random export, sorted by key: the n rows with the smallest
    seeded md5 of the key (a top-n, planned as TakeOrderedAndProject), then
    ordered by key."""
    from cellrisk.operators.splits import seeded_unit
    pick = df.withColumn("_h", seeded_unit(seed, *key)).orderBy("_h", *key).limit(n).drop("_h")
    return pick.orderBy(*key)


def frozen_params_row(spark: SparkSession, reference_date: str, clip_value: float, n_cells: int,
                      n_rows: int, params) -> DataFrame:
    """The label-parameter record frozen next to the grid table."""
    row = {"reference_date": reference_date, "grid_decimals": params.grid_decimals,
           "half_life_days": params.half_life_days, "sigma_km": params.sigma_km,
           "cutoff_km": params.cutoff_km, "clip_percentile": params.clip_percentile,
           "score_clip_value": float(clip_value) if clip_value is not None and not math.isnan(clip_value) else None,
           "score_exponent": params.score_exponent, "n_cells": int(n_cells), "n_rows": int(n_rows),
           "feature_columns": list(params.feature_columns), "target": "risk_score",
           "label_ingredient_columns": ["base_value", "risk_raw"]}
    return spark.createDataFrame([row])


GRID_TABLE_SCHEMA = T.StructType(
    [T.StructField("cell_id", T.StringType()), T.StructField("dow", T.IntegerType()),
     T.StructField("hour", T.IntegerType())]
    + [T.StructField(c, T.IntegerType() if c == "is_weekend" else T.DoubleType())
       for c in ["lat_r", "lon_r", "is_weekend", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
                 "crime_count", "violent_share", "arrest_rate", "cell_total_count",
                 "neighbor_count_mean", "risk_score"]])


def load_feature_table(spark: SparkSession, path: str) -> DataFrame:
    """The published grid table (16 columns) with an explicit schema."""
    return spark.read.schema(GRID_TABLE_SCHEMA).option("header", True).csv(path)
