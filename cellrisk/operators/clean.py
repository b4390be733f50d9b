"""Cleaning operators: taxonomy canonicalisation, coordinate flags, filters,
locked feature projection and request validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions.space import in_box
from cellrisk.functions.text import upper_strip
from cellrisk.operators.joins import join_small


def canonical_map(df: DataFrame, code: str = "iucr", ptype: str = "primary_type",
                  year: str = "yr") -> DataFrame:
    """code -> canonical label: the most frequent label in the last year the
    code appears (ties -> smallest label).

    Counts are pre-aggregated per (code, year, label) first, so a hot code
    costs one row per year and label; the per-code window then runs on that
    small table."""
    counts = (df.filter(F.col(code).isNotNull())
              .groupBy(code, year, ptype).agg(F.count(F.lit(1)).alias("_n")))
    last = F.max(year).over(Window.partitionBy(code))
    recent = counts.withColumn("_last", last).filter(F.col(year) == F.col("_last"))
    recent = recent.filter(F.col(ptype).isNotNull()).groupBy(code, ptype).agg(F.sum("_n").alias("_n"))
    rk = F.row_number().over(Window.partitionBy(code).orderBy(F.desc("_n"), F.asc(ptype)))
    return recent.withColumn("_rk", rk).filter("_rk = 1").select(code, F.col(ptype).alias("_canon"))


def canonical_type(df: DataFrame, code: str = "iucr", ptype: str = "primary_type",
                   year: str = "yr", out: str = "primary_type_canon",
                   normalise=upper_strip) -> DataFrame:
    """Attach the canonical label (code without a canonical label keeps its
    own), upper-cased and stripped."""
    if code not in df.columns:
        return df.withColumn(out, normalise(ptype))
    cmap = canonical_map(df, code, ptype, year)
    # one row per code: measured, then broadcast so the incident rows are
    # never shuffled for this lookup (a hot code would skew that shuffle)
    j = join_small(df, cmap, [code], "left", max_rows=1_000_000)
    return j.withColumn(out, normalise(F.coalesce(F.col("_canon"), F.col(ptype)))).drop("_canon")


def since_year(df: DataFrame, year, first: int | None) -> DataFrame:
    """Rows of the year ``first`` or later (``year``: a column or its name); all rows for None."""
    if first is None:
        return df
    return df.filter((F.col(year) if isinstance(year, str) else year) >= first)


def null_outlier_coords(df: DataFrame, lat: str, lon: str, extra: list[str] | None = None,
                        region: P.Region = P.MONTHLY_REGION) -> DataFrame:
    """Coordinates present but outside the box -> the coordinate columns are
    nulled; ``coord_missing`` = latitude is null afterwards."""
    has = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    outlier = has & ~F.coalesce(in_box(lat, lon, region), F.lit(False))
    cols = [lat, lon] + list(extra or [])
    out = df.withColumn("_out", outlier).withColumns(
        {c: F.when(F.col("_out"), F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
         for c in cols})
    return out.withColumn("coord_missing", F.col(lat).isNull()).drop("_out")


def missing_coord_flag(df: DataFrame, lat: str, lon: str, base: str | None = None,
                       region: P.Region = P.MONTHLY_REGION) -> DataFrame:
    """``base_missing | lat null | lon null | not in box``."""
    b = F.coalesce(F.col(base).cast("boolean"), F.lit(False)) if base and base in df.columns \
        else F.lit(False)
    box = F.coalesce(in_box(lat, lon, region), F.lit(False))
    return df.withColumn("coord_missing", b | F.col(lat).isNull() | F.col(lon).isNull() | ~box)


def drop_required(df: DataFrame, cols: list[str], region: P.Region | None = None,
                  lat: str = "lat", lon: str = "lon") -> tuple[DataFrame, DataFrame]:
    """Required-field drop and optional box filter, with (before, removed,
    after) counts from one aggregate."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    if region is not None:
        ok = ok & F.coalesce(in_box(lat, lon, region), F.lit(False))
    counts = df.agg(F.count(F.lit(1)).alias("before"),
                    F.count_if(~ok).alias("removed"),
                    F.count_if(ok).alias("after"))
    return df.filter(ok), counts


def locked_features(df: DataFrame, cols: list[str] = P.FEATURE_COLUMNS,
                    dtype: str = "double", keep: list[str] | None = None) -> DataFrame:
    """Exact set and order of feature columns; missing column -> 0.0,
    null -> 0.0, cast to ``dtype``."""
    exprs = [F.col(k) for k in dict.fromkeys(keep or []) if k not in cols]
    for c in cols:
        v = F.col(c).cast(dtype) if c in df.columns else F.lit(0.0).cast(dtype)
        exprs.append(F.coalesce(v, F.lit(0.0).cast(dtype)).alias(c))
    return df.select(*exprs)


def assert_no_leak(cols: list[str], leak=P.LABEL_INGREDIENT_COLUMNS + [P.TARGET_COLUMN]) -> None:
    bad = [c for c in cols if c in leak]
    if bad:
        raise ValueError(f"label ingredient columns in the feature list: {bad}")


def exclude_columns(df: DataFrame, drop: list[str]) -> DataFrame:
    """Drop label-ingredient / leak columns and de-duplicate the rest."""
    seen, keep = set(), []
    for c in df.columns:
        if c in drop or c in seen:
            continue
        seen.add(c)
        keep.append(c)
    return df.select(*keep)


def validate_points(req: DataFrame, idx: str = "idx", lat: str = "lat", lon: str = "lon",
                    region: P.Region = P.HOURLY_REGION) -> DataFrame:
    """One error row per point outside the box (``idx, error``)."""
    ok = F.coalesce(in_box(lat, lon, region), F.lit(False))
    msg = F.format_string(
        "points[%d]: (lat=%s, lon=%s) outside the model region (lat %s..%s, lon %s..%s)",
        F.col(idx), F.col(lat).cast("string"), F.col(lon).cast("string"),
        F.lit(str(region.lat_min)), F.lit(str(region.lat_max)),
        F.lit(str(region.lon_min)), F.lit(str(region.lon_max)))
    return req.filter(~ok).select(F.col(idx), msg.alias("error"))


class PointsRejected(ValueError):
    """Raised by ``reject_all``; ``errors`` is the table of all bad points."""

    def __init__(self, count: int, shown: list[str], errors: DataFrame):
        more = f" and {count - len(shown)} more" if count > len(shown) else ""
        super().__init__(f"{count} point(s) rejected: {'; '.join(shown)}{more}")
        self.count, self.errors = count, errors


def reject_all(req: DataFrame, **kw) -> DataFrame:
    """Reject-all validation: raise when any point is bad.  The exception
    holds the full error table, however long it is, and its count."""
    errs = validate_points(req, **kw)
    idx = kw.get("idx", "idx")
    shown = [r["error"] for r in errs.orderBy(idx).limit(20).collect()]   # the message; all are in the table
    if shown:
        raise PointsRejected(errs.count(), shown, errs)
    return req


def parse_with_fallback(df: DataFrame, text: str, out: str,
                        fmt: str = "MM/dd/yyyy hh:mm:ss a", gate: float = 0.5) -> DataFrame:
    """Parse with ``fmt``; when more than ``gate`` of the values fail, fall
    back to the free-format parse for the ones that failed (the failure share
    is one aggregate)."""
    first = F.try_to_timestamp(F.col(text), F.lit(fmt))
    share = df.agg(F.avg(first.isNull().cast("double")).alias("s")).first()["s"] or 0.0
    parsed = F.coalesce(first, F.try_to_timestamp(F.col(text))) if share > gate else first
    return df.withColumn(out, parsed)


def partial_period(df: DataFrame, period: str, out: str = "is_partial_period") -> DataFrame:
    """Flag rows of the latest period (the month still in progress).  The
    latest period is one scalar aggregate, applied as a literal."""
    pmax = df.agg(F.max(period).alias("m")).first()["m"]
    return df.withColumn(out, (F.col(period) == F.lit(pmax)).cast("int"))
