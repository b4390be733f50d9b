"""Serving: request points -> features -> scores, as DataFrame plans.

A request table (``idx, lat, lon, datetime``) may be a batch DataFrame or a
streaming one; the grid lookup is a left join on (cell_id, dow, hour) whose
missing rows give zero aggregates.  Validation is a filter, never a driver
loop: ``validate_points`` lists every bad point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions import score as SC
from cellrisk.functions import timefx as T
from cellrisk.functions.space import grid_cells, in_box
from cellrisk.operators.clean import locked_features
from cellrisk.operators.joins import lookup_measured

DISCLAIMER = ("Statistical estimate from historical incident patterns; not a prediction "
              "that an incident will occur.")


def resolve_requests(req: DataFrame, text: str = "datetime") -> DataFrame:
    """Attach ``local_ts`` (zone-resolved wall time) and ``time_error``."""
    r = T.resolve_request_time(text)
    return req.withColumns({"local_ts": r["local_ts"], "time_error": r["time_error"]})


def split_requests(req: DataFrame, text: str = "datetime", lat: str = "lat", lon: str = "lon",
                   region: P.Region = P.HOURLY_REGION) -> tuple[DataFrame, DataFrame]:
    """(accepted with ``local_ts``, rejected with ``error``): a request whose
    time cannot be resolved or whose point lies outside the box is never scored."""
    r = resolve_requests(req, text)
    outside = ~F.coalesce(in_box(lat, lon, region), F.lit(False))
    error = F.coalesce(F.col("time_error"), F.when(outside, F.lit("outside_region")))
    r = r.withColumn("error", error)
    return (r.filter(F.col("error").isNull()).drop("error", "time_error"),
            r.filter(F.col("error").isNotNull()).drop("time_error"))


def build_features_batch(req: DataFrame, grid: DataFrame, ts: str = "local_ts",
                         lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Request rows with cell, time features and the five grid aggregates
    (missing (cell, dow, hour) -> 0) and ``data_coverage``."""
    g = grid_cells(lat, lon)
    tf = T.time_features(ts)
    r = req.withColumns({"lat_r": g["lat_r"], "lon_r": g["lon_r"], "cell_id": g["cell_id"], **tf})
    lookup = grid.select("cell_id", "dow", "hour", *P.AGGREGATE_COLUMNS)
    j = lookup_measured(r, lookup, ["cell_id", "dow", "hour"]).fillna(0.0, subset=P.AGGREGATE_COLUMNS)
    return j.withColumn("data_coverage", F.when(F.col("cell_total_count") > 0, "historical_data")
                        .otherwise("no_historical_data"))


def predict_batch(model, feats: DataFrame, version: str = P.MODEL_VERSION,
                  last_updated: str | None = None) -> DataFrame:
    """Locked feature columns -> fitted pipeline (its first stage assembles
    the vector in the locked order) -> raw and clamped score, level and the
    response fields."""
    keep = [c for c in feats.columns if c not in P.FEATURE_COLUMNS]
    x = locked_features(feats, P.FEATURE_COLUMNS, keep=keep)
    out = model.transform(x).withColumnRenamed("prediction", "risk_score_raw")
    out = out.withColumn("risk_score", SC.clamp("risk_score_raw"))
    return out.withColumns({
        "level": SC.risk_level("risk_score"),
        "risk_score_2dp": F.round("risk_score", 2),
        "model_version": F.lit(version),
        "last_updated": F.lit(last_updated or ""),
        "disclaimer": F.lit(DISCLAIMER),
    }).drop("features")


def score_rows(scored: DataFrame, zone: str = P.REGION_TIMEZONE) -> DataFrame:
    """The 11-field response row, after the request's ``idx`` if it has one:
    ``datetime`` is the resolved local wall time, ``resolved_local_datetime``
    the same with its offset."""
    wall = F.date_format("local_ts", "yyyy-MM-dd'T'HH:mm:ss")
    minutes = F.round((F.unix_micros(F.col("local_ts").cast("timestamp"))
                       - F.unix_micros(F.to_utc_timestamp(F.col("local_ts"), zone))) / 60e6).cast("int")
    offset = F.concat(F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
                      F.lpad((F.abs(minutes) / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                      F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))
    first = ["idx"] if "idx" in scored.columns else []
    return scored.select(*first, "lat", "lon", wall.alias("datetime"),
                         F.concat(wall, offset).alias("resolved_local_datetime"),
                         "cell_id", F.col("risk_score_2dp").alias("risk_score"), "level", "data_coverage",
                         "model_version", "last_updated", "disclaimer")


def level_table(spark) -> DataFrame:
    """Left-closed level thresholds as a 4-row table."""
    b = [0.0] + P.RISK_LEVEL_BOUNDS + [100.0]
    rows = [(lab, b[i], b[i + 1]) for i, lab in enumerate(P.RISK_LEVEL_LABELS)]
    return spark.createDataFrame(rows, "level string, min double, max double")
