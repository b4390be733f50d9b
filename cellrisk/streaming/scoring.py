"""Structured Streaming re-aims of the request path and the batch loop.

``start_scoring``: request files (``idx, lat, lon, datetime``) arrive in a
folder; each micro-batch is zone-resolved, validated (bad points go to an
error sink), joined to the static grid (stream-static left join, no state)
and scored by the fitted pipeline into a Parquet sink.  The checkpoint makes
a restart pick up only new files, so a second ``availableNow`` run adds no
rows.

``start_period_monitor``: arriving monthly rows drive ``Monitor.step`` from
``foreachBatch``.  Each micro-batch overwrites its own partition of the history
table, which merges the parts of a year however it is split; a year is decided
once, when it is complete, so neither a split arrival nor a replayed micro-batch
makes a second decision.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions.space import in_box
from cellrisk.plans.serve import build_features_batch, predict_batch, resolve_requests

REQUEST_SCHEMA = "idx long, lat double, lon double, datetime string"


def scoring_stream(spark: SparkSession, requests_dir: str, grid: DataFrame, model,
                   region: P.Region = P.HOURLY_REGION) -> tuple[DataFrame, DataFrame]:
    """(scored stream, rejected stream) for requests arriving in a folder."""
    req = spark.readStream.schema(REQUEST_SCHEMA).parquet(requests_dir)
    req = resolve_requests(req)
    ok = F.coalesce(in_box("lat", "lon", region), F.lit(False)) & F.col("time_error").isNull()
    good = req.filter(ok)
    bad = req.filter(~ok).select("idx", F.coalesce(
        F.col("time_error"), F.lit("outside the model region")).alias("error"))
    feats = build_features_batch(good, grid)
    return predict_batch(model, feats), bad


def start_scoring(spark: SparkSession, requests_dir: str, out_dir: str, checkpoint: str,
                  grid: DataFrame, model, available_now: bool = True):
    scored, bad = scoring_stream(spark, requests_dir, grid, model)
    trig = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    q1 = (scored.writeStream.format("parquet").option("path", os.path.join(out_dir, "scores"))
          .option("checkpointLocation", os.path.join(checkpoint, "scores")).trigger(**trig).start())
    q2 = (bad.writeStream.format("parquet").option("path", os.path.join(out_dir, "rejected"))
          .option("checkpointLocation", os.path.join(checkpoint, "rejected")).trigger(**trig).start())
    return q1, q2


def step_arrived(spark: SparkSession, monitor, schema, base: DataFrame, period: str = "period_str", closing: bool = False) -> None:
    """Steps, in order, the years that are complete: those whose December or a
    later year is in the history; with ``closing`` (the end of the stream) the
    last one too.  A year in the log is not stepped again; rows that come after
    its decision only count as history of later years."""
    arrived = spark.read.schema(schema).parquet(f"{monitor.store}/history/*")
    table = base.unionByName(arrived, allowMissingColumns=True)
    years = arrived.groupBy(F.substring(period, 1, 4).alias("y")).agg(F.max(period).alias("last")).orderBy("y").collect()   # a row for each year
    for i, r in enumerate(years):
        if closing or i + 1 < len(years) or r["last"] >= f"{r['y']}-12":
            monitor.step(table, r["y"])


def start_period_monitor(spark: SparkSession, arrivals_dir: str, schema: str, monitor, base: DataFrame,
                         checkpoint: str, period: str = "period_str"):
    """Each micro-batch of arriving rows is added to the history (``base`` and
    what arrived before), then ``step_arrived`` decides what is complete."""
    def handle(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{monitor.store}/history/arrival={batch_id}")
        step_arrived(df.sparkSession, monitor, schema, base, period)

    stream = spark.readStream.schema(schema).parquet(arrivals_dir)
    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
