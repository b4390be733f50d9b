"""cellrisk: a Spark-native engine that turns incident records (time, place,
type) into 0-100 risk scores per grid cell and time slot.

Every public operator takes and returns DataFrames and is built from Spark
SQL expressions, joins, windows, aggregates and MLlib.

Layout
------
sources/    scans, sinks and the adapter views over the driver tables
functions/  column expressions (text, time, space, severity, score)
operators/  DataFrame -> DataFrame operators (clean, profile, panel,
            neighbours, stats, splits, baselines, evaluate, models, drift,
            registry)
plans/      end-to-end plans (monthly score, hour-of-week grid, serving)
            and the query catalogue used by ``__spark_entry__``
streaming/  Structured Streaming scoring and the period-arrival monitor
"""

from cellrisk.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
