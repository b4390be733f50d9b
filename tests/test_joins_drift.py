"""Late additions: measured-bound broadcast and grouped PSI."""
import math

from pyspark.sql import functions as F


def test_join_small_measured_broadcast(spark):
    from cellrisk.operators.joins import join_small
    big = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    small = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    j = join_small(big, small, ["k"], "left", max_rows=100)
    assert "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()
    assert j.filter(F.col("v") == F.col("k") * 10).count() == 1000


def test_grouped_psi_equals_per_batch(spark):
    from cellrisk.operators.drift import psi_table
    ref = spark.range(2000).select((F.col("id") % 97 * 1.0).alias("x"), (F.col("id") % 13 * 1.0).alias("y"))
    act = spark.range(3000).select((F.col("id") % 3).cast("string").alias("b"),
                                   (F.col("id") % 89 * 1.1).alias("x"), (F.col("id") % 11 * 1.0).alias("y"))
    grouped = {(r.b, r.feature): r.psi for r in psi_table(ref, act, ["x", "y"], group="b").collect()}
    for b in ("0", "1", "2"):
        single = {r.feature: r.psi for r in psi_table(ref, act.filter(F.col("b") == b), ["x", "y"]).collect()}
        for f, v in single.items():
            assert math.isclose(grouped[(b, f)], v, rel_tol=1e-12, abs_tol=1e-15)
