"""The pass over raw events that the hourly grid and its evaluation start with."""
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

#: The JVM never compiles a method of more bytecodes than this; it stays interpreted.
JIT_LIMIT = 8000


def _events(spark):
    from cellrisk.operators.models import scratch_path
    kinds = ["error", "purchase", "signup", "click", "view", None]
    rows = [(i, datetime(2026, 1, 1) + timedelta(hours=7 * i), i * 11, kinds[i % 6], float(i), f'{{"k": {i % 40}}}' if i % 9 else None) for i in range(400)]
    path = scratch_path(spark, f"events-{uuid.uuid4().hex[:6]}")
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(path + "/events.parquet")
    return path


def test_no_generated_method_of_the_event_pass_stays_interpreted(spark):
    from cellrisk.plans.hourly import clean_incidents, event_values, unit_aggregate
    from cellrisk.sources.adapters import inc_hourly
    ev = event_values(clean_incidents(inc_hourly(spark, _events(spark))))
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the plan as it runs, without the wrapper
    try:
        plan = unit_aggregate(ev)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan).iterator()
    sizes = []
    while stages.hasNext():
        sizes.append(stages.next()._3().maxMethodCodeSize())
    assert len(sizes) > 1 and 0 < max(sizes) < JIT_LIMIT


def test_event_severity_is_the_layered_one(spark):
    """Untrimmed, lower-case, null and slash-edged texts score as the public expressions do."""
    from cellrisk.functions import severity as S
    from cellrisk.plans.hourly import event_values
    types = ["ROBBERY", " robbery\t", "THEFT", "CRIMINAL SEXUAL ASSAULT", "UNKNOWN KIND", "", None]
    descs = ["ARMED: HANDGUN", " armed: handgun ", "/ knife / ", "SIMPLE", "aggravated: minor", "ATTEMPT DOMESTIC", "\n", "", None]
    rows = [(t, d, 41.8, -87.7, datetime(2026, 1, 1), False) for t in types for d in descs]
    df = spark.createDataFrame(rows, "primary_type_canon string, desc_canon string, lat double, lon double, ts timestamp_ntz, arrest boolean")
    ev = event_values(df)
    assert not {"_type", "_desc"} & set(ev.columns)
    got = ev.select("severity", "sev_layer", S.layered_severity("primary_type_canon", "desc_canon").alias("s"),
                    S.severity_layer("primary_type_canon", "desc_canon").alias("l"), "primary_type_canon", "desc_canon").collect()
    assert len(got) == len(rows) and all((r["severity"], r["sev_layer"]) == (r["s"], r["l"]) for r in got)
    known = {(r["primary_type_canon"], r["desc_canon"]): r["severity"] for r in got}
    assert known["UNKNOWN KIND", "aggravated: minor"] == 25 + 10 + 8 and known[None, "ATTEMPT DOMESTIC"] == 25 + 5 - 8
    assert known[None, None] == 25 and known[" robbery\t", " armed: handgun "] == known["ROBBERY", "ARMED: HANDGUN"]
