"""Zone resolution of request times (naive, offset, UTC equality, DST gap,
doubled hour)."""
from pyspark.sql import functions as F

from cellrisk.functions.timefx import resolve_request_time


def resolve(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    r = resolve_request_time("s")
    return [(row.t and row.t.strftime("%Y-%m-%d %H:%M"), row.e)
            for row in df.select(r["local_ts"].alias("t"), r["time_error"].alias("e")).collect()]


def test_naive_is_wall_time(spark):
    assert resolve(spark, ["2026-04-11T23:00:00"]) == [("2026-04-11 23:00", None)]


def test_offset_converted(spark):
    assert resolve(spark, ["2026-04-12T06:00:00+07:00"]) == [("2026-04-11 18:00", None)]


def test_same_instant(spark):
    a, b = resolve(spark, ["2026-04-12T04:00:00Z", "2026-04-11T23:00:00-05:00"])
    assert a == b


def test_dst_gap_and_doubled_hour_rejected(spark):
    gap, dbl = resolve(spark, ["2026-03-08T02:30:00", "2026-11-01T01:30:00"])
    assert gap == (None, "dst_gap")
    assert dbl == (None, "dst_ambiguous")


def test_doubled_hour_with_offset_accepted(spark):
    (t, e), = resolve(spark, ["2026-11-01T01:30:00-05:00"])
    assert e is None and t == "2026-11-01 01:30"


def test_unparsable(spark):
    (t, e), = resolve(spark, ["not a time"])
    assert t is None and e == "unparsable"
