"""Literal cases (doc examples and boundary cases of the surveyed tests)."""
import math

from pyspark.sql import functions as F

from cellrisk.functions import score as SC
from cellrisk.functions import severity as SEV
from cellrisk.functions import timefx as T
from cellrisk.functions.space import gaussian_weight, grid_cells, in_box
from cellrisk.params import HOURLY_REGION


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def test_grid_id(spark):
    g = grid_cells(F.lit(41.8010), F.lit(-87.6526))
    r = one(spark, lat_r=g["lat_r"], lon_r=g["lon_r"], cell=g["cell_id"])
    assert (r.lat_r, r.lon_r, r.cell) == (41.8, -87.65, "41.8_-87.65")


def test_half_even_rounding(spark):
    # numpy rounds half to even on the scaled value
    g = grid_cells(F.lit(41.125), F.lit(-87.635))
    r = one(spark, a=g["lat_r"], b=g["lon_r"])
    assert r.a == round(41.125 * 100) / 100 or r.a == 41.12
    assert isinstance(r.b, float)


def test_time_parts(spark):
    tf = T.time_features(F.lit("2026-04-11 23:30:00").cast("timestamp"))
    r = one(spark, hour=tf["hour"], dow=tf["dow"], wk=tf["is_weekend"])
    assert (r.hour, r.dow, r.wk) == (23, 5, 1)


def test_severity_examples(spark):
    r = one(spark, a=SEV.layered_severity(F.lit("ROBBERY"), F.lit("ARMED: HANDGUN")),
            b=SEV.layered_severity(F.lit("BATTERY"), F.lit("SIMPLE")))
    assert (r.a, r.b) == (82.0, 50.0)


def test_severity_anchors(spark):
    cases = [("CRIMINAL SEXUAL ASSAULT", "AGGRAVATED: HANDGUN", 95), ("ROBBERY", "ARMED: HANDGUN", 82),
             ("BATTERY", "SIMPLE", 50), ("THEFT", "FROM PERSON", 38), ("CRIMINAL DAMAGE", "TO VEHICLE", 12)]
    df = spark.createDataFrame([(t, d) for t, d, _ in cases], "t string, d string")
    got = [r[0] for r in df.select(SEV.layered_severity("t", "d")).collect()]
    assert got == [float(v) for _, _, v in cases]


def test_severity_layers_and_default(spark):
    df = spark.createDataFrame([("ROBBERY", "ARMED: HANDGUN"), ("ROBBERY", "ATTEMPT ARMED: KNIFE"),
                                ("MYSTERY", "SIMPLE"), (None, None),
                                ("WEAPONS VIOLATION", "POSSESS FIREARM")], "t string, d string")
    rows = df.select(SEV.layered_severity("t", "d").alias("s"), SEV.severity_layer("t", "d").alias("l")).collect()
    assert rows[0].l == "1-anchor"
    assert rows[1].s == 65 + 10 - 8 and rows[1].l == "2-base+modifier"     # blade/armed +10, attempt -8
    assert rows[2].s == 25 and rows[2].l == "3-default"
    assert rows[3].s == 25
    assert rows[4].s == 55            # weapon modifier off for weapon-essence types


def test_tier_modifier_quirks(spark):
    r = one(spark, a=SEV.description_multiplier(F.lit("STRONG ARM - NO WEAPON")),
            b=SEV.description_multiplier(F.lit("ARMED: HANDGUN")),
            c=SEV.tier_severity(F.lit("ROBBERY"), F.lit("AGGRAVATED: HANDGUN")))
    assert math.isclose(r.a, 1.3)                 # NO WEAPON matches the weapon pattern
    assert math.isclose(r.b, 1.8)
    assert math.isclose(r.c, 8 * 2.2)             # 1.8 * 1.4 clipped to 2.2


def test_half_life_and_distance_weight(spark):
    r = one(spark, w=SC.temporal_weight(F.lit(365.0), 365.0), g=gaussian_weight(F.lit(1.0), 1.0))
    assert round(r.w, 3) == 0.5 and round(r.g, 3) == 0.607


def test_levels(spark):
    df = spark.createDataFrame([(74.0,), (0.0,), (100.0,), (25.0,), (-5.0,), (150.0,)], "s double")
    got = [r[0] for r in df.select(SC.risk_level("s")).collect()]
    assert got == ["High", "Low", "Very High", "Medium", "Low", "Very High"]


def test_clamp(spark):
    df = spark.createDataFrame([(float(x),) for x in range(-50, 151, 25)], "p double")
    got = [r[0] for r in df.select(SC.clamp("p")).collect()]
    assert min(got) == 0.0 and max(got) == 100.0


def test_box_accept_reject(spark):
    df = spark.createDataFrame([(41.88, -87.62), (40.71, -74.0), (0.0, 0.0), (90.0, -87.6)], "lat double, lon double")
    got = [r[0] for r in df.select(F.coalesce(in_box("lat", "lon", HOURLY_REGION), F.lit(False))).collect()]
    assert got == [True, False, False, False]


def test_power_score_anchors(spark):
    df = spark.createDataFrame([(0.0,), (4.0,), (9.0,), (20.0,)], "r double")
    got = [r[0] for r in df.select(SC.power_score("r", 16.0, 0.5)).collect()]
    assert got == [0.0, 50.0, 75.0, 100.0]
    assert one(spark, z=SC.power_score(F.lit(3.0), 0.0)).z == 0.0
