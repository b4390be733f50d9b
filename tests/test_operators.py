"""Distributed operators against brute force / numpy on small fixtures."""
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellrisk.operators import neighbours as NB
from cellrisk.operators.drift import psi_table
from cellrisk.operators.joins import broadcast_threshold
from cellrisk.operators.stats import average_rank, quantile_table, quantiles, ranges, ranked, spearman


@pytest.mark.parametrize("ties", [0.0, 0.6, 1.0])
def test_quantiles_are_exact_with_ties(spark, ties):
    rnd = random.Random(7)
    vals = [0.0 if rnd.random() < ties else rnd.choice([1, -1]) * rnd.random() * 10 ** rnd.randint(-4, 6) for _ in range(5000)] + [50.0] * 300
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)] + [(None, 1), (float("nan"), 2)], "x double, g int")
    qs = [0.0, 0.01, 0.25, 0.5, 0.99, 0.995, 1.0]
    assert np.allclose(quantiles(df, "x", qs), np.percentile(vals, [q * 100 for q in qs]))
    for r in quantile_table(df, "x", qs, ["g"]).collect():
        assert np.allclose(r["q"], np.percentile(vals[r["g"]::3], [q * 100 for q in qs]))
    assert quantiles(df.limit(0), "x", [0.5]) == [None]


@pytest.mark.parametrize("kind", ["latitude", "epoch", "mixed", "tied"])
def test_ranges_hold_like_shares_of_narrow_values(spark, kind):
    """Splitters come from the values, so no range grows with their narrowness."""
    x = {"latitude": "41.6 + (id * 7919 % 1000003) / 2.5e6", "epoch": "1.7e9 + (id * 7919 % 1000003)", "mixed": "if(id % 2 = 0, 1, -1) * pow(10, id % 40 - 20) * id",
         "tied": "if(id % 3 = 0, 5.0, (id * 7919 % 1000003) / 1e9)"}[kind]
    df = spark.range(400_000).selectExpr(f"cast({x} as double) as x")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        held = [r["n"] for r in ranges(df, "x").groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set(key, was)
    assert len(held) == 8 and max(held) < 2 * sum(held) / len(held)
    vals = [r["x"] for r in df.collect()]
    assert np.allclose(quantiles(df, "x", [0.1, 0.5, 0.999]), np.percentile(vals, [10, 50, 99.9]), rtol=1e-12)


def test_ranked_rows_of_a_hot_value(spark):
    vals = [1.0] * 4000 + [float(i) for i in range(3000)]
    got = [(r["x"], r["rank"]) for r in ranked(spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double"), "x").collect()]
    exp = pd.Series(vals).rank()
    assert sorted(got, key=repr) == sorted([*zip(vals, exp), (None, None)], key=repr)


def test_lookup_of_a_hot_slot(spark):
    from cellrisk.operators.joins import lookup_measured
    left = spark.createDataFrame([("hot", i) for i in range(3000)] + [(f"k{i % 7}", i) for i in range(500)] + [(None, 1)], "k string, i int")
    table = spark.createDataFrame([("hot", 1.0), ("k1", 2.0), ("other", 3.0)], "k string, v double")
    got = sorted(map(tuple, lookup_measured(left, table, ["k"]).select("k", "i", "v").collect()), key=repr)
    assert got == sorted(map(tuple, left.join(table, "k", "left").select("k", "i", "v").collect()), key=repr) and len(got) == 3501


def test_broadcast_threshold_notations(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    try:
        for text, n in (("100MB", 100 << 20), ("10m", 10 << 20), ("-1", -1), ("2048", 2048), ("64kb", 64 << 10)):
            spark.conf.set(key, text)
            assert broadcast_threshold(spark) == n
    finally:
        spark.conf.set(key, was)


def test_average_rank_matches_pandas(spark):
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 40)) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = {row.x: row.rank for row in average_rank(df, "x").collect()}
    exp = pd.Series(vals).rank()
    assert all(math.isclose(r[v], e) for v, e in zip(vals, exp))


def test_spearman_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(50)], "a double, b double")
    assert spearman(df, "a", "b") is None


def test_kernel_sum_brute_force(spark):
    rnd = random.Random(1)
    cells = {(rnd.randint(0, 12), rnd.randint(0, 12)) for _ in range(60)}
    rows = [(i, j, 0, rnd.random()) for i, j in cells]
    df = spark.createDataFrame(rows, "gi int, gj int, p int, v double")
    out = {(r.gi, r.gj): r.k for r in NB.kernel_sum(df, "v", "k", ["gi", "gj", "p"]).collect()}
    val = {(i, j): v for i, j, _, v in rows}
    for (i, j) in cells:
        exp = sum(val.get((i + a, j + b), 0.0) * math.exp(-(a * a + b * b) / 2.0)
                  for a in range(-2, 3) for b in range(-2, 3))
        assert math.isclose(out[(i, j)], exp, rel_tol=1e-12)
    assert set(out) == cells


def test_neighbour_mean_present_divisor(spark):
    rows = [(0, 0, 0, 1.0), (0, 1, 0, 3.0), (1, 1, 0, None), (5, 5, 0, 2.0)]
    df = spark.createDataFrame(rows, "gi int, gj int, p int, v double")
    got = {(r.gi, r.gj): r.m for r in NB.neighbour_mean(df, "v", "m", ["gi", "gj", "p"]).collect()}
    assert got[(0, 0)] == 3.0 and got[(0, 1)] == 1.0 and got[(1, 1)] == 2.0 and got[(5, 5)] is None


@pytest.mark.parametrize("place,cutoff", [("city", 3.0), ("pole", 3.0), ("pole", 400.0), ("date line", 3.0), ("globe", 900.0), ("globe", 15000.0)])
def test_radius_pairs_equal_brute_force(spark, place, cutoff):
    rnd = random.Random(5)
    pts = {"city": [(41.80 + rnd.randint(0, 25) / 100, -87.70 + rnd.randint(0, 25) / 100) for _ in range(120)],
           "pole": [(rnd.choice([1, -1]) * (90 - rnd.random() ** 3 * 0.2), rnd.uniform(-180, 180)) for _ in range(150)] + [(90.0, 0.0), (90.0, 77.0), (89.9, 10.0), (89.9, -170.0), (-90.0, 5.0)],
           "date line": [(rnd.uniform(51, 51.1), rnd.choice([179.98, -179.98, 180.0, -180.0]) + rnd.uniform(-0.01, 0.01)) for _ in range(150)],
           "globe": [(math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 360)) for _ in range(200)]}[place]
    rows = [(f"{a}_{b}", a, b) for a, b in sorted({(round(a, 6), round(b, 6)) for a, b in pts})]
    df = spark.createDataFrame(rows + [("none", None, 1.0)], "cell_id string, lat_r double, lon_r double")
    found = [(r.cell_id, r.nbr) for r in NB.radius_pairs(df, cutoff_km=cutoff).collect()]
    lat, lon = np.radians([r[1] for r in rows]), np.radians([r[2] for r in rows])
    h = np.sin((lat[:, None] - lat) / 2) ** 2 + np.cos(lat)[:, None] * np.cos(lat) * np.sin((lon[:, None] - lon) / 2) ** 2
    near = 2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(h, 1))) <= cutoff
    assert len(found) == len(set(found)) and set(found) == {(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(near))}


def test_psi_matches_numpy(spark):
    rnd = np.random.default_rng(0)
    e = rnd.normal(0, 1, 3000)
    a = rnd.normal(0.3, 1.2, 2000)
    ref = spark.createDataFrame([(float(x),) for x in e], "f double")
    act = spark.createDataFrame([(float(x),) for x in a], "f double")
    got = psi_table(ref, act, ["f"]).first()["psi"]
    q = np.unique(np.quantile(e, np.linspace(0, 1, 11)))
    q[0], q[-1] = -np.inf, np.inf
    ee = np.clip(np.histogram(e, q)[0] / len(e), 1e-6, None)
    aa = np.clip(np.histogram(a, q)[0] / len(a), 1e-6, None)
    assert math.isclose(got, float(np.sum((aa - ee) * np.log(aa / ee))), rel_tol=1e-9)


def test_permutation_is_one_over_the_whole_table(spark):
    from cellrisk.operators.models import numbered, permuted
    df = spark.createDataFrame([(i, float(i % 17), float(i)) for i in range(500)], "k long, v double, u double").repartition(5)
    assert [r["k"] for r in numbered(df, ["k"]).orderBy("_rn").collect()] == list(range(500))
    out = permuted(df, ["v", "u"], ["k"], 3, 1).collect()
    for r in range(3):
        rows = [x for x in out if x["_r"] == r]
        assert len(rows) == 500 and sorted(x["_other"]["u"] for x in rows) == sorted(x["u"] for x in rows)
        assert sum(x["_other"]["u"] != x["u"] for x in rows) > 450
    assert len({tuple(x["_other"]["u"] for x in sorted(out, key=lambda x: x["k"]) if x["_r"] == r) for r in range(3)}) == 3


def test_permutation_importance_is_that_of_a_shuffle(spark):
    from cellrisk.operators.models import assembler, permutation_importance, permuted
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(600, 3))
    y = 3 * x[:, 0] + x[:, 1]
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "k long, a double, b double, c double, risk_score double")
    model = Pipeline(stages=[assembler(["a", "b", "c"]), LinearRegression(labelCol="risk_score")]).fit(df)
    got = {r["feature"]: r for r in permutation_importance(model, df, ["a", "b", "c"], ["k"], repeats=4, seed=9).collect()}
    pairs = permuted(df, ["a", "b", "c"], ["k"], 4, 9).collect()
    for f, w in (("a", 3.0), ("b", 1.0), ("c", 0.0)):
        each = [np.mean([abs(w * (p["_other"][f] - p[f])) for p in pairs if p["_r"] == r]) for r in range(4)]  # by hand, on the same shuffles
        assert math.isclose(got[f]["importance_mean"], np.mean(each), abs_tol=1e-6) and math.isclose(got[f]["importance_std"], np.std(each), abs_tol=1e-6)
        assert math.isclose(got[f]["importance_mean"], w * 2 / math.sqrt(math.pi), abs_tol=0.1 * w + 1e-6)  # E|z - z'| of normals


def test_segments_are_one_aggregate(spark):
    from cellrisk.operators.evaluate import segmented, segments
    rnd = np.random.default_rng(4)
    rows = [(f"c{i % 9}", int(h), float(t), float(t + e), float(t - 2 * e)) for i, (h, t, e) in enumerate(zip(rnd.integers(0, 24, 400), rnd.uniform(0, 100, 400), rnd.normal(0, 8, 400)))]
    df = spark.createDataFrame(rows, "cell_id string, hour int, y double, pred_model double, pred_baseline double")
    plan = segments(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Expand" in plan
    p = pd.DataFrame(rows, columns=df.columns)
    p["em"], p["q"] = (p.y - p.pred_model).abs(), pd.qcut(p.y, 5, labels=False)
    s = segmented(df)
    assert np.allclose(sorted(r["err_model"] for r in s["per_quintile"].collect()), sorted(p.groupby("q").em.mean()))
    assert s["per_hour_group"].count() == 4 and math.isclose(s["large_error_fractions"].first()["model_gt10"], 100 * (p.em > 10).mean())
    assert [r["cell_id"] for r in s["worst_cells"].collect()] == list(p.groupby("cell_id").em.mean().nlargest(5).index)
    rank = {r["predictor"]: r["spearman"] for r in s["spearman"].collect()}
    assert math.isclose(rank["model"], p.y.rank().corr(p.pred_model.rank())) and math.isclose(rank["baseline"], p.y.rank().corr(p.pred_baseline.rank()))
