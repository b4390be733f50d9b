"""Forests in fits of a few trees."""
import gc
import math
import uuid
import weakref

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

FEATURES = ["a", "b"]


def _rows(spark):
    rows = [(float(i % 13), float(i % 7), float(i % 13 + 2 * (i % 7)) + (i * 37 % 11) / 10) for i in range(600)]
    return spark.createDataFrame(rows, "a double, b double, risk_score double")


def _small_fits(monkeypatch, spark, nodes):
    from cellrisk.operators import forest as R
    from cellrisk.operators import modelstore as S
    monkeypatch.setattr(R, "NODES_AT_ONCE", nodes)
    monkeypatch.setattr(S, "store_dir", lambda sp, d=f"{spark.conf.get('spark.sql.warehouse.dir')}/{uuid.uuid4().hex}": d)
    return R, S


def test_no_fit_holds_more_trees_than_the_rows_allow(spark, monkeypatch):
    """All trees are grown, few in each fit, no two fits under one seed."""
    from cellrisk.operators.models import random_forest
    R, S = _small_fits(monkeypatch, spark, 600 * 8 * 3)
    seen, fit = [], RandomForestRegressor._fit
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, df: seen.append((self.getNumTrees(), self.getSeed(), self.getMaxDepth(), self.getMinInstancesPerNode())) or fit(self, df))
    model, row = S.fitted(_rows(spark), FEATURES, random_forest(10, 2, 6))
    assert sorted(n for n, *_ in seen) == [1, 3, 3, 3] and len({s for _, s, *_ in seen}) == 4 and {(d, m) for *_, d, m in seen} == {(6, 2)}
    assert row["algorithm"] == "RandomForestRegressor" and row["n_rows"] == 600 and model.stages[-1].getNumTrees == 10
    trees = model.stages[-1].trees.collect()
    assert sorted(r["tree"] for r in trees) == list(range(10))
    assert len({tuple(r["value"]) for r in trees}) == 10   # no tree is another's copy


def test_the_driver_lets_go_of_each_fit_once_saved(spark, monkeypatch):
    """No MLlib writer, which holds its model, waits for Python's own collections."""
    from cellrisk.operators.models import random_forest
    R, S = _small_fits(monkeypatch, spark, 600 * 8 * 2)
    made, write = [], RandomForestRegressionModel.write

    def seen(self):
        writer = write(self)
        made.append(weakref.ref(writer._jwrite))
        return writer
    monkeypatch.setattr(RandomForestRegressionModel, "write", seen)
    gc.disable()
    try:
        model, _ = S.fitted(_rows(spark), FEATURES, random_forest(6, 2, 6))
        assert len(made) == 3 and all(r() is None for r in made)
    finally:
        gc.enable()
    assert model.stages[-1].getNumTrees == 6


def test_a_forest_scores_as_its_mllib_parts_do(spark, monkeypatch):
    from cellrisk.operators.models import assembler, random_forest
    R, S = _small_fits(monkeypatch, spark, 600 * 8 * 2)
    parts, fit = [], RandomForestRegressor._fit

    def kept(self, df):
        parts.append(fit(self, df))
        return parts[-1]
    monkeypatch.setattr(RandomForestRegressor, "_fit", kept)
    df = _rows(spark).withColumn("i", F.monotonically_increasing_id())
    odd = df.limit(3).withColumns({"a": F.lit(float("nan")), "i": F.col("i") - 100})
    every = df.unionByName(odd)
    model, row = S.fitted(df, FEATURES, random_forest(5, 2, 8))
    assert len(parts) == 3
    x = assembler(FEATURES).transform(every)
    want = {}
    for m in parts:
        for r in m.transform(x).collect():
            want[r["i"]] = want.get(r["i"], 0.0) + r["prediction"] * m.getNumTrees / 5
    for m in (model, PipelineModel.load(row["path"])):
        got = {r["i"]: r["prediction"] for r in m.transform(every).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], abs_tol=1e-9) for i in got)
        assert m.transform(every.filter("i is null")).collect() == []


def test_walk_on_a_literal_tree():
    from cellrisk.operators.forest import walk
    right, feature, value = np.array([2, 0, 4, 0, 0]), np.array([0, 0, 1, 0, 0]), np.array([1.5, 10.0, 0.0, 20.0, 30.0])
    x = np.array([[1.5, 9.0], [1.6, 0.0], [1.6, 0.1], [float("nan"), -1.0]])
    assert walk(right, feature, value, x).tolist() == [10.0, 20.0, 30.0, 20.0]


def test_small_forests_take_one_fit(spark):
    from cellrisk.operators import forest as R
    from cellrisk.operators.models import boosted_trees, random_forest
    assert not R.in_groups(random_forest(4, 2, 6), 600) and R.in_groups(random_forest(), 15_792)
    assert not R.in_groups(boosted_trees(), 10**9) and R.trees_per_fit(10**9) == 1


def test_a_forest_scores_a_stream(spark, monkeypatch):
    from cellrisk.operators.models import random_forest, scratch_path
    R, S = _small_fits(monkeypatch, spark, 600 * 8 * 2)
    df = _rows(spark)
    model, _ = S.fitted(df, FEATURES, random_forest(3, 2, 4))
    base = scratch_path(spark, "forest-stream")
    df.limit(20).write.parquet(base + "/in")
    arriving = spark.readStream.schema(df.schema).parquet(base + "/in")
    (model.transform(arriving).select("a", "b", "prediction").writeStream.format("parquet").option("path", base + "/out")
     .option("checkpointLocation", base + "/ckpt").trigger(availableNow=True).start().awaitTermination())
    got = sorted(tuple(r) for r in spark.read.parquet(base + "/out").collect())
    assert len(got) == 20 and got == sorted(tuple(r) for r in model.transform(df.limit(20)).select("a", "b", "prediction").collect())
