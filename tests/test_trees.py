"""Forests and boosted trees grown inside tasks."""
import math
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

FEATURES = ["a", "b", "c"]


@pytest.fixture
def store(spark, monkeypatch):
    from cellrisk.operators import modelstore as S
    monkeypatch.setattr(S, "store_dir", lambda sp, d=f"{spark.conf.get('spark.sql.warehouse.dir')}/{uuid.uuid4().hex}": d)
    return S


def _values(n=800):
    r = random.Random(5)
    rows = [(r.gauss(0, 1), float(i % 9), r.random()) for i in range(n)]
    return [(a, b, c, 3 * a + b * c + r.gauss(0, 0.3)) for a, b, c in rows]


def _rows(spark, values):
    return spark.createDataFrame(values, "a double, b double, c double, risk_score double")


def _jobs(spark, work):
    group, sc = uuid.uuid4().hex, spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = work()
        return out, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)


def _predictions(model, df):
    return {(r["a"], r["b"], r["c"]): r["prediction"] for r in model.transform(df).collect()}


def test_boosting_is_mllibs_without_a_job_for_each_level(spark, store):
    from cellrisk.operators.models import assembler, boosted_trees
    df, est = _rows(spark, _values()), boosted_trees(30, 4, 0.1)
    want = est.fit(assembler(FEATURES).transform(df.coalesce(1)))
    (model, row), jobs = _jobs(spark, lambda: store.fitted(df, FEATURES, est))
    assert jobs < 30   # 30 rounds of four levels or more
    assert model.stages[-1].getNumTrees == 30 and (row["algorithm"], row["n_rows"]) == ("GBTRegressor", 800)
    every = df.unionByName(df.limit(2).withColumns({"a": F.lit(99.0), "c": F.col("c") - 7}))
    mllib = _predictions(want, assembler(FEATURES).transform(every))
    for m in (model, PipelineModel.load(row["path"])):
        got = _predictions(m, every)
        assert got.keys() == mllib.keys() and all(math.isclose(got[k], mllib[k], abs_tol=1e-6) for k in got)


def test_a_forest_takes_few_jobs_and_errs_as_mllibs(spark, store):
    from cellrisk.operators.models import assembler, random_forest
    values = _values()
    train, rest = _rows(spark, values[:600]), _rows(spark, values[600:])
    (model, row), jobs = _jobs(spark, lambda: store.fitted(train, FEATURES, random_forest()))
    assert jobs < 30   # two fits of up to 30 levels
    trees = model.stages[-1].trees.collect()
    assert sorted(r["tree"] for r in trees) == list(range(200)) and len({tuple(r["value"]) for r in trees}) == 200
    mae = lambda m, d: m.transform(d).agg(F.avg(F.abs(F.col("prediction") - F.col("risk_score")))).first()[0]
    mllib = random_forest(60).fit(assembler(FEATURES).transform(train.coalesce(1)))
    assert mae(model, rest) < 1.1 * mae(mllib, assembler(FEATURES).transform(rest))
    nodes = sum(len(r["value"]) for r in trees) / 200
    assert 0.9 < nodes / (mllib.totalNumNodes / 60) < 1.1


def test_a_fit_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    from cellrisk.operators.models import random_forest
    from cellrisk.operators.trees import fit_in_tasks
    values, made = _values(200), []
    for k, rows in enumerate((values, values[::-1])):
        model = fit_in_tasks(_rows(spark, rows).repartition(3), FEATURES, random_forest(6), f"{tmp_path}/{k}")
        made.append(sorted((r["tree"], *r["right"], *r["feature"], *r["value"]) for r in model.stages[-1].trees.collect()))
    assert made[0] == made[1]


def test_which_fits_are_grown_in_tasks():
    from cellrisk.operators import trees as T
    from cellrisk.operators.models import boosted_trees, random_forest, ridge
    assert T.in_tasks(boosted_trees(), 1) and T.in_tasks(boosted_trees(), T.ROWS_IN_TASK) and T.in_tasks(random_forest(), 15_792)
    assert not T.in_tasks(boosted_trees(), 0) and not T.in_tasks(boosted_trees(), T.ROWS_IN_TASK + 1)
    assert not T.in_tasks(boosted_trees(4, 4), 600) and not T.in_tasks(random_forest(10, 2, 6), 600) and not T.in_tasks(ridge(), 600)
    assert not T.in_tasks(boosted_trees().setSubsamplingRate(0.5), 600) and not T.in_tasks(random_forest().setMinInfoGain(0.1), 15_792)


def test_labels_have_to_be_numbers(spark, store):
    from cellrisk.operators.models import boosted_trees
    df = _rows(spark, [*_values(20), (1.0, 1.0, 1.0, None)])
    with pytest.raises(Exception, match="labels must not be null"):
        store.fitted(df, FEATURES, boosted_trees())


def test_thresholds_by_hand():
    from cellrisk.operators.trees import thresholds
    assert thresholds(np.array([3.0, 1.0, 1.0, 2.0, np.nan]), 32).tolist() == [1.5, 2.5]
    assert thresholds(np.array([4.0, 4.0]), 32).tolist() == []
    # shares of 2.5 rows: the five zeros pass the first, 1.0 is nearest to the second, 3.0 to the third (7.5 lies between 2.0 and 3.0)
    assert thresholds(np.array([0.0] * 5 + [1.0, 2.0, 3.0, 4.0, 5.0]), 4).tolist() == [0.5, 1.5, 3.5]


@pytest.mark.parametrize("seed", range(4))
def test_each_node_is_split_where_the_variance_falls_most(seed):
    """Every node against all splits tried one by one; leaves hold their rows' mean; histograms in parts."""
    from cellrisk.operators import trees as T
    rng = np.random.default_rng(seed)
    x, y = np.round(rng.normal(size=(60, 3)), 1), rng.normal(size=60)
    x[0, 1] = np.nan
    splits, bins, y = T.binned(x, y, 8)
    w = rng.poisson(1.0, 60).astype(float)
    old, T.CELLS = T.CELLS, 16
    try:
        (right, feature, value), own = T.grow(bins, splits, y, w, 4, 2, 3, rng)
    finally:
        T.CELLS = old
    sse = lambda m: float(np.sum(w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2)) if w[m].sum() else 0.0

    def check(at, m, depth):
        options = [sse(m) - sse(m & (bins[j] <= b)) - sse(m & (bins[j] > b)) for j in range(3) for b in range(len(splits[j]))
                   if w[m & (bins[j] <= b)].sum() >= 2 and w[m & (bins[j] > b)].sum() >= 2]
        if right[at] == 0:
            assert depth == 4 or max(options, default=0) <= 1e-9
            assert math.isclose(value[at], np.average(y[m], weights=w[m])) and np.allclose(own[m & (w > 0)], value[at])
            return 1
        b = splits[feature[at]].tolist().index(value[at])
        go = bins[feature[at]] <= b
        assert math.isclose(sse(m) - sse(m & go) - sse(m & ~go), max(options), abs_tol=1e-9)
        n = check(at + 1, m & go, depth + 1)
        assert right[at] == at + 1 + n
        return 1 + n + check(right[at], m & ~go, depth + 1)
    assert check(0, np.ones(60, bool), 0) == len(right) > 5


def test_sent_trees_are_let_go_and_sent_anew(spark, store):
    """What was scored and written stays; a copy and a later call send the trees themselves."""
    from cellrisk.operators.forest import release
    from cellrisk.operators.models import boosted_trees
    df = _rows(spark, _values(100))
    model, _ = store.fitted(df, FEATURES, boosted_trees(20, 4, 0.1))
    own = model.copy()
    want, later = _predictions(model, df), own.transform(df)
    sent = model.stages[-1]._sent._path
    release([model])
    assert model.stages[-1]._sent is None and not os.path.exists(sent)
    assert {(r["a"], r["b"], r["c"]): r["prediction"] for r in later.collect()} == want == _predictions(model, df)
