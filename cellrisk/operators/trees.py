"""Forests and boosted trees grown inside tasks.

MLlib grows a tree level by level, with Spark jobs for each: deep forests in fits
of a few trees, and rounds of boosting, are thousands of jobs one after another,
whose start takes minutes however few the rows.  Rows that a task has room for are
binned once instead (a byte a value) and sent to all executors, where each task
grows whole trees of a forest; the rounds of boosting, each of which needs the one
before, are one task.  More rows, and fits of few jobs, stay with MLlib.

Parameters, thresholds, gains and stopping are MLlib's: quantile thresholds (from
all rows, where MLlib samples 10 000), variance gain, Poisson bootstrap and a third
of the features a node for forests, squared error for boosting.  Boosting so gives
MLlib's trees; those of a forest differ as under another seed.  Rows are put in
order first, so a fit depends on the rows alone, not on how they arrive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a fit that a task grows trees on: 26 features of them take 6.5 MB.
ROWS_IN_TASK = 250_000

#: Levels, each a Spark job or more, that MLlib may grow one after another.
LEVELS_IN_MLLIB = 50

#: Cells (node x bin) of the histograms that are held at once.
CELLS = 1 << 20

#: Parameters that are followed here, or that only say how MLlib goes about it.
FOLLOWED = {"featuresCol", "labelCol", "predictionCol", "numTrees", "maxIter", "stepSize", "maxDepth", "maxBins",
            "minInstancesPerNode", "seed", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval"}


def in_tasks(estimator, n_rows: int) -> bool:
    """Whether the trees of ``estimator`` are grown here."""
    from cellrisk.operators.forest import trees_per_fit
    if isinstance(estimator, RandomForestRegressor):
        fits = -(-estimator.getNumTrees() // trees_per_fit(n_rows))
    elif isinstance(estimator, GBTRegressor):
        fits = estimator.getMaxIter()
    else:
        return False
    return (0 < n_rows <= ROWS_IN_TASK and fits * estimator.getMaxDepth() > LEVELS_IN_MLLIB and estimator.getMaxBins() <= 256
            and all(p.name in FOLLOWED or not estimator.isSet(p) for p in estimator.params))


def thresholds(x: np.ndarray, max_bins: int) -> np.ndarray:
    """Where MLlib may split a column: between all its values, or between those next
    to equal shares of the rows."""
    values, counts = np.unique(x[~np.isnan(x)], return_counts=True)
    between = (values[:-1] + values[1:]) / 2.0
    splits = min(max_bins, len(x)) - 1
    if len(between) <= splits:
        return between
    seen = np.cumsum(counts)
    both, stride = seen[:-1] + seen[1:], counts.sum() / (splits + 1)
    found, at, target = [], 0, stride
    while (at := max(at, int(np.searchsorted(both, 2 * target, side="right")))) < len(between):
        found.append(at)
        at, target = at + 1, target + stride
    return between[found]


def binned(x: np.ndarray, y: np.ndarray, max_bins: int) -> tuple:
    """(thresholds of each column, bins as column x row, labels), rows in order."""
    if np.isnan(y).any() or np.isinf(y).any():
        raise ValueError("labels must not be null, NaN or infinite")
    order = np.lexsort((y, *x.T))
    x, y = x[order], y[order]
    splits = [thresholds(c, max_bins) for c in x.T]
    return splits, np.stack([np.searchsorted(s, c).astype(np.uint8) for s, c in zip(splits, x.T)]), y


def _best_splits(bins, sizes, rows, node, w, wy, k: int, chosen, min_leaf: int) -> tuple:
    """(feature, bin) of the split with the largest variance gain of ``k`` nodes, whose
    rows are ``rows``; feature -1 where none gains."""
    gain, feature, split = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64)
    for j, size in enumerate(sizes):
        if size < 2:
            continue
        r, at, a, b, nodes = rows, node, w, wy, np.arange(k)
        if chosen is not None:
            nodes = np.flatnonzero(chosen[:, j])
            mine = chosen[node, j]
            r, at, a, b = rows[mine], (np.cumsum(chosen[:, j]) - 1)[node[mine]], w[mine], wy[mine]
        if not len(nodes):
            continue
        key = at * size + bins[j, r]
        lw = np.bincount(key, a, len(nodes) * size).reshape(-1, size).cumsum(axis=1)
        ls = np.bincount(key, b, len(nodes) * size).reshape(-1, size).cumsum(axis=1)
        tw, ts, lw, ls = lw[:, -1:], ls[:, -1:], lw[:, :-1], ls[:, :-1]
        rw, rs = tw - lw, ts - ls
        with np.errstate(divide="ignore", invalid="ignore"):
            g = (ls * ls / lw + rs * rs / rw - ts * ts / tw) / tw
        g[(lw < min_leaf) | (rw < min_leaf)] = -np.inf
        best = g.argmax(axis=1)
        g = g[np.arange(len(nodes)), best]
        more = g > gain[nodes]
        gain[nodes[more]], feature[nodes[more]], split[nodes[more]] = g[more], j, best[more]
    return feature, split


def grow(bins: np.ndarray, splits: list, y: np.ndarray, w: np.ndarray, depth: int, min_leaf: int, n_features: int, rng) -> tuple:
    """One regression tree on the rows of weight ``w``, as (right, feature, value) with a
    node's left child next to it, and the value of each row's leaf."""
    sizes, every = [len(s) + 1 for s in splits], n_features >= len(splits)
    rows = np.flatnonzero(w)
    node, leaf, first = np.zeros(len(rows), np.int64), np.zeros(len(y), np.int64), 0
    levels, values = [], []   # of each level: nodes that split, their features, bins and left children; values of all nodes
    k = 1
    for level in range(depth + 1):
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        wr, yr = w[rows], y[rows]
        starts = np.searchsorted(node, np.arange(k))
        weight = np.add.reduceat(wr, starts)
        values.append(np.add.reduceat(wr * yr, starts) / weight)
        leaf[rows] = first + node
        open_ = (np.maximum.reduceat(yr, starts) > np.minimum.reduceat(yr, starts)) & (weight >= 2 * min_leaf)
        if level == depth or not open_.any():
            break
        ids = np.flatnonzero(open_)
        stay = open_[node]
        rows, node = rows[stay], (np.cumsum(open_) - 1)[node[stay]]
        wr, wy = wr[stay], (wr * yr)[stay]
        feature, split = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
        step = max(1, CELLS // max(sizes))
        for a in range(0, len(ids), step):
            b = min(a + step, len(ids))
            part = slice(*np.searchsorted(node, [a, b]))
            chosen = None
            if not every:
                chosen = np.zeros((b - a, len(splits)), bool)
                np.put_along_axis(chosen, rng.random(chosen.shape).argpartition(n_features - 1, axis=1)[:, :n_features], True, axis=1)
            feature[a:b], split[a:b] = _best_splits(bins, sizes, rows[part], node[part] - a, wr[part], wy[part], b - a, chosen, min_leaf)
        cut = feature >= 0
        if not cut.any():
            break
        stay = cut[node]
        rows, node = rows[stay], node[stay]
        right = bins[feature[node], rows] > split[node]
        node = 2 * (np.cumsum(cut) - 1)[node] + right
        levels.append((first + ids[cut], feature[cut], split[cut], first + k + 2 * np.arange(cut.sum())))
        first, k = first + k, 2 * int(cut.sum())
    value = np.concatenate(values)
    size, place = np.ones(len(value), np.int64), np.zeros(len(value), np.int64)
    for ids, _, _, left in reversed(levels):
        size[ids] += size[left] + size[left + 1]
    out = np.zeros(len(value), np.int32), np.zeros(len(value), np.int16), np.empty(len(value))
    for ids, _, _, left in levels:
        place[left] = place[ids] + 1
        place[left + 1] = place[left] + size[left]
    own = value[leaf]
    for ids, feature, split, left in levels:
        out[0][place[ids]], out[1][place[ids]] = place[left + 1], feature
        value[ids] = [splits[j][s] for j, s in zip(feature, split)]
    out[2][place] = value
    return out, own


def forest_tree(data: tuple, tree: int, seed: int, depth: int, min_leaf: int) -> tuple:
    """Tree ``tree`` of a forest: a Poisson bootstrap of the rows, a third of the features a node."""
    splits, bins, y = data
    rng = np.random.default_rng([seed % 2**63, tree])
    w = rng.poisson(1.0, len(y)).astype(np.float64)
    return grow(bins, splits, y, w if w.any() else w + 1, depth, min_leaf, -(-len(splits) // 3), rng)[0]


def boosted(data: tuple, rounds: int, step: float, depth: int, min_leaf: int):
    """The trees of boosting under squared error, leaves times their step: the first
    on the labels, each other on twice what is left of them."""
    splits, bins, y = data
    left, one = y, np.ones(len(y))
    for i in range(rounds):
        rate = 1.0 if i == 0 else step
        (right, feature, value), own = grow(bins, splits, left if i == 0 else 2 * left, one, depth, min_leaf, len(splits), None)
        left = left - rate * own
        yield right, feature, np.where(right > 0, value, rate * value)


PACKED = "splits array<array<double>>, bins binary, y binary"
TREES = "tree int, right array<int>, feature array<short>, value array<double>"


def _packed(rows: DataFrame, features: list[str], label: str, max_bins: int) -> tuple:
    """``binned`` rows, made in one task: what reaches the driver is a byte a value."""
    def pack(batches):
        parts = [b.to_pandas().to_numpy(np.float64) for b in batches]
        both = np.concatenate(parts) if parts else np.zeros((0, len(features) + 1))
        splits, bins, y = binned(both[:, :-1], both[:, -1], max_bins)
        yield pa.RecordBatch.from_arrays([pa.array([splits], pa.list_(pa.list_(pa.float64()))), pa.array([bins.tobytes()]), pa.array([y.tobytes()])], ["splits", "bins", "y"])
    wide = rows.select(*[F.col(c).cast("double") for c in (*features, label)])
    r = wide.repartition(1).mapInArrow(pack, PACKED).first()
    return [np.array(s) for s in r["splits"]], np.frombuffer(r["bins"], np.uint8).reshape(len(features), -1), np.frombuffer(r["y"])


def fit_in_tasks(rows: DataFrame, features: list[str], estimator, path: str) -> PipelineModel:
    """(assembler, trees) of ``estimator`` fitted on ``rows``: the tasks that grow trees save
    them under ``path``, as part of the model."""
    from cellrisk.operators.forest import BoostedModel, ForestModel
    from cellrisk.operators.models import assembler
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(_packed(rows, features, estimator.getLabelCol(), estimator.getMaxBins()))
    depth, min_leaf, seed = estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getSeed()
    boosting = isinstance(estimator, GBTRegressor)
    if boosting:
        rounds, step = estimator.getMaxIter(), estimator.getStepSize()
        asked = spark.range(0, 1, 1, 1)
    else:
        trees = estimator.getNumTrees()
        asked = spark.range(0, trees, 1, min(trees, 4 * spark.sparkContext.defaultParallelism))

    def made(batches):
        for batch in batches:
            for first in batch.column(0).to_pylist():
                for tree in (boosted(sent.value, rounds, step, depth, min_leaf) if boosting else [forest_tree(sent.value, first, seed, depth, min_leaf)]):
                    right, feature, value = tree
                    yield pa.RecordBatch.from_arrays([pa.array([first], pa.int32()), pa.array([right], pa.list_(pa.int32())),
                                                      pa.array([feature], pa.list_(pa.int16())), pa.array([value], pa.list_(pa.float64()))], ["tree", "right", "feature", "value"])
                    first += 1
    model = (BoostedModel if boosting else ForestModel)(asked.mapInArrow(made, TREES))
    model._set(featuresCol=estimator.getFeaturesCol(), predictionCol=estimator.getPredictionCol())
    PipelineModel([assembler(features), model]).save(path)
    sent.destroy()
    return PipelineModel.load(path)
