"""Large forests on MLlib, fitted a few trees at a time.

MLlib grows all trees of one fit in the driver, some 500 bytes a node, and keeps
bin statistics of every open node in each partition: 200 deep trees outgrow a
driver.  Trees of a forest do not depend on each other, so ``fit_forest`` makes
fits of a few trees, each with a seed of its own, saves each and lets go of it.
Parameters, rows and number of trees are those of the estimator; the trees differ
from those of a single fit as they do under another seed.

The fitted forest is a table of its trees (tree, right, feature, value: arrays in
the order that MLlib saves nodes, a node's left child being the next one).
``ForestModel`` scores with them: 14 bytes a node, compressed to about half, go to the tasks.
"""

from __future__ import annotations

import gc
import pickle
import zlib
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce
from threading import Lock

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fits of trees that the driver has room for, of all forests of the process.
FITS_AT_ONCE = 8

#: Nodes that those fits may hold in the driver together: a tree has a node for
#: each row at most (with two rows a leaf), so more rows make smaller fits.
NODES_AT_ONCE = 600_000

#: Fits that run beside each other: fewer than there is room for, as one that is
#: being saved holds its nodes again as rows.
FITS_RUNNING = 5

_FITS = ThreadPoolExecutor(FITS_RUNNING)
_RELEASING = Lock()


def _release() -> None:
    """Python's handle of a model's writer is in a reference cycle; until that is
    collected the driver's JVM keeps the model.  One at a time: a collection that
    meets another does nothing."""
    with _RELEASING:
        gc.collect()


def trees_per_fit(n_rows: int) -> int:
    return max(1, NODES_AT_ONCE // (FITS_AT_ONCE * max(n_rows, 1)))


def in_groups(estimator, n_rows: int) -> bool:
    """Whether ``estimator`` is a forest that takes more than one fit."""
    from pyspark.ml.regression import RandomForestRegressor
    return isinstance(estimator, RandomForestRegressor) and estimator.getNumTrees() > trees_per_fit(n_rows)


def _trees(spark, path: str, firsts: list[int]) -> DataFrame:
    """(tree, right, feature, value) of the MLlib forests saved under ``path``; a leaf
    has no right child and its prediction as value.  The first tree of each fit is read
    from its folder's name, so one plan packs all of them."""
    n, leaf = F.col("nodeData"), F.col("nodeData.leftChild") < 0
    saved = spark.read.option("basePath", path).parquet(*[f"{path}/first={k}/data" for k in firsts])
    nodes = saved.select(
        (F.col("treeID") + F.col("first").cast("int")).alias("tree"), n["id"].alias("id"), F.when(leaf, 0).otherwise(n["rightChild"]).alias("right"),
        F.when(leaf, 0).otherwise(n["split"]["featureIndex"]).cast("short").alias("feature"),
        F.when(leaf, n["prediction"]).otherwise(n["split"]["leftCategoriesOrThreshold"][0]).alias("value"))
    return (nodes.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("id", "right", "feature", "value"))).alias("n"))
            .select("tree", "n.right", "n.feature", "n.value"))


def fit_forest(rows: DataFrame, features: list[str], estimator, n_rows: int, path: str) -> PipelineModel:
    """(assembler, forest) fitted on ``rows`` in fits of a few trees, kept under ``path``."""
    from cellrisk.operators.models import assembler
    from cellrisk.operators.panel import materialize
    spark, size, total = rows.sparkSession, trees_per_fit(n_rows), estimator.getNumTrees()
    ready = materialize(assembler(features).transform(rows).select(estimator.getFeaturesCol(), estimator.getLabelCol()))

    def part(first: int) -> None:
        own = estimator.copy({estimator.numTrees: min(size, total - first), estimator.seed: estimator.getSeed() + first})
        own.fit(ready).save(f"{path}/first={first}")
        _release()
    firsts = list(range(0, total, size))
    for f in [_FITS.submit(inheritable_thread_target(spark)(part), first) for first in firsts]:
        f.result()
    _trees(spark, path, firsts).write.parquet(f"{path}/trees")
    forest = ForestModel(spark.read.parquet(f"{path}/trees"))
    forest._set(featuresCol=estimator.getFeaturesCol(), predictionCol=estimator.getPredictionCol())
    return PipelineModel([assembler(features), forest])


def walk(right: np.ndarray, feature: np.ndarray, value: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row of ``x`` ends in: left where the feature
    is at most the threshold, so NaN goes right, as in MLlib."""
    at, moving = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        moving = moving[right[at[moving]] > 0]
        if not len(moving):
            return value[at]
        node = at[moving]
        at[moving] = np.where(x[moving, feature[node]] <= value[node], node + 1, right[node])


class _Packed:
    """Trees as tasks compressed them, unpacked where they score: the driver only passes them on,
    and a broadcast is a file on the driver and on each executor."""

    def __init__(self, packed: list):
        self._packed = packed

    @cached_property
    def trees(self) -> list:
        return [pickle.loads(zlib.decompress(t)) for t in self._packed]


def _pack(batches):
    for batch in batches:
        arrays = [[np.asarray(r.values) for r in batch.column(c)] for c in ("right", "feature", "value")]
        packed = [zlib.compress(pickle.dumps(t, 5), 1) for t in zip(*arrays)]
        yield pa.RecordBatch.from_arrays([batch.column("tree").cast(pa.int32()), pa.array(packed, pa.binary())], ["tree", "packed"])


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """Mean of the trees of a table (tree, right, feature, value)."""

    mean = True

    def __init__(self, trees: DataFrame | None = None):
        super().__init__()
        self.trees, self._sent = trees, None

    @property
    def getNumTrees(self) -> int:
        return self.trees.count()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        if self._sent is None:
            packed = sorted(tuple(r) for r in self.trees.select("tree", "right", "feature", "value").mapInArrow(_pack, "tree int, packed binary").collect())
            self._sent = spark.sparkContext.broadcast(_Packed([bytes(t) for _, t in packed]))
        sent, mean = self._sent, self.mean

        @F.pandas_udf("double")
        def predict(features: pd.Series) -> pd.Series:
            x, trees = np.stack(features.to_numpy()) if len(features) else np.zeros((0, 1)), sent.value.trees
            return pd.Series(reduce(np.add, (walk(*tree, x) for tree in trees)) / (len(trees) if mean else 1))
        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(F.col(self.getFeaturesCol()))))

    def copy(self, extra=None) -> ForestModel:
        """A copy sends its trees for itself."""
        that = super().copy(extra)
        that._sent = None
        return that

    def release(self) -> None:
        """Let go of the trees that were sent; what they score has to be written by then."""
        if self._sent is not None:
            self._sent.destroy()
            self._sent = None

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


class BoostedModel(ForestModel):
    """Sum of the trees of a table, whose leaves hold their step."""

    mean = False


def release(models) -> None:
    """``ForestModel.release`` of fitted pipelines."""
    for stage in (stage for m in models for stage in m.stages):
        if isinstance(stage, ForestModel):
            stage.release()


class _ForestWriter(MLWriter):
    def __init__(self, instance: ForestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.trees.write.parquet(path + "/trees")


class _ForestReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(path + "/trees"))
        model._resetUid(found["uid"])
        DefaultParamsReader.getAndSetParams(model, found)
        return model
