"""Fitted pipelines in a shared store, known by what made them.

An artefact's key is a digest of the training rows (count and order-free hash,
doubles at 6 places, so that the order of additions upstream does not matter),
the feature list and the estimator with its parameters.  ``fitted`` loads the
artefact of that key or fits it: other sessions on the same store never refit.

The store is the folder that ``cellrisk.models.dir`` names, or one in the
warehouse.  A model is written first, under a name of its own, and then made
known by one index row; a session that dies before that leaves nothing that
others would load, and two that fit the same key at once leave two equal rows.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cellrisk.operators.profile import fingerprint

INDEX = ("key string, algorithm string, features array<string>, params string, n_rows long, digest string, "
         "path string, train_seconds double, artifact_kb double, fitted_at timestamp")


#: Fits that run beside each other: boosting waits for its rounds while a forest uses the cores.
PARALLEL_FITS = 6


def store_dir(spark: SparkSession) -> str:
    return spark.conf.get("cellrisk.models.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/cellrisk_models"


def index(spark: SparkSession) -> DataFrame:
    """One row per artefact that was committed."""
    from cellrisk.sources.files import exists
    root = store_dir(spark) + "/index"
    return spark.read.schema(INDEX).parquet(root + "/*") if exists(spark, root) else spark.createDataFrame([], INDEX)


def data_fingerprint(rows: DataFrame) -> Row:
    """(n_rows, digest) of training rows."""
    kinds = dict(rows.dtypes)
    return fingerprint(rows.select(*[F.round(c, 6).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in sorted(rows.columns)])).first()


def estimator_params(estimator) -> dict:
    """Set and default parameters by name; what a fit is made from beside the rows."""
    found = {p.name: v for p, v in estimator.extractParamMap().items() if p.name != "thresholds"}
    return {k: round(v, 9) if isinstance(v, float) else v for k, v in sorted(found.items())}


def artefact_key(found: Row, features: list[str], estimator) -> tuple[str, str]:
    """(key, parameters as text)."""
    params = json.dumps(estimator_params(estimator), sort_keys=True, default=str)
    parts = [type(estimator).__name__, params, list(features), int(found["n_rows"]), found["digest"]]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest(), params


def fitted(rows: DataFrame, features: list[str], estimator) -> tuple[PipelineModel, Row]:
    """The pipeline of (assembler, ``estimator``) fitted on ``rows`` (features
    and target), and its index row."""
    from cellrisk.operators.forest import fit_forest, in_groups
    from cellrisk.operators.models import _dir_kb, assembler, scratch_path, training_rows
    from cellrisk.operators.trees import fit_in_tasks, in_tasks
    spark = rows.sparkSession
    own = rows.select(*features, estimator.getLabelCol())
    found = data_fingerprint(own)
    key, params = artefact_key(found, features, estimator)
    known = index(spark).filter(F.col("key") == key).orderBy("fitted_at").first()
    if known is not None:
        return PipelineModel.load(known["path"]), known
    path = f"{store_dir(spark)}/models/{uuid.uuid4().hex}"
    tasks = in_tasks(estimator, found["n_rows"])
    ready = own if tasks else training_rows(own, found["n_rows"])
    start = time.perf_counter()
    if tasks:
        model = fit_in_tasks(own, features, estimator, path)
    elif in_groups(estimator, found["n_rows"]):
        model = fit_forest(ready, features, estimator, found["n_rows"], scratch_path(spark, "forest"))
    else:
        model = Pipeline(stages=[assembler(features), estimator]).fit(ready)
    seconds = time.perf_counter() - start
    if not tasks:
        model.save(path)
    row = [(key, type(estimator).__name__, list(features), params, int(found["n_rows"]), found["digest"], path, round(seconds, 4), round(_dir_kb(spark, path), 1))]
    (spark.createDataFrame(row, INDEX.rpartition(",")[0]).withColumn("fitted_at", F.current_timestamp()).coalesce(1)
     .write.parquet(f"{store_dir(spark)}/index/{uuid.uuid4().hex}"))
    return model, index(spark).filter(F.col("key") == key).orderBy("fitted_at").first()


def fitted_all(spark: SparkSession, jobs: list[tuple]) -> list[tuple[PipelineModel, Row]]:
    """``fitted`` of several (rows, features, estimator), each a job of its own."""
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fitted), *job) for job in jobs]]
