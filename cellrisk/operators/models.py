"""Models on MLlib: candidates, selection, importance, ablation, bundles.

Fits are distributed MLlib estimators, kept in the model store
(``modelstore``); metrics are one grouped aggregate
over a long predictions table (``evaluate.metrics``).  The driver only
loops over a handful of candidate names.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.operators.clean import locked_features
from cellrisk.operators.evaluate import metrics

TARGET = P.TARGET_COLUMN


def ridge(alpha: float = 1.0, n: int = 1, y_std: float = 1.0, standardize: bool = False):
    """Ridge as MLlib's normal-equation least squares: ``alpha`` in the
    unscaled objective maps to ``regParam = alpha / n * std_pop(y)``."""
    return LinearRegression(featuresCol="features", labelCol=TARGET, regParam=alpha / max(n, 1) * y_std,
                            elasticNetParam=0.0, standardization=standardize, solver="normal")


def random_forest(num_trees: int = 200, min_leaf: int = 2, max_depth: int = 30, seed: int = P.RANDOM_STATE):
    """Rows carry the node they are in (checkpointed to the shared folder every
    few levels), so the trees grown so far are not shipped with each level."""
    return RandomForestRegressor(featuresCol="features", labelCol=TARGET, numTrees=num_trees,
                                 minInstancesPerNode=min_leaf, maxDepth=max_depth, seed=seed, maxMemoryInMB=256,
                                 cacheNodeIds=True, checkpointInterval=10)


def boosted_trees(max_iter: int = 100, max_depth: int = 6, step: float = 0.3, seed: int = P.RANDOM_STATE):
    return GBTRegressor(featuresCol="features", labelCol=TARGET, maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, seed=seed)


#: Rows of one training partition.  Each partition of a level holds and moves bin
#: statistics of every open node, so too many cost more than they share: fits of
#: few rows use the cores by running beside each other.
ROWS_PER_PARTITION = 50_000


def training_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    """Rows in partitions of a size that suits a fit, written once: a fit of
    hundreds of rounds starts each from a flat scan."""
    from cellrisk.operators.panel import materialize
    n = df.count() if n is None else n
    return materialize(df.repartition(max(1, -(-n // ROWS_PER_PARTITION))))


def candidate_models(train: DataFrame) -> dict:
    """Name -> unfitted estimator (the three candidate families, full size)."""
    s = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(TARGET).alias("sd")).first()
    return {
        "Model: Ridge Regression": ridge(1.0, s["n"], s["sd"] or 1.0),
        "Model: Random Forest": random_forest(),
        "Model: Gradient Boosted Trees": boosted_trees(),
    }


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def prepare(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Locked feature projection (missing -> 0.0) plus kept columns."""
    return locked_features(df, features, keep=keep)


def _dir_kb(spark, path: str) -> float:
    """Size of a folder on whatever storage holds it."""
    from cellrisk.sources.files import _fs
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() / 1024.0


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local
    on a cluster: ``spark.checkpoint.dir`` names shared storage there)."""
    from cellrisk.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), "artifacts", f"{name}-{uuid.uuid4().hex[:8]}")


def train_candidates(train: DataFrame, test: DataFrame, features: list[str], key: list[str],
                     estimators: dict | None = None, clip: bool = False):
    """Fit every candidate, or load it from the model store; metrics, fit
    seconds and artefact size.  Returns (metrics DataFrame, {name: fitted PipelineModel})."""
    from cellrisk.operators.modelstore import fitted_all
    spark = train.sparkSession
    tr = prepare(train, features, keep=key + [TARGET])
    te = prepare(test, features, keep=key + [TARGET])
    estimators = estimators or candidate_models(tr)
    fitted, preds, extra = {}, [], []
    made = fitted_all(spark, [(tr, features, est) for est in estimators.values()])
    for name, (model, row) in zip(estimators, made):
        p = model.transform(te).select(*key, F.col(TARGET).alias("y"), F.col("prediction").alias("pred"))
        if clip:
            p = p.withColumn("pred", F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("pred"))))
        preds.append(p.withColumn("model", F.lit(name)))
        extra.append((name, row["train_seconds"], row["artifact_kb"]))
        fitted[name] = model
    allp = preds[0]
    for p in preds[1:]:
        allp = allp.unionByName(p)
    m = metrics(allp, ["model"])
    ex = spark.createDataFrame(extra, "model string, train_seconds double, artifact_kb double")
    return m.join(ex, "model"), fitted


def select_champion(table: DataFrame, margin: float = P.MAE_TIE_MARGIN) -> DataFrame:
    """Candidates within ``margin`` of the best MAE are ties; among ties the
    fastest fit, then the smallest artefact wins.  One row: champion, reason."""
    best = table.agg(F.min("MAE")).first()[0]
    tied = table.filter(F.col("MAE") <= F.lit(best + margin))
    n_tied = tied.count()
    win = tied.orderBy("train_seconds", "artifact_kb", "model").limit(1)
    if n_tied == 1:
        reason = F.format_string("%s has the lowest MAE (%.3f) by more than %s; accuracy decides.",
                                 F.col("model"), F.col("MAE"), F.lit(str(margin)))
    else:
        reason = F.format_string("%d candidates tie within %s MAE; %s wins on fit time (%.2f s) and size (%.1f KB).",
                                 F.lit(n_tied), F.lit(str(margin)), F.col("model"), F.col("train_seconds"),
                                 F.col("artifact_kb"))
    return win.select(F.col("model").alias("champion"), reason.alias("reason"), "MAE", "train_seconds",
                      "artifact_kb")


def numbered(df: DataFrame, by: list, out: str = "_rn") -> DataFrame:
    """Rows with their place in the order of ``by``, from 0, over the whole
    table: a range exchange, and offsets from the ranges' row counts (one small
    row for each range)."""
    from cellrisk.operators.panel import materialize
    ranged = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(w), F.lit(0)).alias("_off"))
    place = F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(out, place).drop("_part", "_off", "_at")


def permuted(df: DataFrame, columns: list[str], key: list[str], repeats: int, seed: int) -> DataFrame:
    """Every row ``repeats`` times (``_r``), each time with the ``columns`` of
    another row beside its own, in the struct ``_other``: the k-th row in order
    of the key meets the k-th in order of a seeded hash, so each repeat is one
    permutation of the whole table."""
    own = numbered(df, key)
    n = own.count()
    each = own.select(*columns, *key, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_r"))
    each = each.withColumn("_hash", F.md5(F.concat_ws("|", F.col("_r") + F.lit(seed), *[F.col(c).cast("string") for c in key])))
    others = numbered(each, ["_r", "_hash", *key]).select("_r", (F.col("_rn") - F.col("_r") * n).alias("_rn"), F.struct(*columns).alias("_other"))
    return own.join(others, "_rn").drop("_rn")


def permutation_importance(model: PipelineModel, test: DataFrame, features: list[str], key: list[str],
                           repeats: int = 5, seed: int = P.RANDOM_STATE) -> DataFrame:
    """MAE increase when one feature is shuffled, mean and std over repeats.

    Rows, features and repeats are stacked: one transform scores them all and
    one aggregate gives every error."""
    te = prepare(test, features, keep=key + [TARGET])
    both = permuted(te, features, key, repeats, seed)
    # variant f has feature f of the other row; variant "" is the row itself
    variants = F.array(*[F.struct(F.lit(v).alias("_feature"), *[(F.col(f"_other.{f}") if f == v else F.col(f)).alias(f) for f in features]) for v in ("", *features)])
    both = both.repartition(both.sparkSession.sparkContext.defaultParallelism)   # each row is scored often
    stacked = both.select(F.col(TARGET).alias("_y"), "_r", F.explode(variants).alias("v")).select("_y", "_r", "v.*")
    mae = (model.transform(stacked).groupBy("_feature", "_r").agg(F.avg(F.abs(F.col("_y") - F.col("prediction"))).alias("mae")))
    base = mae.filter("_feature = ''").select("_r", F.col("mae").alias("base"))
    return (mae.filter("_feature <> ''").join(F.broadcast(base), "_r").groupBy(F.col("_feature").alias("feature"))
            .agg(F.avg(F.col("mae") - F.col("base")).alias("importance_mean"), F.stddev_pop(F.col("mae") - F.col("base")).alias("importance_std"))
            .orderBy(F.desc("importance_mean")))


def target_encoding_ablation(protocols: dict, features: list[str], key: list[str], estimator_fn) -> DataFrame:
    """With / without the smoothed cell encoding on protocols A and B, with
    the unseen-cell percentage."""
    from cellrisk.operators.baselines import apply_target_encoding, target_encoding
    from cellrisk.operators.joins import unseen_fraction
    parts = []
    for prot in ("A", "B"):
        tr, te = protocols[prot]["train"], protocols[prot]["test"]
        unseen = unseen_fraction(tr, te)
        enc, g = target_encoding(tr)
        for label, trd, ted, feats in [
            ("without target encoding", tr, te, features),
            ("with target encoding", apply_target_encoding(tr, enc, g), apply_target_encoding(te, enc, g),
             features + ["cell_risk_mean"])]:
            m, _ = train_candidates(trd, ted, feats, key, {label: estimator_fn(trd)})
            parts.append(m.withColumn("protocol", F.lit(prot)).withColumn("unseen_cell_pct", F.lit(unseen)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dataset_row(df: DataFrame) -> dict:
    from cellrisk.operators.profile import fingerprint
    r = fingerprint(df).first()
    return {"n_rows": int(r["n_rows"]), "hash": r["digest"]}


def save_bundle(model: PipelineModel, algorithm: str, metrics_summary: dict, dataset: DataFrame,
                label_params: dict, path: str, version: str = P.MODEL_VERSION) -> DataFrame:
    """Save the fitted pipeline and a one-row metadata table next to it;
    returns the metadata row as a DataFrame."""
    spark = dataset.sparkSession
    model.save(os.path.join(path, "model"))
    found = dataset_row(dataset)
    meta = {
        "algorithm": algorithm, "feature_columns": list(P.FEATURE_COLUMNS),
        "label_params": json.dumps(label_params, sort_keys=True), "model_version": version,
        "trained_at": datetime.now(timezone.utc).isoformat(),
        "metrics": json.dumps(metrics_summary, sort_keys=True, default=str),
        "dataset_n_rows": found["n_rows"], "dataset_hash": found["hash"],
    }
    df = spark.createDataFrame([meta])   # one row
    df.write.mode("overwrite").parquet(os.path.join(path, "meta"))
    return df


def load_bundle(spark, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(os.path.join(path, "model")), spark.read.parquet(os.path.join(path, "meta"))


def registry_entry(meta: DataFrame, artifact_path: str, status: str = "champion") -> DataFrame:
    return meta.select(F.col("model_version").alias("version"), "trained_at", "algorithm",
                       F.col("metrics"), F.lit(artifact_path).alias("artifact_path"),
                       "dataset_n_rows", "dataset_hash", F.lit(status).alias("status"))


def append_registry(entry: DataFrame, path: str) -> None:
    """Append-only registry table."""
    entry.write.mode("append").parquet(path)
