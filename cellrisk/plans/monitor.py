"""Continual learning over tables: drift, challenger, decision log.

The state between batches is one folder: ``log`` holds the decision log, a
Parquet table that only grows, and ``models`` the fitted pipelines.  A step
reads the champion's row from the log, so a restarted job carries on where
the last append left off; rows are keyed by ``batch_id`` and a batch that is
in the log already is not stepped again.

Every heavy piece is a distributed job (transform, grouped PSI, MLlib fit);
the driver sees one log row and a few numbers per step.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.operators.drift import drift_decision, drift_features, drift_profile, holdout_periods, psi_table
from cellrisk.operators.models import assembler, prepare

LOG_SCHEMA = ("seq int, version int, batch string, train_end string, n_train long, model_type string, "
              "MAE_batch double, R2_batch double, psi_max double, psi_mean double, drift_detected boolean, "
              "decision string, top_drift string, reason string, holdout_end string, "
              "holdout_start string, ref_mae double, model_path string, batch_id string, "
              "features array<string>, target string, psi_threshold double, degrade_tol double")


def _scored(model, df: DataFrame, target: str) -> Row:
    """MAE and R2 of the clamped prediction, one aggregate."""
    err = F.col(target) - F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("prediction")))
    r = model.transform(df).agg(F.avg(F.abs(err)).alias("mae"), F.sum(err * err).alias("res"),
                                (F.var_pop(target) * F.count(F.lit(1))).alias("tot")).first()
    return Row(mae=float(r["mae"]), r2=float(1 - r["res"] / r["tot"]) if r["tot"] else 0.0)


@dataclass
class Monitor:
    """What does not change between batches; the rest is in ``store``."""
    features: list
    estimator_fn: object
    store: str
    target: str = P.TARGET_COLUMN
    period: str = "period_str"
    psi_threshold: float = P.PSI_THRESHOLD
    degrade_tol: float = P.DEGRADE_TOL
    holdout: int = P.HOLDOUT_PERIODS

    def decision_log(self, spark) -> DataFrame:
        from cellrisk.sources.files import exists
        path = f"{self.store}/log"
        log = spark.read.schema(LOG_SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], LOG_SCHEMA)
        return log.orderBy("seq")

    def _append(self, spark, **row) -> None:
        names = [f.split()[0] for f in LOG_SCHEMA.split(", ")]
        row |= dict(features=list(self.features), target=self.target, psi_threshold=self.psi_threshold, degrade_tol=self.degrade_tol)
        spark.createDataFrame([tuple(row.get(n) for n in names)], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.store}/log")

    def _rows(self, table: DataFrame, upto: str, before: str | None = None) -> DataFrame:
        keep = F.col(self.period) <= upto
        if before is not None:
            keep = keep & (F.col(self.period) < before)
        return prepare(table.filter(keep), self.features, keep=[self.period, self.target])

    def _fit(self, df: DataFrame) -> tuple[PipelineModel, str, str]:
        """(model, where it is saved, the estimator's name)."""
        estimator = self.estimator_fn(df)
        model = Pipeline(stages=[assembler(self.features), estimator]).fit(df)
        path = f"{self.store}/models/{uuid.uuid4().hex}"
        model.save(path)
        return model, path, type(estimator).__name__

    def init(self, table: DataFrame, train_end: str, batch_id: str = "init") -> None:
        """The first champion, unless the log has one."""
        spark = table.sparkSession
        if not self.decision_log(spark).filter(F.col("decision") == "INIT").isEmpty():
            return
        train = self._rows(table, train_end)
        model, path, name = self._fit(train)
        self._append(spark, seq=1, version=1, batch="init", train_end=train_end, n_train=train.count(), model_type=name,
                     drift_detected=False, decision="INIT", top_drift="-", reason="initial champion",
                     ref_mae=_scored(model, train, self.target)["mae"], model_path=path, batch_id=batch_id)

    def step(self, table: DataFrame, batch: str, batch_id: str | None = None) -> None:
        """Measure one batch against the champion, train a challenger if it
        drifted, append the decision."""
        spark = table.sparkSession
        batch_id = batch_id or batch
        log = self.decision_log(spark)
        if not log.filter((F.col("batch_id") == batch_id) & (F.col("batch") == batch)).isEmpty():
            return
        arrived = prepare(table.filter(F.col(self.period).startswith(batch)), self.features, keep=[self.period, self.target])
        if arrived.isEmpty():
            return
        now = champion_row(log).first()
        champion = PipelineModel.load(now["model_path"])
        reference = self._rows(table, now["train_end"], now["holdout_start"])
        names = drift_features(self.features)
        own = _scored(champion, arrived, self.target)
        decided = drift_decision(F.col("psi_max"), F.lit(own["mae"]), F.lit(now["ref_mae"]), self.psi_threshold, self.degrade_tol)
        prof = drift_profile(psi_table(reference, arrived, names), names).withColumn("drift", decided).first()
        row = dict(seq=log.agg(F.max("seq")).first()[0] + 1, version=now["version"], batch=batch, batch_id=batch_id, train_end=now["train_end"],
                   n_train=now["n_train"], model_type=now["model_type"], MAE_batch=round(own["mae"], 3), R2_batch=round(own["r2"], 3),
                   psi_max=round(prof["psi_max"], 3), psi_mean=round(prof["psi_mean"], 3), top_drift=prof["top_drift"],
                   drift_detected=bool(prof["drift"]), holdout_start=now["holdout_start"], ref_mae=now["ref_mae"], model_path=now["model_path"])
        seen = f"psi_max={prof['psi_max']:.3f}"
        if not prof["drift"]:
            self._append(spark, **row | dict(decision="KEEP", reason=f"no significant drift ({seen})"))
            return
        end = f"{batch}-12"
        window = self._rows(table, end)
        last = holdout_periods(window, end, self.holdout, self.period)
        bounds = last.agg(F.min(self.period).alias("lo"), F.max(self.period).alias("hi")).first()
        train, held = self._rows(table, end, bounds["lo"]), window.filter(F.col(self.period) >= bounds["lo"])
        challenger, path, name = self._fit(train)
        a, b = _scored(champion, held, self.target)["mae"], _scored(challenger, held, self.target)["mae"]
        row |= dict(holdout_end=bounds["hi"])
        if b <= a:
            row |= dict(version=now["version"] + 1, train_end=end, n_train=train.count(), holdout_start=bounds["lo"], ref_mae=b, model_path=path, model_type=name)
        self._append(spark, **row | dict(decision="PROMOTED" if b <= a else "REJECTED",
                                        reason=f"drift ({seen}); challenger {b:.3f} {'<=' if b <= a else '>'} champion {a:.3f}"))


def champion_row(log: DataFrame) -> DataFrame:
    """The log row of the champion: the latest INIT or PROMOTED."""
    return log.filter(F.col("decision").isin("INIT", "PROMOTED")).orderBy(F.desc("seq")).limit(1)


def current_champion(log: DataFrame) -> DataFrame:
    """The production record, seven fields of the latest INIT / PROMOTED row: it
    is part of the decision's own append, so the two never disagree.  No row in
    an empty log."""
    return champion_row(log).select(F.col("version").alias("production_version"), "train_end", "model_type", "features", "target", "psi_threshold", "degrade_tol")
