"""Models and streaming on the smallest tables."""
import math

from pyspark.sql import functions as F

from conftest import SF001


def test_ridge_matches_closed_form(spark):
    from cellrisk.plans import catalog as C
    rows = C.QUERIES["ridge_closed_form_check"](spark, SF001).collect()
    for r in rows:
        assert math.isclose(r.mllib, r.closed_form, rel_tol=1e-3, abs_tol=1e-3), r


def test_stream_scoring_idempotent(spark):
    """Two arrivals scored once each; a third run with no new files adds
    nothing (the query re-runs availableNow on the same checkpoint)."""
    from cellrisk.plans import catalog as C
    out = C.QUERIES["stream_scoring"](spark, SF001)
    req = C._requests(spark, SF001)
    from cellrisk.plans.serve import split_requests
    good, bad = split_requests(req)
    assert bad.count() > 0 and out.count() == good.count()   # rejected requests are never scored
    assert out.select("idx").distinct().count() == out.count()
    r = out.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0.0 <= r[0] <= r[1] <= 100.0


def test_champion_log_has_init_and_decisions(spark):
    from cellrisk.plans import catalog as C
    log = C.QUERIES["champion_challenger_log"](spark, SF001).collect()
    assert log[0].decision == "INIT"
    assert all(r.decision in ("KEEP", "PROMOTED", "REJECTED") for r in log[1:])
    prod = C.QUERIES["production_champion"](spark, SF001).first()
    assert prod.production_version == max(r.version for r in log if r.decision in ("INIT", "PROMOTED"))


def test_monitor_restart_keeps_the_log(spark):
    """A new Monitor on the same store carries on; a batch is stepped once."""
    from cellrisk.plans import catalog as C
    from cellrisk.plans.monitor import LOG_SCHEMA, Monitor, champion_row
    from pyspark.ml.regression import LinearRegression
    rows = [(f"{y}-{m:02d}", float(m + i), float(3 * m + i + (40 if y >= 2002 else 0))) for y in (2000, 2001, 2002) for m in range(1, 13) for i in range(20)]
    t = spark.createDataFrame(rows, "period_str string, x double, risk_score double")
    store = C._scratch(spark, "monitor-test")

    def new():
        return Monitor(features=["x"], estimator_fn=lambda df: LinearRegression(labelCol="risk_score"), store=store)
    new().init(t, "2000-12")
    new().init(t, "2000-12")
    new().step(t, "2001")
    new().step(t, "2001")
    new().step(t, "2002")
    log = new().decision_log(spark)
    assert log.columns == [f.split()[0] for f in LOG_SCHEMA.split(", ")]
    got = [(r["seq"], r["batch"], r["decision"]) for r in log.orderBy("seq").collect()]
    assert got == [(1, "init", "INIT"), (2, "2001", "KEEP"), (3, "2002", "PROMOTED")]
    assert champion_row(log).first()["version"] == 2
    assert {r["model_type"] for r in log.collect()} == {"LinearRegression"}   # the estimator, not the pipeline around it


def test_the_production_record_is_the_decisions_own(spark):
    from cellrisk.plans.monitor import LOG_SCHEMA, current_champion
    names = [f.split()[0] for f in LOG_SCHEMA.split(", ")]

    def row(**known):
        return tuple(known.get(n) for n in names)
    own = dict(target="y", psi_threshold=0.2, degrade_tol=0.15)
    log = spark.createDataFrame([
        row(seq=1, version=1, decision="INIT", train_end="2000-12", model_type="A", features=["x"], **own),
        row(seq=2, version=2, decision="PROMOTED", train_end="2001-12", model_type="B", features=["x", "z"], **own),
        row(seq=3, version=2, decision="REJECTED", train_end="2001-12", model_type="B", features=["x", "z"], **own),
        row(seq=4, version=2, decision="KEEP", train_end="2001-12", model_type="B", features=["x", "z"], **own)], LOG_SCHEMA)
    assert [tuple(r) for r in current_champion(log).collect()] == [(2, "2001-12", "B", ["x", "z"], "y", 0.2, 0.15)]
    assert [r["model_type"] for r in current_champion(log.filter("seq = 1")).collect()] == ["A"]
    assert current_champion(log.filter("seq < 0")).collect() == []


def test_champion_order_on_a_literal_table(spark):
    """Within 0.5 of the best MAE the fastest fit wins, then the smallest artefact, then the name."""
    from cellrisk.operators.models import select_champion

    def won(*rows):
        return select_champion(spark.createDataFrame(rows, "model string, MAE double, train_seconds double, artifact_kb double")).first()["champion"]
    assert won(("a", 5.0, 9.0, 9.0), ("b", 5.5, 1.0, 9.0), ("c", 5.51, 0.1, 0.1)) == "b"
    assert won(("a", 5.0, 9.0, 9.0), ("b", 5.6, 1.0, 1.0)) == "a"
    assert won(("a", 5.0, 1.0, 9.0), ("b", 5.2, 1.0, 8.0)) == "b"
    assert won(("b", 5.0, 1.0, 8.0), ("a", 5.2, 1.0, 8.0)) == "a"


def test_challenger_windows(spark):
    from cellrisk.operators.drift import challenger_windows
    periods = ["2000-01", "2000-02", "2001-05", "2001-06", "2003-01"]   # nothing in 2002
    t = spark.createDataFrame([(p,) for p in periods for _ in range(2)], "period_str string")
    got = {(r["batch"], r["period_str"]): (r["role"], r["n"]) for r in challenger_windows(t, "2000-12", 2).collect()}
    want = {("2001", p): ("holdout" if p > "2000-12" else "train", 2) for p in periods[:4]}
    want |= {("2003", p): ("holdout" if p > "2001-05" else "train", 2) for p in periods}
    assert got == want
    assert challenger_windows(t, "2003-12", 2).collect() == []


def test_split_and_replayed_arrivals_give_one_decision(spark):
    from pyspark.ml.regression import LinearRegression
    from cellrisk.plans import catalog as C
    from cellrisk.plans.monitor import Monitor
    from cellrisk.streaming.scoring import start_period_monitor, step_arrived
    rows = [(f"{y}-{m:02d}", float(m + i), float(3 * m + i)) for y in (2000, 2001, 2002) for m in range(1, 13 if y < 2002 else 5) for i in range(20)]
    t = spark.createDataFrame(rows, "period_str string, x double, risk_score double")
    base, own = C._scratch(spark, "split-arrivals"), t.filter("period_str <= '2000-12'")

    def monitor():
        return Monitor(features=["x"], estimator_fn=lambda df: LinearRegression(labelCol="risk_score"), store=base + "/store")

    def arrive(name, lo, hi):
        if name:
            t.filter(f"period_str between '{lo}' and '{hi}'").write.mode("overwrite").parquet(f"{base}/in/{name}")
        start_period_monitor(spark, base + "/in/*", t.schema, monitor(), own, base + "/ckpt").awaitTermination()
        return [(r["batch"], r["decision"]) for r in monitor().decision_log(spark).collect()]
    monitor().init(own, "2000-12")
    first = [("init", "INIT")]
    assert arrive("a", "2001-01", "2001-06") == first            # half a year: not decided yet
    done = arrive("b", "2001-07", "2001-12")
    assert [b for b, _ in done] == ["init", "2001"]
    assert arrive(None, None, None) == done                      # nothing new
    step_arrived(spark, monitor(), t.schema, own)                # a replay
    assert arrive("c", "2002-01", "2002-04") == done
    for _ in range(2):
        step_arrived(spark, monitor(), t.schema, own, closing=True)
        assert [r["batch"] for r in monitor().decision_log(spark).collect()] == ["init", "2001", "2002"]


def test_checkpoint_folder_has_to_be_named_on_a_cluster():
    import pytest
    from cellrisk.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_a_second_session_loads_what_the_first_fitted(spark, monkeypatch):
    """Keyed by rows, features and parameters; the index row points at the artefact."""
    import uuid
    from pyspark.ml import Pipeline, PipelineModel
    from cellrisk.operators import modelstore as S
    from cellrisk.operators.models import random_forest
    monkeypatch.setattr(S, "store_dir", lambda sp, d=f"{spark.conf.get('spark.sql.warehouse.dir')}/{uuid.uuid4().hex}": d)
    fits, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    df = spark.createDataFrame([(float(i % 13), float(i % 7), float(i % 13 + 2 * (i % 7))) for i in range(600)], "a double, b double, risk_score double")

    def est(trees=4):
        return random_forest(trees, 2, 6)
    model, row = S.fitted(df, ["a", "b"], est())
    again, same = S.fitted(df.repartition(5).withColumn("a", F.col("a") + 1e-12), ["a", "b"], est())  # other order, other last bits
    assert len(fits) == 1 and same == row and row["n_rows"] == 600 and row["algorithm"] == "RandomForestRegressor"
    score = [[r["prediction"] for r in m.transform(df).orderBy("a", "b").collect()] for m in (model, again, PipelineModel.load(row["path"]))]
    assert score[0] == score[1] == score[2]
    S.fitted(df, ["a"], est())
    S.fitted(df, ["a", "b"], est(5))
    S.fitted(df.limit(599), ["a", "b"], est())
    assert len(fits) == 4 and S.index(spark).count() == 4
    S.fitted_all(spark, [(df, ["a", "b"], est()), (df, ["b"], est())])
    assert len(fits) == 5


def _fresh_models(monkeypatch):
    """Forget fitted models; small candidates of which the boosted trees win."""
    from cellrisk.operators import models as M
    from cellrisk.plans import catalog as C
    made = ("candidates", "champion_name", "champion_predictions", "final_model", "bundle", "monthly_predictions", "monthly_metrics")
    monkeypatch.setattr(C, "_MEMO", {k: v for k, v in C._MEMO.items() if k[2] not in made})
    monkeypatch.setattr(M, "candidate_models", lambda train: {
        "Model: Ridge Regression": M.ridge(1e12, 1, 1.0), "Model: Gradient Boosted Trees": M.GBTRegressor(labelCol="risk_score", maxIter=4, maxDepth=4, seed=1)})
    return C


def test_the_bundle_holds_the_champion_and_its_metrics(spark, monkeypatch):
    import json
    from pyspark.ml.regression import GBTRegressionModel
    C = _fresh_models(monkeypatch)
    name = C.QUERIES["champion_selection"](spark, SF001).first()["champion"]
    assert name == "Model: Gradient Boosted Trees"
    model, meta, _ = C._final_bundle(spark, SF001)
    assert isinstance(model.stages[-1], GBTRegressionModel) and model.stages[-1].getNumTrees == 4
    assert C.QUERIES["final_bundle_registry"](spark, SF001).first()["algorithm"] == name
    found = json.loads(meta.first()["metrics"])
    want = C.QUERIES["champion_comparison"](spark, SF001).collect()
    assert sorted(found) == ["protocol_A", "protocol_B", "protocol_C"]
    for r in want:
        assert r.asDict() in found[f"protocol_{r['protocol']}"]
    assert sum(map(len, found.values())) == len(want) and all(any(x["predictor"] == name for x in v) for v in found.values())
    assert C._final_model(spark, SF001) == (name, model)   # what the serving queries score with


def test_importance_and_ablation_are_the_champions(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
    from cellrisk.operators import models as M
    C = _fresh_models(monkeypatch)
    seen = []
    monkeypatch.setattr(M, "permutation_importance", lambda model, *a: seen.append(model.stages[-1]) or spark.range(0))
    monkeypatch.setattr(M, "target_encoding_ablation", lambda pf, feats, key, est: seen.append(est(pf["B"]["train"])) or spark.createDataFrame([(1.0, 1.0)], "train_seconds double, artifact_kb double"))
    C.QUERIES["permutation_importance"](spark, SF001)
    C.QUERIES["target_encoding_ablation"](spark, SF001)
    assert isinstance(seen[0], GBTRegressionModel) and isinstance(seen[1], GBTRegressor)


def test_models_are_evaluated_on_segments_hard_cases_and_tiers(spark, monkeypatch):
    from cellrisk.operators import models as M
    C = _fresh_models(monkeypatch)
    small = M.GBTRegressor(labelCol="risk_score", maxIter=4, maxDepth=4, seed=1)
    monkeypatch.setattr(M, "boosted_trees", lambda *a: small)
    kinds = {}
    for r in C.QUERIES["champion_segments"](spark, SF001).collect():
        kinds.setdefault(r["segment_kind"], []).append(r)
    assert set(kinds) >= {"quintile", "hour_group", "large_error_pct", "worst_cell"}
    b = [(r["cell_id"], abs(r["y"] - r["pred"])) for r in C._champion_predictions(spark, SF001).filter("protocol = 'B' and predictor_type = 'model'").collect()]
    for r in kinds["large_error_pct"]:
        t = float(r["segment"].removeprefix("gt"))
        assert math.isclose(r["err_model"], 100 * sum(e > t for _, e in b) / len(b), abs_tol=1e-3)
    for r in kinds["worst_cell"]:
        own = [e for c, e in b if c == r["segment"]]
        assert len(own) == r["n"] >= 10 and math.isclose(r["err_model"], sum(own) / len(own), abs_tol=1e-3)
    hard = {(r["generation"], r["subset"]): r for r in C.QUERIES["monthly_model_hard_cases"](spark, SF001).collect()}
    base = {r["subset"]: r for r in C.QUERIES["hard_cases"](spark, SF001).collect()}
    assert set(hard) == {(g, s) for g in ("v1", "v2") for s in base}
    assert all(r["n"] == base[s]["n"] and r["MAE_persistence"] == base[s]["MAE_persistence"] for (_, s), r in hard.items())
    for r in C.QUERIES["monthly_models"](spark, SF001).filter("chosen = 1 and part = 'test'").collect():
        assert hard[r["generation"], "all"]["model"] == r["model"] and math.isclose(hard[r["generation"], "all"]["MAE_model"], r["MAE"], abs_tol=1e-3)
    tiers = C.QUERIES["monthly_model_tier_accuracy"](spark, SF001).collect()
    assert {r["generation"] for r in tiers} == {"v1", "v2"} and all(0 < r["tier_accuracy"] <= 1 for r in tiers)
