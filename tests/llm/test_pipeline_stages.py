"""Each stage against a brute-force version of it, over the smallest tables."""

import numpy as np

import corpus_pipeline as P
from cellrisk.llm import langid, toxicity
from .fixtures import odd_rows
from .test_dedup import brute_groups, brute_lines, line_rows, sha
from .test_other import brute_contaminated

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "packing"]
    now = docs
    rows = {r["doc_id"]: r for r in now.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == columns
        out = P.stored(out, "test-stage")
        got = {r["doc_id"]: r for r in out.collect()}
        texts = [(i, r["text"]) for i, r in rows.items()]
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            model = toxicity.learn(docs, labels.where(~langid.held_out(labels["doc_id"])).withColumnRenamed("toxic", "label"))
            assert set(got) == {i for i, t in texts if model.score(t or "") < toxicity.THRESHOLD}
        elif name == "line_dedup":
            assert {(i, sha(r["text"])) for i, r in got.items()} == {(i, s) for i, _, _, s in brute_lines(texts)}
            assert all(r["n_chars"] == len(r["text"]) for r in got.values())
        elif name == "ngram_jaccard_join":
            assert set(got) == {i for i, _, c in brute_groups(texts) if i == c}
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(got) == set(rows) - {x[0] for x in brute_contaminated(texts, items)}
        now, rows = out, got
    pieces = P.STAGES[-1][1](spark, now, SF).collect()
    assert {r["doc_id"] for r in pieces} == set(rows)
    total = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert sum(total.values()) == sum(r["length"] for r in pieces)
    assert np.all([r["length"] <= 2048 for r in pieces])


CLASHING = {"toxicity": "keep", "__own_id": 7, "__own_key": "k", "__own_keep": "b", "__OWN_LENGTH": 1, "__row_id": 8, "__row_key": "r"}


def test_stages_keep_odd_rows_and_clashing_columns(spark):
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` {'string' if isinstance(v, str) else 'long'}" for c, v in CLASHING.items())
    rows = odd_rows() + [(None if i is None else i + 100, t) for i, t in line_rows()]
    docs = spark.createDataFrame([(*r, *CLASHING.values()) for r in rows], schema).repartition(3)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = out.collect()
        assert {tuple(r)[2:] for r in got} == {tuple(CLASHING.values())}
        texts = sorted(((r["doc_id"], r["text"] or "") for r in got), key=repr)
        if name == "line_dedup":
            assert {(i, sha(t)) for i, t in texts} == {(i, s) for i, _, _, s in brute_lines(rows)}
        elif name == "ngram_jaccard_join":
            kept = {t for _, t in texts}
            assert {t or "" for _, t in rows if not (t or "").strip()} <= kept and "one" in kept
            assert sum(t == "one" for _, t in texts) == 1 and len(texts) < len(rows)
        else:  # nothing here is toxic or a benchmark item
            assert texts == sorted(((i, t or "") for i, t in rows), key=repr)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert P.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
