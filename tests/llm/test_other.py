import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellrisk.llm import chat, langid, toxicity, urlfilter
from cellrisk.llm.decontaminate import contaminated, without_contaminated
from cellrisk.llm.packing import cuts, encoder, pack_documents
from cellrisk.llm.queries import CONTROL
from .fixtures import frame, odd_rows, random_rows

SF = "/root/testdata/sf0.01"


# decontamination --------------------------------------------------------------

def brute_contaminated(docs, items, width=5, percent=80):
    def grams(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[p:p + width]) for p in range(max(1, len(w) - width + 1))} if w else set()
    held, own = {}, {}
    for i, t in docs:
        if i is not None:
            held.setdefault(i, set()).update(grams(t))
    for i, t in items:
        if i is not None:
            own.setdefault(i, set()).update(grams(t))
    return sorted((d, i, len(s), len(s & g)) for d, g in held.items() for i, s in own.items() if s and 100 * len(s & g) >= percent * len(s))


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_contamination_matches_brute_force(spark, broadcast):
    r = random.Random(4)
    items = [(i, " ".join(r.choices([f"q{k}" for k in range(400)], k=r.randint(1, 60)))) for i in range(40)] + [(None, "x"), (50, None), (51, "..."), (52, "a b c"), (3, "more of item three")]
    docs = odd_rows() + random_rows(5, n=20)
    for k, (i, t) in enumerate(items[:40]):
        w = t.split()
        for m in (0, 1, len(w) // 12, len(w) // 4):  # some words changed, inside a long text
            v = [*w]
            for p in r.sample(range(len(v)), min(m, len(v))):
                v[p] = "other"
            docs.append((1000 + 4 * k + m % 4, " ".join([*r.choices(["l1", "l2", "l3"], k=3000), *v, "end"]).title() + ", and so on."))
    bench = spark.createDataFrame([(*x, 7, 8) for x in items], "item_id long, text string, doc_id long, hash long")
    out = contaminated(frame(spark, docs), bench, max_broadcast=broadcast)
    want = brute_contaminated(docs, items)
    assert sorted(tuple(x)[:4] for x in out.collect()) == want and len(want) > 40
    left = {x["doc_id"] for x in without_contaminated(frame(spark, docs), bench).collect()}
    assert left == {i for i, _ in docs} - {w[0] for w in want}
    assert contaminated(frame(spark, []), bench).collect() == [] == contaminated(frame(spark, docs), bench.limit(0)).collect()


def test_a_text_without_an_id_is_searched_too(spark):
    item = " ".join(f"q{k}" for k in range(20))
    half, rest = " ".join(f"q{k}" for k in range(12)), " ".join(f"q{k}" for k in range(8, 20))
    docs = [(None, "before " + item + " after"), (None, "an innocent text without an id"), (None, None), (1, "y " + item), (2, "clean text of five words"),
            (3, half), (3, rest), (None, half), (None, rest)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = without_contaminated(frame(spark, docs), bench)
    assert left.columns == frame(spark, docs).columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == sorted([docs[1], docs[2], docs[4], docs[7], docs[8]], key=repr)
    assert {r["doc_id"] for r in contaminated(frame(spark, docs), bench).collect()} == {1, 3}


# language -----------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.held_out(docs["doc_id"])
    found = langid.identify(docs, langid.learn(docs.where(~out))).join(docs.where(out).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in found)


def test_mixed_documents_and_odd_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs)
    by = {x: " ".join(r["text"] for r in docs.where(docs.lang == x).limit(10).collect())[:4000] for x in ("en", "de")}
    half = model.mixture(by["en"] + " " + by["de"])
    assert set(half) == {"en", "de"} and 0.3 < half["en"] < 0.7
    assert set(model.mixture(by["en"])) == {"en"}
    rows = [(1, None), (2, ""), (3, "12 34 !"), (None, by["de"]), (4, by["en"]), (4, by["en"])]
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(frame(spark, rows), model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "de"), (4, "en")}
    none = langid.learn(frame(spark, []))
    assert [r["lang_pred"] for r in langid.identify(frame(spark, [(1, "some text")]), none).collect()] == ["und"]
    assert langid.identify(frame(spark, []), model).collect() == []


def _every_set(counts: dict, text: str) -> dict:
    """Plain EM over the nested sets, from the method's description."""
    names = sorted(counts)
    size = 1 << langid.GRAM_BITS
    log = {x: {g: math.log((counts[x].get(g, 0) + langid.SMOOTH) / (sum(counts[x].values()) + langid.SMOOTH * size)) for g in set(langid.grams(text).tolist())} for x in names}
    c = {g: n * langid.TEMPER for g, n in Counter(langid.grams(text).tolist()).items()}
    total = sum(c.values())

    def em(chosen):
        share = {x: 1 / len(chosen) for x in chosen}
        for _ in range(langid.ROUNDS):
            mix = {g: sum(share[x] * math.exp(log[x][g]) for x in chosen) for g in c}
            new = {x: sum(c[g] * share[x] * math.exp(log[x][g]) / mix[g] for g in c) / total for x in chosen}
            done = max(abs(new[x] - share[x]) for x in chosen) < 1e-3
            share = new
            if done:
                break
        return share, sum(c[g] * math.log(sum(share[x] * math.exp(log[x][g]) for x in chosen)) for g in c)

    first = max(names, key=lambda x: sum(c[g] * log[x][g] for g in c))
    share, _ = em(names)
    order = sorted(names, key=lambda x: -share[x])
    fee = 0.5 * math.log(max(total, 2.0))
    found = [({first: 1.0}, sum(c[g] * log[first][g] for g in c))]
    for k in range(2, len(names) + 1):
        s, v = em(order[:k])
        found.append((s, v - fee * (k - 1)))
    best = max(found, key=lambda x: x[1])[0]
    return {x: v / sum(best.values()) for x, v in best.items()}


def test_mixture_matches_plain_em_in_both_forms(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and text is not null").select("text", "lang")
    model = langid.learn(docs)
    counts = {}
    for r in docs.collect():
        counts.setdefault(r["lang"], Counter()).update(langid.grams(r["text"]).tolist())
    by = {x: [r["text"] for r in docs.where(docs.lang == x).limit(6).collect()] for x in counts}
    langs = sorted(by)
    texts = [v[0][:700] for v in by.values()] + ["x", "Ein the der", by[langs[0]][1][:400] + " " + by[langs[-1]][2][:400], " ".join(v[3][:300] for v in by.values())]
    for text in texts:
        want = _every_set(counts, text)
        for cells in (0, 1 << 40):
            got = model.mixture(text, cells)
            assert got.keys() == want.keys() and all(math.isclose(got[x], want[x], rel_tol=1e-6) for x in got), text


def test_every_language_of_three_hundred_is_predicted(spark):
    rng = np.random.default_rng(5)
    words = {f"l{i:03d}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(40)] for i in range(300)}

    def text(x, n):
        return " ".join(rng.choice(words[x], n))
    rows = [(text(x, 60), x) for x in words for _ in range(1 + (x == "l007") * 40)]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.names == sorted(words) and len(model.more) < 300 * 2000   # no dense table
    asked = frame(spark, [(i, text(x, 25)) for i, x in enumerate(words)])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(asked, model).collect()}
    assert got == {i: x for i, x in enumerate(words)}
    long = text("l001", 150_000) + " " + text("l299", 150_000)
    assert set(model.mixture(long)) == {"l001", "l299"}


def test_the_fold_is_that_of_crc32(spark):
    rows = spark.range(200).select("id", langid.held_out(F.col("id")).alias("x")).collect()
    assert all(r["x"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


# toxicity -----------------------------------------------------------------------

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    both = docs.join(labels.withColumnRenamed("toxic", "label"), "doc_id")
    out = langid.held_out(both["doc_id"])
    scored = toxicity.with_toxicity(both.where(out), toxicity.learn(docs, both.where(~out).drop("text"))).select("label", "toxicity").collect()
    caught = np.mean([r["toxicity"] >= 0.3 for r in scored if r["label"]])
    wrong = np.mean([r["toxicity"] >= 0.3 for r in scored if not r["label"]])
    assert caught > 0.85 and wrong < 0.02


def test_identity_terms_do_not_raise_the_score(spark):
    r = random.Random(1)
    plain = [f"n{i}" for i in range(50)]
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        text = r.choices(plain, k=12) + (["vile"] if bad and i % 2 else []) + (["filth"] if bad and not i % 2 else [])
        if r.random() < (0.6 if bad else 0.05):  # the labels go with one group
            text.append("muslim")
        elif r.random() < 0.2:
            text.append("christian")
        r.shuffle(text)
        rows.append((i, " ".join(text), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn(df, df.drop("text"))
    a, b = model.score("n1 n2 muslim n3"), model.score("n1 n2 christian n3")
    assert abs(a - b) < 0.05 and a < 0.3 and model.score("n1 vile filth n2") > 0.5


def test_toxicity_odd_cases(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 0), (3, "x", None), (4, "y", 7)], "doc_id long, text string, label int")
    model = toxicity.learn(df, df.drop("text"))
    rows = toxicity.with_toxicity(frame(spark, odd_rows()), model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["toxicity"] <= 1 for r in rows)
    assert toxicity.learn(df, df.where("label = 0")).score("x") < 0.01 and toxicity.learn(df, df.limit(0)).score("") < 0.01
    assert toxicity.with_toxicity(frame(spark, []), model).collect() == []


# packing ------------------------------------------------------------------------

def test_ids_are_those_of_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, own = Tokenizer.from_file(path), encoder(path)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    texts += ["", " ", "  a  b\n\n c\t\r\n", "it's we'll I'D", "日本語 テキスト 🙂🙂 e\u0301 \u00a0x\u2003y", "1234 5,6", "a<|endoftext|>b <|endoftext|>", "\x00\x01", "x" * 3000, "٣٤ ½ Ⅷ"]
    for x in texts:
        assert own(x) == t.encode(x, add_special_tokens=False).ids


def test_cuts_fill_whole_classes():
    for n in range(1, 5000):
        c = cuts(n, 2048)
        assert sum(c) == n and len(c) <= n // 2048 + 6
        assert all(2048 % s < 46 for s in c)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_round_trip(spark, capacity):
    import public_tokenizers
    encode = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rows = odd_rows() + random_rows(3)
    rows = [(1000 + k if i is None else 100 * k + i, t) for k, (i, t) in enumerate(rows)]
    out = pack_documents(frame(spark, rows), capacity=capacity).collect()
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, t in rows:
        p = sorted(pieces[i], key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(r["ids"] for r in p), "<u4").tolist()
        assert ids == [*encode(t or ""), 1] and {r["doc_tokens"] for r in p} == {len(ids)}
        assert [r["start"] for r in p] == np.cumsum([0, *(r["length"] for r in p)])[:-1].tolist()
    padding = total = 0
    for s in sequences.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == np.cumsum([0, *(r["length"] for r in s)])[:-1].tolist()
        n = sum(r["length"] for r in s)
        assert n <= capacity
        total += n
        padding += 0 if n & (n - 1) == 0 else capacity - n
    assert padding < 0.06 * total if capacity == 64 else padding < 0.01 * total
    assert pack_documents(frame(spark, [])).collect() == []


def test_packing_keeps_null_and_repeated_ids(spark):
    out = pack_documents(frame(spark, [(None, "a"), (1, "b c"), (1, "b c"), (2, None)])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out if r["start"] == 0) == [(False, 1), (False, 1), (False, 2), (True, 0)]


# chat ---------------------------------------------------------------------------

def conversations(spark, rows):
    return spark.createDataFrame([(*r, True, 5) for r in rows], "conv_id long, turn long, role string, text string, valid boolean, segment long").repartition(4)


def test_escapes_read_back():
    r = random.Random(2)
    bits = [*chat.CONTROLS, "\\", "<", "[", "]", "/", "s>", "INST", " ", "\n", "é", "<<", "</"]
    for _ in range(3000):
        t = "".join(r.choices(bits, k=r.randint(0, 12)))
        e = chat.escaped(t)
        assert chat.unescaped(e) == t and not any(c in e for c in chat.CONTROLS)
        assert len(e) == len(t) + len(re.findall(CONTROL, t))  # as the SQL counts it


def test_chat_round_trip_and_order(spark):
    r = random.Random(3)
    bits = [*chat.CONTROLS, "\\", "<", " ", "\n", "word", "é"]
    some = lambda: "".join(r.choices(bits, k=r.randint(0, 9)))
    convs = {c: [(t, r.choice(["system", "user", "assistant", "assistant", "user", "tool", "", None]), r.choice([some(), some(), None])) for t in range(r.randint(1, 9))] for c in range(80)}
    convs[80] = [(0, "system", "s"), (1, "user", "u"), (2, "assistant", "a"), (3, "user", "u2"), (4, "assistant", "")]
    convs[81] = [(None, "user", "u"), (1, "assistant", "a"), (1, "assistant", "a")]
    convs[None] = [(0, "user", "<</ROLE>>"), (1, "a<<TEXT>>b", "<<TEXT>>")]
    df = conversations(spark, [(c, *t) for c, ts in convs.items() for t in ts])
    segments = chat.format_conversations(df)
    parts = {}
    for s in segments.collect():
        parts.setdefault(s["conv_id"], []).append(s)
    digests = {r["conv_id"]: r for r in chat.formatted_digests(segments).collect()}
    assert set(parts) == set(convs) == set(digests)
    for c, ts in convs.items():
        own = sorted(((t if t is not None else -1, x or "", y or "") for t, x, y in ts))
        segs = sorted(parts[c], key=lambda s: s["segment"])
        turns, rest = chat.read_turns("".join(s["text"] for s in segs))
        assert rest == "" and turns == [(x, y) for _, x, y in own]
        assert "".join(chat.unescaped(s["text"]) for s in segs if s["loss"]) == "".join(y for _, x, y in own if x == "assistant")
        d = digests[c]
        assert d["n_turns"] == len(ts) and d["formatted_chars"] == sum(len(s["text"]) for s in segs)
    assert digests[80]["valid"] and not digests[81]["valid"]
    assert chat.formatted_digests(chat.format_conversations(df.limit(0))).collect() == []


# urls ---------------------------------------------------------------------------

URLS = ["http://a.example.org/es/1?x", "https://EXAMPLE.org/en/17#t", "http://x.example.org/en/2", "ftp://org/", "http://org", "http://b.com/fr/9", "http://com/de/", "http://com.net/fr/", "http://evilcom/fr/",
        "x", "", None, "http://", "http:///fr/", "a://b://c/d?e#f", "http://h?q/z", "http://h#f/z", "http://H.NET/Path/?q", "http://é.example.net/ä", "http://example.org/en/1", "https://x.com/DE/", "http://a.com/fr/", "http://a.com/fr/"]


def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", 1.0) for i, u in enumerate(URLS)], "page_id long, url string, host string, score double")
    out = {r["page_id"]: r for r in urlfilter.judge_urls(pages, urlfilter.labelled_by_rules(pages)).collect()}
    assert len(out) == len(URLS)
    verdict = {h + p: v for v, h, p in urlfilter.RULES}
    for i, u in enumerate(URLS):
        host, path, rule = brute_rule(u)
        r = out[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict[rule] if rule else r["verdict"] in ("allow", "block")
    none = urlfilter.judge_urls(pages, urlfilter.labelled_by_rules(pages).limit(0)).where("rule is null")
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert urlfilter.judge_urls(pages.limit(0), urlfilter.labelled_by_rules(pages)).collect() == []


def test_url_regression_learns_the_table(spark):
    r = random.Random(5)
    rows = [(f"http://{r.choice(['ads', 'track', 'click'])}{i}.example.net/{r.randint(0, 99)}", 1) for i in range(80)] + [(f"http://{r.choice(['news', 'wiki', 'docs'])}{i}.example.net/{r.randint(0, 99)}", 0) for i in range(80)]
    r.shuffle(rows)
    labelled = spark.createDataFrame(rows[:120], "url string, label int")
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[120:])], "page_id long, url string")
    got = {x["page_id"]: x["verdict"] for x in urlfilter.judge_urls(pages, labelled, rules=[]).collect()}
    assert np.mean([got[i] == ("block" if y else "allow") for i, (_, y) in enumerate(rows[120:])]) > 0.95
