import hashlib
import re

import numpy as np
import pytest

from cellrisk.llm.exactdedup import QuotientFilter, exact_dedup
from cellrisk.llm.jaccard import divide_skip, jaccard_groups, one_of_each_group
from cellrisk.llm.linededup import line_digests, without_repeated_lines
from cellrisk.llm.passages import passage_digests, recompressed, without_repeated_passages
from cellrisk.llm.sharing import pack, unpack
from .fixtures import SPACE, frame, odd_rows, random_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
order = lambda i: -1 << 63 if i is None else i


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# lines ----------------------------------------------------------------------

def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(SPACE).translate(LOW)
    own = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                own.setdefault(key(line), set()).add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(own.get(key(x), ())) < min_docs or order(i) == max(own[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def line_rows():
    a, b = "A line of at least forty code points that repeats itself", "ÄÖÜ" * 14
    return [(i, f"{a}\n own {i}\n  {a.upper()}\t\n{b}\r\nshort") for i in range(9)] + odd_rows() + [(20, "\n".join([a] * 9)), (20, a), (None, a), (21, b + "x\n" + b)]


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_lines_match_brute_force(spark, chunk):
    rows = line_rows()
    assert got(line_digests(frame(spark, rows), chunk_lines=chunk)) == brute_lines(rows)


def test_lines_kept_as_text(spark):
    rows = line_rows()
    out = without_repeated_lines(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    want = {(i, s) for i, _, _, s in brute_lines(rows)}
    assert {(r["doc_id"], sha(r["text"] or "")) for r in out.collect()} == want


# exact ----------------------------------------------------------------------

def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 54, 5000, dtype=np.uint64) for _ in range(2))
    b = np.concatenate([b, a[:1000], a[:10]])
    f, g = (QuotientFilter(*np.unique(x, return_counts=True)) for x in (a, b))
    m = QuotientFilter.load(QuotientFilter.load(f.dump()).merged(QuotientFilter.load(g.dump())).dump())
    items, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    assert (m.items() == items).all() and (m.counts == counts).all()


def test_exact_matches_brute_force(spark):
    rows = odd_rows() + random_rows(3) + [(70, "a  b c"), (71, "ab c  "), (72, "a b   c "), (72, "a b   c ")]
    out = got(exact_dedup(frame(spark, rows)))
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(words(t)), []).append((i, t or ""))
    want, kept = [], {}
    for norm, g in groups.items():
        best = max(g, key=lambda r: (len(r[1]), -order(r[0])))
        kept[sha(norm)] = best[0]
        want += [(i, best[0], len(g), sha(norm)) for i, _ in g]
    assert sorted(((i, k, n, s) for i, k, n, _, s in out), key=repr) == sorted(want, key=repr)
    stays = [(i, s) for i, _, _, k, s in out if k]
    assert sorted(stays, key=repr) == sorted(((i, s) for s, i in kept.items()), key=repr)  # one row of each group


# passages -------------------------------------------------------------------

def brute_passages(rows, width):
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p:p + width])] < order(i):
                gone.update(range(p, p + width))
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width,chunk,seed,vocab", [(13, 50, 1, 30), (13, 100_000, 2, 3), (13, 300, 6, 2), (4, 100, 3, 8), (30, 200, 4, 2), (1, 100, 5, 400)])
def test_passages_match_brute_force(spark, width, chunk, seed, vocab):
    rows = random_rows(seed, vocab=vocab) + [(a if a is None else a + 100, t) for a, t in odd_rows()]
    assert got(passage_digests(frame(spark, rows), width=width, chunk_words=chunk)) == brute_passages(rows, width)


def test_a_full_filter_only_costs_work(spark):
    rows = random_rows(7, vocab=4)
    assert got(passage_digests(frame(spark, rows), chunk_words=200, filter_bits=19)) == brute_passages(rows, 13)


def test_passages_kept_as_text(spark):
    rows = random_rows(8, vocab=5)
    out = without_repeated_passages(frame(spark, rows))
    want = {i: (n, s) for i, _, n, s in brute_passages(rows, 13)}
    for r in out.collect():
        n, s = want[r["doc_id"]]
        assert sha(r["text"]) == s if n else r["text"] == dict(rows)[r["doc_id"]]


def test_symbols_that_a_passage_determines_are_the_same_wherever_it_stands():
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 4, 13, dtype=np.uint64)
    seen = []
    for _ in range(30):
        text = np.concatenate([rng.integers(0, 4, 20, dtype=np.uint64), passage, rng.integers(0, 4, 20, dtype=np.uint64)])
        s = recompressed(text, np.zeros(len(text), np.int64), 13)
        inside = (s.start >= 20) & (s.end <= 33)
        seen.append({(int(n), int(a) - 20, int(b) - 20) for n, a, b in zip(s.name[inside], s.start[inside], s.end[inside])})
    common = set.intersection(*seen)
    assert all(x == common for x in seen) and common


def test_packed_names_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 1000):
        x = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        m = rng.random(len(x)) < 0.3
        a, b = unpack(pack(x, m))
        assert (a == x).all() and (b == m).all()


# near -----------------------------------------------------------------------

def brute_groups(rows, width=5, percent=80):
    sets = []
    for _, t in rows:
        w = [x.translate(LOW) for x in words(t)]
        sets.append({tuple(w[p:p + width]) for p in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a = len(sets[i] & sets[j])
            if sets[i] and 100 * a >= percent * (len(sets[i]) + len(sets[j]) - a):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), (1 << 62, None)), (order(rows[i][0]), rows[i][0]), key=lambda x: x[0])
    return sorted(((rows[i][0], len(sets[i]), least[find(i)][1]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("seed,chunk,bucket,vocab", [(1, 100, 60, 30), (2, 100_000, 1_000_000, 30), (9, 300, 200, 6)])
def test_groups_match_brute_force(spark, seed, chunk, bucket, vocab):
    rows = random_rows(seed, n=80, vocab=vocab) + [(a if a is None else a + 100, t) for a, t in odd_rows()]
    out = jaccard_groups(frame(spark, rows), chunk_words=chunk, bucket_shingles=bucket, filter_bits=20)
    assert got(out.select("doc_id", "n_shingles", "component_id")) == brute_groups(rows)


def test_groups_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    rows = random_rows(6, vocab=8) + odd_rows()
    monkeypatch.setattr("cellrisk.llm.jaccard.BROADCAST_ROWS", 0)
    monkeypatch.setattr("cellrisk.llm.jaccard.GUEST_POSTINGS", 5)
    out = jaccard_groups(frame(spark, rows), chunk_words=40, bucket_shingles=100, filter_bits=20)
    assert got(out.drop("class_id")) == brute_groups(rows)


def test_a_chain_of_near_copies_is_one_group(spark):
    base = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(25):  # each differs from the next in one word; the ends share little
        base = [*base[1:], f"u{i}"]
        rows.append((100 - i, " ".join(base)))
    out = jaccard_groups(frame(spark, rows), chunk_words=200, bucket_shingles=100)
    assert {r["component_id"] for r in out.collect()} == {76}
    assert [r["doc_id"] for r in one_of_each_group(frame(spark, rows)).collect()] == [76]


def test_only_the_copies_of_a_repeated_or_null_id_go(spark):
    def text(k, n=60):
        return " ".join(f"{k}{i}" for i in range(n))
    rows = [(6, text("a")), (7, text("a") + " end"), (7, text("b")), (7, text("c")), (8, text("c") + " end"),  # 7 repeats: a copy of 6, a clean text, and one with a copy
            (None, text("d")), (None, text("d") + " end"), (None, text("e")), (None, text("f")), (None, text("f")), (None, None), (None, ""), (9, text("d") + " more"),
            (10, text("g")), (10, text("g"))]
    left = one_of_each_group(frame(spark, rows))
    assert left.columns == frame(spark, rows).columns
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    d = [x for x in got if x[1] in (text("d"), text("d") + " end")]
    assert len(d) == 1 and d[0][0] is None
    want = [rows[0], rows[2], rows[3], d[0], rows[7], rows[8], rows[10], rows[11], rows[13]]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_divide_skip_finds_every_component():
    rng = np.random.default_rng(3)
    for _ in range(20):
        base = [rng.integers(0, 300, 60) for _ in range(3)]
        sets = []
        for _ in range(30):
            s = base[rng.integers(3)].copy()
            s[rng.integers(0, 60, rng.integers(0, 12))] = rng.integers(300, 600)
            sets.append(np.unique(s).astype(np.uint64))
        root = {}

        def find(i):
            while root.get(i, i) != i:
                i = root[i]
            return i
        for i, j in divide_skip(sets, 80):
            root[find(i)] = find(j)
        for i in range(30):
            for j in range(i):
                a = len(np.intersect1d(sets[i], sets[j]))
                if 100 * a >= 80 * (len(sets[i]) + len(sets[j]) - a):
                    assert find(i) == find(j)


def test_empty_tables(spark):
    none = frame(spark, [])
    for f in (line_digests, exact_dedup, passage_digests, jaccard_groups, one_of_each_group, without_repeated_lines, without_repeated_passages):
        assert f(none).collect() == []


def test_equal_words_have_equal_names():
    import random
    from cellrisk.llm.common import word_names
    r = random.Random(4)
    bits = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "a", "b", "A", "ab", "ba", "é", "É", " ", " ", "\x1c", "\x00", "word", "x" * 70]
    texts = ["".join(r.choices(bits, k=r.randint(0, 25))) for _ in range(3000)] + ["", " "]
    for lower in (False, True):
        seen = {}
        for t, names in zip(texts, word_names([t.encode() for t in texts], lower)):
            own = (t.encode().lower() if lower else t.encode()).split()
            assert len(own) == len(names)
            for w, n in zip(own, names):
                assert seen.setdefault(w, int(n)) == int(n)
        assert len(set(seen.values())) == len(seen)


def test_lists_do_not_depend_on_batches():
    import pyarrow as pa
    from cellrisk.llm.jaccard import _lists
    rng = np.random.default_rng(6)
    rows = sorted((int(g), int(c), int(c) % 7 + 1) for g, c in zip(rng.integers(0, 60, 400), rng.integers(0, 8, 400)))
    want = []
    for g in sorted({r[0] for r in rows}):
        own = sorted({r for r in rows if r[0] == g})
        if len(own) > 2:
            want += [(*r, own[0][1], own[0][2], False) for r in own]
        elif len(own) == 2:
            want.append((*own[1], own[0][1], own[0][2], True))
    for size in (1, 2, 3, 7, 50, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[i:i + size])], ["gram", "cls", "n"]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in _lists(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == sorted(want)


def _reached(links):
    """(node, smallest reachable) by plain union."""
    root = {x: x for ab in links for x in ab}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return {x: r for x, r in root.items() if any(x in ab and ab[0] != ab[1] for ab in links)}


def test_few_links_take_no_round(spark, monkeypatch):
    """Each round is three jobs with joins that the driver plans and broadcasts:
    links that one task holds are joined before the first."""
    from cellrisk.llm import common
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (200, 150), (150, 120)]
    names, kept = [], common.stored
    monkeypatch.setattr(common, "stored", lambda df, name: names.append(name) or kept(df, name))
    got = common.components(spark.createDataFrame(links, "a long, b long").coalesce(1)).collect()
    assert {r["node"]: r["component"] for r in got} == _reached(links) and len(got) == len(_reached(links))
    assert names == ["links"]


def test_links_of_many_tasks_are_joined_in_rounds(spark):
    from cellrisk.llm import common
    links = [(i * 37 % 101, (i + 1) * 37 % 101) for i in range(60)] + [(500 + i, 500) for i in range(30)] + [(-5, -9)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = common.components(spark.createDataFrame(links, "a long, b long")).collect()
        none = common.components(spark.createDataFrame([], "a long, b long")).collect()
    finally:
        spark.conf.unset(key)
    assert {r["node"]: r["component"] for r in got} == _reached(links) and len(got) == len(_reached(links))
    assert none == []


def test_a_task_joins_its_links_block_by_block(monkeypatch):
    import pyarrow as pa
    from cellrisk.llm import common
    monkeypatch.setattr(common, "STAR_LINKS", 3)
    batch = lambda *uv: pa.RecordBatch.from_arrays([pa.array([u for u, _ in uv], pa.int64()), pa.array([v for _, v in uv], pa.int64())], ["u", "v"])
    got = [b.to_pylist() for b in common.stars([batch((9, 8), (8, 4)), batch(), batch((7, 4), (3, 2)), batch((2, 1))])]
    assert got == [[{"u": u, "v": v} for u, v in block] for block in ([(3, 2), (7, 4), (8, 4), (9, 4)], [(2, 1)])]
