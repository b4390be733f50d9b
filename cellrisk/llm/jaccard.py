"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document's set holds its distinct shingles of ``width`` lower-cased (A-Z)
words; a shorter text is one shingle.  Two documents link when the intersection
is at least ``percent`` % of the union.  The result names, for each document,
the smallest doc_id that links reach, which keeps every link's effect without
writing out the pairs of a group.

Equal sets form a class; everything below works on classes.  A partner of a set
of n shingles shares at least T = ceil(n * percent / 100) of them.  DivideSkip
sets L = T - t of the query's inverted lists aside as long ones; a partner must
then occur on at least t of the remaining short lists:

1. Shingles that many documents of a chunk share are marked in a bit table of
   fixed size and ordered last, so they are the long lists.  Any order is exact;
   this one keeps the short lists short.
2. Postings of the n - L short lists travel only if another document may share
   them (bit table again) and are grouped into inverted lists.
3. For each list the first class is a pivot, and a class follows the pivot it
   meets on most lists, if on t of them.  Classes that follow one another make a
   bucket; a class without a pivot joins the bucket it meets on most lists, if
   on t of them.  A bucket holds whole sets, is split by its size, and is searched by
   DivideSkip: merge the short lists, keep those on enough of them for the two
   sizes, probe the long lists by binary search.
4. A bucket's part is searched completely, so what is left are pairs between
   parts.  Lists of three classes or more that still hold several components and
   parts give them; lists of two give their pair itself, kept if it is
   on enough lists with all the longer lists that the two could share.  The pairs
   of longer lists are counted in tasks: a class that meets a part on enough
   lists is probed against the part's own lists there.  These
   pairs become buckets of their own and are searched in the same way.

A pair of sizes a and b that links shares at least o = ceil(percent * (a + b) /
(100 + percent)) shingles.  Of these at most L(a) and at most L(b) are on long
lists, and both orders are one, so o - max(L(a), L(b)) are on short lists of both.

Classes and shingles are compared by 64-bit names (a false match has a chance of
about n^2 / 2^65).

Defined cases: a null, empty or blank text has no shingles, links with nothing
and is its own component; a null doc_id orders before all others; rows that
repeat a doc_id are rows of their own; empty tables give empty results; extra
columns are ignored, or kept by ``one_of_each_group``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.llm.common import MIX, NO_ID, BitTable, components, documents, free_names, join_hot, mixed, null_id, starts_of, stored, whole_groups, window_names
from cellrisk.llm.sharing import chunks, shared_names, spots

WIDTH, PERCENT = 5, 80
CHUNK_WORDS = 500_000
FILTER_BITS = 26
#: Sum over chunks of the documents that share a shingle, from which it is frequent.
FREQUENT = 16
#: Shingles that one part of a bucket holds.
BUCKET_SHINGLES = 1_000_000
#: Rows of (class, its document, bucket, part) up to which they are broadcast: 28 bytes each.
BROADCAST_ROWS = 1_000_000
#: Candidates that a query probes one by one before it probes them together.
SINGLE_PROBES = 16


def shingles(names: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle names of one document."""
    return np.unique(window_names(names, min(width, len(names)))) if len(names) else np.zeros(0, np.uint64)


def least_overlap(n, percent: int):
    """T: what a partner of a set of n shares at least."""
    return -(-n * percent // 100)


def least_short(n):
    """t: on how many of the short lists a partner occurs at least."""
    return 1 + n // 20


def pair_overlap(a, b, percent: int):
    """What linked sets of these sizes share at least."""
    return -(-(a + b) * percent // (100 + percent))


def set_name(s: np.ndarray) -> int:
    """Of the sum and the exclusive or of a set's names, and its size."""
    whole = np.array([np.add.reduce(s)], np.uint64) * MIX ^ np.bitwise_xor.reduce(s) ^ np.uint64(len(s))
    return int(mixed(whole).view(np.int64)[0])


def _short(s: np.ndarray, frequent: BitTable, filter_bits: int, percent: int) -> np.ndarray:
    """The shingles of the short lists: all but the L last in the global order."""
    n = len(s)
    k = n - least_overlap(n, percent) + least_short(n)
    return s[np.argsort(frequent.has(spots(s, filter_bits)), kind="stable")[:k]]


def _sets(batches: Iterator[pa.RecordBatch], width: int, chunk: int) -> Iterator[list]:
    """Chunks as lists of (doc_id, set, text_key)."""
    for c in chunks(batches, chunk, lower=True):
        names, _, begin, _, _ = c.arrays()
        all_of = window_names(names, width)
        yield [(doc, np.unique(all_of[i:i + len(x) - width + 1]) if len(x) >= width else shingles(x, width), key) for doc, key, i, x in zip(c.ids, c.keys, begin, c.names)]


def _scan(width: int, chunk: int):
    """Rows of documents, and of shingles that classes of a chunk share."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _sets(batches, width, chunk):
            cls = np.array([set_name(s) for _, s, _ in docs], np.int64)
            n = np.array([len(s) for _, s, _ in docs], np.int64)
            _, one = np.unique(cls, return_index=True)
            names, times = np.unique(np.concatenate([docs[i][1] for i in one]), return_counts=True)
            names, times = names[times > 1], times[times > 1]
            a, b = len(docs), len(names)
            yield pa.RecordBatch.from_arrays([
                pa.array([d for d, _, _ in docs], pa.int64()), pa.array([k for _, _, k in docs], pa.int64()), pa.array(cls), pa.array(n), pa.nulls(a, pa.int64())], ["doc_id", "text_key", "cls", "n", "times"])
            if b:
                yield pa.RecordBatch.from_arrays([pa.nulls(b, pa.int64()), pa.nulls(b, pa.int64()), pa.array(names.view(np.int64)), pa.nulls(b, pa.int64()), pa.array(times.astype(np.int64))], ["doc_id", "text_key", "cls", "n", "times"])
    return scan


def _short_names(width: int, chunk: int, frequent: BitTable, filter_bits: int, percent: int):
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for docs in _sets(batches, width, chunk):
            short = {set_name(s): _short(s, frequent, filter_bits, percent) for _, s, _ in docs if len(s)}
            if short:
                n = [len(x) for x in short.values()]
                yield np.concatenate(list(short.values())), np.repeat(np.arange(len(n)), n)
    return names


def _postings(width: int, chunk: int, frequent: BitTable, shared: BitTable, filter_bits: int, percent: int):
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _sets(batches, width, chunk):
            for cls, s in {set_name(s): s for _, s, _ in docs if len(s)}.items():
                x = _short(s, frequent, filter_bits, percent)
                x = x[shared.has(spots(x, filter_bits))]
                if k := len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(np.full(k, cls, np.int64)), pa.array(np.full(k, len(s), np.int64))], ["gram", "cls", "n"])
    return _batched(postings)


def _batched(f, least: int = 20_000):
    """Fewer and larger batches."""
    def g(batches):
        held, rows = [], 0
        for b in f(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= least:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return g


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings in order of (gram, cls), made distinct.

    A list of three classes or more gives a row for each, with its first class
    as pivot; a list of two gives one row, the second with the first; a list of
    one gives none.  No list is held whole: of one that a batch cuts, two rows
    at most are carried on, or the pivot once there are three."""
    names = ["gram", "cls", "n", "pivot", "pivot_n", "two"]
    carry, pivot = None, None  # rows of a list that may end with two classes; (gram, pivot, its size, last class) of a longer one

    def out(gram, cls, n, pivot, size, two) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, cls, n, pivot, size, two)], names)

    def settled(gram, cls, n, last: bool):
        """Rows of whole lists; the last list is whole if ``last``."""
        nonlocal carry, pivot
        new = starts_of(gram)
        at = np.flatnonzero(new)
        k = np.diff(np.r_[at, len(gram)])
        g = np.cumsum(new) - 1
        first, size = cls[at][g], n[at][g]
        if pivot is not None and pivot[0] == gram[0]:
            first, size = np.where(g == 0, pivot[1], first), np.where(g == 0, pivot[2], size)
            k = np.r_[3, k[1:]]  # long already
        keep = k[g] >= 3
        two = (k[g] == 2) & ~new
        if not last:
            tail = g == g[-1]
            if k[-1] >= 3:
                pivot = gram[-1], first[-1], size[-1], cls[-1]
                carry = None
            else:
                carry, pivot = (gram[tail], cls[tail], n[tail]), None
                keep &= ~tail
                two &= ~tail
        rows = keep | two
        if rows.any():
            yield out(gram[rows], cls[rows], n[rows], first[rows], size[rows], two[rows])

    for b in batches:
        if not b.num_rows:
            continue
        gram, cls, n = (b.column(c).to_numpy() for c in ("gram", "cls", "n"))
        if carry is not None:
            gram, cls, n = (np.concatenate(x) for x in zip(carry, (gram, cls, n)))
        fresh = starts_of(gram, cls)
        if pivot is not None and pivot[0] == gram[0]:
            fresh[0] = cls[0] != pivot[3]
        carry = None
        if fresh.any():
            if pivot is not None and pivot[0] != gram[fresh][0]:
                pivot = None
            yield from settled(gram[fresh], cls[fresh], n[fresh], False)
    if carry is not None:
        pivot = None
        yield from settled(*carry, True)


def divide_skip(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join the given sets into their components.

    Each set is a query over the sets before it in size: its inverted lists are
    divided into L long ones and the rest; the short ones are merged in order,
    places that occur t times are candidates, and the long lists are probed for
    them by binary search.  Candidates of the query's own component are done."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    part = np.arange(len(sets))  # component of each rank
    sizes = np.array([len(sets[i]) for i in order])
    grams = np.concatenate([sets[i] for i in order])
    rank = np.repeat(np.arange(len(order)), sizes)
    o = np.argsort(grams, kind="stable")  # within a list by rank
    grams, rank = grams[o], rank[o]
    cut = np.flatnonzero(starts_of(grams))
    heads, ends = grams[cut], np.r_[cut[1:], len(grams)]
    for q, i in enumerate(order):
        s, n = sets[i], len(sets[i])
        at = np.searchsorted(heads, s)
        length = ends[at] - cut[at]
        long = least_overlap(n, percent) - least_short(n)
        short = np.argsort(length, kind="stable")[:n - long]
        short = at[short[length[short] > 1]]
        if not q or not len(short):
            continue
        times = np.bincount(np.concatenate([rank[cut[k]:ends[k]] for k in short]), minlength=q)[:q]  # the merge
        ok = (times > 0) & (100 * sizes[:q] >= percent * n)
        ok &= times >= np.maximum(1, pair_overlap(n, sizes[:q], percent) - long)
        left = np.flatnonzero(ok & (part[:q] != part[q]))
        left = left[np.argsort(-times[left], kind="stable")]
        tried = 0
        while len(left):
            if tried == SINGLE_PROBES:  # many candidates that do not link: probe each list for all of them
                inter = np.zeros(len(left), np.int64)
                for k in at:
                    places = rank[cut[k]:ends[k]]
                    inter += places[np.minimum(np.searchsorted(places, left), len(places) - 1)] == left
                left = left[100 * inter >= percent * (n + sizes[left] - inter)]
                for p in left:
                    if part[p] != part[q]:
                        part[part == part[q]] = part[p]
                        yield i, order[p]
                break
            p, left, tried = left[0], left[1:], tried + 1
            x = sets[order[p]]
            probe = np.searchsorted(x, s)
            inter = int((x[np.minimum(probe, len(x) - 1)] == s).sum())
            if 100 * inter >= percent * (n + len(x) - inter):
                part[part == part[q]] = part[p]
                left = left[part[left] != part[q]]
                yield i, order[p]


def _search(percent: int):
    """Rows sorted by (bucket, part): links between the classes of each part."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["bucket", "part"], 200):
            bucket, part, cls = (t[c].to_numpy() for c in ("bucket", "part", "cls"))
            blobs = t["grams"].to_pylist()
            cut = np.flatnonzero(starts_of(bucket, part))
            a, b = [], []
            for i, j in zip(cut, [*cut[1:], len(cls)]):
                held = {int(c): np.frombuffer(x, np.uint64) for c, x in zip(cls[i:j], blobs[i:j])}
                ids = list(held)
                for x, y in divide_skip(list(held.values()), percent) if len(ids) > 1 else ():
                    a.append(ids[x])
                    b.append(ids[y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return search


def _grams(width: int, chunk: int, wanted: BitTable):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _sets(batches, width, chunk):
            cls = np.array([set_name(s) for _, s, _ in docs], np.int64)
            for i in np.flatnonzero(wanted.has(cls)):
                yield pa.RecordBatch.from_arrays([pa.array([docs[i][0]], pa.int64()), pa.array(cls[i:i + 1]), pa.array([docs[i][1].tobytes()], pa.binary())], ["doc_id", "cls", "grams"])
    return _batched(grams, 200)


def _links(texts: DataFrame, classes: DataFrame, members: DataFrame, width: int, percent: int, chunk: int, filter_bits: int, bucket_shingles: int) -> tuple[DataFrame, DataFrame]:
    """Links within the parts of buckets, and (bucket, part, cls).  ``members``:
    (bucket, cls, n); a bucket's own class is a member of each of its parts."""
    size = members.groupBy("bucket").agg(F.ceil(F.sum("n") / F.lit(bucket_shingles)).cast("int").alias("parts"))
    split = members.join(size, "bucket")
    rest = split.where("cls <> bucket").select("bucket", F.expr("pmod(xxhash64(cls), parts)").cast("int").alias("part"), "cls")
    own = split.groupBy("bucket").agg(F.max("parts").alias("parts")).select("bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("bucket").alias("cls"))
    places = stored(rest.union(own), "places")
    if places.isEmpty():
        return places.select(F.col("bucket").alias("a"), F.col("cls").alias("b")), places
    wanted = stored(places.join(classes.select("cls", F.col("rep").alias("doc_id")), "cls"), "wanted")
    table = BitTable.of(wanted, "cls", filter_bits)
    # whole sets move once where the table of their places is small, and twice beyond that
    to = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    sets = texts.mapInArrow(_grams(width, chunk, table), "doc_id long, cls long, grams binary").join(to, ["doc_id", "cls"])
    found = stored(sets.select("bucket", "part", "cls", "grams").repartition("bucket", "part").sortWithinPartitions("bucket", "part", "cls")
                   .mapInArrow(_search(percent), "a long, b long"), "found")
    table.drop()
    return found, places


#: Postings of guests that one task probes a part's lists with, and pairs of postings that it counts at a time.
GUEST_POSTINGS, COUNTED = 500_000, 2_000_000


def _probe(percent: int):
    """Rows sorted by (other, slice): the postings of a part's own classes, and of
    classes from elsewhere (guests) that are probed against the part's lists.
    Gives the pairs that are on enough lists, each once."""
    names = ["clsa", "clsb", "times", "na", "nb"]

    def pairs(own: tuple, guest: tuple) -> Iterator[pa.RecordBatch]:
        """Of (gram, cls, n, comp) of each side."""
        o = np.argsort(own[0], kind="stable")
        gram, cls, n, comp = (x[o] for x in own)
        _, first, member = np.unique(cls, return_index=True, return_inverse=True)
        cls, n, comp = cls[first], n[first], comp[first]
        o = np.argsort(guest[1], kind="stable")
        g_gram, g_cls, g_n, g_comp = (x[o] for x in guest)
        low, high = np.searchsorted(gram, g_gram), np.searchsorted(gram, g_gram, "right")
        met = np.cumsum(high - low)
        heads = np.flatnonzero(starts_of(g_cls))
        i = 0
        while i < len(heads):  # whole guests, as many as fit
            base = met[heads[i] - 1] if heads[i] else 0
            k = max(i + 1, int(np.searchsorted(met[np.r_[heads[1:], len(met)] - 1], base + COUNTED, "right")))
            at = slice(heads[i], heads[k] if k < len(heads) else len(met))
            length = high[at] - low[at]
            ends = np.cumsum(length)
            spot = np.arange(ends[-1]) + np.repeat(low[at] - ends + length, length)
            code, times = np.unique(np.repeat(np.cumsum(starts_of(g_cls[at])) - 1, length) * len(cls) + member[spot], return_counts=True)
            x, y = heads[i:k][code // len(cls)], code % len(cls)
            na, nb = g_n[x], n[y]
            least = pair_overlap(na, nb, percent) - np.maximum(*(least_overlap(m, percent) - least_short(m) for m in (na, nb)))
            ok = (g_comp[x] != comp[y]) & ((na < nb) | (na == nb) & (g_cls[x] < cls[y])) & (100 * na >= percent * nb) & (times >= least)
            if ok.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[ok]) for c in (g_cls[x], cls[y], times, na, nb)], names)
            i = k

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["other", "slice"]):
            other, piece, guest = (t[c].to_numpy() for c in ("other", "slice", "guest"))
            columns = [t[c].to_numpy() for c in ("gram", "cls", "n", "comp")]
            cut = np.flatnonzero(starts_of(other, piece))
            for i, j in zip(cut, [*cut[1:], len(other)]):
                g = guest[i:j] > 0
                if g.any() and not g.all():
                    yield from pairs(tuple(c[i:j][~g] for c in columns), tuple(c[i:j][g] for c in columns))
    return probe


def _met_pairs(left: DataFrame, parts: DataFrame, viable: DataFrame, percent: int) -> DataFrame:
    """(clsa, clsb, times, na, nb): pairs of ``left`` (gram, cls, n, comp, place)
    from two places whose first, the smaller, may have a partner in the second's
    place (``viable``, with the number of lists on which it meets that place).  Rows grow with the postings: a class goes to a place
    once with each list that the place is on (``parts``), the place's own
    postings go to each slice of its guests, and the pairs are counted there."""
    guests = left.join(viable.select("cls", "other"), "cls").join(parts, ["gram", "other"], "left_semi").select("other", "gram", "cls", "n", "comp")
    slices = stored(viable.groupBy("other").agg(F.ceil(F.sum("met") / F.lit(GUEST_POSTINGS)).cast("int").alias("slices")), "slices")
    guests = guests.join(slices, "other").select("other", F.expr("pmod(xxhash64(cls), slices)").cast("int").alias("slice"), F.lit(1).alias("guest"), "gram", "cls", "n", "comp")
    own = (left.withColumnRenamed("place", "other").join(slices, "other")
           .select("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("guest"), "gram", "cls", "n", "comp"))
    return (guests.union(own).repartition("other", "slice").sortWithinPartitions("other", "slice")
            .mapInArrow(_probe(percent), "clsa long, clsb long, times long, na long, nb long"))


def jaccard_groups(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and class_id (the
    smallest doc_id with the same set)."""
    return _grouped(docs, **options).select(null_id(), "n_shingles", null_id("component_id"), null_id("class_id"))


def _grouped(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, chunk_words: int = CHUNK_WORDS,
             filter_bits: int = FILTER_BITS, bucket_shingles: int = BUCKET_SHINGLES) -> DataFrame:
    """The same with NO_ID for null, text_key, and component: its name, which two
    components never share; null where there is no shingle."""
    texts = documents(docs)
    scanned = stored(texts.mapInArrow(_scan(width, chunk_words), "doc_id long, text_key long, cls long, n long, times long"), "scan")
    rows = scanned.where("times is null").select("doc_id", "text_key", "cls", "n")
    classes = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.count("*").alias("copies"))
    often = (scanned.where("times is not null").groupBy("cls").agg(F.sum("times").alias("times")).where(F.col("times") >= FREQUENT)
             .select(F.shiftrightunsigned("cls", 64 - filter_bits).alias("spot")))
    frequent = BitTable.of(often, "spot", filter_bits)
    shared = shared_names(texts, _short_names(width, chunk_words, frequent, filter_bits, percent), filter_bits)
    lists = stored(texts.mapInArrow(_postings(width, chunk_words, frequent, shared, filter_bits, percent), "gram long, cls long, n long")
                   .repartition("gram").sortWithinPartitions("gram", "cls")
                   .mapInArrow(_lists, "gram long, cls long, n long, pivot long, pivot_n long, two boolean"), "lists")
    frequent.drop()
    shared.drop()

    def on_enough(a: str, b: str):
        long = [F.expr(f"({x} * {percent} + 99) div 100 - 1 - {x} div 20") for x in (a, b)]
        share = F.expr(f"(({a} + {b}) * {percent} + {99 + percent}) div {100 + percent}")
        return F.col("times") >= share - F.greatest(*long)

    def sizes_fit(a: str, b: str):
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent

    # the pivot that a class meets most often
    met = stored(lists.where((F.col("cls") != F.col("pivot")) & sizes_fit("n", "pivot_n")).groupBy("cls", "pivot")
                 .agg(F.count("*").alias("times"), F.count_if("two").alias("twos"), F.min("n").alias("n"), F.min("pivot_n").alias("pivot_n")), "met")
    best = stored(met.where("times > least(n, pivot_n) div 20").groupBy("cls").agg(F.max(F.struct("times", "pivot")).alias("best")).select("cls", F.col("best.pivot").alias("pivot")), "best")
    args = (width, percent, chunk_words, filter_bits, bucket_shingles)
    followers = stored(components(best, "cls", "pivot").select(F.col("component").alias("bucket"), F.col("node").alias("cls")).join(classes.select("cls", "n"), "cls")
                       .select("bucket", "cls", "n"), "followers")
    lists = lists.where("not two")
    # a class without a pivot goes to the bucket that it meets on most lists, if on t
    beside = stored(lists.select("gram", "cls", "n").join(followers.select("cls", "bucket"), "cls", "left"), "beside")
    free = beside.where("bucket is null").select("gram", "cls", "n")
    free = free.join(free.groupBy("cls").agg(F.count("*").alias("times"), F.min("n").alias("n")).where("times > n div 20").select("cls"), "cls", "left_semi")
    near = (free
             .join(beside.where("bucket is not null").select("gram", "bucket").distinct(), "gram")
             .groupBy("cls", "bucket").agg(F.count("*").alias("times"), F.min("n").alias("n")).where("times > n div 20"))
    late = near.groupBy("cls").agg(F.max(F.struct("times", "bucket")).alias("best"), F.min("n").alias("n")).select(F.col("best.bucket").alias("bucket"), "cls", "n")
    followers = followers.union(late)
    first, places = _links(texts, classes, followers, *args)

    # longer lists on which several components and parts meet
    where = stored(places.where("cls <> bucket").select("cls", F.xxhash64("bucket", "part").alias("place"))
                   .join(components(first), F.col("cls") == F.col("node"), "full")
                   .select(F.coalesce("cls", "node").alias("cls"), "place", F.col("component").alias("comp")), "where")
    own = [F.coalesce("comp", "cls").alias("comp"), F.coalesce("place", "cls").alias("place")]
    on = lists.select("gram", "cls", "n").join(where, "cls", "left").select("gram", "cls", "n", *own)
    by_gram = Window.partitionBy("gram")

    def meeting(rows: DataFrame) -> DataFrame:
        for c in ("comp", "place"):
            rows = rows.withColumn(c + "s", F.min(c).over(by_gram) != F.max(c).over(by_gram))
        return rows.where("comps and places").drop("comps", "places")

    left = stored(meeting(on), "mixed")
    # a class on fewer than t such lists has no partner there
    enough = stored(left.groupBy("cls").agg(F.count("*").alias("times"), F.min("n").alias("n")).where("times > n div 20").select("cls"), "enough")
    left = stored(meeting(left.join(enough, "cls", "left_semi")), "mixed")
    # nor has a class in a part that it meets on fewer than t lists
    parts = left.select("gram", F.col("place").alias("other")).distinct()
    meets = stored(left.join(parts, "gram").where("place <> other").groupBy("cls", "other").agg(F.count("*").alias("met"), F.min("n").alias("n")), "meets")
    viable = meets.where("met > n div 20").select("cls", "other", "met")
    pairs = stored(_met_pairs(left, parts, stored(viable, "viable"), percent), "pairs")
    # pairs that meet on lists of two: on longer lists they meet no more often than the first meets
    # the second's part, or than classes do that were left out above
    alone = met.where("twos > 0").select(F.col("cls").alias("clsa"), F.col("pivot").alias("clsb"), "twos", F.col("n").alias("na"), F.col("pivot_n").alias("nb"))
    longer = lists.groupBy("cls").agg(F.count("*").alias("longer"))
    for k in "ab":
        alone = (alone.join(longer.withColumnRenamed("cls", "cls" + k).withColumnRenamed("longer", "longer" + k), "cls" + k, "left")
                 .fillna(0, ["longer" + k]))
    alone = alone.withColumn("times", F.col("twos") + F.least("longera", "longerb")).where(on_enough("na", "nb"))
    for k in "ab":
        alone = (alone.join(where.select(F.col("cls").alias("cls" + k), F.col("place").alias("place" + k), F.col("comp").alias("comp" + k)), "cls" + k, "left")
                 .withColumns({c + k: F.coalesce(c + k, "cls" + k) for c in ("place", "comp")}))
    alone = (alone.where("placea <> placeb and compa <> compb")
             .join(meets.select(F.col("cls").alias("clsa"), F.col("other").alias("placeb"), "met"), ["clsa", "placeb"], "left"))
    most = F.greatest(F.coalesce("met", F.lit(0)), F.least("longera", "longerb", F.expr("greatest(na, nb) div 20")))
    alone = alone.withColumn("times", F.col("twos") + most).where(on_enough("na", "nb")).select("clsa", "clsb", "times", "na", "nb")
    pairs = pairs.union(alone)
    second, _ = _links(texts, classes, pairs.select(F.col("clsb").alias("bucket"), F.col("clsa").alias("cls"), F.col("na").alias("n")), *args)
    groups = components(first.union(second))
    named = classes.select("cls", "rep", "copies").join(groups, F.col("cls") == F.col("node"), "left").select("cls", "rep", "copies", F.coalesce("component", "cls").alias("component"))
    named = stored(named, "named")
    smallest = stored(named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("size")), "smallest")
    named = stored(join_hot(named, smallest, ["component"], "size", "inner").select("cls", "copies", F.col("rep").alias("class_id"), "component_id", "component"), "classes")
    linked = join_hot(rows.where("n > 0"), named, ["cls"], "copies", "inner").select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id", "class_id", "component")
    alone = rows.where("n = 0").select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), F.lit(None).cast("long").alias("component"))
    return linked.union(alone)


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest
    (doc_id, text_key).  Other rows with the id of a row that goes or stays are
    judged by their own text; texts without shingles all stay."""
    groups = stored(_grouped(docs, **options).where("component is not null").select("doc_id", "text_key", "component_id", "component"), "groups")
    heads = stored(groups.where("doc_id = component_id").groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("copies")), "heads")
    kept = heads.groupBy("component").agg(F.min("text_key").alias("kept_key"), F.count("*").alias("texts"))
    judged = stored(join_hot(heads, kept, ["component"], "texts", "inner"), "judged")
    own_id, own_key, row_id, row_key = free_names(docs, "__own_id", "__own_key", "__row_id", "__row_key")
    keys = [F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)]
    again = judged.where("text_key = kept_key and copies > 1").select(*keys)  # the kept row itself, repeated
    gone = groups.where("doc_id <> component_id").union(judged.where("text_key <> kept_key").select(groups.columns[:2] + ["doc_id", "component"])).select(*keys).distinct()
    own = docs.withColumns({row_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), row_key: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    same = (F.col(row_id) == F.col(own_id)) & (F.col(row_key) == F.col(own_key))
    if again.isEmpty():
        return own.join(gone, same, "left_anti").select(docs.columns)
    once = own.join(again, same, "left_semi").dropDuplicates([row_id, row_key])
    return own.join(gone.union(again), same, "left_anti").unionByName(once).select(docs.columns)
