"""Exact dedup: counting quotient filters, merged losslessly, then byte verification.

Two texts are equal when they are identical without ASCII white space.

1. A pass over whole texts writes (doc_id, fingerprint, code points, SHA-256).
2. Every task builds counting quotient filters over its fingerprints, one for
   each range of quotients: an occupied bit for each quotient, a run-end bit for
   each slot, sorted remainders and their counts.  Filters of a range merge by
   their sorted remainders without loss, so the merged counts are exact.
3. Fingerprints counted more than once route their documents to byte
   verification: tasks first fold equal texts among themselves, then texts are
   grouped by their own bytes.  A bit table of fixed size keeps the texts of
   most other documents out of that shuffle.
4. The document with the most code points in its original text stays, then the
   smallest doc_id (a null doc_id orders before all others).

Defined cases: null text is empty; empty texts equal each other; rows that
repeat a doc_id count as rows of their own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import SPACE, BitTable, as_bytes, documents, join_hot, null_id, stored

#: Quotient ranges (2**RANGE_BITS filters) and quotient bits inside one range.
RANGE_BITS, QUOTIENT_BITS = 10, 16
#: Fingerprints that a task puts into one set of filters.
CHUNK_FINGERPRINTS = 500_000
FILTER_BITS = 26


class QuotientFilter:
    """Counting quotient filter over the 64 - RANGE_BITS low bits of one range.

    ``occupied``: a bit for each quotient that has a run; ``runend``: a bit for
    each slot that ends a run; ``remainders`` and ``counts``: the slots in order.
    """

    REMAINDER_BITS = 64 - RANGE_BITS - QUOTIENT_BITS

    def __init__(self, items: np.ndarray, counts: np.ndarray):
        """Of sorted distinct items."""
        q = (items >> np.uint64(self.REMAINDER_BITS)).astype(np.int64)
        self.remainders = items & np.uint64((1 << self.REMAINDER_BITS) - 1)
        self.counts = counts.astype(np.int64)
        self.occupied = np.zeros(1 << QUOTIENT_BITS, bool)
        self.occupied[q] = True
        self.runend = np.r_[q[1:] != q[:-1], True][:len(q)]

    def items(self) -> np.ndarray:
        """The items again: run k belongs to the k-th occupied quotient."""
        run = np.cumsum(self.runend) - self.runend
        return np.flatnonzero(self.occupied)[run].astype(np.uint64) << np.uint64(self.REMAINDER_BITS) | self.remainders

    def merged(self, other: "QuotientFilter") -> "QuotientFilter":
        items = np.concatenate([self.items(), other.items()])
        counts = np.concatenate([self.counts, other.counts])
        o = np.argsort(items, kind="stable")
        items, counts = items[o], counts[o]
        new = np.flatnonzero(np.r_[True, items[1:] != items[:-1]][:len(items)])
        return QuotientFilter(items[new], np.add.reduceat(counts, new) if len(new) else counts)

    def dump(self) -> bytes:
        parts = (np.packbits(self.occupied), np.packbits(self.runend), self.remainders, self.counts)
        return len(self.counts).to_bytes(8, "little") + zlib.compress(b"".join(p.tobytes() for p in parts), 1)

    @classmethod
    def load(cls, blob: bytes) -> "QuotientFilter":
        n, body, self = int.from_bytes(blob[:8], "little"), zlib.decompress(blob[8:]), cls.__new__(cls)
        a, b = (1 << QUOTIENT_BITS) // 8, (n + 7) // 8
        self.occupied = np.unpackbits(np.frombuffer(body, np.uint8, a)).astype(bool)
        self.runend = np.unpackbits(np.frombuffer(body, np.uint8, b, a))[:n].astype(bool)
        self.remainders = np.frombuffer(body, np.uint64, n, a + b)
        self.counts = np.frombuffer(body, np.int64, n, a + b + 8 * n)
        return self


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp, points, sha = [], [], []
        for t in as_bytes(b.column("text")):
            norm = t.translate(None, SPACE)
            fp.append(xxhash.xxh3_64_intdigest(norm))
            points.append(len(t) if t.isascii() else len(t.decode("utf-8", "replace")))
            sha.append(hashlib.sha256(norm).digest())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(points, pa.int64()), pa.array(sha, pa.binary())],
                                         ["doc_id", "fingerprint", "code_points", "sha"])


def _filters(chunk: int):
    def built(names: np.ndarray) -> pa.RecordBatch:
        items, counts = np.unique(names, return_counts=True)
        part = items >> np.uint64(64 - RANGE_BITS)
        low = items & np.uint64((1 << (64 - RANGE_BITS)) - 1)
        at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        blobs = [QuotientFilter(low[i:j], counts[i:j]).dump() for i, j in zip(at, [*at[1:], len(items)])]
        return pa.RecordBatch.from_arrays([pa.array(part[at].astype(np.int64)), pa.array(blobs, pa.binary())], ["part", "filter"])

    def filters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy().view(np.uint64))
            n += len(held[-1])
            if n >= chunk:
                yield built(np.concatenate(held))
                held, n = [], 0
        if n:
            yield built(np.concatenate(held))
    return filters


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range: one filter is held at a time, and one more to merge."""
    def repeated(part: int, f: QuotientFilter) -> pa.RecordBatch:
        many = f.counts > 1
        names = f.items()[many] | np.uint64(part) << np.uint64(64 - RANGE_BITS)
        return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(f.counts[many])], ["fingerprint", "rows"])

    at, merged = None, None
    for b in batches:
        for part, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            f = QuotientFilter.load(blob)
            if part == at:
                merged = merged.merged(f)
            else:
                if merged is not None:
                    yield repeated(at, merged)
                at, merged = part, f
    if merged is not None:
        yield repeated(at, merged)


def repeated_fingerprints(digests: DataFrame, chunk: int = CHUNK_FINGERPRINTS) -> DataFrame:
    """(fingerprint, rows) of the fingerprints counted more than once."""
    parts = digests.select("fingerprint").mapInArrow(_filters(chunk), "part long, filter binary")
    return (parts.repartition("part").sortWithinPartitions("part").mapInArrow(_merge, "fingerprint long, rows long"))


def _routed(table: BitTable, chunk_bytes: int):
    """Normalised texts whose fingerprint may repeat; equal ones of a chunk as one row."""
    names = ["fingerprint", "bytes", "sha", "code_points", "doc_id", "rows"]

    def flush(held: dict) -> pa.RecordBatch:
        v = list(held.values())
        return pa.RecordBatch.from_arrays([
            pa.array(np.array([x[0] for x in v], np.uint64).view(np.int64)), pa.array(list(held), pa.binary()), pa.array([hashlib.sha256(k).digest() for k in held], pa.binary()),
            pa.array([x[1] for x in v], pa.int64()), pa.array([x[2] for x in v], pa.int64()), pa.array([x[3] for x in v], pa.int64())], names)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for b in batches:
            texts = as_bytes(b.column("text"))
            norms = [t.translate(None, SPACE) for t in texts]
            fps = np.fromiter(map(xxhash.xxh3_64_intdigest, norms), np.uint64, len(norms))
            ids = b.column("doc_id").to_pylist()
            for i in np.flatnonzero(table.has(fps.view(np.int64))):
                t, norm, doc = texts[i], norms[i], ids[i]
                points = len(t) if t.isascii() else len(t.decode("utf-8", "replace"))
                if (x := held.get(norm)) is None:
                    held[norm] = [int(fps[i]), points, doc, 1]
                    size += len(norm) + 200
                else:
                    x[3] += 1
                    if (points, -doc) > (x[1], -x[2]):
                        x[1], x[2] = points, doc
            if size >= chunk_bytes:
                yield flush(held)
                held, size = {}, 0
        if held:
            yield flush(held)
    return routed


def exact_dedup(docs: DataFrame, filter_bits: int = FILTER_BITS, chunk_bytes: int = 32 << 20) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``kept`` is true for the row that stays.  Where rows repeat doc_id, text and
    all, exactly one of them is kept."""
    texts = documents(docs).select("doc_id", "text")
    digests = stored(texts.mapInArrow(_digests, "doc_id long, fingerprint long, code_points long, sha binary")
                     .withColumn("row", F.monotonically_increasing_id()), "digests")
    many = stored(repeated_fingerprints(digests), "repeated")
    table = BitTable.of(many, "fingerprint", filter_bits)
    routed = texts.mapInArrow(_routed(table, chunk_bytes), "fingerprint long, bytes binary, sha binary, code_points long, doc_id long, rows long")
    best = F.max(F.struct(F.col("code_points"), F.expr("-1 - doc_id").alias("back")))  # the smallest doc_id is the largest -1 - doc_id
    classes = stored(routed.groupBy("fingerprint", "bytes").agg(F.min("sha").alias("sha"), best.alias("best"), F.sum("rows").alias("group_size"))
                     .where("group_size > 1")
                     .select("fingerprint", "sha", "group_size", F.col("best.code_points").alias("most"), F.expr("-1 - best.back").alias("keep_id")), "classes")
    # of rows that repeat the kept one, the first
    key = ["fingerprint", "sha"]
    keepers = (join_hot(digests, classes, key, "group_size", "inner").where("doc_id = keep_id and code_points = most")
               .groupBy(*key).agg(F.min("row").alias("keep_row")))
    both = join_hot(digests, stored(classes.join(keepers, key), "kept"), key, "group_size", "left")
    return both.select(null_id(), F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                       F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
                       F.lower(F.hex("sha")).alias("text_sha256")).withColumn("keep_id", null_id("keep_id"))
