"""Cross-tokenizer alignment by interval coalescing over byte offsets.

Two tokenizers cut the same bytes, a blank and the text, into tokens.  All
tokens of A and B are sorted by start (lexsort), the running maximum of their
ends is taken (maximum.accumulate), and a group breaks where a start reaches it:
the offsets where tokens of both end.  Within a group the A and B tokens whose
byte ranges overlap are expanded into links.

A text falls into units at each blank between two characters that are no white
space.  Both tokenizers break there (A's pre-tokenizer puts such a blank before
the next word; no piece of B holds a blank after another character, which is
checked), so a group never crosses a unit, and a unit's tokens, groups and links
are the same wherever it stands.  Tasks coalesce each distinct unit once, many
in one pass, and put texts together from their units' results.

Counts over the corpus: a task's chunk of texts emits, for each id pair that it
links, in how many of its documents that is; summed over chunks these give each
pair's count and each A id's highest.  The counts go back to the chunks that
hold the pair: a join on the pair, with a row for each chunk and pair and none
for a link.  Chunks keep their links as places in the chunk's pairs, commonest
first and compressed, so texts are read and encoded once.

Defined cases: texts that are null, empty, or whose joined bytes differ from the
blank and the text under either tokenizer have no tokens: zeros and an empty
groups_sha256; a null doc_id stays null; rows that repeat a doc_id are documents
of their own; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import starts_of, stored
from cellrisk.llm.packing import byte_letters, encoder

#: Bytes of text that make a chunk, and units that a task remembers.
CHUNK_BYTES, MOST_UNITS = 8 << 20, 300_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: A blank that is no cut.
_UNCUT = re.compile(r"^ | $|\s | \s")


def byte_level_tokens(path: str) -> dict[int, bytes]:
    """Bytes of each id of a byte-level BPE file."""
    spec = json.load(open(path, encoding="utf-8"))
    letter, own = byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    return {i: w.encode() if w in own else bytes(letter[c] for c in w) for w, i in spec["model"]["vocab"].items()}


def piece_tokens(model) -> dict[int, bytes]:
    """Bytes of each id of a sentencepiece model with byte fallback."""
    def piece(i: int) -> bytes:
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
    return {i: piece(i) for i in range(model.get_piece_size())}


def coalesced(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Group of each interval, for intervals in order of start: a new group where
    a start reaches the running maximum of the ends before it."""
    new = np.zeros(len(start), bool)
    if len(start):
        new[0] = True
        new[1:] = start[1:] >= np.maximum.accumulate(end)[:-1]
    return np.cumsum(new) - 1


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and B tokens of every overlapping pair, by start of the
    overlap.  Both cover the same bytes without gaps, so an overlap begins at a
    start of either and each start begins one."""
    ends = np.union1d(a_end, b_end)
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)


def cut_units(text: str) -> list[str]:
    return _CUT.split(text) if _UNCUT.search(text) else text.split(" ")


def runs(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + length, length)


class _Column:
    """Numbers that are appended to, in an array that doubles."""

    def __init__(self):
        self.held, self.size = np.zeros(1 << 10, np.int64), 0

    def extend(self, x: np.ndarray) -> None:
        while self.size + len(x) > len(self.held):
            self.held = np.concatenate([self.held, np.zeros_like(self.held)])
        self.held[self.size:self.size + len(x)] = x
        self.size += len(x)


class Aligner:
    """Units and what they align to: tokens of A, of B, groups, id pairs of the
    links as a << 32 | b, and the text of the groups.  Unit 0 stands for those
    whose bytes differ."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.a, self.model = encoder(a_path, special_strings=False), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes, self.b_bytes = byte_level_tokens(a_path), piece_tokens(self.model)
        self.sizes = [np.zeros(max(t) + 1, np.int64) for t in (self.a_bytes, self.b_bytes)]
        for size, t in zip(self.sizes, (self.a_bytes, self.b_bytes)):
            size[list(t)] = [len(x) for x in t.values()]
        self.written = [[f"{sep}{i}" for i in range(max(map(len, self.sizes)))] for sep in ",|;"]
        self.whole = any(re.search("[^▁]▁", self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        self.forget()

    def forget(self) -> None:
        self.units: dict[str, int] = {}
        self.text = [""]
        self.n_a, self.n_b, self.n_groups, self.first, self.n_links, self.pairs = (_Column() for _ in range(6))
        for c in (self.n_a, self.n_b, self.n_groups, self.first, self.n_links):
            c.extend(np.zeros(1, np.int64))

    def of(self, texts: list[str]) -> list[list[int]]:
        """The places of the texts' units, all of them aligned."""
        if len(self.units) > MOST_UNITS:
            self.forget()
        cut = [[t] if self.whole else cut_units(t) for t in texts]
        fresh = set().union(*cut).difference(self.units)
        if fresh:
            self._align(list(fresh))
        return [list(map(self.units.__getitem__, units)) for units in cut]

    def _align(self, units: list[str]) -> None:
        wanted = [(" " + u).encode("utf-8", "replace") for u in units]
        a, b = [self.a(" " + u) for u in units], self.model.encode(units, num_threads=1)
        by_a, by_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        whole = b"".join(wanted)
        if not b"".join(map(by_a, chain.from_iterable(a))) == whole == b"".join(map(by_b, chain.from_iterable(b))):
            same = [b"".join(map(by_a, x)) == w == b"".join(map(by_b, y)) for x, y, w in zip(a, b, wanted)]
            self.units.update((u, 0) for u, ok in zip(units, same) if not ok)
            units, a, b = ([x for x, ok in zip(c, same) if ok] for c in (units, a, b))
        if not units:
            return
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids = np.fromiter(chain(chain.from_iterable(a), chain.from_iterable(b)), np.int64)
        tokens_a = int(n_a.sum())
        ids_a, ids_b = ids[:tokens_a], ids[tokens_a:]
        end_a, end_b = np.cumsum(self.sizes[0][ids_a]), np.cumsum(self.sizes[1][ids_b])
        start, end = np.concatenate([end_a - self.sizes[0][ids_a], end_b - self.sizes[1][ids_b]]), np.concatenate([end_a, end_b])
        side = np.repeat([0, 1], [len(end_a), len(end_b)])
        order = np.lexsort((side, start))
        group = np.empty(len(order), np.int64)
        group[order] = coalesced(start[order], end[order])
        at_a, at_b = overlaps(end_a, end_b)
        # units end where groups do: their tokens, links and groups follow one another
        last_a = np.cumsum(n_a)
        cut_links = np.searchsorted(at_a, np.r_[0, last_a])
        groups = np.diff(np.r_[-1, group[last_a - 1]])
        place = len(self.text) + np.arange(len(units))
        self.first.extend(self.pairs.size + cut_links[:-1])
        for column, x in ((self.n_a, n_a), (self.n_b, n_b), (self.n_groups, groups), (self.n_links, np.diff(cut_links)), (self.pairs, ids_a[at_a] << 32 | ids_b[at_b])):
            column.extend(x)
        self.units.update(zip(units, place.tolist()))
        # the text: tokens by group and side, each with what separates it from the one before
        order = np.lexsort((side, group))
        new, other = starts_of(group[order]), starts_of(group[order], side[order])
        comma, bar, semi = self.written
        written = [semi[i] if k == 2 else bar[i] if k else comma[i] for i, k in zip(ids[order].tolist(), (new.astype(np.int8) + other).tolist())]
        cut = np.r_[0, np.cumsum(n_a + n_b)].tolist()
        self.text.extend("".join(written[i:j]) for i, j in zip(cut, cut[1:]))

    def documents(self, units: list[list[int]]) -> Iterator[tuple[int, int, int, np.ndarray, str]]:
        """n_a, n_b, n_groups, id pairs of the links, groups_sha256 of each."""
        n = np.array([len(x) for x in units])
        if not len(n):
            return
        at = np.fromiter(chain.from_iterable(units), np.int64, int(n.sum()))
        cut = np.cumsum(n) - n
        ok = np.minimum.reduceat(at, cut) > 0
        a, b, g, links = (np.add.reduceat(c.held[at], cut) for c in (self.n_a, self.n_b, self.n_groups, self.n_links))
        pairs = np.split(self.pairs.held[runs(self.first.held[at], self.n_links.held[at])], np.cumsum(links)[:-1])
        for i, x in enumerate(units):
            if ok[i]:
                yield int(a[i]), int(b[i]), int(g[i]), pairs[i], hashlib.sha256("".join(map(self.text.__getitem__, x))[1:].encode()).hexdigest()
            else:
                yield 0, 0, 0, np.zeros(0, np.int64), ""


_CHUNK = "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, pairs binary, documents binary, links binary"
_NAMES = [x.split()[0] for x in _CHUNK.split(", ")]
_LONGS, _TEXTS = pa.list_(pa.int64()), pa.list_(pa.string())


def _squeezed(x: np.ndarray) -> bytes:
    """Whole numbers under 2**32, byte plane by byte plane."""
    body = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True) if len(x) else bytes(8)


def _spread(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    if not n:
        return np.zeros(0, np.int64)
    body = np.frombuffer(pa.decompress(blob[8:], 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(body.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _chunk_row(name: int, docs: list[tuple]) -> pa.RecordBatch:
    """Of (doc_id, n_a, n_b, n_groups, links, sha) of a chunk's documents."""
    links = [d[4] for d in docs]
    n = np.array([len(x) for x in links], np.int64)
    found = pa.array(np.concatenate(links)).dictionary_encode()
    pairs, place = found.dictionary.to_numpy(), found.indices.to_numpy()
    times = np.bincount(place, minlength=len(pairs))
    common = np.lexsort((pairs, -times))
    rank = np.empty(len(common), np.int64)
    rank[common] = np.arange(len(common))
    pairs, place = pairs[common], rank[place]
    once = np.unique(np.repeat(np.arange(len(docs)), n) * max(1, len(pairs)) + place)  # (document, pair)
    in_docs = np.bincount(once % max(1, len(pairs)), minlength=len(pairs))
    columns = [pa.array([[d[i] for d in docs]], _LONGS) for i in range(4)]
    return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), *columns, pa.array([n.tolist()], _LONGS), pa.array([[d[5] for d in docs]], _TEXTS),
                                       *(pa.array([x], pa.binary()) for x in (pairs.astype("<i8").tobytes(), _squeezed(in_docs), _squeezed(place)))], _NAMES)


def _aligned(a_path: str | None, b_path: str | None, chunk_bytes: int):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        aligner = Aligner(a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model"))
        name, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
            for i in range(0, len(texts), 64):
                some = texts[i:i + 64]
                found = aligner.documents(aligner.of([t for t in some if t]))
                for doc, t in zip(ids[i:i + 64], some):
                    held.append((doc, *(next(found) if t else (0, 0, 0, np.zeros(0, np.int64), ""))))
                    size += len(t or "") + 100
                    if size >= chunk_bytes:
                        yield _chunk_row(name, held)
                        name, held, size = name + 1, [], 0
        if held:
            yield _chunk_row(name, held)
    return aligned


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, place, pair, documents) of each pair of a chunk."""
    for b in batches:
        for chunk, pairs, docs in zip(b.column("chunk").to_pylist(), b.column("pairs").to_pylist(), b.column("documents").to_pylist()):
            p = np.frombuffer(pairs, "<i8")
            for i in range(0, len(p), 100_000):
                q = p[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(q), chunk), np.arange(i, i + len(q)), q, _spread(docs)[i:i + len(q)])], ["chunk", "place", "pair", "documents"])


_FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the count of each of their pairs, negative for an A id's highest."""
    for b in batches:
        for row in b.to_pylist():
            signed = np.zeros(len(row["pairs"]) // 8, np.int64)
            for place, count in zip(row["places"] or (), row["counts"] or ()):
                signed[np.frombuffer(place, ">i4")] = np.frombuffer(count, ">i8")
            n = np.array(row["n_links"], np.int64)
            at = signed[_spread(row["links"])]
            owner = np.repeat(np.arange(len(n)), n)
            best = np.bincount(owner[at < 0], minlength=len(n))
            total = np.zeros(len(n), np.int64)
            np.add.at(total, owner, np.abs(at))
            columns = [row["doc_id"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], best, total]
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns), pa.array(row["groups_sha256"], pa.string())], [x.split()[0] for x in _FOUND.split(", ")])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signed counts sorted by chunk, packed into a row for each chunk and batch."""
    for b in batches:
        chunk, place, signed = (b.column(c).to_numpy() for c in ("chunk", "place", "signed"))
        cut = np.flatnonzero(starts_of(chunk))
        parts = [(place[i:j].astype(">i4").tobytes(), signed[i:j].astype(">i8").tobytes()) for i, j in zip(cut, [*cut[1:], len(chunk)])]
        yield pa.RecordBatch.from_arrays([pa.array(chunk[cut]), pa.array([p for p, _ in parts], pa.binary()), pa.array([s for _, s in parts], pa.binary())], ["chunk", "places", "counts"])


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.  The paths name a byte-level BPE file and a
    sentencepiece model on every worker."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = stored(texts.mapInArrow(_aligned(a_path, b_path, chunk_bytes), _CHUNK), "aligned")
    pairs = stored(chunks.select("chunk", "pairs", "documents").mapInArrow(_pairs, "chunk long, place long, pair long, documents long"), "pairs")
    counts = pairs.groupBy("pair").agg(F.sum("documents").alias("count"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32)), "counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    signed = counts.join(highest, "a").select("pair", F.when(F.col("count") == F.col("highest"), -F.col("count")).otherwise(F.col("count")).alias("signed"))
    found = (pairs.select("chunk", "place", "pair").join(signed, "pair").select("chunk", "place", "signed")
             .repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_gathered, "chunk long, places binary, counts binary")
             .groupBy("chunk").agg(F.collect_list("places").alias("places"), F.collect_list("counts").alias("counts")))
    return chunks.join(found, "chunk", "left").mapInArrow(_scored, _FOUND)
