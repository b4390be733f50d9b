"""Substring dedup by recompression.

A passage of ``width`` consecutive words is repeated when its word sequence also
starts in a document with a smaller doc_id; every word that a repeated passage
covers goes.  Passages are judged on the input, not on what is left.

Recompression rewrites every text in rounds.  A round first names maximal runs
of one symbol, then names pairs (left, right) under one partition of all symbols
into lefts and rights.  A name is a 64-bit fingerprint of what it stands for and
the partition is a hash bit, so all workers name alike without exchanging a
dictionary, and equal substrings get equal symbols except near their ends.  For
each symbol the words that determine it are tracked: any passage that holds
them holds the symbol, wherever it occurs.

1. *Reveal.*  Tasks emit the pairs of neighbouring top symbols, packed as sorted
   deltas for each range of names.  Names that two documents share set bits of a
   table of fixed size.  A passage that determines a pair which nobody shares
   cannot be repeated; all others stay candidates, also those that determine no
   pair at all.  The table only saves work: full, it would let every passage
   through.
2. *Verify.*  Candidate passages travel as (96-bit name, doc_id, position).  A
   chunk of documents first settles its own repeats, so a passage that a third
   of all documents hold costs a row a chunk.  Rows are sorted by (name,
   doc_id); a task streams them and marks those after the first document.
3. Marked positions return to their documents, and the text is cut once.

Names of 96 bits are compared in place of words; two different passages meet
with a chance of about n^2 / 2^97.

Defined cases: null, empty and short texts have no passage and keep all their
words; a null doc_id orders before all others; rows that repeat a doc_id are one
document, so they never remove each other's words; empty tables give empty
results; extra columns are ignored, or kept by ``without_repeated_passages``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import MIX, NO_ID, BitTable, as_bytes, documents, free_names, mixed, null_id, starts_of, window_names
from cellrisk.llm.sharing import Chunk, chunks, shared_names, spots

WIDTH = 13
#: Words that a task settles among themselves.
CHUNK_WORDS = 500_000
FILTER_BITS = 27
_FAR = 1 << 60


class Symbols:
    """Symbols of a chunk: name, owner (document's place in the chunk), and the
    words [start, end) that determine each; beyond a text's ends it is open."""

    def __init__(self, names: np.ndarray, owner: np.ndarray):
        at = np.arange(len(names), dtype=np.int64)
        self.name, self.owner, self.start, self.end = names, owner, at, at + 1

    def round(self, level: int) -> "Symbols":
        """Name runs, then pairs."""
        n = len(self.name)
        if not n:
            return self
        first = np.flatnonzero(starts_of(self.name, self.owner))
        last = np.r_[first[1:], n] - 1
        run = (last - first + 1).astype(np.uint64)
        base, owner = self.name[first], self.owner[first]
        name = np.where(run > 1, mixed(base + run * MIX + np.uint64(level)), base)
        # that a run ends here shows in the symbols beside it
        inner = owner[1:] == owner[:-1]
        start, end = np.full(len(first), -_FAR), np.full(len(first), _FAR)
        start[1:][inner] = self.start[first[1:] - 1][inner]
        end[:-1][inner] = self.end[last[:-1] + 1][inner]
        left = (mixed(base ^ mixed(np.array([level + 1], np.uint64))) & np.uint64(1)).astype(bool)
        lead = np.r_[left[:-1] & ~left[1:] & inner, False]
        head = ~np.r_[False, lead[:-1]]
        name[:-1] = np.where(lead[:-1], mixed(name[:-1] * MIX ^ mixed(name[1:] + np.uint64(level))), name[:-1])
        end[:-1] = np.where(lead[:-1], end[1:], end[:-1])
        out = Symbols.__new__(Symbols)
        out.name, out.owner, out.start, out.end = name[head], owner[head], start[head], end[head]
        return out

    def pairs(self, width: int) -> "Symbols":
        """Neighbouring symbols that a passage of ``width`` words can determine."""
        ok = (self.owner[1:] == self.owner[:-1]) & (self.start[:-1] >= 0) & (self.end[1:] < _FAR) & (self.end[1:] - self.start[:-1] <= width)
        out = Symbols.__new__(Symbols)
        out.name = mixed(self.name[:-1] * MIX + self.name[1:])[ok]
        out.owner, out.start, out.end = self.owner[:-1][ok], self.start[:-1][ok], self.end[1:][ok]
        return out


def rounds_for(width: int) -> int:
    """So many that a passage still determines a few top symbols."""
    return max(1, int(math.log2(max(2.0, width / 3.2))))


def recompressed(names: np.ndarray, owner: np.ndarray, width: int) -> Symbols:
    s = Symbols(names, owner)
    for level in range(rounds_for(width)):
        s = s.round(level)
    return s.pairs(width)


def _names_of(width: int, chunk_words: int):
    """Pair names of each chunk, with the document that owns each."""
    def names_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for c in chunks(batches, chunk_words):
            names, owner, *_ = c.arrays()
            s = recompressed(names, owner, width)
            yield s.name, s.owner
    return names_of


def _by_document(doc: np.ndarray, key: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """A row for each document with its positions as little-endian uint32."""
    o = np.lexsort((pos, key, doc))
    doc, key, pos = doc[o], key[o], pos[o].astype("<u4")
    at = np.flatnonzero(starts_of(doc, key))
    blobs = [pos[i:j].tobytes() for i, j in zip(at, [*at[1:], len(pos)])]
    return pa.RecordBatch.from_arrays([pa.array(doc[at]), pa.array(key[at]), pa.array(blobs, pa.binary())], ["doc_id", "text_key", "positions"])


_CLAIMS = "h1 long, h2 int, doc_id long, text_key long, position int, positions binary"


def _claims(width: int, chunk: int, table: BitTable, filter_bits: int):
    def settle(c: Chunk) -> Iterator[pa.RecordBatch]:
        names, owner, begin, ids, keys = c.arrays()
        n = len(names) - width + 1
        if n <= 0:
            return
        s = recompressed(names, owner, width)
        alone = ~table.has(spots(s.name, filter_bits))
        # a pair that nobody shares rules out every passage that determines it
        out = np.zeros(len(names) + 1, np.int32)
        np.add.at(out, np.maximum(s.end[alone] - width, 0), 1)
        np.add.at(out, s.start[alone] + 1, -1)
        ok = (np.cumsum(out)[:n] == 0) & (owner[:n] == owner[width - 1:])
        at = np.flatnonzero(ok)
        if not len(at):
            return
        h1 = window_names(names, width)[at]
        h2 = (window_names(names, width, 1)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        doc, key, pos = ids[owner[at]], keys[owner[at]], (at - begin[owner[at]]).astype(np.int32)
        o = np.lexsort((doc, h2, h1))
        new = starts_of(h1[o], h2[o])
        first = np.empty(len(o), bool)
        first[o] = doc[o] == doc[o][new][np.cumsum(new) - 1]  # rows stay in the text's order, which packs better
        k = int(first.sum())
        empty = pa.nulls(k, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(h1[first].view(np.int64)), pa.array(h2[first]), pa.array(doc[first]), pa.array(key[first]), pa.array(pos[first]), empty],
                                         ["h1", "h2", "doc_id", "text_key", "position", "positions"])
        if k < len(first):
            r = _by_document(doc[~first], key[~first], pos[~first])
            none = r.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(none, pa.int64()), pa.nulls(none, pa.int32()), r.column(0), r.column(1), pa.nulls(none, pa.int32()), r.column(2)],
                                             ["h1", "h2", "doc_id", "text_key", "position", "positions"])

    def claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, chunk):
            for whole in settle(c):
                for i in range(0, whole.num_rows, 50_000):
                    yield whole.slice(i, 50_000)
    return claims


_MARKED = ["doc_id", "text_key", "position", "positions"]


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (name, doc_id): positions after the first document."""
    last = None
    for b in batches:
        settled = b.column("h1").is_valid().to_numpy(zero_copy_only=False)
        if not settled.all():
            yield b.filter(pa.array(~settled)).select(_MARKED)
            b = b.filter(pa.array(settled))
        if not b.num_rows:
            continue
        h1, h2, doc, key, pos = (b.column(c).to_numpy() for c in ("h1", "h2", "doc_id", "text_key", "position"))
        new = starts_of(h1, h2)
        firsts = doc[new]
        if last is not None and last[0] == h1[0] and last[1] == h2[0]:
            firsts = firsts.copy()
            firsts[0] = last[2]
        first = firsts[np.cumsum(new) - 1]
        last = (h1[-1], h2[-1], first[-1])
        lost = doc != first
        if lost.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[lost]), pa.array(key[lost]), pa.array(pos[lost]), pa.nulls(int(lost.sum()), pa.binary())], _MARKED)


def repeated_passages(docs: DataFrame, width: int = WIDTH, chunk_words: int = CHUNK_WORDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, text_key, starts, blocks): for each document that loses words,
    where its repeated passages start, singly and as little-endian uint32 blocks."""
    texts = documents(docs)
    table = shared_names(texts, _names_of(width, chunk_words), filter_bits)
    claims = texts.mapInArrow(_claims(width, chunk_words, table, filter_bits), _CLAIMS)
    return (claims.repartition(F.coalesce("h1", "text_key")).sortWithinPartitions("h1", "h2", "doc_id")
            .mapInArrow(_marked, "doc_id long, text_key long, position int, positions binary")
            .groupBy("doc_id", "text_key").agg(F.collect_list("position").alias("starts"), F.collect_list("positions").alias("blocks")))


def kept_words(words: list[bytes], starts: list[int] | None, blocks: list[bytes] | None, width: int) -> list[bytes]:
    if not starts and not blocks:
        return words
    at = np.r_[np.array(starts or [], np.int64), np.frombuffer(b"".join(blocks or []), "<u4")]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, np.minimum(at + width, len(words)), -1)
    keep = np.cumsum(cover)[:-1] == 0
    return [words[i] for i in np.flatnonzero(keep)]


def without_repeated_passages(docs: DataFrame, width: int = WIDTH, **options) -> DataFrame:
    """``docs`` with the kept words joined by one space; a text that loses
    nothing is unchanged."""
    own_id, own_key, own_starts, own_blocks = free_names(docs, "__own_id", "__own_key", "__own_starts", "__own_blocks")
    found = repeated_passages(docs, width, **options).select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), F.col("starts").alias(own_starts), F.col("blocks").alias(own_blocks))
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    both = docs.join(found, (ids == F.col(own_id)) & (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col(own_key)), "left").drop(own_id, own_key)
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            out = [t if starts is None else b" ".join(kept_words(t.split(), starts, blocks, width)) for t, starts, blocks in
                   zip(texts.cast(pa.binary()).to_pylist(), b.column(own_starts).to_pylist(), b.column(own_blocks).to_pylist())]
            new = pa.array(out, pa.binary()).cast(texts.type)
            yield pa.RecordBatch.from_arrays([new if f.name == "text" else b.column(f.name) for f in schema], [f.name for f in schema])
    return both.mapInArrow(cut, schema)


def passage_digests(docs: DataFrame, width: int = WIDTH, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 of the kept words."""
    found = repeated_passages(docs, width, **options)
    both = documents(docs).join(found, ["doc_id", "text_key"], "left").select("doc_id", "text", "starts", "blocks")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, lost, sha = [], [], []
            for t, starts, blocks in zip(as_bytes(b.column("text")), b.column("starts").to_pylist(), b.column("blocks").to_pylist()):
                words = t.split()
                kept = kept_words(words, starts, blocks, width)
                n.append(len(words))
                lost.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return (both.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
            .select(null_id(), "n_words", "n_removed", "kept_sha256"))
