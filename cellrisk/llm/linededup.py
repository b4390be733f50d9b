"""Line dedup: range-partitioned line hashes, streamed in order of document and position.

A line's key is the line without ASCII white space at both ends, A-Z lowered.
Keys of at least ``min_chars`` code points that at least ``min_docs`` documents
hold lose all their lines except those of the largest doc_id that holds them.

* Tasks turn whole texts into (128-bit key hash, doc_id, position) rows.  Before
  anything moves, a chunk of lines settles keys that enough of its own documents
  share: only the chunk's largest holder travels, with the others' count, so a
  line that a third of all documents repeat costs a few rows a chunk.
* The rows are written, range-partitioned on the hash and sorted by (hash,
  doc_id descending, position); a task streams them, keeps the first holder's
  lines and marks the rest.
* What comes back is one compressed keep bitmap for each document that loses
  lines, never text.  Documents without a bitmap keep every line.

Defined cases: null and empty texts are one empty line; rows that repeat a
doc_id count as one document and get the same treatment; a null doc_id orders
before all others; empty tables give empty results; extra columns of the input
are ignored by ``line_bitmaps`` and kept by ``without_repeated_lines``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import NO_ID, SPACE, as_bytes, documents, free_names, null_id, starts_of, stored, whole_groups

MIN_CHARS, MIN_DOCS = 40, 5
#: Lines that a task settles among themselves before it sends rows.
CHUNK_LINES = 400_000

_ROWS = "dropped boolean, hi long, lo long, doc_id long, text_key long, position int, holders long"


def _line_rows(min_chars: int, min_docs: int, chunk: int):
    def settle(keys: list[bytes], ids: list[int], texts: list[int], at: list[int]) -> pa.RecordBatch:
        h = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).view(np.int64).reshape(-1, 2)
        doc, text, pos = np.array(ids, np.int64), np.array(texts, np.int64), np.array(at, np.int32)
        o = np.lexsort((pos, text, ~doc, h[:, 1], h[:, 0]))
        hi, lo, doc, text, pos = h[o, 0], h[o, 1], doc[o], text[o], pos[o]
        key, holder = starts_of(hi, lo), starts_of(hi, lo, doc)
        g = np.cumsum(key) - 1
        n = np.add.reduceat(holder.astype(np.int64), np.flatnonzero(key))[g]
        first = doc == doc[key][g]
        dropped = (n >= min_docs) & ~first
        holders = np.where(holder, np.where(n >= min_docs, n, 1), 0)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (dropped, hi, lo, doc, text, pos, holders)],
                                          ["dropped", "hi", "lo", "doc_id", "text_key", "position", "holders"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, texts, at = [], [], [], []
        for b in batches:
            for doc, text, body in zip(b.column("doc_id").to_pylist(), b.column("text_key").to_pylist(), as_bytes(b.column("text"))):
                for i, line in enumerate(body.split(b"\n")):
                    key = line.strip(SPACE)
                    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
                        continue
                    keys.append(xxhash.xxh3_128_digest(key.lower()))
                    ids.append(doc)
                    texts.append(text)
                    at.append(i)
                if len(keys) >= chunk:
                    yield settle(keys, ids, texts, at)
                    keys, ids, texts, at = [], [], [], []
        if keys:
            yield settle(keys, ids, texts, at)
    return rows


def _repeats(min_docs: int):
    """From rows in order of key, doc_id descending: those that lose their line."""
    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["hi", "lo"]):
            hi, lo, doc, holders = (t[c].to_numpy() for c in ("hi", "lo", "doc_id", "holders"))
            key, holder = starts_of(hi, lo), starts_of(hi, lo, doc)
            g = np.cumsum(key) - 1
            each = np.maximum.reduceat(holders, np.flatnonzero(holder))  # a document's rows may come from several chunks
            n = np.add.reduceat(each, np.flatnonzero(key[holder]))
            lost = (n[g] >= min_docs) & (doc != doc[key][g])
            if lost.any():
                yield from t.filter(pa.array(lost)).select(["doc_id", "text_key", "position"]).to_batches()
    return repeats


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        maps, n = [], []
        for at in b.column("positions").to_pylist():
            keep = np.ones(max(at) // 8 * 8 + 8, bool)  # whole bytes, kept beyond the last drop
            keep[at] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
            n.append(len(set(at)))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(maps, pa.binary()), pa.array(n, pa.int64())],
                                         ["doc_id", "text_key", "keep_bitmap", "n_dropped"])


def kept_lines(lines: list, bitmap: bytes | None) -> list:
    """Lines that the bitmap keeps; those beyond its end stay."""
    if bitmap is None:
        return lines
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)
    return [x for i, x in enumerate(lines) if i >= len(keep) or keep[i]]


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """(doc_id, text_key, keep_bitmap, n_dropped) of documents that lose lines."""
    rows = stored(documents(docs).mapInArrow(_line_rows(min_chars, min_docs, chunk_lines), _ROWS), "line-rows")
    ordered = (rows.where("not dropped").select("hi", "lo", "doc_id", "text_key", "position", "holders")
               .repartitionByRange("hi", "lo").sortWithinPartitions("hi", "lo", F.desc("doc_id"), "text_key", "position"))
    at = "doc_id long, text_key long, position int"
    lost = rows.where("dropped").select("doc_id", "text_key", "position").union(ordered.mapInArrow(_repeats(min_docs), at))
    return (lost.groupBy("doc_id", "text_key").agg(F.collect_set("position").alias("positions"))
            .mapInArrow(_bitmaps, "doc_id long, text_key long, keep_bitmap binary, n_dropped long"))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the kept lines as text; a text that loses nothing is unchanged."""
    own_id, own_key, own_keep = free_names(docs, "__own_id", "__own_key", "__own_keep")
    maps = line_bitmaps(docs, **options).select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), F.col("keep_bitmap").alias(own_keep))
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    both = docs.join(maps, (ids == F.col(own_id)) & (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col(own_key)), "left").drop(own_id, own_key)
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            out = [t if k is None else b"\n".join(kept_lines(t.split(b"\n"), k)) for t, k in
                   zip(texts.cast(pa.binary()).to_pylist(), b.column(own_keep).to_pylist())]
            new = pa.array(out, pa.binary()).cast(texts.type)
            yield pa.RecordBatch.from_arrays([new if f.name == "text" else b.column(f.name) for f in schema], [f.name for f in schema])
    return both.mapInArrow(cut, schema)


def line_digests(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 of the joined kept lines."""
    maps = line_bitmaps(docs, **options)
    both = documents(docs).join(maps, ["doc_id", "text_key"], "left").select("doc_id", "text", "keep_bitmap")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, lost, sha = [], [], []
            for t, k in zip(as_bytes(b.column("text")), b.column("keep_bitmap").to_pylist()):
                lines = t.split(b"\n")
                kept = kept_lines(lines, k)
                n.append(len(lines))
                lost.append(len(lines) - len(kept))
                sha.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha, pa.string())],
                                             ["doc_id", "n_lines", "n_dropped", "kept_sha256"])
    return (both.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
            .select(null_id(), "n_lines", "n_dropped", "kept_sha256"))
