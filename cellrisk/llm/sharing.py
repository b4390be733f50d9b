"""Names that more than one document holds, as a bit table of fixed size.

Tasks read whole texts in chunks and emit the distinct names of a chunk for each
range of names, packed as sorted deltas (three to four bytes a name); a range's
task merges them and sets the bits of the names that occur twice."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellrisk.llm.common import BitTable, as_bytes, starts_of, word_names

#: Bits of a name that are compared here.
_BITS = 48


class Chunk:
    """Word names of some whole documents."""

    def __init__(self):
        self.names, self.ids, self.keys, self.size = [], [], [], 0

    def add(self, doc: int, key: int, names: np.ndarray) -> None:
        self.names.append(names)
        self.ids.append(doc)
        self.keys.append(key)
        self.size += len(names)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Names, the document's place in the chunk for each, where each
        document begins, and the documents' ids and text keys."""
        n = np.array([len(x) for x in self.names], np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        return np.concatenate(self.names), owner, np.cumsum(n) - n, np.array(self.ids, np.int64), np.array(self.keys, np.int64)


#: Bytes of texts that are named in one pass.
_NAMED = 1 << 15


def chunks(batches: Iterator[pa.RecordBatch], least: int, lower: bool = False) -> Iterator[Chunk]:
    """Chunks of at least ``least`` words, the last one aside."""
    chunk, held, size = Chunk(), [], 0

    def named() -> Iterator[Chunk]:
        nonlocal chunk
        for (doc, key, _), names in zip(held, word_names([t for _, _, t in held], lower)):
            chunk.add(doc, key, names)
            if chunk.size >= least:
                yield chunk
                chunk = Chunk()

    for b in batches:
        for row in zip(b.column("doc_id").to_pylist(), b.column("text_key").to_pylist(), as_bytes(b.column("text"))):
            held.append(row)
            size += len(row[2]) + 1
            if size >= _NAMED:
                yield from named()
                held, size = [], 0
    if held:
        yield from named()
    if chunk.ids:
        yield chunk


def pack(names: np.ndarray, many: np.ndarray) -> bytes:
    """Sorted distinct names as delta bytes, plane by plane, and flags."""
    d = np.diff(names, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    used = np.flatnonzero(d[:, 1:].any(axis=1))
    planes = int(used[-1]) + 1 if len(used) else 0
    body = names[:1].tobytes() + bytes([planes]) + np.ascontiguousarray(d[:planes, 1:]).tobytes()
    return len(names).to_bytes(4, "little") + body + zlib.compress(np.packbits(many).tobytes(), 1)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, planes = int.from_bytes(blob[:4], "little"), blob[12]
    d = np.zeros((n, 8), np.uint8)
    d[0] = np.frombuffer(blob, np.uint8, 8, 4)
    d[1:, :planes] = np.frombuffer(blob, np.uint8, planes * (n - 1), 13).reshape(planes, n - 1).T
    many = np.unpackbits(np.frombuffer(zlib.decompress(blob[13 + planes * (n - 1):]), np.uint8))[:n].astype(bool)
    return np.cumsum(d.view(np.uint64).ravel(), dtype=np.uint64), many


def spots(names: np.ndarray, filter_bits: int) -> np.ndarray:
    """Places of names in a table made by ``shared_names``."""
    return (names >> np.uint64(64 - filter_bits)).astype(np.int64)


def _packed(names_of: Callable, range_bits: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, who in names_of(batches):
            if not len(name):
                continue
            name = name >> np.uint64(64 - _BITS)
            o = np.lexsort((who, name))
            name, who = name[o], who[o]
            at = np.flatnonzero(starts_of(name))
            ends = np.r_[at[1:], len(name)] - 1
            name, many = name[at], who[ends] != who[at]
            part = name >> np.uint64(_BITS - range_bits)
            cut = np.flatnonzero(starts_of(part))
            blobs = [pack(name[i:j], many[i:j]) for i, j in zip(cut, [*cut[1:], len(name)])]
            yield pa.RecordBatch.from_arrays([pa.array(part[cut].astype(np.int64)), pa.array(blobs, pa.binary())], ["part", "names"])
    return packed


def _shared(range_bits: int, filter_bits: int):
    """Rows sorted by range: bits of the names that two documents hold."""
    width = filter_bits - range_bits

    def bits_of(part: int, names: list, many: list) -> pa.RecordBatch:
        x, m = np.concatenate(names), np.concatenate(many)
        o = np.argsort(x, kind="stable")
        x, m = x[o], m[o]
        m[1:] |= x[1:] == x[:-1]
        bits = np.zeros(1 << width, bool)
        bits[(x[m] >> np.uint64(_BITS - filter_bits)).astype(np.int64) & ((1 << width) - 1)] = True
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["block", "bits"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, many = None, [], []
        for b in batches:
            for part, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if part != at and names:
                    yield bits_of(at, names, many)
                    names, many = [], []
                at = part
                x, m = unpack(blob)
                names.append(x)
                many.append(m)
        if names:
            yield bits_of(at, names, many)
    return shared


def shared_names(texts: DataFrame, names_of: Callable, filter_bits: int) -> BitTable:
    """``names_of`` turns Arrow batches into (names, owners) of whole chunks.

    The more shuffle partitions the session has, the more ranges there are, so a
    range's names stay a small part of the whole."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    range_bits = min(14, max(8, (4 * parts).bit_length()))
    rows = (texts.mapInArrow(_packed(names_of, range_bits), "part long, names binary")
            .repartition("part").sortWithinPartitions("part")
            .mapInArrow(_shared(range_bits, filter_bits), "block long, bits binary").collect())  # 2**filter_bits bits at most
    return BitTable(spark, filter_bits, rows, filter_bits - range_bits)
