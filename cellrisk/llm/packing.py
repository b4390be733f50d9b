"""Harmonic packing of token ids into sequences of one capacity.

A document is its token ids and one end id.  It is cut into whole sequences
while it is long enough; what is left over goes, as long as a part remains, to
the reciprocal-capacity class of the largest length C // k that it can fill (a
remainder of at most sqrt(C) is a class of its own length).  A class of length s
fills a sequence with exactly C // s pieces, whatever the documents, so a
worker keeps fewer than one sequence per class open (about 2 sqrt(C) classes)
and needs no other worker.  A full class sequence leaves C mod s ids of padding,
less than sqrt(C).

At a task's end the open pieces are laid end to end, cut at the capacity, and
the last, short one is cut into sequences whose lengths are powers of two, which
need no padding.

Defined cases: null and empty texts are the end id alone; a null doc_id stays
null; rows that repeat a doc_id are packed as rows of their own; empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, END_ID = 2048, 1
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
#: White space of this length is beyond the stack of ``tiktoken``'s expressions by far less than it bears.
_LONG_BLANK = re.compile(r"\s{10000}")


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable bytes are
    written as themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def encoder(path: str, special_strings: bool = True):
    """text -> ids, as ``tokenizers`` gives them for the file at ``path``.  Strings
    of special tokens inside a text are these tokens, or plain text if not
    ``special_strings``.

    A byte-level BPE without a normaliser, whose ids rank its merges, is run by
    ``tiktoken`` over the file's own vocabulary: the same ids in a fifth of the
    time.  Texts with very long white space, which overflow its stack, and any
    other file are run by ``tokenizers`` itself."""
    @cache
    def whole():
        from tokenizers import Tokenizer
        loaded = Tokenizer.from_file(path)
        loaded.encode_special_tokens = not special_strings
        return loaded

    def by_tokenizers(text: str) -> list[int]:
        return whole().encode(text, add_special_tokens=False).ids
    spec = json.load(open(path, encoding="utf-8"))
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    plain = (model.get("type") == "BPE" and pre == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not spec.get("normalizer")
             and not model.get("dropout") and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)))
    if not plain:
        return by_tokenizers
    import public_tokenizers
    import tiktoken
    letter = byte_letters()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letter[c] for c in word): i for word, i in vocab.items() if word not in special}
    bpe = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> list[int]:
        if _LONG_BLANK.search(text):
            return by_tokenizers(text)
        if special_strings and any(s in text for s in special):
            return bpe.encode(text, allowed_special="all")
        return bpe.encode_ordinary(text)
    return ids


def cuts(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces."""
    out = [capacity] * (n // capacity)
    r = n % capacity
    while r:
        k = -(-capacity // r)
        s = r if r * r <= capacity else capacity // k
        out.append(s)
        r -= s
    return out


class Packer:
    """Open sequences of one task, a list of pieces for each class."""

    def __init__(self, capacity: int, base: int):
        self.capacity, self.next, self.open = capacity, base, {}
        self.out: list[tuple] = []

    def place(self, pieces: list[tuple]) -> None:
        """As the next sequence."""
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), ids.tobytes(), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        start = 0
        for s in cuts(len(ids), self.capacity):
            held = self.open.setdefault(s, [])
            held.append((doc, start, ids[start:start + s], len(ids)))
            start += s
            if len(held) == self.capacity // s:
                self.place(self.open.pop(s))

    def close(self) -> None:
        rest = [p for s in sorted(self.open, reverse=True) for p in self.open[s]]
        left = sum(len(p[2]) for p in rest)
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            now = []
            while room:
                doc, start, ids, total = rest.pop(0)
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, ids[room:], total))
                    ids = ids[:room]
                now.append((doc, start, ids, total))
                room -= len(ids)
            self.place(now)
        self.open = {}

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _NAMES)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32),
    doc_tokens, sequence_id, offset.  ``tokenizer`` is the path of a tokenizer
    file on every worker, by default that of byte_bpe_50k.json.

    A sequence_id is the task's partition and a counter in it, so a task that
    runs again after a lost executor gives the same ids again."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        encode = encoder(tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                packer.add(doc, np.array([*encode(text or ""), end_id], "<u4"))
                if len(packer.out) >= 2000:
                    yield packer.batch()
        packer.close()
        yield packer.batch()
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(pack, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"))
