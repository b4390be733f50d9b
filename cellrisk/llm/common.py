"""Shared pieces of the training-data operators.

Words are maximal runs without ASCII white space (``[^\\x20\\x09-\\x0D]+``),
which is what ``bytes.split()`` yields on UTF-8.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.session import checkpoint_dir

#: ASCII white space, as bytes to strip or delete.
SPACE = b" \t\n\x0b\x0c\r"
#: Stands for a null doc_id inside the operators: it orders before all ids.
NO_ID = -(1 << 63)
MIX = np.uint64(0x9E3779B97F4A7C15)


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that spark.checkpoint.dir names."""
    _made.append(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def release(spark: SparkSession) -> None:
    """Delete the tables that this process has stored.  For when the results
    that read them have been written; nothing calls it on its own."""
    for path in _made:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _made.clear()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and
    a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(df: DataFrame) -> DataFrame:
    """``doc_id`` (null -> NO_ID), ``text`` and ``text_key``.

    A row is known by (doc_id, text_key): rows that repeat an id with another
    text stay apart, exact repeats of a row share one result."""
    return df.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"),
                     F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key"))


def null_id(name: str = "doc_id"):
    return F.when(F.col(name) != F.lit(NO_ID), F.col(name)).alias(name)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until no column of ``docs`` has it."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit names that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A name for each byte, zero for white space; and the same with A-Z lowered.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * MIX)
_BYTE[list(SPACE)] = 0
_LOWERED = _BYTE[np.frombuffer(bytes(range(256)).lower(), np.uint8)]
_GAP = np.zeros(256, bool)
_GAP[list(SPACE)] = True


def word_names(texts: list[bytes], lower: bool = False) -> list[np.ndarray]:
    """64-bit names of each text's words, in order.

    A word's name is the sum of its bytes' names, each times a power of one odd
    number for its place, mixed; all texts are named in one vector pass."""
    x = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    gap = _GAP.take(x)
    start = ~gap
    start[1:] &= gap[:-1]
    starts = np.flatnonzero(start)
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    tail = x[starts[0]:]
    at = starts - starts[0]
    run = np.diff(np.r_[at, len(tail)])
    place = np.arange(len(tail), dtype=np.int32) - np.repeat(at.astype(np.int32), run)
    power = np.full(int(run.max()), MIX | np.uint64(1), np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    names = mixed(np.add.reduceat((_LOWERED if lower else _BYTE).take(tail) * power.take(place), at))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.split(names, np.searchsorted(starts, ends[:-1]))


def window_names(names: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Name of every run of ``width`` consecutive names; empty if there is none."""
    n = len(names) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    m = mixed(names + np.uint64(seed))
    h = np.full(n, np.uint64(seed + width), np.uint64)
    for j in range(width):
        h = h * MIX + m[j:j + n]
    return mixed(h)


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted block of rows begins a new value of the columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], least: int = 200_000) -> Iterator[pa.Table]:
    """Tables of at least ``least`` rows that never cut a group of the sorted input."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < least:
            continue
        last = [b.column(k)[b.num_rows - 1].as_py() for k in keys]
        t = pa.Table.from_batches(held).combine_chunks()
        same = np.ones(t.num_rows, bool)
        for k, v in zip(keys, last):
            same &= t[k].to_numpy() == v
        cut = int(np.argmax(same))
        if cut:
            yield t.slice(0, cut)
            rest = t.slice(cut).combine_chunks()
            held, rows = rest.to_batches(), 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


#: Rows of a bit table's blocks: 2**19 bits, 64 KB.
BLOCK = 19


def bit_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, np.ndarray] = {}
    for b in batches:
        x = b.column(0).to_numpy()
        for k in np.unique(x >> BLOCK):
            bits = blocks.setdefault(int(k), np.zeros(1 << BLOCK, bool))
            bits[x[(x >> BLOCK) == k] & ((1 << BLOCK) - 1)] = True
    for k, bits in blocks.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["block", "bits"])


class BitTable:
    """A filter of fixed size: 2**bits bits, whatever the input's size.

    It may say yes by chance, never no by chance, so callers only use it to
    leave out work that an exact later step would find useless.  At most
    2**bits / 8 bytes go to the driver and to each Python worker."""

    def __init__(self, spark: SparkSession, bits: int, rows: list, block: int = BLOCK):
        """Of rows (block, bits), each with 2**block bits of the table."""
        table = np.zeros(1 << (bits - 3), np.uint8)
        for r in rows:
            table[r["block"] << (block - 3):(r["block"] + 1) << (block - 3)] |= np.frombuffer(r["bits"], np.uint8)
        self.bits, self.shared = bits, spark.sparkContext.broadcast(table)

    @classmethod
    def of(cls, names: DataFrame, column: str, bits: int) -> "BitTable":
        """Of a long column; the table's blocks are filled on the workers."""
        spots = names.select((F.col(column).bitwiseAND(F.lit((1 << bits) - 1))).alias("spot"))
        rows = (spots.repartition(F.shiftright("spot", BLOCK)).mapInArrow(bit_blocks, "block long, bits binary")
                .collect())
        return cls(names.sparkSession, bits, rows)

    def drop(self) -> None:
        """For when nothing that reads it will run again."""
        self.shared.destroy()

    def has(self, names: np.ndarray) -> np.ndarray:
        spot = names.astype(np.int64, copy=False) & ((1 << self.bits) - 1)
        return (self.shared.value[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8) & 1).astype(bool)


#: A key with a share of one in HOT_SHARE of the rows, and HOT_LEAST rows, is hot.
HOT_SHARE, HOT_LEAST = 1000, 1000


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], weight: str, how: str) -> DataFrame:
    """Join with a table that has one row a key, and in ``weight`` how many rows
    of ``left`` hold that key.

    No more than HOT_SHARE keys can each hold one in HOT_SHARE of the rows, so
    the hot ones are broadcast and their rows stay where they are; the rest is
    joined by a shuffle without hot keys."""
    least = max(HOT_LEAST, left.count() // HOT_SHARE)
    hot = F.broadcast(right.where(F.col(weight) >= least))
    cold = left.join(F.broadcast(right.where(F.col(weight) >= least).select(*keys)), keys, "left_anti")
    return left.join(hot, keys).unionByName(cold.join(right.where(F.col(weight) < least), keys, how))


#: Links that a task joins at a time.
STAR_LINKS = 500_000


def stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of each block of the task as stars: every node but the
    smallest of its component in the block, with that smallest one."""
    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v")]
        nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
        a, b = np.split(at, 2)
        root = np.arange(len(nodes))
        while (root[a] != root[b]).any():
            x, y = root[a], root[b]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
        far = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], ["u", "v"])

    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= STAR_LINKS:
            yield joined(held)
            held, rows = [], 0
    if rows:
        yield joined(held)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the links.

    Large-star and small-star rounds until all links are stars: each round is two
    grouped minima and two joins, so no component is ever held by one task.  Tasks
    join the links that they hold before these are stored, so few links take no
    round, and rounds grow with the logarithm of a component's size at most."""
    def kept(links: DataFrame) -> DataFrame:
        return stored(links.distinct().mapInArrow(stars, "u long, v long"), "links")

    e = kept(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v"))
    while True:
        # a star's nodes have one smaller neighbour, and are nobody's
        ends = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v")))
        if ends.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.count_if(F.col("v").isNull()).alias("above")).where("least <> most or least is not null and above > 0").isEmpty():
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stored(both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "links")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        e = kept(large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(down.select("u", F.col("m").alias("v"))))
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
