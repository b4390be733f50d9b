"""Benchmark decontamination by size-partitioned MinHash containment search.

Only DataFrame functions.  A shingle is ``width`` consecutive words; words are
runs of letters and digits, lower-cased.  A document is contaminated by an item
when it holds at least ``percent`` % of the item's distinct shingles, wherever in
its text, however long it is.

* Items are partitioned by size (powers of two of their shingle count).  An
  item's sketch is its shingles with the smallest hashes: as many as may be
  missing, and as many more as its partition asks to be found.  A document that
  holds the required share of the item therefore holds at least that many of the
  sketch: no contaminated document is lost, and the sketch, not the whole item,
  is what all documents are probed with.
* Every document's shingle hashes are made in one expression over its word array
  and exploded into a join with the sketches.  The sketches are broadcast if
  they are fewer than MAX_BROADCAST rows (checked by a count; 16 bytes a row) and
  joined by a shuffle otherwise.  Hits are counted in part before they move.
* Candidates are verified exactly: shingles as text, of the whole document
  against the whole item.

Defined cases: null and empty texts and items, and those without a letter or
digit, match nothing; an item with fewer words than ``width`` is one shingle,
which only a document of the same words holds; rows that repeat a doc_id count
as one document with the shingles of all of them, rows that repeat an item_id as
one item; null ids match nothing in ``contaminated`` (they name no row), while
``without_contaminated`` judges each text with a null doc_id as a document of
its own; empty tables give empty results; extra columns, also of the same name on both sides, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrisk.llm.common import NO_ID, free_names, stored

WIDTH, PERCENT = 5, 80
MAX_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _places(words: Column, width: int) -> Column:
    """Where shingles start; a shorter text has one, an empty one none."""
    n = F.size(words)
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, width: int) -> Column:
    """64-bit hashes of a word array's shingles, in order."""
    return F.transform(_places(words, width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))


def shingle_texts(words: Column, width: int) -> Column:
    """The shingles themselves; no word holds a space."""
    return F.transform(_places(words, width), lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(width)]))


def least_shared(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100).cast("long")


def _hash_of(shingle: Column, width: int) -> Column:
    """The same hash from the shingle's text."""
    words = F.split(shingle, " ")
    return F.xxhash64(*[F.get(words, F.lit(j)) for j in range(width)])


def sketches(items: DataFrame, width: int, percent: int) -> DataFrame:
    """(item_id, hash, needed) of each item's sketch; ``items``: (item_id, shingles)."""
    n = F.size("shingles")
    ranked = items.select("item_id", n.alias("n"), F.array_sort(F.array_distinct(F.transform("shingles", lambda s: _hash_of(s, width)))).alias("hashes"))
    part = F.floor(F.log2(F.greatest(F.col("n"), F.lit(1)))).cast("int")  # the size partition
    needed = (1 + F.floor(F.pow(F.lit(2), part) / 10)).cast("long")
    ranked = ranked.withColumn("needed", needed)
    size = (F.col("n") - least_shared(F.col("n"), percent) + F.col("needed")).cast("int")
    return ranked.select("item_id", "needed", F.explode(F.slice("hashes", F.lit(1), size)).alias("hash"))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every document and
    item of which it holds at least ``percent`` %."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text").cast("string")).alias("words")).where("doc_id is not null")
    return _search(texts, ["doc_id"], benchmark, width, percent, max_broadcast)


def _search(texts: DataFrame, keys: list[str], benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The same for ``texts`` of (keys, words); rows with equal keys are one document."""
    own = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text").cast("string")).alias("words")).where("item_id is not null")
           .select("item_id", F.explode(shingle_texts(F.col("words"), width)).alias("shingle")).distinct())
    own = stored(own, "item-shingles")
    items = own.groupBy("item_id").agg(F.collect_list("shingle").alias("shingles"))
    sketch = sketches(items, width, percent).select("item_id", "needed", "hash")
    sketch = stored(sketch, "sketches")
    few = sketch.count() <= max_broadcast
    probes = texts.select(*keys, F.explode(shingle_hashes(F.col("words"), width)).alias("hash"))
    hits = (probes.join(F.broadcast(sketch) if few else sketch, "hash").select(*keys, "item_id", "needed", "hash").distinct()
            .groupBy(*keys, "item_id").agg(F.count("*").alias("found"), F.max("needed").alias("needed")).where("found >= needed"))
    candidates = stored(hits.select(*keys, "item_id"), "candidates")
    suspects = candidates.select(*keys).distinct()
    held = (texts.join(suspects, keys, "left_semi")
            .select(*keys, F.explode(shingle_texts(F.col("words"), width)).alias("shingle")))
    sizes = own.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    few_own = own.count() <= max_broadcast
    shared = (held.join(F.broadcast(own) if few_own else own, "shingle").select(*keys, "item_id", "shingle").distinct()
              .groupBy(*keys, "item_id").agg(F.count("*").alias("n_shared")))
    return (shared.join(F.broadcast(sizes) if few_own else sizes, "item_id").where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)
            .join(candidates, [*keys, "item_id"], "left_semi")
            .select(*keys, "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    own_id, own_key, row_id, row_key = free_names(docs, "__own_id", "__own_key", "__row_id", "__row_key")
    row = {row_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
           row_key: F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))).otherwise(F.lit(0).cast("long"))}
    texts = docs.select(row[row_id].alias(own_id), row[row_key].alias(own_key), words_of(F.col("text").cast("string")).alias("words"))
    bad = _search(texts, [own_id, own_key], benchmark, **options).select(own_id, own_key).distinct()
    return (docs.withColumns(row).join(bad, (F.col(row_id) == F.col(own_id)) & (F.col(row_key) == F.col(own_key)), "left_anti")
            .select(docs.columns))
