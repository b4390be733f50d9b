"""Corpus pipeline over ``documents``: toxicity, line dedup, near duplicates,
benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and gets what the stage before it kept;
all but the last return the columns of ``documents``, with ``n_chars`` following
a changed text.  Null, empty and blank texts pass all filtering stages; rows that
repeat a doc_id or have none are judged by their own text (decontamination judges
rows of one doc_id together); other columns, whatever their names, are kept; an
empty table gives an empty result.  ``run`` writes each stage's result as Parquet
in the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.llm import langid, toxicity
from cellrisk.llm.common import free_names, stored
from cellrisk.llm.decontaminate import without_contaminated
from cellrisk.llm.jaccard import one_of_each_group
from cellrisk.llm.linededup import without_repeated_lines
from cellrisk.llm.packing import pack_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is at least the threshold go.  The classifier
    learns from the labelled rows of ``documents`` outside the held-out fold."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.learn(texts, labels.where(~langid.held_out(F.col("doc_id"))))
    score, = free_names(docs, "toxicity")
    return toxicity.with_toxicity(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, except from the largest doc_id that holds them."""
    if "n_chars" not in docs.columns:
        return without_repeated_lines(docs)
    was, = free_names(docs, "__own_length")
    cut = without_repeated_lines(docs.withColumn(was, F.length("text")))
    changed = F.length("text") != F.col(was)
    return cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest doc_id."""
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with the digest of their ids."""
    pieces = pack_documents(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("ngram_jaccard_join", dedup_near), ("decontamination", decontaminate), ("packing", pack)]

#: A classifier and a tokenizer have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
