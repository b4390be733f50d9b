"""Secret scans over a history of texts, with an incremental blob ledger.

A version of a path is known by the SHA-256 of its text, its blob.  The ledger
is a table that says, for each blob, which rules it was scanned by (a rule is
its kind and version) and what they found, so a run

1. addresses every version by its content (no text leaves the scan here),
2. takes each blob's first (path, version) and the rules that the ledger does not
   have for it yet: the unseen pairs,
3. scans the texts of these alone and appends them to the ledger, clean ones
   with an empty list,
4. joins the ledger's findings back to every path and version of the blob.

A text that stands under a thousand paths is scanned once, a later run scans new
texts only, and a new version of one rule runs that rule alone.  A run that dies
before its append leaves the ledger as it was; pairs that two runs append at the
same time are made distinct when they are read.

Spans are in code points, the end exclusive.  A rule's matches are leftmost and
do not overlap; a match whose measured group is shorter than the rule's least
length is dropped, and the search goes on after it.

Defined cases: null text is empty, and empty texts have no findings; null paths
and versions are values like others; rows that repeat are rows of their own;
empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.llm.common import join_hot, scratch, stored


class Rule(NamedTuple):
    """``needles``: lower-case strings, one of which every match contains."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False
    needles: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds, in their order, then those that are added to them.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, False, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}"),  # [0-9a-f]+ of 24 characters or more
)
ADDED = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", needles=("private key-----",)),
    Rule("forge", 1, r"gh[opsru]_[A-Za-z0-9]{36,}", needles=("gho_", "ghp_", "ghs_", "ghr_", "ghu_")),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", needles=("xox",)),
    Rule("cloud", 1, r"AIza[A-Za-z0-9_-]{35}", needles=("aiza",)),
)
RULES = BASE + ADDED

_FOUND = "array<struct<rule string, start long, stop long>>"
_LEDGER = f"blob binary, rules array<string>, found {_FOUND}"
_FOUND_ARROW = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def matches(rule: Rule, text: str, lowered: str) -> Iterator[tuple[int, int]]:
    """Spans of one rule.  ``lowered`` is only searched for the needles."""
    if rule.needles and not any(n in lowered for n in rule.needles):
        return
    for m in re.finditer(rule.pattern, text, re.ASCII | re.IGNORECASE if rule.any_case else re.ASCII):
        if m.end(rule.group) - m.start(rule.group) >= rule.least:
            yield m.span()


def _scan(rules: tuple[Rule, ...]):
    by_name = {r.name: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for text, todo in zip(b.column("text").to_pylist(), b.column("todo").to_pylist()):
                lowered = text.lower()
                found.append([{"rule": k, "start": i, "stop": j} for k in todo for i, j in matches(by_name[k], text, lowered)])
            yield pa.RecordBatch.from_arrays([b.column("blob"), b.column("todo").cast(pa.list_(pa.string())), pa.array(found, _FOUND_ARROW)], ["blob", "rules", "found"])
    return scan


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was appended yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def scan_history(history: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, version, blob, found) for every row of ``history`` (path, version,
    text).  ``found`` holds (rule, start, stop), null where there is none.
    ``ledger`` is a path in a shared store; without one the run has its own."""
    spark = history.sparkSession
    ledger = ledger or scratch(spark, "ledger")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = history.select("path", "version", text.alias("text")).withColumns({"blob": F.unhex(F.sha2("text", 256)), "place": F.xxhash64("path", "version")})
    blobs = stored(rows.select("path", "version", "blob", "place"), "blobs")
    firsts = blobs.groupBy("blob").agg(F.min("place").alias("place"), F.count("*").alias("copies"))
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    todo = stored(firsts.join(seen, "blob", "left").select("blob", "place", F.when(F.col("seen").isNull(), names).otherwise(F.array_except(names, F.col("seen"))).alias("todo"))
                  .where(F.size("todo") > 0), "unseen")
    if not todo.isEmpty():
        unseen = rows.select("blob", "place", "text").join(todo, ["blob", "place"]).select("blob", "todo", "text")
        unseen.mapInArrow(_scan(tuple(rules)), _LEDGER).write.mode("append").option("compression", "zstd").parquet(ledger)
    known = read_ledger(spark, ledger).select("blob", F.filter("found", lambda x: x["rule"].isin([r.name for r in rules])).alias("found")).where(F.size("found") > 0)
    known = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    findings = stored(known.join(firsts.select("blob", "copies"), "blob"), "findings")
    return join_hot(blobs, findings, ["blob"], "copies", "left").select("path", "version", "blob", "found")


def secret_digests(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, n_<kind> of each base kind, base_sha256 over
    the base spans and spans over all, by start and then by the rules' order."""
    found = scan_history(docs.select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text"), ledger, rules)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.kind))])
    spans = F.array_sort(F.transform(F.coalesce("found", F.array().cast(_FOUND)), lambda x: F.struct(
        x["start"].alias("start"), order[x["rule"]].alias("at"), x["stop"].alias("stop"), kinds[x["rule"]].alias("kind"))))

    def joined(c):
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    bases = [r.kind for r in BASE]
    base = F.filter("all", lambda x: x["kind"].isin(bases))

    def count(kind: str):
        return F.size(F.filter("all", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in bases]
    return (found.select(F.col("path").alias("doc_id"), spans.alias("all"))
            .select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("all")).alias("spans")))
