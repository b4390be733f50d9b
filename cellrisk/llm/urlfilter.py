"""URL filters: rules first, then logistic regression on hashed character n-grams.

A rule (verdict, host, path) fits its host and all subdomains when the URL's
path starts with the rule's; of several that fit, the longest wins.  Every URL
without a rule is judged by a logistic regression on hashed character n-grams of
host and path, fitted on a small labelled URL table.

The labelled table is at most ``MAX_LABELLED`` rows (its rows with the smallest
hashes), the only thing that reaches the driver; the weights are one array of
2**HASH_BITS floats.  Rules are a short list of a user's own, written into one
expression.

Defined cases: a null URL or one without "://" has an empty host and path, fits
no rule and is judged by the regression; rows that repeat a page_id get a row
each; empty tables give empty results; without labels of both kinds every URL
gets the one verdict there is (allow, if none); extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MAX_LABELLED = 5000
HASH_BITS, GRAMS = 16, (2, 3, 4)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL, empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def features(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams; host and path have names of their own."""
    found = set()
    for mark, s in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            for i in range(len(s) - n + 1):
                found.add(zlib.crc32((mark + s[i:i + n]).encode()) & ((1 << HASH_BITS) - 1))
    return np.fromiter(sorted(found), np.int64, len(found))


def fit(rows: list[tuple[str, str, int]], penalty: float = 1e-3, rounds: int = 150, step: float = 0.1) -> np.ndarray:
    """Weights, the last one the bias, of (host, path, label) by full-batch Adam."""
    w = np.zeros((1 << HASH_BITS) + 1)
    y = np.array([r[2] for r in rows], float)
    if not len(y) or y.min() == y.max():
        w[-1] = 8.0 if len(y) and y[0] else -8.0
        return w
    x = [np.r_[features(h, p), 1 << HASH_BITS] for h, p, _ in rows]
    row, col = np.repeat(np.arange(len(x)), [len(i) for i in x]), np.concatenate(x)
    scale = 1 / np.sqrt([len(i) for i in x])[row]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.bincount(row, w[col] * scale, len(x))))
        g = np.bincount(col, ((p - y) / len(y))[row] * scale, len(w)) + penalty * w / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def block_scores(urls: DataFrame, weights: np.ndarray) -> DataFrame:
    """``urls`` (host, path and others) with ``score``, how likely it is to block."""
    shared = urls.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            out = []
            for host, path in zip(b.column("host").to_pylist(), b.column("path").to_pylist()):
                x = features(host, path)
                out.append(1 / (1 + np.exp(-(w[x].sum() + w[-1]) / np.sqrt(len(x) + 1))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*b.schema.names, "score"])
    return urls.mapInArrow(score, f"{', '.join(f'`{n}` {t}' for n, t in urls.dtypes)}, score double")


def labelled_by_rules(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(url, label 1 = block) of the URLs that a rule decides."""
    host, path = url_parts(F.col("url"))
    return pages.select("url", rule_of(host, path, rules).alias("r")).where("r is not null").select("url", (F.col("r.verdict") == "block").cast("int").alias("label"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = RULES, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, score (null where a rule decides).

    ``labelled``: (url, label), label 1 = block."""
    host, path = url_parts(F.col("url"))
    sample = (labelled.where("label is not null").select(host.alias("host"), path.alias("path"), F.col("label").cast("int").alias("label"))
              .distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_labelled).collect())
    weights = fit([(r["host"], r["path"], r["label"]) for r in sample])
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    ruled = parts.where("r is not null").select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"), F.lit(None).cast("double").alias("score"))
    free = block_scores(parts.where("r is null").select("page_id", "host", "path"), weights)
    return ruled.union(free.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.when(F.col("score") >= 0.5, "block").otherwise("allow").alias("verdict"), "score"))
