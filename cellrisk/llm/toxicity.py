"""Toxicity as a counterfactual-regularised classifier.

Logistic regression over the words of a text and the word beginnings they share.
Labelled sentences that mention a group are swapped: each identity term is
replaced by the others of its kind, and the squared change of the score is added
to the loss, so a mention by itself cannot raise the score.

The classifier is fitted on about MAX_LABELLED labelled texts at most (those
whose id hashes into that share of the range; texts, not prefixes).  Spark counts
their features and chooses those whose rates differ most between the classes;
only the places of the chosen features, at most MAX_FEATURES and the identity
terms, go to the driver.

Words are lower-cased and cut at whatever is neither letter nor digit.

Defined cases: null and empty texts get the bias alone; labels other than 0 and
1, null labels and labels of a null doc_id teach nothing; of several labels of
one doc_id the largest counts; without labels of both kinds the score is that
of the one there is (0 if none); a null doc_id stays null and counts as the
empty string in the split; rows that repeat a doc_id are rows of their own;
empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrisk.llm.common import stored

MAX_LABELLED, MAX_FEATURES = 20_000, 20_000
LEAST_TEXTS, LEAST_Z = 4, 2.5
#: Weight of the counterfactual penalty and of the squared weights.
SWAP, SHRINK = 20.0, 2e-4
THRESHOLD = 0.3
BEGINNING = 5
#: Terms that name a group; those of a row stand in for one another.
IDENTITY = [
    "woman man girl boy", "women men girls boys", "female male", "gay straight lesbian bisexual heterosexual", "transgender cisgender",
    "black white asian latino", "muslim christian jewish hindu buddhist atheist", "muslims christians jews hindus buddhists atheists",
    "immigrant native refugee", "immigrants natives refugees", "american mexican chinese african european", "old young", "disabled blind deaf",
    "femme homme", "femmes hommes", "musulman chrétien juif", "frau mann", "frauen männer", "muslime christen juden", "mujer hombre", "mujeres hombres", "musulmán cristiano judío",
]
KIN = {w: [x for x in row.split() if x != w] for row in IDENTITY for w in row.split()}
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_SENTENCE = regex.compile(r"[.!?\n]+")


def name(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature)


def features(words: set[str]) -> np.ndarray:
    """Sorted names of words, and of the beginnings of longer ones."""
    all_of = words | {f"{w[:BEGINNING]}*" for w in words if len(w) > BEGINNING}
    return np.unique(np.fromiter(map(name, all_of), np.uint64, len(all_of)))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def swaps(text: str) -> list[tuple[int, ...]]:
    """For each identity term of each sentence and each stand-in: names of the
    term, its beginning, the stand-in, its beginning (0 if it has none)."""
    def both(w: str) -> tuple[int, int]:
        return name(w), name(f"{w[:BEGINNING]}*") if len(w) > BEGINNING else 0
    out = []
    for sentence in _SENTENCE.split(text):
        for w in set(words_of(sentence)) & KIN.keys():
            out += [(*both(w), *both(x)) for x in KIN[w]]
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        f, s = [], []
        for text in b.column("text").to_pylist():
            f.append(features(set(words_of(text or ""))).view(np.int64))
            s.append(np.array(sorted(set(swaps(text or ""))), np.uint64).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(f, pa.list_(pa.int64())), pa.array(s, pa.binary())], ["label", "features", "swaps"])


class Classifier:
    """Feature names in order, their weights, the bias."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, bias: float):
        self.names, self.weights, self.bias = names, weights, bias

    def score(self, text: str) -> float:
        x = features(set(words_of(text)))
        total = self.bias
        if len(self.names) and len(x):
            at = np.minimum(np.searchsorted(self.names, x), len(self.names) - 1)
            total += float(self.weights[at[self.names[at] == x]].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(labels: np.ndarray, texts: list[np.ndarray], names: np.ndarray, pairs: list[np.ndarray], rounds: int = 200, step: float = 0.05) -> Classifier:
    """``texts``: places in ``names`` (sorted) of each text's features; ``pairs``:
    its rows of ``swaps``."""
    y = labels.astype(float)
    if not len(y) or y.min() == y.max():
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), 30.0 if len(y) and y[0] else -30.0)
    row, col = np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.concatenate(texts)
    pair = [p for p in pairs if len(p)]
    pair = np.concatenate(pair) if pair else np.zeros((0, 4), np.uint64)
    spot = np.minimum(np.searchsorted(names, pair), max(len(names) - 1, 0))
    sign = np.where(names[spot] == pair, [1, 1, -1, -1], 0) if len(names) else np.zeros(pair.shape)  # a term that the model lacks weighs nothing
    w, bias = np.zeros(len(names)), float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], len(y)) + bias, -30, 30)))
        e = (p - y) / len(y)
        g = np.bincount(col, e[row], len(w)) + SHRINK * w
        if len(pair) and len(names):
            change = (w[spot] * sign).sum(axis=1, keepdims=True)
            g += 2 * SWAP / len(pair) * np.bincount(spot.ravel(), (change * sign).ravel(), len(w))
        g = np.r_[g, e.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - move[:-1], bias - float(move[-1])
    return Classifier(names, w, bias)


def telling_features(rows: DataFrame) -> np.ndarray:
    """Sorted names of the features whose rates differ most between the classes,
    MAX_FEATURES at most, and of the identity terms.  Counted by Spark."""
    n, toxic = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("t")).first()
    one, none = F.col("n1") + 0.5, F.col("n") - F.col("n1") + 0.5
    z = F.abs(F.log((one / (toxic + 1)) / (none / (n - toxic + 1)))) / F.sqrt(1 / one + 1 / none)
    counts = rows.select("label", F.explode("features").alias("name")).groupBy("name").agg(F.sum("label").alias("n1"), F.count("*").alias("n"))
    best = (counts.where(F.col("n") >= LEAST_TEXTS).withColumn("z", z).where(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "name").limit(MAX_FEATURES).select("name").collect())
    terms = features(set(KIN))
    return np.unique(np.concatenate([np.array([r["name"] for r in best], np.int64).view(np.uint64), terms]))


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier:
    """From (doc_id, text) and (doc_id, label 0 or 1)."""
    known = (labels.where("label in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("label").cast("int").alias("label")))
    n = known.count()
    if n > max_labelled:  # a share of the hashes' range
        known = known.where(F.abs(F.xxhash64(F.lit("toxicity"), "doc_id") % 1_000_000) < int(1_000_000 * max_labelled / n))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(known), "doc_id")  # about max_labelled rows of 12 bytes
    rows = stored(texts.select("label", "text").mapInArrow(_rows, "label int, features array<long>, swaps binary"), "toxicity-rows")
    names = telling_features(rows)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for f in b.column("features"):
                x = f.values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(names, x), len(names) - 1)
                out.append(at[names[at] == x].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(out, pa.binary()), b.column("swaps")], ["label", "features", "swaps"])
    got = rows.mapInArrow(places, "label int, features binary, swaps binary").collect()
    return fit(np.array([r["label"] for r in got], np.int64), [np.frombuffer(r["features"], np.int32) for r in got], names,
               [np.frombuffer(r["swaps"], np.uint64).reshape(-1, 4) for r in got])


def with_toxicity(docs: DataFrame, model: Classifier, column: str = "toxicity") -> DataFrame:
    """``docs`` with ``column``, 0 to 1, in place of one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.weights, model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier(*shared.value)
        for b in batches:
            out = [own.score(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*b.schema.names, column])
    plain = docs.drop(column)
    return plain.mapInArrow(score, T.StructType([*plain.schema.fields, T.StructField(column, T.DoubleType())]))
