"""Language ID as multilingual mixture inference.

A document is a mixture of languages: each of its byte n-grams comes from one
language, drawn with the document's proportions.  Expectation-maximisation
estimates the proportions from the languages' n-gram likelihoods; of the nested
sets of the strongest languages the one with the best penalised likelihood is
kept (half a log of the n-gram count for each further language), and the
proportions over that set are the result.

N-gram counts of every labelled text are summed by Spark.  The model keeps the
counts that are not zero, n-gram by n-gram, so every labelled language is
learnt: what reaches the driver and the workers grows with the languages and
the n-grams that each has (at most 2**GRAM_BITS), never with the documents.  A
document's likelihoods are a small matrix of its n-grams and all languages, or,
where that would be large, stay in the sparse form; both give the same numbers.

Text is lower-cased; whatever is not a letter counts as one space.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and
so is every text if nothing is labelled; labelled rows with null text teach
nothing; a null doc_id stays null and counts as the empty string in the split;
rows that repeat a doc_id are rows of their own; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM_BITS, WIDTH = 16, 4
#: Cells (n-grams x languages) of a document that are laid out as a matrix.
DENSE_CELLS = 1 << 20
#: Counts that a task gathers before it adds equal ones up, and that it keeps before it passes them on.
GATHERED = 1 << 20
#: Added to each count, and the likelihood's temper: neighbouring n-grams overlap.
SMOOTH, TEMPER = 0.05, 1 / WIDTH
ROUNDS = 12
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_GAPS = regex.compile(r"[^\p{L}]+")


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def grams(text: str) -> np.ndarray:
    """Hashed byte n-grams of a whole text, in order."""
    x = np.frombuffer(f"  {_GAPS.sub(' ', text.lower())}  ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    h = x[:len(x) - WIDTH + 1].copy()
    for j in range(1, WIDTH):
        h = h << np.uint32(8) | x[j:len(x) - WIDTH + 1 + j]
    return h * np.uint32(2654435761) >> np.uint32(32 - GRAM_BITS)


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their counts."""
    code, place = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(place, np.concatenate(counts), len(code)).astype(np.int64)


def _counts(languages: list[str]):
    """(lang, gram, n), partial sums."""
    place = {x: i for i, x in enumerate(languages)}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times, held = [], [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array((codes[0] >> GRAM_BITS).astype(np.int32)), pa.array((codes[0] & (1 << GRAM_BITS) - 1).astype(np.int32)), pa.array(times[0])],
                                              ["lang", "gram", "n"])
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                if not text:
                    continue
                gram, n = np.unique(grams(text), return_counts=True)
                codes.append((place[lang] << GRAM_BITS) + gram.astype(np.int64))
                times.append(n)
                held += len(gram)
                if held >= GATHERED:
                    codes, times = ([x] for x in _added(codes, times))
                    held = len(codes[0])
                    if held >= GATHERED // 2:
                        yield rows()
                        codes, times, held = [], [], 0
        if codes:
            codes, times = ([x] for x in _added(codes, times))
            yield rows()
    return counts


class Languages:
    """Names, and of each n-gram the languages that have it.  Where language l has
    the n-gram c times, its likelihood is ``floor[l] * (1 + c / SMOOTH)``."""

    def __init__(self, names: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        """``n``: counts of the distinct pairs (``lang``, ``gram``)."""
        order = np.lexsort((lang, gram))
        self.names, self.lang, self.more = names, lang[order].astype(np.int32), n[order] / SMOOTH
        self.start = np.searchsorted(gram[order], np.arange((1 << GRAM_BITS) + 1))
        self.floor = np.log(SMOOTH) - np.log(np.bincount(lang, n, len(names)) + SMOOTH * (1 << GRAM_BITS))

    def _likelihoods(self, at: np.ndarray, c: np.ndarray, floor: np.ndarray, dense_cells: int):
        """Functions of the languages' shares: (the n-grams' likelihoods in the
        mixture, the languages' new shares); and each language's log likelihood
        beside its floor."""
        k = len(self.names)
        has = self.start[at + 1] - self.start[at]
        ends = np.cumsum(has)
        spot = np.arange(ends[-1]) + np.repeat(self.start[at] - ends + has, has)
        row, col, more = np.repeat(np.arange(len(at)), has), self.lang[spot], self.more[spot]
        own = np.bincount(col, c[row] * np.log1p(more), k)
        if len(at) * k <= dense_cells:
            p = np.ones((len(at), k))
            p[row, col] += more
            p *= floor
            return (lambda share: p @ share), (lambda share, per: share * (per @ p)), own

        def mix(share: np.ndarray) -> np.ndarray:
            part = floor * share
            return part.sum() + np.bincount(row, more * part[col], len(at))

        def new(share: np.ndarray, per: np.ndarray) -> np.ndarray:
            return share * floor * (per.sum() + np.bincount(col, more * per[row], k))
        return mix, new, own

    def mixture(self, text: str, dense_cells: int = DENSE_CELLS) -> dict[str, float]:
        """Proportions of the languages of a text's set."""
        count = np.bincount(grams(text), minlength=1 << GRAM_BITS)
        at = np.flatnonzero(count)
        k = len(self.names)
        if not len(at) or not k:
            return {}
        if k == 1:
            return {self.names[0]: 1.0}
        c = count[at] * TEMPER
        n, top = float(c.sum()), self.floor.max()
        mix, new, own = self._likelihoods(at, c, np.exp(self.floor - top), dense_cells)
        own = own + n * self.floor

        def em(chosen: np.ndarray) -> tuple[np.ndarray, float]:
            """Shares of all languages (0 for those not chosen), log likelihood."""
            share = np.zeros(k)
            share[chosen] = 1 / len(chosen)
            p = mix(share)
            for _ in range(ROUNDS):
                before = share
                share = new(share, c / p) / n
                p = mix(share)
                if np.abs(share - before).max() < 1e-3:
                    break
            return share, n * top + float(c @ np.log(p))

        share, whole = em(np.arange(k))
        order = np.argsort(-share, kind="stable")
        best = int(np.argmax(own))
        kept, value = {best: 1.0}, own[best]
        fee = 0.5 * np.log(max(n, 2.0))
        if whole > value + fee:  # no set can beat the likelihood of all languages
            for size in range(2, k + 1):
                s, v = (share, whole) if size == k else em(order[:size])
                if v - fee * (size - 1) > value:
                    kept, value = {int(i): float(s[i]) for i in order[:size]}, v - fee * (size - 1)
                if whole - fee * size <= value:
                    break
        total = sum(kept.values())
        return {self.names[i]: x / total for i, x in kept.items()}


def learn(labelled: DataFrame) -> Languages:
    """From (text, lang) with non-null lang; every value with a text is learnt."""
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null and text <> ''")
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    sums = rows.mapInArrow(_counts(names), "lang int, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = sums.toPandas()
    return Languages(names, *(got[c].to_numpy(np.int64) for c in ("lang", "gram", "n")))


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """Per row: doc_id, lang_pred, score (its proportion), languages (the set with
    proportions, as a map)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Languages.__new__(Languages)
        vars(own).update(shared.value)
        for b in batches:
            best, score, sets = [], [], []
            for text in b.column("text").to_pylist():
                found = own.mixture(text) if text and _LETTER.search(text) else {}
                name = max(found, key=lambda k: (found[k], k)) if found else UNKNOWN
                best.append(name)
                score.append(min(1.0, found.get(name, 0.0)))
                sets.append(list(found.items()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.map_(pa.string(), pa.float64()))],
                                             ["doc_id", "lang_pred", "score", "languages"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(predict, "doc_id long, lang_pred string, score double, languages map<string,double>"))
