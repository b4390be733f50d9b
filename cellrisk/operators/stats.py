"""Global statistics without single-partition plans.

* ``scalars``: one aggregate row (a handful of numbers) brought to the driver
  to parametrise later expressions - bounded by construction.
* ``ranges``: every distinct value with its count, cut into ranges of about
  equally many values by splitters that Spark samples from the values
  themselves (a range exchange), whatever their spread.  Values are counted
  first (map-side, so ties cost one row).
* ``running_counts``: the same with how many rows lie before each value; only
  the ranges' totals, a row for each range, are ordered in one window.
* ``quantile_table`` / ``quantiles``: exact linear-interpolated quantiles
  (numpy ``percentile``), grouped or global, one method at every size; only
  the ranges that hold a wanted rank are searched.
* ``average_rank``: tie-averaged ranks (pandas ``rank()``).
* ``spearman``: correlation of average ranks over distinct (x, y) pairs.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scalars(df: DataFrame, **exprs: Column) -> dict:
    """Evaluate a few aggregate expressions and return them as Python values."""
    row = df.agg(*[e.alias(k) for k, e in exprs.items()]).first()
    return row.asDict() if row is not None else {k: None for k in exprs}


def ranges(df: DataFrame, col: str, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null, non-NaN values per group: (groups..., col, _cnt, _b).

    ``_b`` numbers ranges of neighbouring values that grows with (groups, col).
    The table is written once, so all that follows sees the same splitters."""
    from cellrisk.operators.panel import materialize
    x = F.col(col).cast("double")
    vc = (df.select(*groups, x.alias(col)).filter(F.col(col).isNotNull() & ~F.isnan(col))
          .groupBy(*groups, col).agg(F.count(F.lit(1)).alias("_cnt")))
    return materialize(vc.repartitionByRange(*groups, col).withColumn("_b", F.spark_partition_id()))


def _totals(ranged: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups..., _b, _t, _off, _n): a range's rows, those before it, its group's."""
    tot = ranged.groupBy(*groups, "_b").agg(F.sum("_cnt").alias("_t"))
    whole = Window.partitionBy(*groups)
    before = F.sum("_t").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    return tot.select(*groups, "_b", "_t", F.coalesce(before, F.lit(0)).alias("_off"), F.sum("_t").over(whole).alias("_n"))


def _counted(ranged: DataFrame, totals: DataFrame, col: str, groups: Sequence[str]) -> DataFrame:
    """Values of the ranges in ``totals``: (groups..., col, _cnt, _before, _n)."""
    on = F.col("v._b") == F.col("t._b")
    for c in groups:
        on = on & F.col(f"v.{c}").eqNullSafe(F.col(f"t.{c}"))
    j = ranged.alias("v").join(totals.alias("t"), on).select(*[F.col(f"v.{c}") for c in (*groups, col, "_cnt", "_b")], "_off", "_n")
    # by range of range numbers: neighbours stay together and tasks get like shares
    w = Window.partitionBy(*groups, "_b").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    return (j.repartitionByRange("_b").withColumn("_before", F.col("_off") + F.sum("_cnt").over(w) - F.col("_cnt"))
            .select(*groups, col, "_cnt", "_before", "_n"))


def running_counts(df: DataFrame, col: str, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null, non-NaN values per group: (groups..., col, _cnt,
    _before, _n) - rows with the value, rows with a smaller one, all rows."""
    ranged = ranges(df, col, groups)
    return _counted(ranged, _totals(ranged, groups), col, groups)


def quantile_table(df: DataFrame, col: str, qs: Sequence[float], groups: Sequence[str] = (), out: str = "q") -> DataFrame:
    """(groups..., ``out``: array of the quantiles, ``n``), numpy-equal."""
    ranged = ranges(df, col, groups)
    n, ranks = F.col("_n"), []
    for q in qs:
        lo = F.floor(F.lit(float(q)) * (n - 1))
        ranks += [lo, F.least(lo + 1, n - 1)]
    wanted = F.exists(F.array(*ranks), lambda r: (F.col("_off") <= r) & (r < F.col("_off") + F.col("_t")))
    rc = _counted(ranged, _totals(ranged, groups).filter(wanted), col, groups)
    before, cnt = F.col("_before"), F.col("_cnt")
    aggs, parts = [F.max("_n").alias("n")], []
    for i, q in enumerate(qs):
        for k, rank in (("lo", ranks[2 * i]), ("hi", ranks[2 * i + 1])):
            aggs.append(F.max(F.when((before <= rank) & (rank < before + cnt), F.col(col))).alias(f"_{k}{i}"))
        p = F.lit(float(q)) * (F.col("n") - 1)
        parts.append(F.col(f"_lo{i}") + (p - F.floor(p)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
    got = rc.groupBy(*groups).agg(*aggs)
    return got.select(*groups, F.array(*parts).alias(out), "n")


def quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> list[float | None]:
    """Exact linear-interpolation quantiles of the non-null values of ``col``."""
    row = quantile_table(df, col, qs).first()
    got = row["q"] if row is not None and row["n"] else [None] * len(qs)
    return [None if v is None else float(v) for v in got]


def _rank() -> Column:
    return (F.col("_before") + (F.col("_cnt") + 1) / 2.0).cast("double")


def average_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """Distinct values of ``col`` with their tie-averaged rank (1-based) and
    count.  Join back on ``col`` to rank rows."""
    return running_counts(df, col).select(col, _rank().alias(out), "_cnt")


def average_rank_by(df: DataFrame, groups: list[str], col: str, out: str = "rank") -> DataFrame:
    """Tie-averaged rank of ``col`` within each group, (groups..., col, out)."""
    return running_counts(df, col, groups).select(*groups, col, _rank().alias(out))


def safe_corr(a, b) -> Column:
    """Pearson correlation that is null (not an ANSI error, not rounding
    noise from merged partial variances) when either side is constant:
    ``covar_pop / (stddev_pop * stddev_pop)`` guarded by an exact min == max."""
    const = (F.min(a) == F.max(a)) | (F.min(b) == F.max(b))
    return F.when(~const, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def spearman_by(df: DataFrame, groups: list[str], x: str, y: str, out: str = "Spearman") -> DataFrame:
    """Spearman correlation per group (null when a side is constant).

    Rows are first counted by (x, y), so only distinct pairs meet the rank
    tables; ranks are centred on their known mean before they are summed."""
    d = (df.select(*groups, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
         .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y")))
    pairs = d.groupBy(*groups, "_x", "_y").agg(F.count(F.lit(1)).alias("_k"))
    rx = running_counts(d, "_x", groups).select(*groups, "_x", (_rank() - (F.col("_n") + 1) / 2.0).alias("_rx"))
    ry = running_counts(d, "_y", groups).select(*groups, "_y", (_rank() - (F.col("_n") + 1) / 2.0).alias("_ry"))
    j = pairs.join(rx, [*groups, "_x"]).join(ry, [*groups, "_y"])
    k, a, b = F.col("_k"), F.col("_rx"), F.col("_ry")
    const = (F.min(a) == F.max(a)) | (F.min(b) == F.max(b))
    corr = F.try_divide(F.sum(k * a * b), F.sqrt(F.sum(k * a * a)) * F.sqrt(F.sum(k * b * b)))
    return j.groupBy(*groups).agg(F.when(~const, corr).alias(out))


def spearman(df: DataFrame, x: str, y: str) -> float | None:
    """Spearman correlation (average ranks); null if either side is constant."""
    v = spearman_by(df, [], x, y).first()["Spearman"]
    return None if v is None or math.isnan(v) else float(v)


def ranked(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """Rows of ``df`` with the average rank of ``col`` attached.  Rows of a value
    that many share are ranked where they are."""
    from cellrisk.operators.joins import join_hot
    ranks = running_counts(df, col).select(F.col(col).alias("_v"), _rank().alias(out), "_cnt")
    return join_hot(df.withColumn("_v", F.col(col).cast("double")), ranks, ["_v"], "_cnt").drop("_v", "_cnt")
