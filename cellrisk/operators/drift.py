"""Drift measurement: population stability index per feature, drift
profiles over many features in one grouped pass, decisions.

PSI (reference vs actual) with reference quantile edges: duplicate edges
dropped, outer edges open (-inf, +inf), bins closed on the left, shares
floored at 1e-6; fewer than two distinct edges -> 0.

Plan: both samples are stacked to a long (feature, value) table; the exact
edges of every feature come from one grouped ``quantile_table``; the bin of a value is the
number of inner edges <= value (an array ``filter`` - no join); counts per
(feature, bin) for both sides are joined on a per-feature bin spine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.operators.stats import quantile_table

def _long(df: DataFrame, features: list[str], group: str | None = None) -> DataFrame:
    parts = ", ".join(f"'{f}', cast(`{f}` as double)" for f in features)
    cols = [F.col(group)] if group else []
    return df.select(*cols, F.expr(f"stack({len(features)}, {parts}) as (feature, value)"))


def psi_table(reference: DataFrame, actual: DataFrame, features: list[str],
              bins: int = P.PSI_BINS, floor: float = 1e-6,
              group: str | None = None) -> DataFrame:
    """One row per feature (and per ``group`` value of ``actual`` when given,
    e.g. the batch): ``[group,] feature, psi``.  The reference side - edges,
    counts, totals - is computed once for all groups."""
    g = [group] if group else []
    ref = _long(reference, features)
    act = _long(actual, features, group)
    edges = (quantile_table(ref, "value", [i / bins for i in range(bins + 1)], ["feature"])
             .select("feature", F.array_distinct(F.array_sort("q")).alias("edges")))
    edges = edges.withColumns({
        "n_bins": F.size("edges") - 1,
        "inner": F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))})
    edges = F.broadcast(edges.select("feature", "n_bins", "inner"))   # one row per feature

    def binned(side: DataFrame) -> DataFrame:
        b = side.join(edges, "feature").filter(F.col("n_bins") >= 1)
        return b.withColumn("bin", F.size(F.filter("inner", lambda e: F.col("value") >= e)))

    rc = binned(ref).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("e_c"))
    rn = ref.groupBy("feature").agg(F.count(F.lit(1)).alias("e_n"))
    ac = binned(act).groupBy(*g, "feature", "bin").agg(F.count(F.lit(1)).alias("a_c"))
    an = act.groupBy(*g, "feature").agg(F.count(F.lit(1)).alias("a_n"))
    # bin spine per (group, feature): the actual totals exploded over the
    # feature's bins (equi-join on feature, no cross join)
    spine = an.join(edges.filter(F.col("n_bins") >= 1), "feature").select(
        *g, "feature", "a_n", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)).alias("bin"))
    t = (spine.join(rc, ["feature", "bin"], "left").join(ac, g + ["feature", "bin"], "left")
         .join(rn, "feature", "left").fillna(0, subset=["e_c", "a_c"]))
    e = F.greatest(F.col("e_c") / F.greatest(F.col("e_n"), F.lit(1)), F.lit(floor))
    a = F.greatest(F.col("a_c") / F.greatest(F.col("a_n"), F.lit(1)), F.lit(floor))
    psi = t.groupBy(*g, "feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    keys = an.select(*g, "feature")
    return keys.join(psi, g + ["feature"], "left").fillna(0.0, subset=["psi"])


def drift_profile(psi: DataFrame, features: list[str], top: int = 3,
                  group: str | None = None) -> DataFrame:
    """psi_max, psi_mean and the top-k ``name=value`` text (ties keep the
    feature list order), per ``group`` when given."""
    order = F.create_map(*[F.lit(x) for i, f in enumerate(features) for x in (f, i)])
    p = psi.withColumn("_o", F.try_element_at(order, F.col("feature")))
    items = F.sort_array(F.collect_list(F.struct((-F.col("psi")).alias("k"), F.col("_o").alias("o"),
                                                 F.col("feature").alias("f"), F.col("psi").alias("v"))))
    top_txt = F.array_join(F.transform(F.slice(items, 1, top),
                                       lambda s: F.format_string("%s=%.2f", s["f"], s["v"])), ", ")
    aggs = [F.max("psi").alias("psi_max"), F.avg("psi").alias("psi_mean"), top_txt.alias("top_drift")]
    return p.groupBy(group).agg(*aggs) if group else p.agg(*aggs)


def drift_decision(psi_max: Column, mae: Column, ref_mae: Column,
                   psi_threshold: float = P.PSI_THRESHOLD, tol: float = P.DEGRADE_TOL) -> Column:
    """``psi_max >= threshold or mae >= (1 + tol) * reference mae`` (the
    degradation test only when the reference MAE is known)."""
    degraded = F.coalesce(mae >= F.lit(1.0 + tol) * ref_mae, F.lit(False))
    return (psi_max >= F.lit(psi_threshold)) | degraded


def drift_features(features: list[str], exclude=P.DRIFT_EXCLUDE) -> list[str]:
    return [f for f in features if f not in exclude]


def challenger_windows(df: DataFrame, after: str, h: int = P.HOLDOUT_PERIODS, period: str = "period_str") -> DataFrame:
    """``batch, <period>, role, n``: for every batch (a year with periods later
    than ``after``) the periods up to its end, the last ``h`` of them as
    ``holdout`` and the others as ``train``, with their row counts.

    One aggregate of the rows; each period is then exploded to the batches that
    see it, so the table is bounded by years x periods."""
    n_of = df.groupBy(period).agg(F.count(F.lit(1)).alias("n")).withColumn("_year", F.substring(period, 1, 4).cast("int"))
    batches = n_of.filter(F.col(period) > after).select(F.col("_year").alias("_batch")).distinct()
    ends = batches.agg(F.min("_batch"), F.max("_batch")).first()   # two numbers; null where nothing arrives
    seen = (n_of.filter(F.lit(ends[0] is not None)).filter(F.col("_year") <= F.lit(ends[1]))
            .withColumn("_batch", F.explode(F.sequence(F.greatest("_year", F.lit(ends[0])), F.lit(ends[1]))))
            .join(batches, "_batch", "left_semi"))
    place = F.row_number().over(Window.partitionBy("_batch").orderBy(F.desc(period)))
    return seen.select(F.format_string("%04d", "_batch").alias("batch"), period, F.when(place <= h, "holdout").otherwise("train").alias("role"), "n")


def holdout_periods(df: DataFrame, window_end: str, h: int = P.HOLDOUT_PERIODS,
                    period: str = "period_str") -> DataFrame:
    """The last ``h`` distinct periods up to ``window_end`` (the time holdout
    of a challenger window)."""
    per = df.filter(F.col(period) <= window_end).select(period).distinct()
    return per.orderBy(F.desc(period)).limit(h)
