"""Evaluation over a long predictions table (group..., y, pred).

All metrics of all predictors come from one grouped aggregate; Spearman uses
the distributed average rank (``stats.average_rank``) per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions.timefx import hour_group
from cellrisk.operators.stats import quantiles, spearman, spearman_by


def metrics(pred: DataFrame, groups: list[str], y: str = "y", p: str = "pred",
            r2_zero_if_constant: bool = False, with_spearman: bool = True) -> DataFrame:
    """MAE, RMSE, R2 (and Spearman) per group in one pass.

    R2 = 1 - SS_res / SS_tot with SS_tot = n * var_pop(y); a constant target
    gives -inf/NaN like scikit-learn, or 0 when ``r2_zero_if_constant``."""
    err = F.col(y) - F.col(p)
    agg = pred.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("MAE"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        F.sum(err * err).alias("_ssr"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"))
    r2 = F.when(F.col("_sst") > 0, 1 - F.col("_ssr") / F.col("_sst"))
    r2 = r2.otherwise(F.lit(0.0)) if r2_zero_if_constant else r2
    out = agg.withColumn("R2", r2).drop("_ssr", "_sst")
    if not with_spearman:
        return out
    if not groups:
        return out.withColumn("Spearman", F.lit(spearman(pred, p, y)).cast("double"))
    return out.join(spearman_by(pred, groups, p, y), groups, "left")


def add_improvement(results: DataFrame, protocol: str = "protocol", kind: str = "predictor_type") -> DataFrame:
    """``(1 - MAE / strongest baseline MAE) * 100`` per protocol."""
    best = (results.filter(F.col(kind) == "baseline").groupBy(protocol)
            .agg(F.min("MAE").alias("_best")))
    return (results.join(best, protocol, "left")
            .withColumn("improvement_vs_strongest_baseline_pct", (1 - F.col("MAE") / F.col("_best")) * 100)
            .drop("_best"))


def quantile_bins(df: DataFrame, col: str, q: int = 5, labels=None, out: str = "quantile") -> DataFrame:
    """``pd.qcut``: edges at exact quantiles, duplicate edges dropped, bins
    right-closed with the first bin closed on the left; ties share a bin."""
    edges = quantiles(df, col, [i / q for i in range(q + 1)])
    uniq = sorted(set(edges))
    labels = labels or [f"Q{i + 1}" for i in range(len(uniq) - 1)]
    expr = None
    for i in range(len(uniq) - 1):
        lo, hi = uniq[i], uniq[i + 1]
        cond = (F.col(col) >= lo) & (F.col(col) <= hi) if i == 0 else (F.col(col) > lo) & (F.col(col) <= hi)
        lab = F.lit(labels[i])
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return df.withColumn(out, expr)


def segments(seg: DataFrame, y: str = "y", pm: str = "pred_model", pb: str = "pred_baseline",
             cell: str = "cell_id", hour: str = "hour") -> DataFrame:
    """(kind, segment, n, err_model, err_baseline, model_gt*, baseline_gt*) per
    label quintile, hour group and cell, and over all rows: grouping sets of one
    aggregate."""
    s = seg.withColumns({"err_model": F.abs(F.col(y) - F.col(pm)),
                         "err_baseline": F.abs(F.col(y) - F.col(pb))})
    s = quantile_bins(s, y, 5, P.QUINTILE_LABELS).withColumn("hour_group", hour_group(F.col(hour)))
    sides = {"quantile": "quantile", "hour_group": "hour_group", "cell": cell}
    s = s.select("err_model", "err_baseline", *[F.col(c).cast("string").alias(k) for k, c in sides.items()])
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("err_model").alias("err_model"), F.avg("err_baseline").alias("err_baseline")]
    aggs += [(F.avg((F.col(f"err_{who}") > t).cast("double")) * 100).alias(f"{who}_gt{t}")
             for t in P.LARGE_ERROR_THRESHOLDS for who in ("model", "baseline")]
    kind, segment = F.lit("all"), F.lit(None).cast("string")
    for k in sides:
        kind, segment = F.when(F.grouping(k) == 0, F.lit(k)).otherwise(kind), F.when(F.grouping(k) == 0, F.col(k)).otherwise(segment)
    sets = [[F.col(k)] for k in sides] + [[]]
    got = s.groupingSets(sets, *[F.col(k) for k in sides]).agg(kind.alias("kind"), segment.alias("segment"), *aggs)
    return got.drop(*sides)


def segmented(seg: DataFrame, y: str = "y", pm: str = "pred_model", pb: str = "pred_baseline",
              cell: str = "cell_id", hour: str = "hour") -> dict[str, DataFrame]:
    """MAE per label quintile and per hour group (model vs baseline), large
    error shares, worst cells and both predictors' rank correlation with the
    label, all but the last from one aggregated table."""
    from cellrisk.operators.panel import materialize
    s = materialize(segments(seg, y, pm, pb, cell, hour))
    gain = (1 - F.col("err_model") / F.col("err_baseline")) * 100
    per_q = s.filter("kind = 'quantile'").select(F.col("segment").alias("quantile"), "err_model", "err_baseline", gain.alias("improvement_pct"))
    per_h = s.filter("kind = 'hour_group'").select(F.col("segment").alias("hour_group"), "err_model", "err_baseline")
    large = s.filter("kind = 'all'").select(*[f"{who}_gt{t}" for t in P.LARGE_ERROR_THRESHOLDS for who in ("model", "baseline")])
    worst = (s.filter((F.col("kind") == "cell") & (F.col("n") >= 10)).select(F.col("segment").alias(cell), F.col("err_model").alias("mean"), F.col("n").alias("count"))
             .orderBy(F.desc("mean"), F.asc(cell)).limit(5))
    both = seg.select(F.col(y).alias("y"), F.explode(F.array(*[F.struct(F.lit(who).alias("predictor"), F.col(c).cast("double").alias("pred")) for who, c in (("model", pm), ("baseline", pb))])).alias("p"))
    rank = spearman_by(both.select("y", "p.*"), ["predictor"], "pred", "y", "spearman")
    return {"per_quintile": per_q, "per_hour_group": per_h, "large_error_fractions": large,
            "worst_cells": worst, "spearman": rank}


def tier_accuracy(df: DataFrame, a: str, b: str) -> DataFrame:
    same = F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return df.agg(F.avg(same.cast("double")).alias("tier_accuracy"))


def hard_cases(df: DataFrame, y: str, prev: str, cell: str, train_filter, top_frac: float = 0.25):
    """Rows with |change| in the top quarter, and rows of cells whose
    (train-only, sample) std of the target is in the top quarter; returned
    as one tagged long table (subset, row columns...)."""
    d = df.withColumn("_chg", F.abs(F.col(y) - F.col(prev)))
    thr = quantiles(d, "_chg", [1 - top_frac])[0]
    big = d.filter(F.col("_chg") >= thr).withColumn("subset", F.lit("large_change"))
    std = df.filter(train_filter).groupBy(cell).agg(F.stddev_samp(y).alias("_sd"))
    sthr = quantiles(std, "_sd", [1 - top_frac])[0]
    vol = std.filter(F.col("_sd") >= sthr).select(cell)
    volatile = df.join(vol, cell, "left_semi").withColumn("subset", F.lit("volatile_cells"))
    return big.drop("_chg").unionByName(volatile)


def worst_k(df: DataFrame, key: str, err: str, min_n: int = 10, k: int = 5) -> DataFrame:
    return (df.groupBy(key).agg(F.avg(err).alias("mean"), F.count(F.lit(1)).alias("count"))
            .filter(F.col("count") >= min_n).orderBy(F.desc("mean"), F.asc(key)).limit(k))


def dedupe_first(df: DataFrame, key: str, order: list) -> DataFrame:
    """Keep the first row per key in the given order (union of result
    tables with repeated names)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
