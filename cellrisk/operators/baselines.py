"""Baselines and encodings as aggregates + joins.

Fitted "models" here are small DataFrames of group statistics; prediction is
a left join with a coalesce chain.  Group tables are keyed by cells, slots or
(cell, hour) - their size is bounded by the grid, and ``join_small`` checks
it before broadcasting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.operators.joins import join_small
from cellrisk.operators.splits import seeded_unit

TARGET = P.TARGET_COLUMN


def global_mean(train: DataFrame, target: str = TARGET) -> float:
    return float(train.agg(F.avg(target)).first()[0])


def group_mean(train: DataFrame, keys: list[str], target: str = TARGET) -> DataFrame:
    return train.groupBy(*keys).agg(F.avg(target).alias("_gm"))


def predict_group_mean(data: DataFrame, stats: DataFrame, keys: list[str], gmean: float,
                       out: str = "pred") -> DataFrame:
    """Group mean, unseen group -> global mean."""
    j = join_small(data, stats, keys, "left")
    return j.withColumn(out, F.coalesce(F.col("_gm"), F.lit(gmean))).drop("_gm")


def shrinkage_stats(train: DataFrame, keys: list[str], parent: str = "cell_id",
                    target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """(group sums and counts with the parent mean attached, parent means)."""
    pm = train.groupBy(parent).agg(F.avg(target).alias("_pm"))
    g = train.groupBy(*keys).agg(F.sum(target).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return join_small(g, pm, [parent], "left"), pm


def predict_shrinkage(data: DataFrame, stats: DataFrame, parent_means: DataFrame, keys: list[str],
                      m, gmean: float, parent: str = "cell_id", out: str = "pred") -> DataFrame:
    """``(sum + m * parent_mean) / (n + m)`` -> parent mean -> global mean."""
    mm = m if isinstance(m, Column) else F.lit(float(m))
    grp = stats.select(*keys, ((F.col("_s") + mm * F.col("_pm")) / (F.col("_n") + mm)).alias("_g"))
    j = join_small(data, grp, keys, "left")
    j = join_small(j, parent_means, [parent], "left")
    return j.withColumn(out, F.coalesce(F.col("_g"), F.col("_pm"), F.lit(gmean))).drop("_g", "_pm")


def select_shrinkage_m(train: DataFrame, keys: list[str], row_key: list[str],
                       m_grid=P.SHRINKAGE_GRID, val_size: float = P.INNER_VAL_SIZE,
                       seed: int = P.RANDOM_STATE + 1, parent: str = "cell_id",
                       target: str = TARGET) -> tuple[float, DataFrame]:
    """Choose m on an inner split of train: one pass evaluates every m (the
    grid is exploded on the validation rows), MAE per m, smallest MAE wins
    (first in grid order on ties)."""
    u = seeded_unit(seed, *row_key)
    inner, val = train.filter(u >= val_size), train.filter(u < val_size)
    stats, pm = shrinkage_stats(inner, keys, parent, target)
    gm = global_mean(inner, target)
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(m)).alias("m")) for i, m in enumerate(m_grid)])
    v = val.select(*set(keys + [parent, target] + row_key)).withColumn("_mg", F.explode(grid))
    j = join_small(v, stats.drop("_pm"), keys, "left")
    j = join_small(j, pm.withColumnRenamed("_pm", "_pm2"), [parent], "left")
    mm = F.col("_mg.m")
    g = (F.col("_s") + mm * F.col("_pm2")) / (F.col("_n") + mm)
    pred = F.coalesce(g, F.col("_pm2"), F.lit(gm))
    table = (j.groupBy(F.col("_mg.i").alias("i"), F.col("_mg.m").alias("m"))
             .agg(F.avg(F.abs(F.col(target) - pred)).alias("mae_val")))
    best = table.orderBy("mae_val", "i").first()
    return float(best["m"]), table.select("m", "mae_val")


def target_encoding(train: DataFrame, key: str = "cell_id", m: float = P.TARGET_ENCODING_SMOOTHING_M,
                    target: str = TARGET) -> tuple[DataFrame, float]:
    """Smoothed mean per key: ``(sum + m * g) / (n + m)``."""
    g = global_mean(train, target)
    enc = train.groupBy(key).agg(((F.sum(target) + F.lit(m * g)) / (F.count(F.lit(1)) + F.lit(m)))
                                 .alias("cell_risk_mean"))
    return enc, g


def apply_target_encoding(df: DataFrame, enc: DataFrame, g: float, key: str = "cell_id") -> DataFrame:
    j = join_small(df, enc, [key], "left")
    return j.withColumn("cell_risk_mean", F.coalesce(F.col("cell_risk_mean"), F.lit(g)))


BASELINE_LABELS = {
    "global": "Baseline: global mean",
    "cell": "Baseline: cell mean",
    "hour_dow": "Baseline: hour and weekday mean",
    "cell_hour_shrunk": "Baseline: cell and hour, shrunk",
}


def baseline_ladder(train: DataFrame, test: DataFrame, row_key: list[str],
                    target: str = TARGET) -> tuple[DataFrame, float]:
    """Four baseline predictions for ``test`` in long form
    (row_key..., y, predictor, pred) and the chosen shrinkage m."""
    gm = global_mean(train, target)
    best_m, _ = select_shrinkage_m(train, ["cell_id", "hour"], row_key, target=target)
    base = test.select(*row_key, *[c for c in ("cell_id", "dow", "hour") if c not in row_key],
                       F.col(target).alias("y"))
    cell = group_mean(train, ["cell_id"], target)
    hd = group_mean(train, ["dow", "hour"], target)
    stats, pm = shrinkage_stats(train, ["cell_id", "hour"], "cell_id", target)
    p = base.withColumn("p_global", F.lit(gm))
    p = predict_group_mean(p, cell, ["cell_id"], gm, "p_cell")
    p = predict_group_mean(p, hd, ["dow", "hour"], gm, "p_hour_dow")
    p = predict_shrinkage(p, stats, pm, ["cell_id", "hour"], best_m, gm, out="p_cell_hour_shrunk")
    stack = ", ".join(f"'{BASELINE_LABELS[k]}', p_{k}" for k in BASELINE_LABELS)
    long = p.select(*row_key, "y", F.expr(f"stack({len(BASELINE_LABELS)}, {stack}) as (predictor, pred)"))
    return long, best_m
