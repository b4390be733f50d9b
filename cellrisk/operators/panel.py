"""Panel operators: densification and per-cell time windows.

A panel is one row per (cell, period).  Periods are integer month indexes
(``year*12 + month - 1``) so every join and window uses integer keys; the
``yyyy-MM`` text is derived at the end.

Windows are always partitioned by the cell keys: a cell holds at most one row
per calendar period, so no window partition grows with the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def materialize(df: DataFrame, how: str | None = None) -> DataFrame:
    """Reuse a DataFrame across several actions.

    ``checkpoint`` (default): written to the shared ``spark.checkpoint.dir``;
    the lineage is cut, later plans start from a flat scan (small plans, no
    recomputation after an executor loss).  ``persist``: memory-and-disk
    blocks (lost blocks are recomputed from lineage).  The default can be
    changed with ``cellrisk.materialize``.
    """
    how = how or df.sparkSession.conf.get("cellrisk.materialize", "checkpoint")
    if how == "checkpoint":
        from cellrisk.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "none":
        return df
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def densify(obs: DataFrame, cell_keys: list[str], period: str,
            fill_zero: list[str] | None = None, cells: DataFrame | None = None,
            periods: DataFrame | None = None) -> DataFrame:
    """Cells x observed periods, observations left-joined, listed columns -> 0.

    The spine is built per cell by exploding the period range and, when the
    observed periods have gaps, semi-joined to the distinct periods.  No
    cross join.
    """
    per = periods if periods is not None else obs.select(period).distinct()
    s = per.agg(F.min(period).alias("lo"), F.max(period).alias("hi"),
                F.count(F.lit(1)).alias("n")).first()
    lo, hi, n = s["lo"], s["hi"], s["n"]
    if lo is None:
        return obs.limit(0)
    cells = cells if cells is not None else obs.select(*cell_keys).distinct()
    spine = cells.withColumn(period, F.explode(F.sequence(F.lit(int(lo)), F.lit(int(hi)))))
    if n < hi - lo + 1:
        spine = spine.join(per.select(period), period, "left_semi")
    panel = spine.join(obs, cell_keys + [period], "left")
    if fill_zero:
        panel = panel.fillna(0, subset=fill_zero)
    return panel


def cell_window(cell_keys: list[str], order: str) -> Window:
    return Window.partitionBy(*cell_keys).orderBy(order)


def lag_cols(w: Window, specs: dict[str, tuple[str, int]]) -> dict[str, Column]:
    """{out: (col, k)} -> ``lag(col, k)`` over ``w``."""
    return {o: F.lag(c, k).over(w) for o, (c, k) in specs.items()}


def rolling_mean_excl(col: str, k: int, w: Window) -> Column:
    """``shift(1).rolling(k).mean()``: null until k previous values exist."""
    frame = w.rowsBetween(-k, -1)
    return F.when(F.count(col).over(frame) == k, F.avg(col).over(frame))


def expanding_mean_excl(col: str, w: Window) -> Column:
    """``shift(1).expanding().mean()``."""
    return F.avg(col).over(w.rowsBetween(Window.unboundedPreceding, -1))


def moving_avg_short_start(col: str, k: int, w: Window) -> Column:
    """``rolling(k, min_periods=1).mean()`` including the current row."""
    return F.avg(col).over(w.rowsBetween(-(k - 1), 0))


def decay_sum(col: str, w: Window, half_life: float, window: int) -> Column:
    """``sum_{k=0..window} col[t-k] * 0.5**(k/half_life)``, missing = 0.
    All lags share one sort of the window partition."""
    terms = [F.coalesce(F.lag(col, k).over(w) if k else F.col(col), F.lit(0.0))
             * F.lit(0.5 ** (k / half_life)) for k in range(window + 1)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out
