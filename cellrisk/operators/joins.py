"""Join helpers.

``join_small`` broadcasts the smaller side only after checking its row
count against a bound; beyond the bound it leaves the choice to the planner
(shuffle join, with AQE able to switch at runtime from real sizes).  Literal
or calendar-bounded tables are broadcast directly by the callers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (no job is run)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:
        return None


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def broadcast_threshold(spark) -> int:
    """The session's broadcast threshold in bytes, in any notation Spark takes
    (``10485760``, ``10m``, ``100MB``; -1 is off)."""
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    number = text.rstrip("abcdefghijklmnopqrstuvwxyz")
    return int(number) * _UNITS[text[len(number):]]


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_bytes: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Join that broadcasts ``small`` only behind a size check.

    ``max_rows`` given: the small side is materialised once and counted, and
    broadcast when the measured row count is within the bound (use it when
    the big side is raw data that must not be shuffled).  Otherwise the
    optimizer's size estimate is compared with ``max_bytes`` (default: the
    session's broadcast threshold) and, beyond it, a regular join is planned
    that AQE may still switch to a broadcast from real sizes."""
    if max_rows is not None:
        from cellrisk.operators.panel import materialize
        small = materialize(small)
        side = F.broadcast(small) if small.count() <= max_rows else small
        return big.join(side, on, how)
    if max_bytes is None:
        max_bytes = broadcast_threshold(small.sparkSession)
    est = estimated_bytes(small)
    side = F.broadcast(small) if est is not None and 0 <= est <= max_bytes else small
    return big.join(side, on, how)


#: A key with one in HOT_SHARE of the rows, and HOT_LEAST rows, is hot.
HOT_SHARE, HOT_LEAST = 1000, 1000


def join_hot(df: DataFrame, table: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Left join with a table of one row a key, whose ``weight`` says how many
    rows of ``df`` hold that key.

    At most HOT_SHARE keys can hold one in HOT_SHARE of the rows each: these are
    broadcast and their rows stay where they are; the rest is shuffled, and no
    key is hot among it."""
    from cellrisk.operators.panel import materialize
    table = materialize(table)
    total = table.agg(F.sum(weight)).first()[0] or 0
    least = max(HOT_LEAST, -(-total // HOT_SHARE))
    hot, cold = table.filter(F.col(weight) >= least), table.filter(F.col(weight) < least)
    if hot.isEmpty():
        return df.join(cold, on, "left")
    own = F.broadcast(hot)
    return df.join(own, on).unionByName(df.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, "left"))


def lookup_measured(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a table of one row a key, after counting how many rows of
    ``df`` hold each key (one pass over the keys, combined map-side).  A stream
    is joined plainly."""
    if df.isStreaming:
        return df.join(table, on, "left")
    asked = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_asked"))
    return join_hot(df, asked.join(table, on, "left"), on, "_asked").drop("_asked")


def lookup_with_default(df: DataFrame, table: DataFrame, on: list[str], value: str,
                        default, out: str | None = None) -> DataFrame:
    """Left lookup join, missing -> ``default`` (a literal or a column)."""
    d = default if isinstance(default, Column) else F.lit(default)
    j = join_small(df, table.select(*on, F.col(value).alias("_lv")), on, "left")
    return j.withColumn(out or value, F.coalesce(F.col("_lv"), d)).drop("_lv")


def semi(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys_df.select(*on).distinct(), on, "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys_df.select(*on).distinct(), on, "left_anti")


def duplicated_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once (semi-join to a having-count)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return df.join(dup.select(*keys), keys, "left_semi")


def unseen_fraction(train: DataFrame, test: DataFrame, key: str = "cell_id") -> float:
    """Percent of test rows whose key never appears in train."""
    n = test.count()
    if n == 0:
        return float("nan")
    unseen = test.join(train.select(key).distinct(), key, "left_anti").count()
    return 100.0 * unseen / n
