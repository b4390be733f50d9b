"""Train/test splits.

Random and group splits use an ``md5`` bucket of a row key or group key, so a
split is reproducible, needs no shuffle and is the same in any engine
(DuckDB computes the same bucket).  Row choice differs from scikit-learn's
generators; the proportions and the group-holdout guarantee are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrisk import params as P


def md5_unit(*cols) -> Column:
    """Uniform [0, 1) value from the first 32 bits of md5 of the key text."""
    key = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                             for c in cols])
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    return h / F.lit(4294967296.0)


def seeded_unit(seed: int, *cols) -> Column:
    return md5_unit(F.lit(str(seed)), *cols)


def split_random(df: DataFrame, key: list[str], test_size: float = P.TEST_SIZE,
                 seed: int = P.RANDOM_STATE) -> tuple[DataFrame, DataFrame]:
    """Protocol A: rows to test when their hashed key falls under test_size."""
    u = seeded_unit(seed, *key)
    return df.filter(u >= test_size), df.filter(u < test_size)


def split_group(df: DataFrame, group: str = "cell_id", test_size: float = P.TEST_SIZE,
                seed: int = P.RANDOM_STATE) -> tuple[DataFrame, DataFrame]:
    """Protocol B: whole groups go to test (spatial holdout by cell)."""
    u = seeded_unit(seed, group)
    return df.filter(u >= test_size), df.filter(u < test_size)


def night_subset(df: DataFrame, hours=P.NIGHT_HOURS, hour: str = "hour") -> DataFrame:
    """Protocol C rows: night hours."""
    return df.filter(F.col(hour).isin(*hours))


def split_chrono(df: DataFrame, train_end: str, val_end: str,
                 period: str = "period_str") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train <= train_end < val <= val_end < test, on the period text."""
    p = F.col(period)
    return (df.filter(p <= train_end), df.filter((p > train_end) & (p <= val_end)),
            df.filter(p > val_end))


def protocol_tags(df: DataFrame, row_key: list[str], group: str = "cell_id",
                  test_size: float = P.TEST_SIZE, seed: int = P.RANDOM_STATE,
                  night_hours=P.NIGHT_HOURS) -> DataFrame:
    """All three protocols as tag columns on one table: ``split_A``,
    ``split_B`` ('train'/'test') and ``split_C`` ('test' for night rows of
    B's test, 'train' for B's train, null otherwise)."""
    a = F.when(seeded_unit(seed, *row_key) < test_size, "test").otherwise("train")
    b = F.when(seeded_unit(seed, group) < test_size, "test").otherwise("train")
    c = F.when(b == "train", "train").when(F.col("hour").isin(*night_hours), "test")
    return df.withColumns({"split_A": a, "split_B": b, "split_C": c})


def protocol_frames(tagged: DataFrame) -> dict:
    """{protocol: {'train': df, 'test': df}} views over the tagged table."""
    out = {}
    for p in ("A", "B", "C"):
        col = F.col(f"split_{p}")
        out[p] = {"train": tagged.filter(col == "train"), "test": tagged.filter(col == "test")}
    return out
