"""Data-quality and exploratory aggregates.

Every profile is a single aggregate pass (or a two-stage aggregate) whose
output is tiny; wide "one value per column" results are produced with
``stack`` after one ``agg``, never with a loop of jobs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions.space import in_box
from cellrisk.operators.stats import quantile_table, quantiles


def _stack(names_values: list[tuple[str, Column]], key: str, val: str) -> Column:
    parts = ", ".join(f"'{n}', `{n}`" for n, _ in names_values)
    return F.expr(f"stack({len(names_values)}, {parts}) as ({key}, {val})")


def missing_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count and percent of nulls per column; only columns with nulls,
    largest first."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.select("_n", _stack([(c, None) for c in cols], "column", "n_missing"))
    return (long.filter(F.col("n_missing") > 0)
            .select("column", F.col("n_missing").cast("long").alias("n_missing"),
                    (F.col("n_missing") * 100.0 / F.col("_n")).alias("pct_missing")))


def missing_by_group(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Percent null per column and group (long form)."""
    agg = df.groupBy(group).agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(c)
                                  for c in cols])
    return agg.select(group, _stack([(c, None) for c in cols], "column", "pct_missing"))


def co_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where both columns of each pair are null, one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[F.count_if(F.col(a).isNull() & F.col(b).isNull()).alias(f"{a}&{b}")
                   for a, b in pairs])
    return agg.select(_stack([(f"{a}&{b}", None) for a, b in pairs], "pair", "n_both_missing"))


def null_rate_by_category(df: DataFrame, category: str, col: str, floor: int,
                          top: int = 15) -> DataFrame:
    """Null rate of ``col`` per category with at least ``floor`` rows, top."""
    return (df.groupBy(category).agg(F.count(F.lit(1)).alias("n"),
                                     (F.avg(F.col(col).isNull().cast("double")) * 100.0).alias("pct_null"))
            .filter(F.col("n") >= floor)
            .orderBy(F.desc("pct_null"), F.asc(category)).limit(top))


def key_uniqueness(df: DataFrame, key: list[str], all_cols: list[str]) -> DataFrame:
    """rows, distinct keys, duplicate keys and full-row duplicates: one
    grouping over all columns (partial-combined), then one aggregate."""
    g = df.groupBy(*all_cols).agg(F.count(F.lit(1)).alias("_c"))
    out = g.agg(F.sum("_c").cast("long").alias("n_rows"),
                F.count_distinct(*[F.col(c) for c in key]).alias("n_distinct_keys"),
                F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1).otherwise(0)).cast("long")
                .alias("full_row_dups"))
    return out.select("n_rows", "n_distinct_keys",
                      (F.col("n_rows") - F.col("n_distinct_keys")).alias("dup_keys"),
                      "full_row_dups",
                      (F.col("n_rows") == F.col("n_distinct_keys")).cast("int").alias("is_unique"))


def rows_per_key_histogram(df: DataFrame, key: list[str]) -> DataFrame:
    """value_counts of value_counts: how many keys have n rows."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_per_key"))
            .groupBy("rows_per_key").agg(F.count(F.lit(1)).alias("n_keys")))


def codes_per_duplicated_key(df: DataFrame, key: list[str], code: str) -> DataFrame:
    """For keys with >1 row: keys with one distinct code vs several."""
    per = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                F.count_distinct(code).alias("_codes"))
           .filter(F.col("_n") > 1))
    return per.agg(F.count(F.lit(1)).alias("dup_keys"),
                   F.count_if(F.col("_codes") == 1).alias("same_code"),
                   F.count_if(F.col("_codes") > 1).alias("different_code"))


def repetition_of_category(df: DataFrame, key: str, category: str, value: str) -> DataFrame:
    """Rows of one category, distinct keys, keys with more than one row."""
    sub = df.filter(F.col(category) == value)
    per = sub.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.sum("_n").cast("long").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                   F.count_if(F.col("_n") > 1).alias("keys_repeated"))


def consistency_counts(df: DataFrame, year: str, ts: str, updated: str) -> DataFrame:
    """year != year(ts); ts > updated; null ts."""
    return df.agg(F.count_if(F.col(year) != F.year(ts)).alias("year_mismatch"),
                  F.count_if(F.col(ts) > F.col(updated)).alias("date_after_updated"),
                  F.count_if(F.col(ts).isNull()).alias("null_dates"))


def taxonomy_conflicts(df: DataFrame, code: str, label: str) -> DataFrame:
    """Number of codes mapped to more than one label."""
    return (df.filter(F.col(code).isNotNull()).groupBy(code)
            .agg(F.count_distinct(label).alias("_k")).agg(F.count_if(F.col("_k") > 1).alias("n_conflicts")))


def top_labels_per_code(df: DataFrame, code: str, label: str, k: int = 3) -> DataFrame:
    """Top-k labels per conflicting code (count desc, label asc)."""
    c = df.filter(F.col(code).isNotNull()).groupBy(code, label).agg(F.count(F.lit(1)).alias("n"))
    conflicted = c.groupBy(code).agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select(code)
    c = c.join(conflicted, code, "left_semi")
    rk = F.row_number().over(Window.partitionBy(code).orderBy(F.desc("n"), F.asc(label)))
    return c.withColumn("rank", rk).filter(F.col("rank") <= k)


def label_span(df: DataFrame, label: str, year: str) -> DataFrame:
    return df.groupBy(label).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"),
                                 F.count(F.lit(1)).alias("n"))


def spatial_outliers(df: DataFrame, lat: str, lon: str, region: P.Region,
                     zero_tol: float = 1.0) -> DataFrame:
    """Rows with coordinates outside the box, near (0, 0), and the 8-number
    summary of both coordinates (count, mean, std, min, quartiles, max)."""
    long = df.select(F.explode(F.array(F.struct(F.lit(lat).alias("c"), F.col(lat).cast("double").alias("v")),
                                       F.struct(F.lit(lon).alias("c"), F.col(lon).cast("double").alias("v")))).alias("p")).select("p.c", "p.v")
    got = {r["c"]: r["q"] for r in quantile_table(long, "v", [0.25, 0.5, 0.75], ["c"]).collect()}   # two rows
    has = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    aggs = [F.count_if(has & ~in_box(lat, lon, region)).alias("n_out_of_box"),
            F.count_if(has & (F.abs(F.col(lat)) < zero_tol) & (F.abs(F.col(lon)) < zero_tol))
            .alias("n_near_zero")]
    for c in (lat, lon):
        p25, p50, p75 = (F.lit(v).cast("double") for v in got.get(c, [None] * 3))
        aggs += [F.count(c).alias(f"{c}_count"), F.avg(c).alias(f"{c}_mean"),
                 F.stddev_samp(c).alias(f"{c}_std"), F.min(c).alias(f"{c}_min"),
                 p25.alias(f"{c}_p25"), p50.alias(f"{c}_p50"),
                 p75.alias(f"{c}_p75"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def pandas_skew(c: Column, n: Column) -> Column:
    """Bias-adjusted sample skewness from Spark's population ``skewness``."""
    return F.when(n > 2, c * F.sqrt(n * (n - 1)) / (n - 2))


def grid_density(df: DataFrame, gi: str = "gi", gj: str = "gj") -> DataFrame:
    """Incidents per cell: count, mean, std, min, quartiles, max, skewness."""
    per = df.groupBy(gi, gj).agg(F.count(F.lit(1)).alias("n"))
    p25, p50, p75 = (F.lit(v).cast("double") for v in quantiles(per, "n", [0.25, 0.5, 0.75]))
    return per.agg(F.count(F.lit(1)).alias("cells"), F.avg("n").alias("mean"),
                   F.stddev_samp("n").alias("std"), F.min("n").alias("min"),
                   p25.alias("p25"), p50.alias("p50"), p75.alias("p75"), F.max("n").alias("max"),
                   pandas_skew(F.skewness("n"), F.count(F.lit(1)).cast("double")).alias("skew"))


def cell_size_comparison(df: DataFrame, lat: str, lon: str,
                         sizes=(0.02, 0.01, 0.005), slots: int = 168) -> DataFrame:
    """Floor binning at several cell sizes: active cells, events per cell,
    events per (cell x slot) unit.  One explode, one aggregate."""
    arr = F.array(*[F.lit(float(s)) for s in sizes])
    ex = df.select(F.explode(arr).alias("size"), lat, lon)
    ex = ex.select("size", (F.floor(F.col(lat) / F.col("size")).cast("long") * 100000
                            + F.floor(F.col(lon) / F.col("size")).cast("long")).alias("_cell"))
    per = ex.groupBy("size").agg(F.count(F.lit(1)).alias("events"),
                                 F.count_distinct("_cell").alias("active_cells"))
    return per.select("size", "active_cells",
                      F.round(F.col("events") / F.col("active_cells")).cast("long").alias("events_per_cell"),
                      F.round(F.col("events") / (F.col("active_cells") * slots), 1).alias("events_per_unit"))


def cardinality(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Distinct values per column (exact by default): values are stacked to
    (column, value), made distinct with map-side combine, then counted."""
    if approx:
        agg = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return agg.select(_stack([(c, None) for c in cols], "column", "n_unique"))
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    seen = df.select(F.explode(each).alias("p")).select("p.column", "p.value").distinct()
    return seen.groupBy("column").agg(F.count("value").alias("n_unique"))


def top_values(df: DataFrame, col: str, n: int | None) -> DataFrame:
    """Value counts, largest first (ties by value), top n (None = all)."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col))
    return out.limit(n) if n else out


def calendar_counts(df: DataFrame, ts: str) -> DataFrame:
    """Counts by year, month, weekday and hour in long form (one pass)."""
    parts = F.array(
        F.struct(F.lit("year").alias("part"), F.year(ts).alias("value")),
        F.struct(F.lit("month").alias("part"), F.month(ts).alias("value")),
        F.struct(F.lit("dow").alias("part"), F.weekday(ts).alias("value")),
        F.struct(F.lit("hour").alias("part"), F.hour(ts).alias("value")))
    ex = df.filter(F.col(ts).isNotNull()).select(F.explode(parts).alias("p"))
    return ex.groupBy(F.col("p.part").alias("part"), F.col("p.value").cast("int").alias("value")) \
             .agg(F.count(F.lit(1)).alias("n"))


def hour_weekday_pivot(df: DataFrame, ts: str) -> DataFrame:
    """Dense 7 x 24 table (dow rows, h00..h23 columns), absent -> 0."""
    obs = df.filter(F.col(ts).isNotNull()).select(F.weekday(ts).alias("dow"), F.hour(ts).alias("hour"))
    spine = df.sparkSession.range(7).select(F.col("id").cast("int").alias("dow"))
    piv = obs.groupBy("dow").pivot("hour", list(range(24))).agg(F.count(F.lit(1)))
    out = spine.join(F.broadcast(piv), "dow", "left").fillna(0)
    return out.select("dow", *[F.col(str(h)).cast("long").alias(f"h{h:02d}") for h in range(24)])


def mean_per_calendar_month(df: DataFrame, ts: str) -> DataFrame:
    """Count per calendar month divided by the number of distinct years."""
    from cellrisk.operators.stats import scalars
    s = df.filter(F.col(ts).isNotNull())
    years = scalars(s, y=F.count_distinct(F.year(ts)))["y"]
    per = s.groupBy(F.month(ts).alias("month")).agg(F.count(F.lit(1)).alias("_n"))
    return per.select(F.col("month").cast("int").alias("month"),
                      (F.col("_n") / F.lit(float(years))).alias("mean_count"))


def hourly_profile_per_day(df: DataFrame, ts: str) -> DataFrame:
    """Events per hour per day, weekday vs weekend (divide by the distinct
    days of each class)."""
    s = df.filter(F.col(ts).isNotNull()).select(
        (F.weekday(ts) >= 5).cast("int").alias("is_weekend"), F.hour(ts).alias("hour"),
        F.to_date(ts).alias("d"))
    days = s.groupBy("is_weekend").agg(F.count_distinct("d").alias("_days"))
    per = s.groupBy("is_weekend", "hour").agg(F.count(F.lit(1)).alias("_n"))
    return per.join(F.broadcast(days), "is_weekend").select(
        "is_weekend", F.col("hour").cast("int").alias("hour"),
        (F.col("_n") / F.col("_days")).alias("per_day"))


def density_bins(df: DataFrame, ts: str, lat: str, lon: str, step: float = 0.01) -> DataFrame:
    """log(count) per square bin, by year and by day/night half (06-17)."""
    h = F.hour(ts)
    sl = F.array(F.concat(F.lit("year="), F.year(ts).cast("string")),
                 F.when((h >= 6) & (h <= 17), F.lit("half=day")).otherwise(F.lit("half=night")))
    ex = df.filter(F.col(ts).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()) \
           .select(F.explode(sl).alias("slice"),
                   F.floor(F.col(lat) / step).cast("int").alias("bi"),
                   F.floor(F.col(lon) / step).cast("int").alias("bj"))
    return ex.groupBy("slice", "bi", "bj").agg(F.log(F.count(F.lit(1))).alias("log_count"))


def rates_by_category(df: DataFrame, category: str, flags: list[str], top: int = 20) -> DataFrame:
    """Volume and percent of each flag per category, 1 decimal, top by volume."""
    aggs = [F.count(F.lit(1)).alias("n")] + [
        F.round(F.avg(F.col(f).cast("double")) * 100.0, 1).alias(f"{f}_pct") for f in flags]
    return df.groupBy(category).agg(*aggs).orderBy(F.desc("n"), F.asc(category)).limit(top)


def pair_frequency(df: DataFrame, a: str, b: str, top: int) -> DataFrame:
    """Top pairs by count with the number of distinct pairs attached."""
    pairs = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    n_pairs = df.select(a, b).distinct().count()
    return (pairs.orderBy(F.desc("n"), F.asc(a), F.asc(b)).limit(top)
            .withColumn("n_groups", F.lit(n_pairs).cast("long")))


def severity_diagnostics(df: DataFrame, ptype: str, base: str, sev: str, mult: str,
                         top: int = 12) -> tuple[DataFrame, DataFrame]:
    """Per type: base, mean and max severity, n (top by mean); share of rows
    whose modifier is not 1."""
    per = (df.groupBy(ptype).agg(F.min(base).alias("base"), F.avg(sev).alias("final_mean"),
                                 F.max(sev).alias("final_max"), F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("final_mean"), F.asc(ptype)).limit(top))
    share = df.agg(F.count_if(F.col(mult) != 1.0).alias("n_modified"),
                   (F.avg((F.col(mult) != 1.0).cast("double")) * 100.0).alias("pct_modified"))
    return per, share


def share_by(df: DataFrame, col: str) -> DataFrame:
    """Percent of rows per value."""
    tot = df.count()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .select(col, "n", (F.col("n") * 100.0 / F.lit(float(tot))).alias("pct")))


def decay_mass_by_year(df: DataFrame, ts: str, age: str, half_lives=(180, 365, 730)) -> DataFrame:
    """Share of total decay weight per year, for each half-life."""
    ex = df.select(F.year(ts).alias("year"), age,
                   F.explode(F.array(*[F.lit(float(h)) for h in half_lives])).alias("H"))
    per = ex.groupBy("H", "year").agg(F.sum(F.pow(F.lit(0.5), F.col(age) / F.col("H"))).alias("_w"))
    tot = per.groupBy("H").agg(F.sum("_w").alias("_t"))
    return per.join(F.broadcast(tot), "H").select(
        "H", F.col("year").cast("int").alias("year"), (F.col("_w") / F.col("_t") * 100.0).alias("pct"))


def score_summary(df: DataFrame, score: str, others: list[str], tier: str | None = None) -> DataFrame:
    """Mean, median, bias-adjusted skew, quartiles, correlation to inputs."""
    p25, p50, p75 = (F.lit(v).cast("double") for v in quantiles(df, score, [0.25, 0.5, 0.75]))
    n = F.count(score).cast("double")
    aggs = [F.count(score).alias("n"), F.avg(score).alias("mean"),
            p50.alias("median"),
            pandas_skew(F.skewness(score), n).alias("skew"),
            F.stddev_samp(score).alias("std"), F.min(score).alias("min"),
            p25.alias("p25"), p75.alias("p75"),
            F.max(score).alias("max")]
    aggs += [F.corr(score, o).alias(f"corr_{o}") for o in others]
    return df.agg(*aggs)


def normaliser_comparison(df: DataFrame, raw: str, clip: float) -> DataFrame:
    """median, Q1, Q3, % < 25, % > 75 for four score curves."""
    from cellrisk.functions.score import log_anchor_score, power_score
    curves = [("A_linear", power_score(raw, clip, 1.0)), ("B_sqrt", power_score(raw, clip, 0.5)),
              ("C_pow035", power_score(raw, clip, 0.35)), ("D_log1p", log_anchor_score(raw, clip))]
    wide = df.select(*[c.alias(n) for n, c in curves])
    long = wide.select(_stack([(n, None) for n, _ in curves], "curve", "v"))
    shares = long.groupBy("curve").agg((F.avg((F.col("v") < 25).cast("double")) * 100).alias("pct_lt25"),
                                       (F.avg((F.col("v") > 75).cast("double")) * 100).alias("pct_gt75"))
    q = quantile_table(long, "v", [0.25, 0.5, 0.75], ["curve"])
    return q.join(shares, "curve").select("curve", q["q"][1].alias("median"), q["q"][0].alias("q1"), q["q"][2].alias("q3"),
                                          "pct_lt25", "pct_gt75")


def hotspots(df: DataFrame, keys: list[str], score: str, top: int = 5) -> DataFrame:
    """Mean score per cell, top cells."""
    return (df.groupBy(*keys).agg(F.avg(score).alias("mean_score"))
            .orderBy(F.desc("mean_score"), *[F.asc(k) for k in keys]).limit(top))


def quiet_busy(df: DataFrame, score: str, count: str, nbr: str, busy_frac: float = 0.01) -> DataFrame:
    """Median score of slots with no incidents and no neighbour incidents, and
    of the busiest 1 % of slots (by count, ties by score then cell order)."""
    n = df.count()
    k = int(busy_frac * n)
    quiet = df.filter((F.col(count) == 0) & (F.col(nbr) == 0)).select(F.lit("quiet").alias("subset"), score)
    busy = (df.orderBy(F.desc(count), F.desc(score), "cell_id", "dow", "hour").limit(k)
            .select(F.lit("busiest_1pct").alias("subset"), score))
    both = quiet.unionByName(busy)
    n_of = both.groupBy("subset").agg(F.count(F.lit(1)).alias("n"))
    q = quantile_table(both, score, [0.5], ["subset"]).select("subset", F.col("q")[0].alias("median_score"))
    return n_of.join(q, "subset", "left")


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count + order-free 16-hex digest of the sum of 64-bit row hashes
    (a sum, so equal rows do not cancel)."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    total = F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.substring(F.md5(total.cast("string")), 1, 16).alias("digest"))


def key_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count + the sum of the rows' 60-bit md5 prefixes over exact columns
    (text and whole numbers), which any engine computes alike."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    part = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(part), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), total.cast("string").alias("digest"))


def check_list(df: DataFrame, key: str, ts: str, lat: str, lon: str, code: str, label: str,
               region: P.Region = P.HOURLY_REGION) -> DataFrame:
    """Pass/fail rows of a run: (check, seen, passed), ``seen`` counts the rows
    that speak against it.  One aggregate plus the duplicate-key count."""
    has = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    one = df.agg(F.count_if(F.col(ts).isNull()).alias("time_present"),
                 F.count_if(F.col(code).isNull()).alias("code_present"),
                 F.count_if(F.col(label).isNull()).alias("type_present"),
                 F.count_if(~has).alias("coordinates_present"),
                 F.count_if(has & ~in_box(lat, lon, region)).alias("coordinates_in_region"))
    names = ["time_present", "code_present", "type_present", "coordinates_present", "coordinates_in_region"]
    rows = one.select(_stack([(n, None) for n in names], "check", "seen"))
    dup = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
           .agg(F.lit("key_unique").alias("check"), F.count(F.lit(1)).alias("seen")))
    return rows.union(dup).withColumn("passed", (F.col("seen") == 0).cast("int"))
