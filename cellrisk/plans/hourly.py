"""Hour-of-week generation: incidents -> (cell, weekday, hour) grid with a
pseudo-label score.

Plan shape:

1. clean + event values: narrow projection with pushed-down filters
   (required fields, box), layered severity from map literals, age from a
   single scalar (max timestamp);
2. unit aggregate per (cell, dow, hour) with partial aggregation (the only
   shuffle over incident rows);
3. cell table (one row per cell) -> in-radius pair table by a grid-bucket
   equi-join (no cross join);
4. kernel weighted mean: pairs joined to the observed unit rows on the
   neighbour key, ``sum(w * v)`` per (cell, slot), divided by the cell's
   weight total over *all* in-radius cells (empty slots count 0);
5. dense 168-slot spine per cell (explode, no cross join), left-joined to
   unit values, kernel sums and the 8-neighbour scatter;
6. p99 anchor over the grid (exact quantile) and the anchored power score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions import score as SC
from cellrisk.functions import severity as SEV
from cellrisk.functions import timefx as T
from cellrisk.functions.space import grid_cells, grid_index, in_box
from cellrisk.functions.text import normalize_text, parse_bool_strict, upper_strip
from cellrisk.operators import neighbours as NB
from cellrisk.operators import panel as PN
from cellrisk.operators.clean import canonical_type, since_year
from cellrisk.operators.joins import join_small
from cellrisk.operators.stats import quantiles, scalars

SLOTS = 168


def clean_incidents(inc: DataFrame, lat: str = "lat", lon: str = "lon", ts: str = "ts",
                    region: P.Region = P.HOURLY_REGION, start_year: int | None = None,
                    code: str = "iucr", ptype: str = "primary_type", year: str = "yr",
                    desc: str = "description", arrest: str = "arrest_str") -> DataFrame:
    """Required fields present, inside the box, optional start year; the
    canonical type (last year's mode per code) and normalised description
    attached; arrest parsed strictly."""
    df = since_year(inc, year, start_year)
    df = df.dropna(subset=[lat, lon, ts]).filter(in_box(lat, lon, region))
    df = canonical_type(df, code=code, ptype=ptype, year=year, out="primary_type_canon")
    return df.withColumns({"desc_canon": normalize_text(desc),
                           "arrest": parse_bool_strict(arrest)})


def event_values(clean: DataFrame, ts: str = "ts", half_life: float = P.HALF_LIFE_DAYS,
                 reference_ts=None, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Cell, time parts, layered severity, age from the reference time (max
    timestamp unless given), decay weight and event value."""
    if reference_ts is None:
        reference_ts = scalars(clean, m=F.max(ts))["m"]
    g = grid_cells(lat, lon)
    out = clean.withColumns({
        "lat_r": g["lat_r"], "lon_r": g["lon_r"],
        "_type": upper_strip("primary_type_canon"), "_desc": upper_strip("desc_canon"),
    }).withColumns({
        "cell_id": F.concat_ws("_", F.col("lat_r").cast("string"), F.col("lon_r").cast("string")),
        "gx": grid_index("lat_r"), "gy": grid_index("lon_r"),
        "hour": F.hour(ts).cast("int"), "dow": F.weekday(ts).cast("int"),
        "severity": SEV.stripped_severity("_type", "_desc"),
        "sev_layer": SEV.stripped_layer("_type", "_desc"),
        "is_violent": F.coalesce(F.col("primary_type_canon").isin(*P.VIOLENT_TYPES), F.lit(False)),
        "age_days": F.timestamp_diff("MICROSECOND", F.col(ts).cast("timestamp_ntz"),
                                     F.lit(str(reference_ts)).cast("timestamp_ntz")) / F.lit(86400e6),
    })
    return out.drop("_type", "_desc").withColumns({"w_time": SC.temporal_weight("age_days", half_life)}) \
              .withColumn("event_value", F.col("severity") * F.col("w_time"))


def unit_aggregate(ev: DataFrame) -> DataFrame:
    """(cell, dow, hour) aggregate: base value, count, violent share, arrest
    rate."""
    return ev.groupBy("cell_id", "gx", "gy", "lat_r", "lon_r", "dow", "hour").agg(
        F.sum("event_value").alias("base_value"),
        F.count(F.lit(1)).alias("crime_count"),
        F.avg(F.col("is_violent").cast("double")).alias("violent_share"),
        F.avg(F.col("arrest").cast("double")).alias("arrest_rate"))


def cells_of(ev: DataFrame) -> DataFrame:
    """One row per cell with its total incident count."""
    return ev.groupBy("cell_id", "gx", "gy", "lat_r", "lon_r").agg(
        F.count(F.lit(1)).alias("cell_total_count"))


def kernel_weighted_mean(unit: DataFrame, pairs: DataFrame, value: str = "base_value",
                         out: str = "risk_raw") -> DataFrame:
    """``S = W @ M`` with W row-normalised over all in-radius cells.
    Returns (cell_id, slot, out) for slots with a non-zero contribution."""
    wsum = pairs.groupBy("cell_id").agg(F.sum("w").alias("_wsum"))
    vals = unit.select(F.col("cell_id").alias("nbr"), T.hour_slot("dow", "hour").alias("slot"),
                       F.col(value).alias("_v"))
    contrib = (pairs.select("cell_id", "nbr", "w").join(vals, "nbr")
               .groupBy("cell_id", "slot").agg(F.sum(F.col("w") * F.col("_v")).alias("_s")))
    return contrib.join(wsum, "cell_id").select("cell_id", "slot",
                                                (F.col("_s") / F.col("_wsum")).alias(out))


def hourly_grid(ev: DataFrame, sigma_km: float = P.SIGMA_KM, cutoff_km: float = P.CUTOFF_KM,
                clip_percentile: float = P.CLIP_PERCENTILE,
                exponent: float = P.SCORE_EXPONENT, materialize: str | None = None,
                with_clip: bool = False):
    """Full (cell x 168 slot) grid with features, label ingredients and the
    score.  Returns the grid (and the clip value when ``with_clip``)."""
    # one pass over the incidents: everything below reads cell x slot rows
    unit = PN.materialize(unit_aggregate(ev), materialize)
    cells = unit.groupBy("cell_id", "gx", "gy", "lat_r", "lon_r").agg(F.sum("crime_count").alias("cell_total_count"))
    cells = PN.materialize(cells, materialize)
    pairs = NB.radius_pairs(cells.select("cell_id", "lat_r", "lon_r"), cutoff_km, sigma_km)
    raw = kernel_weighted_mean(unit, pairs)
    # 8-neighbour mean of counts, divisor fixed at 8, scattered on (gx, gy, slot)
    cnt = unit.select("gx", "gy", T.hour_slot("dow", "hour").alias("slot"),
                      F.col("crime_count").cast("double").alias("cc"))
    nbm = NB.scatter(cnt, ["gx", "gy", "slot"],
                     {"_v": F.when(~F.col("is_self"), F.col("cc"))},
                     NB.offsets(1), None, gi="gx", gj="gy", aggs={"_s": ("sum", "_v")})
    nbm = nbm.select("gx", "gy", "slot", (F.coalesce(F.col("_s"), F.lit(0.0)) / 8.0)
                     .alias("neighbor_count_mean"))
    spine = cells.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    uval = unit.select("cell_id", T.hour_slot("dow", "hour").alias("slot"), "base_value",
                       "crime_count", "violent_share", "arrest_rate")
    grid = (spine.join(uval, ["cell_id", "slot"], "left")
            .join(raw, ["cell_id", "slot"], "left")
            .join(nbm, ["gx", "gy", "slot"], "left"))
    grid = grid.fillna(0.0, subset=["base_value", "violent_share", "arrest_rate", "risk_raw",
                                    "neighbor_count_mean"]).fillna(0, subset=["crime_count"])
    tf_h = F.col("slot") % 24
    tf_d = (F.col("slot") / 24).cast("int")
    hs, hc = T.cyclic(tf_h, 24)
    ds, dc = T.cyclic(tf_d, 7)
    grid = grid.withColumns({
        "dow": tf_d, "hour": tf_h.cast("int"), "is_weekend": T.is_weekend(tf_d),
        "hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc,
        "crime_count": F.col("crime_count").cast("double"),
        "cell_total_count": F.col("cell_total_count").cast("double"),
    })
    grid = PN.materialize(grid, materialize)
    clip = quantiles(grid, "risk_raw", [clip_percentile])[0]
    grid = grid.withColumn("risk_score", SC.power_score("risk_raw", clip, exponent))
    return (grid, clip) if with_clip else grid


FINAL_COLUMNS = ["cell_id", "dow", "hour"] + [c for c in P.FEATURE_COLUMNS
                                               if c not in ("dow", "hour")] + [P.TARGET_COLUMN]


def features_labels(grid: DataFrame) -> DataFrame:
    """The published 16-column grid table: key, locked features, target (label
    ingredients excluded)."""
    return grid.select(*FINAL_COLUMNS)


def build(inc: DataFrame, materialize: str | None = None, **kw) -> DataFrame:
    """Incidents -> features_labels grid."""
    ev = event_values(clean_incidents(inc))
    return features_labels(hourly_grid(ev, materialize=materialize, **kw))


def join_cell_totals(grid: DataFrame, ev: DataFrame) -> DataFrame:
    """Per-cell incident totals attached (aggregate + size-checked join)."""
    tot = ev.groupBy("cell_id").agg(F.count(F.lit(1)).alias("cell_total_count"))
    return join_small(grid, tot, ["cell_id"], "inner")
