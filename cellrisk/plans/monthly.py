"""Monthly generation: incidents -> grid-month panel -> pseudo-label score.

Plan shape (shuffles marked):

1. incident rows -> ``groupBy(gi, gj, pidx)`` with map-side partial
   aggregation (shuffle 1; a hot cell is pre-combined in every map task);
2. dense spine per cell (period range exploded, no cross join) left-joined
   to the observations (shuffle 2, panel-sized);
3. range partition on (gi, gj) (shuffle 3): satisfies the per-cell window
   (lags, rolling means, decay) and puts spatial neighbours in one task;
4. neighbour scatter (explode offsets -> partial aggregate -> shuffle 4)
   that also re-attaches the panel columns, so there is no join back;
5. global scalars (quantile, min, max) over the materialised panel, then a
   narrow projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions import severity as SEV
from cellrisk.functions import score as SC
from cellrisk.functions import timefx as T
from cellrisk.functions.space import grid_index, in_box
from cellrisk.functions.text import parse_bool_lenient
from cellrisk.operators import neighbours as NB
from cellrisk.operators import panel as PN
from cellrisk.operators.stats import quantiles, scalars

CELL = ["gi", "gj"]


# ---------------------------------------------------------------------------
# incident level
# ---------------------------------------------------------------------------
def incident_features(inc: DataFrame, ts: str = "ts", lat: str | None = "lat",
                      lon: str | None = "lon", ptype: str = "primary_type",
                      arrest: str | None = None, domestic: str | None = None,
                      region: P.Region = P.MONTHLY_REGION,
                      violent=P.VIOLENT_TYPES_MONTHLY, prop=P.PROPERTY_TYPES,
                      grid: float = P.GRID_STEP) -> DataFrame:
    """Incident features: month index and text, calendar parts, night and
    weekend flags, class flags, missing-coordinate flag and the integer
    grid index (null when the coordinate is missing or out of the box).
    Inputs with ready ``gi``/``gj`` (and no coordinates) keep them."""
    t = F.col(ts)
    cols = {
        "pidx": T.month_index(t),
        "period_str": T.period_of_ts(t),
        "year": F.year(t).cast("int"),
        "month": F.month(t).cast("int"),
        "hour": F.hour(t).cast("int"),
        "dow": F.weekday(t).cast("int"),
    }
    out = inc.withColumns(cols)
    canon = F.upper(F.trim(F.col(ptype)))
    out = out.withColumns({
        "is_night": T.is_night(F.col("hour")),
        "is_weekend": T.is_weekend(F.col("dow")),
        "is_violent": F.coalesce(canon.isin(*violent), F.lit(False)).cast("int"),
        "is_property": F.coalesce(canon.isin(*prop), F.lit(False)).cast("int"),
    })
    if arrest:
        out = out.withColumn("arrest_b", parse_bool_lenient(arrest).cast("int"))
    if domestic:
        out = out.withColumn("domestic_b", parse_bool_lenient(domestic).cast("int"))
    if lat and lon and lat in inc.columns:
        la, lo_ = F.col(lat).cast("double"), F.col(lon).cast("double")
        missing = la.isNull() | lo_.isNull() | ~F.coalesce(in_box(la, lo_, region), F.lit(False))
        out = out.withColumn("coord_missing", missing)
        out = out.withColumns({
            "gi": F.when(~missing, grid_index(la, grid)),
            "gj": F.when(~missing, grid_index(lo_, grid)),
        })
    else:
        out = out.withColumn("coord_missing", F.col("gi").isNull() | F.col("gj").isNull())
    return out.withColumns({"glat": F.col("gi") * F.lit(grid), "glon": F.col("gj") * F.lit(grid)})


def geocoded(inc: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows with a cell and a time (the filter every grid aggregate uses)."""
    return inc.filter(~F.col("coord_missing") & F.col(ts).isNotNull())


# ---------------------------------------------------------------------------
# grid-month aggregate and panel features
# ---------------------------------------------------------------------------
def grid_month_aggregate(feat: DataFrame, ptype: str = "primary_type") -> DataFrame:
    """Counts and rates per (gi, gj, period): one aggregate, partial-combined
    before the shuffle."""
    n = F.count(F.lit(1))
    agg = feat.groupBy(*CELL, "pidx").agg(
        n.alias("n_crimes"),
        F.sum("is_violent").cast("long").alias("n_violent"),
        F.sum("is_property").cast("long").alias("n_property"),
        F.sum(F.coalesce(F.col("arrest_b"), F.lit(0))).cast("long").alias("n_arrest"),
        F.sum(F.coalesce(F.col("domestic_b"), F.lit(0))).cast("long").alias("n_domestic"),
        F.count_distinct(F.upper(F.trim(F.col(ptype)))).alias("n_types"),
        F.sum("is_night").cast("long").alias("night"),
        F.sum("is_weekend").cast("long").alias("weekend"),
    )
    return agg.withColumns({
        "arrest_rate": F.col("n_arrest") / F.col("n_crimes"),
        "domestic_rate": F.col("n_domestic") / F.col("n_crimes"),
        "share_night": F.col("night") / F.col("n_crimes"),
        "share_weekend": F.col("weekend") / F.col("n_crimes"),
    })


COUNT_COLS = ["n_crimes", "n_violent", "n_property", "n_arrest", "n_domestic",
              "n_types", "night", "weekend"]
RATE_COLS = ["arrest_rate", "domestic_rate", "share_night", "share_weekend"]


def gridmonth_panel(agg: DataFrame, grid: float = P.GRID_STEP,
                    fill_features: bool = True) -> DataFrame:
    """Dense cell x month panel with calendar, lag, rolling, trend,
    composition-lag and neighbour-lag features (34 columns)."""
    agg = PN.materialize(agg)   # cells x months; the raw rows are read once
    panel = PN.densify(agg, CELL, "pidx", fill_zero=COUNT_COLS + RATE_COLS)
    panel = NB.cluster_cells(panel)
    yr = F.floor(F.col("pidx") / 12).cast("int")
    mo = (F.col("pidx") % 12 + 1).cast("int")
    y0 = scalars(agg, y0=F.min(F.floor(F.col("pidx") / 12)))["y0"]
    ms, mc = T.cyclic(mo, 12)
    w = PN.cell_window(CELL, "pidx")
    panel = panel.withColumns({
        "glat": F.col("gi") * F.lit(grid), "glon": F.col("gj") * F.lit(grid),
        "period_str": T.period_str("pidx"),
        "year_idx": (yr - F.lit(int(y0))).cast("int"),
        "pmonth": mo, "pquarter": T.quarter_of_month(mo),
        "pmonth_sin": ms, "pmonth_cos": mc,
        "lag_1": F.lag("n_crimes", 1).over(w).cast("double"),
        "lag_3": F.lag("n_crimes", 3).over(w).cast("double"),
        "lag_12": F.lag("n_crimes", 12).over(w).cast("double"),
        "roll3_mean": PN.rolling_mean_excl("n_crimes", 3, w),
        "roll6_mean": PN.rolling_mean_excl("n_crimes", 6, w),
        "roll12_mean": PN.rolling_mean_excl("n_crimes", 12, w),
        "cell_hist_mean": PN.expanding_mean_excl("n_crimes", w),
        "n_violent_lag1": F.lag("n_violent", 1).over(w).cast("double"),
        "arrest_rate_lag1": F.lag("arrest_rate", 1).over(w),
        "domestic_rate_lag1": F.lag("domestic_rate", 1).over(w),
        "share_night_lag1": F.lag("share_night", 1).over(w),
        "share_weekend_lag1": F.lag("share_weekend", 1).over(w),
    }).withColumn("trend_3_12", F.col("roll3_mean") - F.col("roll12_mean"))
    panel = NB.neighbour_mean(panel, "lag_1", "neighbor_lag1_mean", CELL + ["pidx"])
    if fill_features:
        panel = panel.fillna(0.0, subset=P.FEATURE_COLUMNS_MONTHLY)
    return panel


# ---------------------------------------------------------------------------
# pseudo labels
# ---------------------------------------------------------------------------
def harm_table(feat: DataFrame, ptype: str = "primary_type", desc: str = "description") -> DataFrame:
    """Tier x modifier severity summed per (gi, gj, period)."""
    sev = SEV.tier_severity(F.upper(F.trim(F.col(ptype))), F.col(desc))
    return (feat.withColumn("severity", sev).groupBy(*CELL, "pidx")
            .agg(F.sum("severity").alias("harm"), F.count(F.lit(1)).alias("n_inc"),
                 F.avg("severity").alias("sev_mean")))


def monthly_scores(feat: DataFrame, ptype: str = "primary_type", desc: str = "description",
                   half_life: float = P.TEMPORAL_HALFLIFE_MONTHS,
                   window: int = P.TEMPORAL_WINDOW_MONTHS,
                   bandwidth: float = P.SPATIAL_BANDWIDTH_CELLS,
                   radius: int = P.SPATIAL_RADIUS_CELLS,
                   clip_pctl: float = P.CLIP_PCTL_MONTHLY,
                   grid: float = P.GRID_STEP, materialize: str | None = None) -> DataFrame:
    """Pseudo-label table (13 columns) from geocoded, dated incident rows
    that carry ``gi``, ``gj`` and ``pidx``."""
    sev = SEV.tier_severity(F.upper(F.trim(F.col(ptype))), F.col(desc))
    obs = (feat.withColumn("severity", sev).groupBy(*CELL, "pidx")
           .agg(F.count(F.lit(1)).alias("n_crimes"), F.sum("severity").alias("harm")))
    obs = PN.materialize(obs, materialize)   # cells x months; the raw rows are read once
    panel = PN.densify(obs, CELL, "pidx", fill_zero=["n_crimes"])
    panel = panel.fillna(0.0, subset=["harm"])
    panel = NB.cluster_cells(panel)
    w = PN.cell_window(CELL, "pidx")
    panel = panel.withColumn("harm_temporal", PN.decay_sum("harm", w, half_life, window))
    k = NB.kernel_sum(panel, "harm_temporal", "harm_spatial", CELL + ["pidx"], radius=radius,
                      bandwidth=bandwidth)
    k = PN.materialize(k.withColumn("_r", F.log1p(F.greatest(F.col("harm_spatial"), F.lit(0.0)))),
                       materialize)
    return score_log_minmax(k, "_r", clip_pctl, grid)


def score_log_minmax(k: DataFrame, r: str, clip_pctl: float, grid: float) -> DataFrame:
    """log1p -> winsorise at the percentile -> min-max to 0..100; a zero
    span gives 0.  Tier (right-closed) and partial-period flag attached."""
    # one fused aggregate for the count, range and latest period; the
    # quantile job reuses the count
    ok = F.col(r).isNotNull() & ~F.isnan(r)
    s = scalars(k, n=F.count_if(ok), rmin=F.min(r), rmax=F.max(r), pmax=F.max("pidx"))
    cap = quantiles(k, r, [clip_pctl / 100.0])[0]
    lo = min(max(s["rmin"], 0.0), cap)
    hi = min(max(s["rmax"], 0.0), cap)
    span = hi - lo
    rc = F.least(F.greatest(F.col(r), F.lit(0.0)), F.lit(cap))
    score = (rc - F.lit(lo)) / F.lit(span) * F.lit(100.0) if span > 0 else F.lit(0.0)
    return (k.withColumns({
        "glat": F.col("gi") * F.lit(grid), "glon": F.col("gj") * F.lit(grid),
        "period_str": T.period_str("pidx"),
        "risk_raw": F.col("harm_spatial").cast("double"),
        "risk_score": score.cast("double"),
        "is_partial_period": (F.col("pidx") == F.lit(s["pmax"])).cast("int"),
    }).withColumn("risk_tier", SC.tier_right_closed("risk_score"))
        .select("gi", "gj", "period_str", "glat", "glon", "n_crimes", "harm", "harm_temporal",
                "harm_spatial", "risk_raw", "risk_score", "risk_tier", "is_partial_period"))


LABEL_ADD = ["risk_score", "risk_tier", "harm", "harm_temporal", "harm_spatial", "risk_raw",
             "is_partial_period"]


def training_table(panel: DataFrame, labels: DataFrame) -> DataFrame:
    """Panel features with the label columns attached (left equi-join on the
    cell-month key; duplicate columns come from the panel)."""
    lab = labels.select("gi", "gj", "period_str", *LABEL_ADD)
    keep = [c for c in panel.columns if c not in LABEL_ADD and c not in ("pidx", "night", "weekend", "year")]
    return panel.select(*keep).join(lab, ["gi", "gj", "period_str"], "left")


def add_risk_lags(t: DataFrame, train_end: str, lags=(1, 3, 12), target: str = "risk_score") -> DataFrame:
    """``risk_lag_L`` per cell (missing -> train mean of the target) and the
    raw previous value ``prev_risk`` for persistence."""
    gm = t.filter(F.col("period_str") <= train_end).agg(F.avg(target)).first()[0]
    w = PN.cell_window(CELL, "period_str")
    cols = {f"risk_lag_{k}": F.coalesce(F.lag(target, k).over(w), F.lit(gm)) for k in lags}
    cols["prev_risk"] = F.lag(target, 1).over(w)
    return t.withColumns(cols)
