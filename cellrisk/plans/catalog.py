"""Registered queries: one callable per operator (or group of related scalar
operators) of the survey inventory.  Each takes ``(spark, sf_dir)``, reads
the driver tables / adapter views over the whole tables, goes through the
library operators and returns a DataFrame whose column names equal the
matching oracle text in ``cellrisk.plans.oracles``.

Computed doubles are rounded to 6 places here and in the oracle texts so the
engines compare equal.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.sources.adapters import inc_hourly, inc_monthly, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_MEMO: dict = {}


def memo(name: str, materialized: bool = True):
    """Share one intermediate between the queries of a session and data
    folder.  Aggregated tables (grid, panel, protocol and model tables) are
    materialised; incident-level tables are only shared as lazy plans -
    copying raw rows would cost as much as the input itself."""
    def deco(fn):
        def wrapper(spark, sf_dir):
            key = (id(spark), sf_dir, name)
            if key not in _MEMO:
                from cellrisk.operators.panel import materialize
                df = fn(spark, sf_dir)
                _MEMO[key] = materialize(df) if materialized else df
            return _MEMO[key]
        wrapper.__name__ = fn.__name__
        return wrapper
    return deco


def clear_memo() -> None:
    for df in _MEMO.values():
        try:
            df.unpersist()
        except Exception:
            pass
    _MEMO.clear()


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Round double columns to 6 places (all doubles when ``cols`` is None)."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def r4(df: DataFrame) -> DataFrame:
    """Summary statistics are compared at 4 places (interpolated quantiles
    of computed scores sit too close to a 6th-place rounding edge)."""
    cols = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c), 4) for c in cols})


@memo("monthly_features", materialized=False)
def monthly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellrisk.plans.monthly import geocoded, incident_features
    inc = inc_monthly(spark, sf_dir)
    return geocoded(incident_features(inc, lat=None, lon=None,
                                      arrest="arrest_flag", domestic="domestic_flag"))


@memo("monthly_scores")
def monthly_scores_df(spark, sf_dir):
    from cellrisk.plans.monthly import monthly_scores
    return monthly_scores(monthly_features(spark, sf_dir))


# ---------------------------------------------------------------------------
# minimum slice
# ---------------------------------------------------------------------------
@query("monthly_risk_score")
def q_monthly_risk_score(spark, sf_dir):
    return r6(monthly_scores_df(spark, sf_dir))


# ---------------------------------------------------------------------------
# hour-of-week generation
# ---------------------------------------------------------------------------
HOURLY_GRID_COLS = ["cell_id", "dow", "hour", "lat_r", "lon_r", "is_weekend", "hour_sin", "hour_cos",
                    "dow_sin", "dow_cos", "crime_count", "violent_share", "arrest_rate",
                    "cell_total_count", "neighbor_count_mean", "risk_score", "base_value", "risk_raw"]


@memo("hourly_events", materialized=False)
def hourly_events(spark, sf_dir):
    from cellrisk.plans.hourly import clean_incidents, event_values
    return event_values(clean_incidents(inc_hourly(spark, sf_dir)))


@memo("hourly_grid")
def hourly_grid_df(spark, sf_dir):
    from cellrisk.plans.hourly import hourly_grid
    return hourly_grid(hourly_events(spark, sf_dir))


@query("hourly_grid")
def q_hourly_grid(spark, sf_dir):
    return r6(hourly_grid_df(spark, sf_dir).select(*HOURLY_GRID_COLS))


# ---------------------------------------------------------------------------
# 2.3 projections, filters, predicates (inc_hourly unless noted)
# ---------------------------------------------------------------------------
def _h(spark, sf_dir):
    return inc_hourly(spark, sf_dir)


@query("bool_parse")
def q_bool_parse(spark, sf_dir):
    from cellrisk.functions.text import parse_bool_lenient, parse_bool_strict
    return _h(spark, sf_dir).select(
        "id", parse_bool_strict("arrest_str").cast("int").alias("arrest_strict"),
        parse_bool_lenient("arrest_str").cast("int").alias("arrest_lenient"),
        parse_bool_strict("domestic_str").cast("int").alias("domestic_strict"),
        parse_bool_lenient("domestic_str").cast("int").alias("domestic_lenient"))


def _ts_strings(spark, sf_dir):
    """Incident-style time text built from events.ts; every 13th row is junk."""
    h = _h(spark, sf_dir)
    return h.select("id", F.when(F.col("id") % 13 == 0, F.lit("not a date"))
                    .otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a")).alias("date_str"))


@query("ts_parse")
def q_ts_parse(spark, sf_dir):
    from cellrisk.functions.timefx import parse_ts
    d = _ts_strings(spark, sf_dir)
    return d.select("id", F.date_format(parse_ts("date_str"), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("ts_parse_fallback")
def q_ts_parse_fallback(spark, sf_dir):
    from cellrisk.operators.clean import parse_with_fallback
    h = _h(spark, sf_dir)
    d = h.select("id", F.when(F.col("id") % 3 == 0, F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
                 .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("date_str"))
    out = parse_with_fallback(d, "date_str", "parsed")
    return out.select("id", F.date_format("parsed", "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("bbox_predicate")
def q_bbox(spark, sf_dir):
    from cellrisk.functions.space import in_box
    from cellrisk.params import HOURLY_REGION, MONTHLY_REGION
    h = _h(spark, sf_dir)
    return h.select("id", F.coalesce(in_box("lat", "lon", HOURLY_REGION), F.lit(False)).cast("int").alias("in_box"),
                    F.coalesce(in_box("lat", "lon", MONTHLY_REGION), F.lit(False)).cast("int").alias("in_box_monthly"))


@query("outlier_coords_nulled")
def q_outlier(spark, sf_dir):
    from cellrisk.operators.clean import null_outlier_coords
    h = _h(spark, sf_dir).withColumn("x_coord", F.col("lat") * 1e5).withColumn("y_coord", F.col("lon") * 1e5)
    out = null_outlier_coords(h, "lat", "lon", ["x_coord", "y_coord"])
    return r6(out.select("id", "lat", "lon", "x_coord", "y_coord",
                         F.col("coord_missing").cast("int").alias("coord_missing")))


@query("missing_coord_flag")
def q_missing_flag(spark, sf_dir):
    from cellrisk.operators.clean import missing_coord_flag
    h = _h(spark, sf_dir).withColumn("base_missing", F.col("id") % 17 == 0)
    out = missing_coord_flag(h, "lat", "lon", "base_missing")
    return out.select("id", F.col("coord_missing").cast("int").alias("coord_missing"))


@query("geocoded_dated_filter")
def q_geocoded(spark, sf_dir):
    from cellrisk.plans.monthly import geocoded, incident_features
    f = geocoded(incident_features(_h(spark, sf_dir)))
    return f.select("id", "gi", "gj", "pidx")


@query("start_year_filter")
def q_start_year(spark, sf_dir):
    from cellrisk.operators.clean import since_year
    m = inc_monthly(spark, sf_dir)
    return since_year(m, F.year("ts"), 1997).select("l_orderkey", "l_linenumber",
                                                 F.date_format("ts", "yyyy-MM-dd").alias("d"))


@query("required_fields_drop")
def q_required(spark, sf_dir):
    from cellrisk.operators.clean import drop_required
    from cellrisk.params import HOURLY_REGION
    _, counts = drop_required(_h(spark, sf_dir), ["lat", "lon", "ts"], HOURLY_REGION)
    return counts.select("before", "removed", "after",
                         F.round(F.col("removed") * 100.0 / F.col("before"), 6).alias("pct_removed"))


@query("partial_period_filter")
def q_partial(spark, sf_dir):
    from cellrisk.operators.clean import partial_period
    f = monthly_features(spark, sf_dir)
    agg = f.groupBy("gi", "gj", "pidx").agg(F.count(F.lit(1)).alias("n"))
    flagged = partial_period(agg, "pidx")
    return flagged.filter(F.col("is_partial_period") == 0).select("gi", "gj", "pidx", "n")


@query("night_subset")
def q_night(spark, sf_dir):
    from cellrisk.operators.splits import night_subset
    g = hourly_grid_df(spark, sf_dir)
    return night_subset(g).select("cell_id", "dow", "hour")


@query("class_flags")
def q_class_flags(spark, sf_dir):
    from cellrisk.params import PROPERTY_TYPES, VIOLENT_TYPES, VIOLENT_TYPES_MONTHLY
    h = _h(spark, sf_dir)
    t = F.upper(F.trim("primary_type"))
    return h.select("id", F.coalesce(t.isin(*VIOLENT_TYPES), F.lit(False)).cast("int").alias("is_violent"),
                    F.coalesce(t.isin(*VIOLENT_TYPES_MONTHLY), F.lit(False)).cast("int").alias("is_violent_ho"),
                    F.coalesce(t.isin(*PROPERTY_TYPES), F.lit(False)).cast("int").alias("is_property"))


@query("locked_feature_projection")
def q_locked(spark, sf_dir):
    from cellrisk.operators.clean import locked_features
    from cellrisk.params import FEATURE_COLUMNS
    g = hourly_grid_df(spark, sf_dir).drop("arrest_rate").withColumn(
        "violent_share", F.when(F.col("hour") == 3, F.lit(None)).otherwise(F.col("violent_share")))
    return r6(locked_features(g, FEATURE_COLUMNS, keep=["cell_id"]))


@query("features_labels")
def q_features_labels(spark, sf_dir):
    from cellrisk.operators.clean import assert_no_leak, exclude_columns
    from cellrisk.params import FEATURE_COLUMNS, LABEL_INGREDIENT_COLUMNS
    from cellrisk.plans.hourly import FINAL_COLUMNS
    assert_no_leak(FEATURE_COLUMNS)
    g = hourly_grid_df(spark, sf_dir)
    return r6(exclude_columns(g.select(*FINAL_COLUMNS, *LABEL_INGREDIENT_COLUMNS),
                              LABEL_INGREDIENT_COLUMNS))


@query("incident_table_layout")
def q_layout(spark, sf_dir):
    from cellrisk.plans.monthly import incident_features
    from cellrisk.operators.clean import canonical_type
    f = incident_features(canonical_type(_h(spark, sf_dir)), arrest="arrest_str", domestic="domestic_str")
    cols = ["ts", "period_str", "year", "month", "hour", "dow", "primary_type", "primary_type_canon", "description",
            "location_description", "arrest_b", "domestic_b", "lat", "lon", "coord_missing", "gi", "gj",
            "glat", "glon", "is_night", "is_weekend", "is_violent", "is_property"]
    f = f.withColumns({"ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "coord_missing": F.col("coord_missing").cast("int"),
                       "gi": F.col("gi").cast("double"), "gj": F.col("gj").cast("double")})
    return r6(f.select(cols))


@query("region_validation")
def q_validation(spark, sf_dir):
    from cellrisk.operators.clean import validate_points
    req = _h(spark, sf_dir).filter(F.col("lat").isNotNull()).select(F.col("id").alias("idx"), "lat", "lon")
    return validate_points(req)


# ---------------------------------------------------------------------------
# 2.9 text
# ---------------------------------------------------------------------------
@query("text_normalise")
def q_text_norm(spark, sf_dir):
    from cellrisk.functions.text import normalize_text
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(normalize_text("text"), 256).alias("norm_sha"),
                    F.length(normalize_text("text")).alias("norm_len"))


@query("place_alias_replace")
def q_alias(spark, sf_dir):
    from cellrisk.functions.text import alias_replace, normalize_text
    h = _h(spark, sf_dir)
    return h.select("id", alias_replace(normalize_text("location_description")).alias("location_clean"))


@query("code_hygiene")
def q_hygiene(spark, sf_dir):
    from cellrisk.functions.text import code_hygiene, normalize_text
    h = _h(spark, sf_dir)
    return h.select("id", code_hygiene("iucr").alias("iucr"), normalize_text("description").alias("description"),
                    normalize_text("primary_type").alias("primary_type"))


@query("severity_layered")
def q_sev_layered(spark, sf_dir):
    from cellrisk.functions import severity as S
    from cellrisk.functions.text import normalize_text
    h = _h(spark, sf_dir).withColumn("d", normalize_text("description"))
    return h.select("id", S.keyword_adjust("d").alias("adj"),
                    S.keyword_adjust("d", False).alias("adj_no_weapon"),
                    S.anchor_severity("primary_type", "d").alias("anchor"),
                    S.type_base("primary_type").alias("base"),
                    S.layered_severity("primary_type", "d").alias("severity"),
                    S.severity_layer("primary_type", "d").alias("sev_layer"))


@query("severity_tier_modifier")
def q_sev_tier(spark, sf_dir):
    from cellrisk.functions import severity as S
    h = _h(spark, sf_dir)
    t = F.upper(F.trim("primary_type"))
    return r6(h.select("id", S.tier_base(t).alias("sev_base"), S.description_multiplier("description").alias("mult"),
                       S.tier_severity(t, "description").alias("severity")))


# ---------------------------------------------------------------------------
# 2.10 time
# ---------------------------------------------------------------------------
@query("time_parts")
def q_time_parts(spark, sf_dir):
    from cellrisk.functions import timefx as T
    h = _h(spark, sf_dir)
    cp = T.calendar_parts("ts")
    tf = T.time_features("ts")
    return r6(h.select(
        "id", cp["year"].alias("year"), cp["month"].alias("month"), cp["day"].alias("day"),
        cp["dow"].alias("dow"), cp["hour"].alias("hour"), cp["doy"].alias("doy"),
        F.date_format(cp["date"], "yyyy-MM-dd").alias("date"),
        T.period_of_ts("ts").alias("period_str"),
        F.date_format(T.period_start(T.period_of_ts("ts")), "yyyy-MM-dd").alias("period_start"),
        T.quarter_of_month(cp["month"]).alias("quarter"),
        T.is_night(cp["hour"]).alias("is_night"), tf["is_weekend"].alias("is_weekend"),
        tf["hour_sin"].alias("hour_sin"), tf["hour_cos"].alias("hour_cos"),
        tf["dow_sin"].alias("dow_sin"), tf["dow_cos"].alias("dow_cos"),
        T.cyclic(cp["month"], 12)[0].alias("month_sin"), T.cyclic(cp["month"], 12)[1].alias("month_cos"),
        T.hour_slot(cp["dow"], cp["hour"]).alias("slot"),
        T.hour_group(cp["hour"]).alias("hour_group")))


@query("age_days")
def q_age(spark, sf_dir):
    from cellrisk.functions.score import temporal_weight
    ev = hourly_events(spark, sf_dir)
    return r6(ev.select("id", "age_days", temporal_weight("age_days").alias("w_time"),
                        temporal_weight("age_days", 180.0).alias("w_180"),
                        "severity", "event_value"))


# ---------------------------------------------------------------------------
# 2.11 math, space, scores
# ---------------------------------------------------------------------------
@query("grid_cell_id")
def q_grid_id(spark, sf_dir):
    from cellrisk.functions.space import grid_cells, grid_index
    h = _h(spark, sf_dir).filter(F.col("lat").isNotNull())
    g = grid_cells("lat", "lon")
    return r6(h.select("id", g["lat_r"].alias("lat_r"), g["lon_r"].alias("lon_r"), g["cell_id"].alias("cell_id"),
                       grid_index(g["lat_r"]).alias("gx"), grid_index(g["lon_r"]).alias("gy"),
                       grid_index("lat").alias("gi_raw"), grid_index("lon").alias("gj_raw")))


@query("haversine_gaussian")
def q_haversine(spark, sf_dir):
    from cellrisk.functions.space import gaussian_weight, haversine_km
    h = _h(spark, sf_dir).filter(F.col("lat").isNotNull() & (F.col("lat") != 0))
    d = haversine_km(F.lit(41.8781), F.lit(-87.6298), "lat", "lon")
    return r6(h.select("id", d.alias("d_km"), gaussian_weight(d, 0.7).alias("w"),
                       gaussian_weight(d, 1.0).alias("w_sigma1")))


@query("score_functions")
def q_score_fns(spark, sf_dir):
    from cellrisk.functions import score as SC
    g = hourly_grid_df(spark, sf_dir)
    return r6(g.select("cell_id", "dow", "hour",
                       SC.power_score("risk_raw", 5.0, 0.5).alias("score_sqrt"),
                       SC.power_score("risk_raw", 5.0, 1.0).alias("score_linear"),
                       SC.power_score("risk_raw", 0.0, 0.5).alias("score_zero_clip"),
                       SC.tier_right_closed(F.col("risk_score")).alias("tier"),
                       SC.risk_level("risk_score").alias("level"),
                       SC.clamp(F.col("risk_score") * 1.3 - 20).alias("clamped")))


# ---------------------------------------------------------------------------
# monthly panel (2.4 densify / 8-neighbour mean, 2.6 windows, 2.10 calendar)
# ---------------------------------------------------------------------------
PANEL_COLS = ["gi", "gj", "period_str", "n_crimes", "n_violent", "n_property", "n_arrest", "n_domestic",
              "n_types", "arrest_rate", "domestic_rate", "share_night", "share_weekend", "glat", "glon",
              "year_idx", "pmonth", "pquarter", "pmonth_sin", "pmonth_cos", "lag_1", "lag_3", "lag_12",
              "roll3_mean", "roll6_mean", "roll12_mean", "cell_hist_mean", "trend_3_12", "n_violent_lag1",
              "arrest_rate_lag1", "domestic_rate_lag1", "neighbor_lag1_mean", "share_night_lag1",
              "share_weekend_lag1"]


@memo("gridmonth_panel")
def gridmonth_panel_df(spark, sf_dir):
    from cellrisk.plans.monthly import grid_month_aggregate, gridmonth_panel
    return gridmonth_panel(grid_month_aggregate(monthly_features(spark, sf_dir)))


@query("gridmonth_panel")
def q_gridmonth_panel(spark, sf_dir):
    return r6(gridmonth_panel_df(spark, sf_dir).select(*PANEL_COLS))


@query("grid_month_aggregate")
def q_grid_month_agg(spark, sf_dir):
    from cellrisk.plans.monthly import grid_month_aggregate
    from cellrisk.functions.timefx import period_str
    a = grid_month_aggregate(monthly_features(spark, sf_dir))
    return r6(a.select("gi", "gj", period_str("pidx").alias("period_str"), "n_crimes", "n_violent", "n_property",
                       "n_arrest", "n_domestic", "n_types", "night", "weekend", "arrest_rate", "domestic_rate",
                       "share_night", "share_weekend"))


@query("harm_table")
def q_harm(spark, sf_dir):
    from cellrisk.plans.monthly import harm_table
    from cellrisk.functions.timefx import period_str
    h = harm_table(monthly_features(spark, sf_dir))
    return r6(h.select("gi", "gj", period_str("pidx").alias("period_str"), "harm", "n_inc", "sev_mean"))


@query("training_table")
def q_training_table(spark, sf_dir):
    from cellrisk.plans.monthly import training_table
    t = training_table(gridmonth_panel_df(spark, sf_dir), monthly_scores_df(spark, sf_dir))
    return r6(t)


# ---------------------------------------------------------------------------
# 2.5 aggregations / profiles
# ---------------------------------------------------------------------------
@query("missing_profile")
def q_missing_profile(spark, sf_dir):
    from cellrisk.operators.profile import missing_profile
    h = _h(spark, sf_dir)
    return r6(missing_profile(h, ["lat", "lon", "ts", "location_description", "description", "value"]))


@query("missing_by_group")
def q_missing_by_group(spark, sf_dir):
    from cellrisk.operators.profile import missing_by_group
    return r6(missing_by_group(_h(spark, sf_dir), "event_type", ["lat", "lon", "location_description"]))


@query("co_missing")
def q_co_missing(spark, sf_dir):
    from cellrisk.operators.profile import co_missing
    return co_missing(_h(spark, sf_dir), ["lat", "lon", "location_description"])


@query("null_rate_by_category")
def q_null_rate(spark, sf_dir):
    from cellrisk.operators.profile import null_rate_by_category
    h = _h(spark, sf_dir)
    a = null_rate_by_category(h, "primary_type", "location_description", 500).withColumn("by", F.lit("type")) \
        .withColumnRenamed("primary_type", "category")
    b = null_rate_by_category(h, "description", "lat", 1000).withColumn("by", F.lit("description")) \
        .withColumnRenamed("description", "category")
    return r6(a.unionByName(b))


@query("key_uniqueness")
def q_key_unique(spark, sf_dir):
    from cellrisk.operators.profile import key_uniqueness
    m = inc_monthly(spark, sf_dir)
    return key_uniqueness(m, ["l_orderkey", "l_linenumber"], m.columns)


@query("rows_per_key_histogram")
def q_rows_per_key(spark, sf_dir):
    from cellrisk.operators.profile import rows_per_key_histogram
    return rows_per_key_histogram(inc_monthly(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@query("codes_per_duplicated_key")
def q_codes_dup(spark, sf_dir):
    from cellrisk.operators.profile import codes_per_duplicated_key
    return codes_per_duplicated_key(inc_monthly(spark, sf_dir), ["l_orderkey", "l_linenumber"], "l_returnflag")


@query("duplicated_key_rows")
def q_dup_rows(spark, sf_dir):
    from cellrisk.operators.joins import duplicated_key_rows
    m = inc_monthly(spark, sf_dir)
    return r6(duplicated_key_rows(m, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "gi", "gj", "l_returnflag", "l_quantity"))


@query("category_repetition")
def q_repetition(spark, sf_dir):
    from cellrisk.operators.profile import repetition_of_category
    return repetition_of_category(_h(spark, sf_dir), "case_number", "primary_type", "THEFT")


@query("consistency_counts")
def q_consistency(spark, sf_dir):
    from cellrisk.operators.profile import consistency_counts
    h = _h(spark, sf_dir).withColumns({
        "year_col": F.when(F.col("id") % 11 == 0, F.col("yr") + 1).otherwise(F.col("yr")),
        "updated": F.when(F.col("id") % 7 == 0, F.col("ts") - F.expr("INTERVAL 1 DAY"))
                    .otherwise(F.col("ts") + F.expr("INTERVAL 1 DAY"))})
    return consistency_counts(h, "year_col", "ts", "updated")


@query("taxonomy_conflicts")
def q_conflicts(spark, sf_dir):
    from cellrisk.operators.clean import canonical_type
    from cellrisk.operators.profile import taxonomy_conflicts
    h = _h(spark, sf_dir)
    c = canonical_type(h)
    before = taxonomy_conflicts(h, "iucr", "primary_type").withColumn("stage", F.lit("before"))
    after = taxonomy_conflicts(c, "iucr", "primary_type_canon").withColumn("stage", F.lit("after"))
    changed = c.agg(F.count_if(F.col("primary_type_canon") != F.upper(F.trim("primary_type"))).alias("n_conflicts")) \
               .withColumn("stage", F.lit("rows_relabelled"))
    return before.unionByName(after).unionByName(changed)


@query("top_labels_per_code")
def q_top_labels(spark, sf_dir):
    from cellrisk.operators.profile import top_labels_per_code
    return top_labels_per_code(_h(spark, sf_dir), "iucr", "primary_type", 3)


@query("canonical_labels")
def q_canonical(spark, sf_dir):
    from cellrisk.operators.clean import canonical_map
    return canonical_map(_h(spark, sf_dir)).withColumnRenamed("_canon", "canon")


@query("label_span")
def q_label_span(spark, sf_dir):
    from cellrisk.operators.profile import label_span
    m = inc_monthly(spark, sf_dir).withColumn("year", F.year("ts").cast("int"))
    return label_span(m, "primary_type", "year")


@query("spatial_outliers")
def q_spatial_outliers(spark, sf_dir):
    from cellrisk.operators.profile import spatial_outliers
    from cellrisk.params import HOURLY_REGION
    return r6(spatial_outliers(_h(spark, sf_dir), "lat", "lon", HOURLY_REGION))


@query("grid_density")
def q_grid_density(spark, sf_dir):
    from cellrisk.operators.profile import grid_density
    return r6(grid_density(monthly_features(spark, sf_dir)))


@query("cell_size_comparison")
def q_cell_size(spark, sf_dir):
    from cellrisk.operators.profile import cell_size_comparison
    h = _h(spark, sf_dir).filter(F.col("lat").isNotNull())
    return r6(cell_size_comparison(h, "lat", "lon"))


@query("cardinality")
def q_cardinality(spark, sf_dir):
    from cellrisk.operators.profile import cardinality
    h = _h(spark, sf_dir)
    return cardinality(h, ["id", "case_number", "iucr", "primary_type", "description", "location_description",
                           "arrest_str", "domestic_str", "event_type"])


@query("top_values")
def q_top_values(spark, sf_dir):
    from cellrisk.operators.profile import top_values
    h = _h(spark, sf_dir)
    parts = []
    for c, n in [("primary_type", 20), ("location_description", 15), ("description", 15), ("event_type", None)]:
        t = top_values(h, c, n)
        parts.append(t.select(F.lit(c).alias("column"), F.col(c).alias("value"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("calendar_counts")
def q_calendar(spark, sf_dir):
    from cellrisk.operators.profile import calendar_counts
    return calendar_counts(inc_monthly(spark, sf_dir), "ts")


@query("hour_weekday_pivot")
def q_pivot(spark, sf_dir):
    from cellrisk.operators.profile import hour_weekday_pivot
    return hour_weekday_pivot(_h(spark, sf_dir), "ts")


@query("mean_per_calendar_month")
def q_mean_month(spark, sf_dir):
    from cellrisk.operators.profile import mean_per_calendar_month
    return r6(mean_per_calendar_month(table(spark, sf_dir, "orders"), "o_orderdate"))


@query("hourly_profile_per_day")
def q_hourly_profile(spark, sf_dir):
    from cellrisk.operators.profile import hourly_profile_per_day
    return r6(hourly_profile_per_day(_h(spark, sf_dir), "ts"))


@query("density_bins")
def q_density_bins(spark, sf_dir):
    from cellrisk.operators.profile import density_bins
    return r6(density_bins(_h(spark, sf_dir), "ts", "lat", "lon"))


@query("rates_by_category")
def q_rates(spark, sf_dir):
    from cellrisk.functions.text import parse_bool_lenient, parse_bool_strict
    from cellrisk.operators.profile import rates_by_category
    h = _h(spark, sf_dir).withColumns({"arrest": parse_bool_strict("arrest_str"),
                                       "domestic": parse_bool_lenient("domestic_str")})
    return rates_by_category(h, "primary_type", ["arrest", "domestic"], 20)


@query("pair_frequency")
def q_pairs(spark, sf_dir):
    from cellrisk.operators.profile import pair_frequency
    return pair_frequency(_h(spark, sf_dir), "primary_type", "description", 25)


@query("unit_aggregate")
def q_unit(spark, sf_dir):
    from cellrisk.plans.hourly import unit_aggregate
    return r6(unit_aggregate(hourly_events(spark, sf_dir)))


@query("severity_diagnostics")
def q_sev_diag(spark, sf_dir):
    from cellrisk.functions import severity as S
    from cellrisk.operators.profile import severity_diagnostics
    m = inc_monthly(spark, sf_dir)
    t = F.upper(F.trim("primary_type"))
    m = m.withColumns({"ptc": t, "sev_base": S.tier_base(t), "desc_mult": S.description_multiplier("description"),
                       "severity": S.tier_severity(t, "description")})
    per, share = severity_diagnostics(m, "ptc", "sev_base", "severity", "desc_mult")
    return r6(per.withColumn("pct_modified", F.lit(share.first()["pct_modified"])))


@query("severity_layer_coverage")
def q_layer_cov(spark, sf_dir):
    from cellrisk.operators.profile import share_by
    return r6(share_by(hourly_events(spark, sf_dir), "sev_layer"))


@query("decay_mass_by_year")
def q_decay_mass(spark, sf_dir):
    from cellrisk.operators.profile import decay_mass_by_year
    m = inc_monthly(spark, sf_dir)
    ref = m.agg(F.max("ts")).first()[0]
    m = m.withColumn("age", (F.lit(ref).cast("timestamp_ntz").cast("timestamp").cast("double")
                             - F.col("ts").cast("timestamp").cast("double")) / 86400.0)
    return r6(decay_mass_by_year(m, "ts", "age"))


@query("score_summary")
def q_score_summary(spark, sf_dir):
    from cellrisk.operators.profile import score_summary
    s = monthly_scores_df(spark, sf_dir)
    return r4(score_summary(s, "risk_score", ["harm", "risk_raw"]))


@query("tier_counts")
def q_tier_counts(spark, sf_dir):
    s = monthly_scores_df(spark, sf_dir)
    return s.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))


@query("normaliser_comparison")
def q_normalisers(spark, sf_dir):
    from cellrisk.operators.profile import normaliser_comparison
    from cellrisk.operators.stats import quantiles
    g = hourly_grid_df(spark, sf_dir)
    clip = quantiles(g, "risk_raw", [0.99])[0]
    return r6(normaliser_comparison(g, "risk_raw", clip))


@query("hotspots")
def q_hotspots(spark, sf_dir):
    from cellrisk.operators.profile import hotspots
    s = monthly_scores_df(spark, sf_dir)
    return r6(hotspots(s, ["glat", "glon"], "risk_score", 5))


@query("quiet_busy_slots")
def q_quiet_busy(spark, sf_dir):
    from cellrisk.operators.profile import quiet_busy
    return r6(quiet_busy(hourly_grid_df(spark, sf_dir), "risk_score", "crime_count", "neighbor_count_mean"))


@query("spearman_score_count")
def q_spearman(spark, sf_dir):
    from cellrisk.operators.stats import spearman
    g = hourly_grid_df(spark, sf_dir)
    v = spearman(g, "risk_score", "crime_count")
    p = g.agg(F.corr("risk_score", "crime_count").alias("pearson"))
    return r6(p.withColumn("spearman", F.lit(v).cast("double")))


@query("run_summary")
def q_run_summary(spark, sf_dir):
    from cellrisk.functions.text import parse_bool_lenient, parse_bool_strict
    h = _h(spark, sf_dir)
    return r6(h.agg(F.count(F.lit(1)).alias("rows"),
                    F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
                    F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_ts"),
                    F.count_distinct("primary_type").alias("n_types"),
                    (F.avg(F.col("lat").isNull().cast("double")) * 100).alias("pct_missing_lat"),
                    (F.avg(parse_bool_strict("arrest_str").cast("double")) * 100).alias("arrest_pct"),
                    (F.avg(parse_bool_lenient("domestic_str").cast("double")) * 100).alias("domestic_pct")))


@query("run_checks")
def q_run_checks(spark, sf_dir):
    """The run's check list: one row a check, with what was seen."""
    from cellrisk.operators.profile import check_list
    return check_list(_h(spark, sf_dir), "id", "ts", "lat", "lon", "iucr", "primary_type")


@query("risk_level_table")
def q_level_table(spark, sf_dir):
    """Level thresholds with the number of grid slots at each level."""
    from cellrisk.functions.score import risk_level
    from cellrisk.plans.serve import level_table
    n = hourly_grid_df(spark, sf_dir).groupBy(risk_level("risk_score").alias("level")).agg(F.count(F.lit(1)).alias("n_slots"))
    return level_table(spark).join(n, "level", "left").fillna(0, subset=["n_slots"])


@query("dataset_fingerprint")
def q_fingerprint(spark, sf_dir):
    from cellrisk.operators.profile import fingerprint
    return fingerprint(hourly_grid_df(spark, sf_dir).select(*HOURLY_GRID_COLS))


@query("grid_key_fingerprint")
def q_key_fingerprint(spark, sf_dir):
    from cellrisk.operators.profile import key_fingerprint
    g = hourly_grid_df(spark, sf_dir).withColumns({c: F.col(c).cast("long") for c in ("crime_count", "cell_total_count")})
    return key_fingerprint(g, [*GRID_KEY, "crime_count", "cell_total_count"])


# ---------------------------------------------------------------------------
# 2.12 splits, baselines, encodings (hour-of-week grid)
# ---------------------------------------------------------------------------
GRID_KEY = ["cell_id", "dow", "hour"]


@memo("grid_protocols")
def grid_protocols(spark, sf_dir):
    from cellrisk.operators.splits import protocol_tags
    from cellrisk.operators.panel import materialize
    return protocol_tags(hourly_grid_df(spark, sf_dir), GRID_KEY)


@query("protocol_splits")
def q_protocols(spark, sf_dir):
    return grid_protocols(spark, sf_dir).select(*GRID_KEY, "split_A", "split_B", "split_C")


@query("unseen_cell_fraction")
def q_unseen(spark, sf_dir):
    from cellrisk.operators.joins import unseen_fraction
    from cellrisk.operators.splits import protocol_frames
    pf = protocol_frames(grid_protocols(spark, sf_dir))
    rows = []
    for p in ("A", "B", "C"):
        tr, te = pf[p]["train"], pf[p]["test"]
        rows.append((p, unseen_fraction(tr, te), tr.count(), te.count()))
    df = spark.createDataFrame(rows, "protocol string, unseen_cell_pct double, train_rows long, test_rows long")
    return r6(df)


@query("shrinkage_m_selection")
def q_shrink_m(spark, sf_dir):
    from cellrisk.operators.baselines import select_shrinkage_m
    from cellrisk.operators.splits import protocol_frames
    tr = protocol_frames(grid_protocols(spark, sf_dir))["B"]["train"]
    best, table = select_shrinkage_m(tr, ["cell_id", "hour"], GRID_KEY)
    return r6(table.withColumn("best_m", F.lit(best)))


def _ladder(spark, sf_dir, protocol="B"):
    key = (id(spark), sf_dir, "ladder_" + protocol)
    if key not in _MEMO:
        from cellrisk.operators.panel import materialize
        long, m = _ladder_build(spark, sf_dir, protocol)
        _MEMO[key] = (materialize(long), m)
    return _MEMO[key]


def _ladder_build(spark, sf_dir, protocol="B"):
    from cellrisk.operators.baselines import baseline_ladder
    from cellrisk.operators.splits import protocol_frames
    pf = protocol_frames(grid_protocols(spark, sf_dir))[protocol]
    return baseline_ladder(pf["train"], pf["test"], GRID_KEY)


@query("baseline_ladder")
def q_ladder(spark, sf_dir):
    long, _ = _ladder(spark, sf_dir, "B")
    return r6(long)


@query("baseline_comparison")
def q_comparison(spark, sf_dir):
    from cellrisk.operators.evaluate import add_improvement, metrics
    parts = []
    for p in ("A", "B", "C"):
        long, _ = _ladder(spark, sf_dir, p)
        parts.append(long.withColumn("protocol", F.lit(p)))
    allp = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("predictor_type", F.lit("baseline"))
    m = metrics(allp, ["protocol", "predictor", "predictor_type"])
    return r4(add_improvement(m))


@query("champion_order")
def q_champion_order(spark, sf_dir):
    """The champion's order on figures that do not depend on the clock: of the
    baselines of each protocol, ties in MAE go to the lower RMSE."""
    from cellrisk.operators.models import select_champion
    rows = q_comparison(spark, sf_dir).select("protocol", F.col("predictor").alias("model"), "MAE", F.col("RMSE").alias("train_seconds"),
                                              F.col("n").cast("double").alias("artifact_kb"))
    return reduce(DataFrame.unionByName, [select_champion(rows.filter(F.col("protocol") == p)).select(F.lit(p).alias("protocol"), "champion", "MAE")
                                          for p in ("A", "B", "C")])


@query("target_encoding")
def q_target_enc(spark, sf_dir):
    from cellrisk.operators.baselines import target_encoding
    from cellrisk.operators.splits import protocol_frames
    tr = protocol_frames(grid_protocols(spark, sf_dir))["B"]["train"]
    enc, g = target_encoding(tr)
    return r6(enc.withColumn("global_mean", F.lit(g)))


@query("quantile_bins")
def q_qbins(spark, sf_dir):
    from cellrisk.operators.evaluate import quantile_bins
    from cellrisk.params import QUINTILE_LABELS
    g = hourly_grid_df(spark, sf_dir)
    return quantile_bins(g, "risk_score", 5, QUINTILE_LABELS).select(*GRID_KEY, "quantile")


def _segmented(spark, sf_dir):
    from cellrisk.operators.evaluate import segmented
    long, _ = _ladder(spark, sf_dir, "B")
    wide = long.groupBy(*GRID_KEY, "y").pivot("predictor").agg(F.first("pred"))
    seg = wide.select(*GRID_KEY, "y", F.col("`Baseline: cell and hour, shrunk`").alias("pred_model"),
                      F.col("`Baseline: hour and weekday mean`").alias("pred_baseline"))
    return segmented(seg)


@query("segmented_by_quintile")
def q_seg_q(spark, sf_dir):
    return r6(_segmented(spark, sf_dir)["per_quintile"])


@query("segmented_by_hour_group")
def q_seg_h(spark, sf_dir):
    return r6(_segmented(spark, sf_dir)["per_hour_group"])


@query("large_error_shares")
def q_seg_large(spark, sf_dir):
    return r6(_segmented(spark, sf_dir)["large_error_fractions"])


@query("segmented_spearman")
def q_seg_spearman(spark, sf_dir):
    return r4(_segmented(spark, sf_dir)["spearman"])


@query("worst_cells")
def q_worst(spark, sf_dir):
    return r6(_segmented(spark, sf_dir)["worst_cells"])


# ---------------------------------------------------------------------------
# monthly training table: chronological protocol, lag-risk, persistence
# ---------------------------------------------------------------------------
TRAIN_END, VAL_END = "1995-12", "1996-12"


@memo("monthly_model_table")
def monthly_model_table(spark, sf_dir):
    """Training table without the partial month, with risk lags defaulted to
    the train mean (the modelling table of the monthly generation)."""
    from cellrisk.operators.panel import materialize
    from cellrisk.plans.monthly import add_risk_lags
    from cellrisk.plans.monthly import training_table
    t = training_table(gridmonth_panel_df(spark, sf_dir), monthly_scores_df(spark, sf_dir))
    t = t.filter(F.col("is_partial_period") == 0)
    return add_risk_lags(t, TRAIN_END)


@query("chrono_split")
def q_chrono(spark, sf_dir):
    from cellrisk.operators.splits import split_chrono
    t = monthly_model_table(spark, sf_dir)
    parts = zip(("train", "val", "test"), split_chrono(t, TRAIN_END, VAL_END))
    out = None
    for name, d in parts:
        a = d.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"),
                  F.min("period_str").alias("first_period"), F.max("period_str").alias("last_period"))
        out = a if out is None else out.unionByName(a)
    return out


@query("disjoint_periods")
def q_disjoint(spark, sf_dir):
    from cellrisk.operators.splits import split_chrono
    tr, va, te = split_chrono(monthly_model_table(spark, sf_dir), TRAIN_END, VAL_END)
    p = lambda d: d.select("period_str").distinct()
    a = p(tr).intersect(p(va)).agg(F.count(F.lit(1)).alias("n")).withColumn("pair", F.lit("train&val"))
    b = p(va).intersect(p(te)).agg(F.count(F.lit(1)).alias("n")).withColumn("pair", F.lit("val&test"))
    c = p(tr).intersect(p(te)).agg(F.count(F.lit(1)).alias("n")).withColumn("pair", F.lit("train&test"))
    return a.unionByName(b).unionByName(c)


@query("risk_lags")
def q_risk_lags(spark, sf_dir):
    t = monthly_model_table(spark, sf_dir)
    return r6(t.select("gi", "gj", "period_str", "risk_score", "risk_lag_1", "risk_lag_3", "risk_lag_12"))


def _monthly_baselines(spark, sf_dir):
    from cellrisk.operators.baselines import global_mean, group_mean, predict_group_mean
    from cellrisk.operators.splits import split_chrono
    t = monthly_model_table(spark, sf_dir)
    tr, _, te = split_chrono(t, TRAIN_END, VAL_END)
    gm = global_mean(tr)
    cm = group_mean(tr, ["gi", "gj"])
    p = te.select("gi", "gj", "period_str", F.col("risk_score").alias("y"), "prev_risk")
    p = p.withColumn("GlobalMean", F.lit(gm))
    p = predict_group_mean(p, cm, ["gi", "gj"], gm, "CellMean")
    p = p.withColumn("Persistence", F.coalesce(F.col("prev_risk"), F.lit(gm)))
    return p, gm, tr


@query("monthly_baseline_metrics")
def q_monthly_baselines(spark, sf_dir):
    from cellrisk.operators.evaluate import metrics
    p, _, _ = _monthly_baselines(spark, sf_dir)
    long = p.select("y", F.expr("stack(3, 'GlobalMean', GlobalMean, 'CellMean', CellMean, "
                                "'Persistence', Persistence) as (model, pred)"))
    return r4(metrics(long, ["model"], r2_zero_if_constant=False))


def _hard_case_rows(spark, sf_dir):
    """Test rows with their baselines, once for each subset they belong to."""
    from cellrisk.operators.stats import quantiles
    p, gm, tr = _monthly_baselines(spark, sf_dir)
    d = p.withColumn("chg", F.abs(F.col("y") - F.col("Persistence")))
    thr = quantiles(d, "chg", [0.75])[0]
    vol = tr.groupBy("gi", "gj").agg(F.stddev_samp("risk_score").alias("sd"))
    vthr = quantiles(vol, "sd", [0.75])[0]
    d = d.join(vol, ["gi", "gj"], "left").withColumn("sd", F.coalesce("sd", F.lit(0.0)))
    return d.select("gi", "gj", "period_str", "y", "Persistence", "CellMean", F.explode(F.array(
        F.lit("all"), F.when(F.col("chg") >= thr, F.lit("large_change")),
        F.when(F.col("sd") >= vthr, F.lit("volatile_cells")))).alias("subset")).filter(F.col("subset").isNotNull())


@query("hard_cases")
def q_hard_cases(spark, sf_dir):
    return r4(_hard_case_rows(spark, sf_dir).groupBy("subset").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("y") - F.col("CellMean"))).alias("MAE_cellmean"),
        F.avg(F.abs(F.col("y") - F.col("Persistence"))).alias("MAE_persistence")))


@query("tier_accuracy")
def q_tier_acc(spark, sf_dir):
    from cellrisk.functions.score import tier_right_closed
    from cellrisk.operators.evaluate import tier_accuracy
    p, _, _ = _monthly_baselines(spark, sf_dir)
    t = p.select(tier_right_closed("y").alias("a"), tier_right_closed("Persistence").alias("b"))
    return r6(tier_accuracy(t, "a", "b"))


@query("last_periods_holdout")
def q_last_periods(spark, sf_dir):
    from cellrisk.operators.drift import holdout_periods
    t = monthly_model_table(spark, sf_dir)
    return holdout_periods(t, "1997-12", 6)


@query("challenger_windows")
def q_windows(spark, sf_dir):
    from cellrisk.operators.drift import challenger_windows
    return challenger_windows(monthly_model_table(spark, sf_dir), TRAIN_END)


@query("batch_slice_by_year")
def q_batch_slice(spark, sf_dir):
    t = monthly_model_table(spark, sf_dir)
    y = F.substring("period_str", 1, 4)
    return t.groupBy(y.alias("batch")).agg(F.count(F.lit(1)).alias("rows"),
                                         F.count_distinct("period_str").alias("periods"))


# ---------------------------------------------------------------------------
# 2.14 drift
# ---------------------------------------------------------------------------
@query("psi_events")
def q_psi_events(spark, sf_dir):
    from cellrisk.operators.drift import psi_table
    h = _h(spark, sf_dir).select("value", "k", F.hour("ts").alias("hour"), F.dayofmonth("ts").alias("day"))
    ref, act = h.filter(F.col("day") <= 15), h.filter(F.col("day") > 15)
    return r6(psi_table(ref, act, ["value", "k", "hour"]))


def monthly_drift_features():
    from cellrisk.operators.drift import drift_features
    from cellrisk.params import FEATURE_COLUMNS_MONTHLY, RISK_LAG_COLUMNS
    return drift_features(FEATURE_COLUMNS_MONTHLY + RISK_LAG_COLUMNS)


def _drift_profile(spark, sf_dir):
    from cellrisk.operators.drift import drift_profile, psi_table
    t = monthly_model_table(spark, sf_dir)
    feats = monthly_drift_features()
    ref = t.filter(F.col("period_str") <= TRAIN_END)
    act = t.filter(F.col("period_str") > TRAIN_END).withColumn("batch", F.substring("period_str", 1, 4))   # every arriving year
    # every batch against the one reference in a single grouped pass
    return drift_profile(psi_table(ref, act, feats, group="batch"), feats, group="batch")


@query("drift_profile")
def q_drift_profile(spark, sf_dir):
    return r4(_drift_profile(spark, sf_dir))


@query("drift_decision")
def q_drift_decision(spark, sf_dir):
    from cellrisk.operators.baselines import global_mean, group_mean, predict_group_mean
    from cellrisk.operators.drift import drift_decision
    prof = _drift_profile(spark, sf_dir)
    t = monthly_model_table(spark, sf_dir)
    tr = t.filter(F.col("period_str") <= TRAIN_END)
    gm = global_mean(tr)
    cm = group_mean(tr, ["gi", "gj"])
    ref_mae = predict_group_mean(tr, cm, ["gi", "gj"], gm, "p").agg(
        F.avg(F.abs(F.col("risk_score") - F.col("p")))).first()[0]
    mon = (predict_group_mean(t, cm, ["gi", "gj"], gm, "p")
           .groupBy(F.substring("period_str", 1, 4).alias("batch"))
           .agg(F.avg(F.abs(F.col("risk_score") - F.col("p"))).alias("MAE_batch")))
    d = prof.join(mon, "batch", "left")
    return r4(d.select("batch", "psi_max", "MAE_batch", F.lit(ref_mae).alias("ref_mae"),
                       drift_decision(F.col("psi_max"), F.col("MAE_batch"), F.lit(ref_mae))
                       .cast("int").alias("drift_detected")))


# ---------------------------------------------------------------------------
# 2.4 radius join, serving joins, zone resolution
# ---------------------------------------------------------------------------
@query("radius_pairs")
def q_radius_pairs(spark, sf_dir):
    from cellrisk.operators.neighbours import radius_pairs
    from cellrisk.plans.hourly import cells_of
    cells = cells_of(hourly_events(spark, sf_dir))
    return r6(radius_pairs(cells.select("cell_id", "lat_r", "lon_r")))


def _requests(spark, sf_dir):
    """Request points derived from the incident view: in-box coordinates with
    ISO times; every third carries an offset, every fifth a 'Z'."""
    h = _h(spark, sf_dir).filter(F.col("lat").isNotNull() & (F.col("lat") != 0))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (F.when(F.col("id") % 5 == 0, F.concat(iso, F.lit("Z")))
            .when(F.col("id") % 3 == 0, F.concat(iso, F.lit("+07:00")))
            .when(F.col("id") % 11 == 0, F.date_format("ts", "yyyy-MM-dd"))                     # a date alone
            .when(F.col("id") % 13 == 0, F.concat(iso, F.lit(" America/New_York")))             # no offset: rejected
            .when(F.col("id") % 17 == 0, F.concat(F.year("ts").cast("string"), F.lit("-13-40")))   # junk
            .when(F.col("id") % 19 == 0, F.lit("2025-03-09T02:30:00"))                          # in the gap
            .when(F.col("id") % 23 == 0, F.lit("2025-11-02T01:30:00"))                          # doubled hour
            .otherwise(iso))
    return h.select(F.col("id").alias("idx"), "lat", "lon", text.alias("datetime"))


@query("zone_resolution")
def q_zone(spark, sf_dir):
    from cellrisk.plans.serve import resolve_requests
    r = resolve_requests(_requests(spark, sf_dir))
    return r.select("idx", "datetime", F.date_format("local_ts", "yyyy-MM-dd HH:mm:ss").alias("local_ts"),
                    "time_error")


@query("serve_batch_features")
def q_serve_features(spark, sf_dir):
    from cellrisk.plans.serve import build_features_batch, split_requests
    r, _ = split_requests(_requests(spark, sf_dir))
    f = build_features_batch(r, hourly_grid_df(spark, sf_dir))
    from cellrisk.params import FEATURE_COLUMNS
    return r6(f.select("idx", "cell_id", *FEATURE_COLUMNS, "data_coverage"))


@query("batch_rejects")
def q_batch_rejects(spark, sf_dir):
    from cellrisk.plans.serve import split_requests
    _, bad = split_requests(_requests(spark, sf_dir))
    return bad.select("idx", "error")


# ---------------------------------------------------------------------------
# 2.1 sources, 2.2 sinks (files are written under the shared checkpoint dir)
# ---------------------------------------------------------------------------
def _scratch(spark, name):
    from cellrisk.operators.models import scratch_path
    return scratch_path(spark, name)


def _raw_frame(spark, sf_dir):
    """The incident view laid out like the raw incident file."""
    h = _h(spark, sf_dir)
    return h.select(F.col("id").alias("ID"), F.col("case_number").alias("Case Number"),
                    F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("Date"),
                    F.lit(None).cast("string").alias("Block"), F.col("iucr").alias("IUCR"),
                    F.col("primary_type").alias("Primary Type"), F.col("description").alias("Description"),
                    F.col("location_description").alias("Location Description"),
                    F.col("arrest_str").alias("Arrest"), F.col("domestic_str").alias("Domestic"),
                    F.lit(None).cast("double").alias("Beat"), F.lit(None).cast("double").alias("District"),
                    F.lit(None).cast("double").alias("Ward"), F.lit(None).cast("double").alias("Community Area"),
                    F.lit(None).cast("string").alias("FBI Code"), (F.col("lat") * 1e5).alias("X Coordinate"),
                    (F.col("lon") * 1e5).alias("Y Coordinate"), F.col("yr").cast("double").alias("Year"),
                    F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("Updated On"),
                    F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"),
                    F.lit("(x, y)").alias("Location"))


def _csv_written(spark, sf_dir, drop=None, ending=""):
    path = _scratch(spark, "raw_csv") + ending
    df = _raw_frame(spark, sf_dir)
    if drop:
        df = df.drop(*drop)
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


RAW_OUT = [("ID", "id"), ("Case Number", "case_number"), ("IUCR", "iucr"), ("Primary Type", "primary_type"),
           ("Description", "description"), ("Location Description", "location_description"),
           ("Arrest", "arrest"), ("Domestic", "domestic"), ("Latitude", "lat"), ("Longitude", "lon"),
           ("Year", "year")]


@query("csv_scan_declared")
def q_csv_scan(spark, sf_dir):
    from cellrisk.sources.files import RAW_KEEP, RAW_SCHEMA, read_csv
    path = _csv_written(spark, sf_dir)
    df = read_csv(spark, path, RAW_SCHEMA, RAW_KEEP)
    return r6(df.select(*[F.col(f"`{a}`").alias(b) for a, b in RAW_OUT]))


@query("csv_profile_subset")
def q_csv_profile(spark, sf_dir):
    from cellrisk.sources.files import PROFILE_COLUMNS, RAW_SCHEMA, read_csv
    path = _csv_written(spark, sf_dir, drop=["Arrest"])      # one listed column absent from the file
    out = read_csv(spark, path, RAW_SCHEMA, PROFILE_COLUMNS)
    names = dict(RAW_OUT + [("Date", "date")])
    return r6(out.select(*[F.col(f"`{c}`").alias(names[c]) for c in out.columns]))


@query("parquet_first_existing")
def q_first_existing(spark, sf_dir):
    from cellrisk.sources.files import first_existing
    df, src = first_existing(spark, [f"{sf_dir}/no_such_table.parquet", f"{sf_dir}/lineitem.parquet"])
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.lit(src.rsplit("/", 1)[-1]).alias("source"))


@query("csv_second_choice")
def q_csv_second(spark, sf_dir):
    """No candidate is there as Parquet; the second is there as CSV."""
    from cellrisk.sources.files import RAW_SCHEMA, first_existing
    path = _csv_written(spark, sf_dir, ending=".csv")
    df, src = first_existing(spark, [f"{sf_dir}/no_such_table.parquet", path[:-len("csv")] + "parquet"], RAW_SCHEMA)
    return (df.groupBy(F.col("IUCR").alias("iucr"))
            .agg(F.count(F.lit(1)).alias("n"), F.count("Latitude").alias("n_lat"), F.lit(src.rsplit(".", 1)[-1]).alias("source")))


@query("recursive_lookup")
def q_recursive(spark, sf_dir):
    from cellrisk.sources.files import find_recursive
    root = _scratch(spark, "nested")
    m = inc_monthly(spark, sf_dir).withColumn("yr", F.year("ts"))
    m.write.mode("overwrite").partitionBy("yr").parquet(root + "/a/b")
    df = find_recursive(spark, root, "*.parquet")
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("params_json_read")
def q_params_json(spark, sf_dir):
    from cellrisk.params import LabelParams
    from cellrisk.sources.files import frozen_params_row, read_params, write_json
    g, clip = _grid_with_clip(spark, sf_dir)
    ref = hourly_events(spark, sf_dir).agg(F.max("ts")).first()[0]
    row = frozen_params_row(spark, str(ref), clip, g.select("cell_id").distinct().count(), g.count(), LabelParams())
    path = _scratch(spark, "label_params")
    write_json(row.coalesce(1), path)
    return read_params(spark, path, defaults={"risk_lag_cols": ["risk_lag_1", "risk_lag_3", "risk_lag_12"]})


@query("label_params_record")
def q_label_params(spark, sf_dir):
    """The frozen label parameters as read back from JSON, lists as text."""
    row = q_params_json(spark, sf_dir).withColumn("reference_date", F.substring("reference_date", 1, 19))
    return r6(row.withColumns({c: F.array_join(c, ",") for c in ("feature_columns", "label_ingredient_columns", "risk_lag_cols")}))


def _grid_with_clip(spark, sf_dir):
    from cellrisk.operators.stats import quantiles
    g = hourly_grid_df(spark, sf_dir)
    return g, quantiles(g, "risk_raw", [0.99])[0]


@query("hash_sample")
def q_hash_sample(spark, sf_dir):
    from cellrisk.sources.files import hash_sample
    return hash_sample(_h(spark, sf_dir), ["id"], 0.1).select("id", "event_type")


@query("parquet_sink_roundtrip")
def q_parquet_sink(spark, sf_dir):
    from cellrisk.sources.files import write_table
    s = monthly_scores_df(spark, sf_dir)
    path = write_table(s, _scratch(spark, "labels"), partition_by=["period_str"])
    back = spark.read.parquet(path)
    return r6(back.select("gi", "gj", "period_str", "n_crimes", "risk_score", "risk_tier"))


@query("csv_sink_roundtrip")
def q_csv_sink(spark, sf_dir):
    from cellrisk.sources.files import write_csv
    g = hourly_grid_df(spark, sf_dir).select("cell_id", "dow", "hour", "crime_count", "risk_score")
    path = write_csv(g, _scratch(spark, "grid_csv"))
    back = spark.read.schema("cell_id string, dow int, hour int, crime_count double, risk_score double") \
                .option("header", True).csv(path)
    return r6(back)


@query("export_sample_sorted")
def q_export(spark, sf_dir):
    from cellrisk.sources.files import export_sample
    g = hourly_grid_df(spark, sf_dir).select("cell_id", "dow", "hour", "risk_score")
    return r6(export_sample(g, ["cell_id", "dow", "hour"], 5000))


@query("json_sink_sanitized")
def q_json_sink(spark, sf_dir):
    from cellrisk.sources.files import write_json
    m = q_comparison(spark, sf_dir)
    m = m.withColumn("Spearman", F.when(F.col("Spearman").isNull(), F.lit(float("nan"))).otherwise(F.col("Spearman")))
    path = write_json(m, _scratch(spark, "metrics_json"))
    back = spark.read.schema(m.schema).json(path)
    return back.select("protocol", "predictor", "MAE", "Spearman")


# ---------------------------------------------------------------------------
# 2.6-2.8 remaining windows, top-k, set operations
# ---------------------------------------------------------------------------
@query("moving_avg_30")
def q_moving_avg(spark, sf_dir):
    from pyspark.sql import Window
    from cellrisk.operators.panel import moving_avg_short_start
    o = table(spark, sf_dir, "orders")
    daily = o.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    # the daily table is calendar-bounded (one row per day), so one ordered
    # window over it is small by construction
    w = Window.orderBy("d")
    return r6(daily.select(F.date_format("d", "yyyy-MM-dd").alias("d"), "n",
                           moving_avg_short_start("n", 30, w).alias("ma30")))


@query("group_max_per_code")
def q_group_max(spark, sf_dir):
    from cellrisk.operators.joins import join_small
    h = _h(spark, sf_dir)
    mx = h.filter(F.col("iucr").isNotNull()).groupBy("iucr").agg(F.max("yr").alias("last_year"))
    return join_small(h.select("id", "iucr"), mx, ["iucr"], "left")


@query("per_group_sample")
def q_group_sample(spark, sf_dir):
    from pyspark.sql import Window
    from cellrisk.operators.evaluate import quantile_bins
    from cellrisk.operators.splits import seeded_unit
    g = hourly_grid_df(spark, sf_dir)
    cm = g.groupBy("cell_id").agg(F.avg("risk_score").alias("cell_mean"))
    cm = quantile_bins(cm, "cell_mean", 5)
    w = Window.partitionBy("quantile").orderBy(seeded_unit(42, "cell_id"), "cell_id")
    return cm.withColumn("rn", F.row_number().over(w)).filter("rn <= 5").select("quantile", "cell_id")


@query("concat_dedupe_sorted")
def q_concat(spark, sf_dir):
    from cellrisk.operators.evaluate import dedupe_first
    m = q_monthly_baselines(spark, sf_dir)
    both = m.unionByName(m.withColumn("MAE", F.col("MAE") + 1.0))
    return dedupe_first(both, "model", [F.asc("MAE")]).orderBy("MAE").select("model", "MAE", "RMSE")


@query("distinct_cells_periods")
def q_distinct(spark, sf_dir):
    f = monthly_features(spark, sf_dir)
    cells = f.select("gi", "gj").distinct().agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("cells"))
    per = f.select("pidx").distinct().agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("periods"))
    return cells.unionByName(per)


@query("decay_kernel_sweep")
def q_sweep(spark, sf_dir):
    from cellrisk.functions.score import temporal_weight
    from cellrisk.functions.space import gaussian_weight, haversine_km
    ev = hourly_events(spark, sf_dir)
    d = haversine_km("lat", "lon", "lat_r", "lon_r")
    grid = F.array(*[F.struct(F.lit(float(h)).alias("H"), F.lit(float(s)).alias("sigma"))
                     for h in (180, 365, 730) for s in (0.5, 0.7, 1.0)])
    ex = ev.select("severity", "age_days", d.alias("d_km"), F.explode(grid).alias("p"))
    v = F.col("severity") * temporal_weight("age_days", F.col("p.H")) * gaussian_weight(F.col("d_km"), F.col("p.sigma"))
    return r6(ex.groupBy(F.col("p.H").alias("H"), F.col("p.sigma").alias("sigma")).agg(F.sum(v).alias("total_value")))


@query("decay_scenarios")
def q_scenarios(spark, sf_dir):
    """Relative contribution (%) of one incident in four cases for each (H,
    sigma), and that of the table's incidents on average."""
    from cellrisk.functions.score import scenario_shares, temporal_weight
    from cellrisk.functions.space import gaussian_weight, haversine_km
    from cellrisk.params import HALF_LIFE_DAYS, SCENARIO_GRID, SIGMA_KM
    ev = hourly_events(spark, sf_dir)
    grid = F.array(*[F.struct(F.lit(float(h)).alias("H"), F.lit(float(s)).alias("sigma")) for h, s in SCENARIO_GRID])
    ex = ev.select("age_days", haversine_km("lat", "lon", "lat_r", "lon_r").alias("d_km"), F.explode(grid).alias("p"))
    w = temporal_weight("age_days", F.col("p.H")) * gaussian_weight(F.col("d_km"), F.col("p.sigma"))
    seen = ex.groupBy(F.col("p.H").alias("H"), F.col("p.sigma").alias("sigma")).agg((F.avg(w) * 100).alias("mean_incident"))
    used = (F.col("H") == HALF_LIFE_DAYS) & (F.col("sigma") == SIGMA_KM)
    return r6(seen.select("H", "sigma", *scenario_shares("H", "sigma"), "mean_incident", used.cast("int").alias("used")))


# ---------------------------------------------------------------------------
# 2.13 models and evaluation (rows-only checks: no SQL form for MLlib fits)
# ---------------------------------------------------------------------------
def _protocol_b(spark, sf_dir):
    from cellrisk.operators.splits import protocol_frames
    return protocol_frames(grid_protocols(spark, sf_dir))["B"]


def _candidates(spark, sf_dir):
    key = (id(spark), sf_dir, "candidates")
    if key not in _MEMO:
        from cellrisk.operators.models import candidate_models, train_candidates
        from cellrisk.params import FEATURE_COLUMNS
        b = _protocol_b(spark, sf_dir)
        ests = candidate_models(b["train"])
        table, fitted = train_candidates(b["train"], b["test"], FEATURE_COLUMNS, GRID_KEY, ests)
        from cellrisk.operators.forest import release
        from cellrisk.operators.panel import materialize
        _MEMO[key] = (materialize(table), fitted)
        release(fitted.values())
    return _MEMO[key]


def _champion_name(spark, sf_dir):
    """The candidate that champion_selection names."""
    key = (id(spark), sf_dir, "champion_name")
    if key not in _MEMO:
        from cellrisk.operators.models import select_champion
        _MEMO[key] = select_champion(_candidates(spark, sf_dir)[0]).first()["champion"]
    return _MEMO[key]


@query("model_candidates")
def q_model_candidates(spark, sf_dir):
    table, _ = _candidates(spark, sf_dir)
    return r4(table.drop("train_seconds", "artifact_kb"))


@query("champion_selection")
def q_champion(spark, sf_dir):
    from cellrisk.operators.models import select_champion
    table, _ = _candidates(spark, sf_dir)
    return select_champion(table).select("champion", "reason")


@query("ridge_closed_form_check")
def q_ridge(spark, sf_dir):
    """Ridge through MLlib's normal equations vs the closed form
    ``(X'X + alpha I)^-1 X'y`` on centred data, from one Gram aggregate."""
    import numpy as np
    from cellrisk.operators.models import prepare, ridge
    from pyspark.ml.feature import VectorAssembler
    feats = ["crime_count", "neighbor_count_mean", "cell_total_count", "hour_sin", "hour_cos"]
    tr = prepare(_protocol_b(spark, sf_dir)["train"], feats, keep=["risk_score"])
    s = tr.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("risk_score").alias("sd")).first()
    x = VectorAssembler(inputCols=feats, outputCol="features").transform(tr)
    model = ridge(1.0, s["n"], s["sd"]).fit(x)
    # Gram matrix of centred features: one aggregate of k*(k+1)/2 + k sums
    means = tr.agg(*[F.avg(c).alias(c) for c in feats + ["risk_score"]]).first()
    cen = tr.select(*[(F.col(c) - F.lit(means[c])).alias(c) for c in feats + ["risk_score"]])
    k = len(feats)
    sums = cen.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(feats)
                     for j, b in enumerate(feats) if j >= i],
                   *[F.sum(F.col(a) * F.col("risk_score")).alias(f"y_{i}") for i, a in enumerate(feats)]).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = sums[f"{i}_{j}"]
    xy = np.array([sums[f"y_{i}"] for i in range(k)])
    beta = np.linalg.solve(g + 1.0 * np.eye(k), xy)
    rows = [(f, float(model.coefficients[i]), float(beta[i])) for i, f in enumerate(feats)]
    return r4(spark.createDataFrame(rows, "feature string, mllib double, closed_form double"))


@query("permutation_importance")
def q_perm(spark, sf_dir):
    from cellrisk.operators.models import permutation_importance
    from cellrisk.params import FEATURE_COLUMNS
    model = _candidates(spark, sf_dir)[1][_champion_name(spark, sf_dir)]
    return r4(permutation_importance(model, _protocol_b(spark, sf_dir)["test"], FEATURE_COLUMNS, GRID_KEY))


@query("target_encoding_ablation")
def q_ablation(spark, sf_dir):
    from cellrisk.operators.models import candidate_models, target_encoding_ablation
    from cellrisk.operators.splits import protocol_frames
    from cellrisk.params import FEATURE_COLUMNS
    pf = protocol_frames(grid_protocols(spark, sf_dir))
    name = _champion_name(spark, sf_dir)

    def est(df):
        return candidate_models(df)[name]
    return r4(target_encoding_ablation(pf, FEATURE_COLUMNS, GRID_KEY, est).drop("train_seconds", "artifact_kb"))


def _final_model(spark, sf_dir):
    """(name, model): the champion, fitted again on all rows."""
    key = (id(spark), sf_dir, "final_model")
    if key not in _MEMO:
        from cellrisk.operators.models import candidate_models, prepare
        from cellrisk.operators.modelstore import fitted
        from cellrisk.params import FEATURE_COLUMNS
        name = _champion_name(spark, sf_dir)
        tr = prepare(hourly_grid_df(spark, sf_dir), FEATURE_COLUMNS, keep=GRID_KEY + ["risk_score"])
        _MEMO[key] = name, fitted(tr, FEATURE_COLUMNS, candidate_models(tr)[name])[0]
    return _MEMO[key]


def _final_bundle(spark, sf_dir):
    """The final model, saved with the comparison rows of protocols A, B and C."""
    key = (id(spark), sf_dir, "bundle")
    if key not in _MEMO:
        from cellrisk.operators.models import save_bundle, scratch_path
        name, model = _final_model(spark, sf_dir)
        rows = q_champion_comparison(spark, sf_dir).orderBy("protocol", "MAE", "predictor").collect()
        summary = {f"protocol_{p}": [r.asDict() for r in rows if r["protocol"] == p] for p in ("A", "B", "C")}
        path = scratch_path(spark, "bundle")
        meta = save_bundle(model, name, summary, hourly_grid_df(spark, sf_dir).select(*GRID_KEY, "risk_score"),
                           {"half_life_days": 365.0, "sigma_km": 0.7}, path)
        _MEMO[key] = (model, meta, path)
    return _MEMO[key]


@query("final_bundle_registry")
def q_bundle(spark, sf_dir):
    from cellrisk.operators.models import append_registry, load_bundle, registry_entry
    model, meta, path = _final_bundle(spark, sf_dir)
    _, meta2 = load_bundle(spark, path)
    reg = path + "_registry"
    append_registry(registry_entry(meta2, path), reg)
    return spark.read.parquet(reg).select("version", "algorithm", "dataset_n_rows", "status")


@query("batch_scoring")
def q_batch_scoring(spark, sf_dir):
    from cellrisk.plans.serve import build_features_batch, predict_batch, score_rows, split_requests
    _, model = _final_model(spark, sf_dir)
    r, _ = split_requests(_requests(spark, sf_dir))
    scored = predict_batch(model, build_features_batch(r, hourly_grid_df(spark, sf_dir)), last_updated=_reference_date(spark, sf_dir))
    return score_rows(scored)


def _reference_date(spark, sf_dir):
    return str(hourly_events(spark, sf_dir).agg(F.max("ts")).first()[0])[:10]


#: Time slots of the score sheet: label and local time.
SHEET_SLOTS = [("Tue 09:00", "2026-04-14T09:00:00"), ("Tue 23:00", "2026-04-14T23:00:00"),
               ("Sat 23:00", "2026-04-11T23:00:00"), ("Sun 02:00", "2026-04-12T02:00:00")]


@query("score_sheet")
def q_score_sheet(spark, sf_dir):
    """Up to 25 cells stratified by mean score x 4 time slots, scored."""
    from pyspark.sql import Window
    from cellrisk.operators.evaluate import quantile_bins
    from cellrisk.operators.splits import seeded_unit
    from cellrisk.plans.serve import build_features_batch, predict_batch, resolve_requests, score_rows
    _, model = _final_model(spark, sf_dir)
    g = hourly_grid_df(spark, sf_dir)
    cm = quantile_bins(g.groupBy("cell_id", "lat_r", "lon_r").agg(F.avg("risk_score").alias("m")), "m", 5)
    w = Window.partitionBy("quantile").orderBy(seeded_unit(42, "cell_id"), "cell_id")
    cells = cm.withColumn("rn", F.row_number().over(w)).filter("rn <= 5")
    slots = F.array(*[F.struct(F.lit(a).alias("slot"), F.lit(b).alias("datetime")) for a, b in SHEET_SLOTS])
    req = (cells.select(F.col("lat_r").alias("lat"), F.col("lon_r").alias("lon"), F.explode(slots).alias("s"))
           .select("lat", "lon", F.col("s.slot").alias("slot"), F.col("s.datetime").alias("datetime")))
    scored = predict_batch(model, build_features_batch(resolve_requests(req), g), last_updated=_reference_date(spark, sf_dir))
    label = F.create_map(*[F.lit(x) for a, b in SHEET_SLOTS for x in (b, a)])
    return score_rows(scored).withColumn("slot", label[F.col("datetime")])


# ---------------------------------------------------------------------------
# 2.14 champion / challenger, decision log
# ---------------------------------------------------------------------------
def _arriving_years(t):
    """Years after the training window, from the data (a handful)."""
    y = t.filter(F.col("period_str") > TRAIN_END).select(F.substring("period_str", 1, 4).alias("y")).distinct()
    return [r["y"] for r in y.orderBy("y").collect()]


def _monitor_run(spark, sf_dir):
    key = (id(spark), sf_dir, "monitor")
    if key not in _MEMO:
        from cellrisk.operators.models import ridge
        from cellrisk.plans.monitor import Monitor
        from cellrisk.params import FEATURE_COLUMNS_MONTHLY, RISK_LAG_COLUMNS
        t = monthly_model_table(spark, sf_dir)

        def est(df):
            s = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("risk_score").alias("sd")).first()
            return ridge(1.0, s["n"], s["sd"] or 1.0, standardize=True)
        mon = Monitor(features=FEATURE_COLUMNS_MONTHLY + RISK_LAG_COLUMNS, estimator_fn=est, store=_scratch(spark, "monitor"))
        mon.init(t, TRAIN_END)
        for y in _arriving_years(t):
            mon.step(t, y)
        _MEMO[key] = mon
    return _MEMO[key]


@query("champion_challenger_log")
def q_cc_log(spark, sf_dir):
    return _monitor_run(spark, sf_dir).decision_log(spark).select(
        "seq", "version", "batch", "train_end", "decision", "drift_detected", "holdout_end")


@query("production_champion")
def q_prod(spark, sf_dir):
    from cellrisk.plans.monitor import current_champion
    return current_champion(_monitor_run(spark, sf_dir).decision_log(spark))


# ---------------------------------------------------------------------------
# 2.15 streaming (availableNow)
# ---------------------------------------------------------------------------
@query("stream_scoring")
def q_stream_scoring(spark, sf_dir):
    from cellrisk.streaming.scoring import start_scoring
    _, model = _final_model(spark, sf_dir)
    base = _scratch(spark, "stream")
    req = _requests(spark, sf_dir)
    req.filter(F.col("idx") % 2 == 0).write.mode("overwrite").parquet(base + "/in/part1")
    for q in start_scoring(spark, base + "/in/*", base + "/out", base + "/ckpt", hourly_grid_df(spark, sf_dir), model):
        q.awaitTermination()
    req.filter(F.col("idx") % 2 == 1).write.mode("overwrite").parquet(base + "/in/part2")
    for q in start_scoring(spark, base + "/in/*", base + "/out", base + "/ckpt", hourly_grid_df(spark, sf_dir), model):
        q.awaitTermination()
    # a third run with no new files adds nothing
    for q in start_scoring(spark, base + "/in/*", base + "/out", base + "/ckpt", hourly_grid_df(spark, sf_dir), model):
        q.awaitTermination()
    return spark.read.parquet(base + "/out/scores").select("idx", "cell_id", "risk_score", "level", "data_coverage")


@query("stream_period_monitor")
def q_stream_monitor(spark, sf_dir):
    from cellrisk.operators.models import ridge
    from cellrisk.plans.monitor import Monitor
    from cellrisk.params import FEATURE_COLUMNS_MONTHLY, RISK_LAG_COLUMNS
    from cellrisk.streaming.scoring import start_period_monitor, step_arrived
    t = monthly_model_table(spark, sf_dir)
    base = _scratch(spark, "arrivals")
    hist = t.filter(F.col("period_str") <= TRAIN_END)
    years = _arriving_years(t)

    def est(df):
        s = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("risk_score").alias("sd")).first()
        return ridge(1.0, s["n"], s["sd"] or 1.0, standardize=True)
    def monitor():   # a new object each time, as after a restart: the state is in the store
        return Monitor(features=FEATURE_COLUMNS_MONTHLY + RISK_LAG_COLUMNS, estimator_fn=est, store=base + "/store")
    monitor().init(hist, TRAIN_END)
    for y in [*years, None]:   # each year arrives; the last run finds nothing new
        if y:
            t.filter(F.col("period_str").startswith(y)).write.mode("overwrite").parquet(f"{base}/in/{y}")
        start_period_monitor(spark, base + "/in/*", t.schema, monitor(), hist, base + "/ckpt").awaitTermination()
    step_arrived(spark, monitor(), t.schema, hist, closing=True)   # the last year may be a part of one
    return monitor().decision_log(spark).select("seq", "version", "batch", "decision")


@query("average_rank")
def q_average_rank(spark, sf_dir):
    from cellrisk.operators.stats import ranked
    g = hourly_grid_df(spark, sf_dir).select(*GRID_KEY, "crime_count")
    return ranked(g, "crime_count", "rank").select(*GRID_KEY, "rank")


@query("score_anchor")
def q_score_anchor(spark, sf_dir):
    from cellrisk.operators.stats import quantiles
    g = hourly_grid_df(spark, sf_dir)
    clip = quantiles(g, "risk_raw", [0.99])[0]
    return r6(g.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cell_id").alias("n_cells"))
              .withColumn("score_clip_value", F.lit(clip)))


@query("feature_table_load")
def q_feature_table_load(spark, sf_dir):
    from cellrisk.plans.hourly import FINAL_COLUMNS
    from cellrisk.sources.files import load_feature_table, write_csv
    path = write_csv(hourly_grid_df(spark, sf_dir).select(*FINAL_COLUMNS), _scratch(spark, "features_labels"))
    return r6(load_feature_table(spark, path))


# ---------------------------------------------------------------------------
# the chosen model in the evaluation
# ---------------------------------------------------------------------------
def _champion_predictions(spark, sf_dir):
    """(protocol, predictor, predictor_type, key, y, pred) of the baselines and
    of the champion, fitted on each protocol's train."""
    key = (id(spark), sf_dir, "champion_predictions")
    if key not in _MEMO:
        from cellrisk.operators.forest import release
        from cellrisk.operators.models import candidate_models, prepare
        from cellrisk.operators.modelstore import fitted_all
        from cellrisk.operators.panel import materialize
        from cellrisk.operators.splits import protocol_frames
        from cellrisk.params import FEATURE_COLUMNS
        _, fitted = _candidates(spark, sf_dir)
        best = _champion_name(spark, sf_dir)
        pf = protocol_frames(grid_protocols(spark, sf_dir))
        rows = {p: prepare(pf[p]["train"], FEATURE_COLUMNS, keep=GRID_KEY + ["risk_score"]) for p in ("A", "C")}
        made = fitted_all(spark, [(tr, FEATURE_COLUMNS, candidate_models(tr)[best]) for tr in rows.values()])
        models = {"B": fitted[best].copy(), **{p: model for p, (model, _) in zip(rows, made)}}
        out = None
        for p in ("A", "B", "C"):
            base = _ladder(spark, sf_dir, p)[0].withColumn("predictor_type", F.lit("baseline"))
            te = prepare(pf[p]["test"], FEATURE_COLUMNS, keep=GRID_KEY + ["risk_score"])
            own = models[p].transform(te).select(*GRID_KEY, F.col("risk_score").alias("y"), F.lit(best).alias("predictor"),
                                             F.col("prediction").alias("pred"), F.lit("model").alias("predictor_type"))
            both = base.select(*own.columns).unionByName(own).withColumn("protocol", F.lit(p))
            out = both if out is None else out.unionByName(both)
        _MEMO[key] = materialize(out)
        release(models.values())
    return _MEMO[key]


@query("champion_comparison")
def q_champion_comparison(spark, sf_dir):
    """Baselines and champion on the three protocols."""
    from cellrisk.operators.evaluate import add_improvement, metrics
    return r4(add_improvement(metrics(_champion_predictions(spark, sf_dir), ["protocol", "predictor", "predictor_type"])))


@query("champion_segments")
def q_champion_segments(spark, sf_dir):
    """The champion and the strongest simple baseline on B, as (segment_kind,
    segment, ...): MAE by label quintile and by hour group, percentages of rows
    with a large error, the champion's worst cells with their row counts, and the
    rank correlations with the label."""
    from cellrisk.operators.evaluate import segmented
    from cellrisk.params import LARGE_ERROR_THRESHOLDS
    b = _champion_predictions(spark, sf_dir).filter(F.col("protocol") == "B")
    wide = b.groupBy(*GRID_KEY, "y").agg(
        F.max(F.when(F.col("predictor_type") == "model", F.col("pred"))).alias("pred_model"),
        F.max(F.when(F.col("predictor") == "Baseline: hour and weekday mean", F.col("pred"))).alias("pred_baseline"))
    s = segmented(wide)
    none = F.lit(None).cast("double")
    gain = ((1 - F.col("err_model") / F.col("err_baseline")) * 100).alias("improvement_pct")
    n = F.lit(None).cast("long").alias("n")
    q = s["per_quintile"].select(F.lit("quintile").alias("segment_kind"), F.col("quantile").alias("segment"), "err_model", "err_baseline", "improvement_pct", n)
    h = s["per_hour_group"].select(F.lit("hour_group").alias("segment_kind"), F.col("hour_group").alias("segment"), "err_model", "err_baseline", gain, n)
    large = s["large_error_fractions"].select(F.explode(F.array(*[
        F.struct(F.lit(f"gt{t}").alias("segment"), F.col(f"`model_gt{t}`").alias("err_model"), F.col(f"`baseline_gt{t}`").alias("err_baseline"))
        for t in LARGE_ERROR_THRESHOLDS])).alias("x")).select(F.lit("large_error_pct").alias("segment_kind"), "x.*").select("*", none.alias("improvement_pct"), n)
    worst = s["worst_cells"].select(F.lit("worst_cell").alias("segment_kind"), F.col("cell_id").alias("segment"), F.col("mean").alias("err_model"),
                                    none.alias("err_baseline"), none.alias("improvement_pct"), F.col("count").alias("n"))
    rank = s["spearman"].groupBy().agg(*[F.max(F.when(F.col("predictor") == who, F.col("spearman"))).alias(f"err_{who}") for who in ("model", "baseline")])
    rank = rank.select(F.lit("spearman").alias("segment_kind"), F.lit("all").alias("segment"), "err_model", "err_baseline", none.alias("improvement_pct"), n)
    return r4(q.unionByName(h).unionByName(large).unionByName(worst).unionByName(rank))


MONTHLY_V1_V2 = ("v1", "v2")


@memo("monthly_predictions", materialized=False)
def _monthly_predictions(spark, sf_dir):
    """(generation, model, part, gi, gj, period_str, y, pred) of both monthly
    generations: three candidates on the features (v1) and on features with
    lagged risk (v2), clipped to 0..100, on the validation and test months."""
    from cellrisk.operators.forest import release
    from cellrisk.operators.models import boosted_trees, candidate_models, prepare
    from cellrisk.operators.modelstore import fitted_all
    from cellrisk.operators.panel import materialize
    from cellrisk.operators.splits import split_chrono
    from cellrisk.params import FEATURE_COLUMNS_MONTHLY, RISK_LAG_COLUMNS
    tr, va, te = split_chrono(monthly_model_table(spark, sf_dir), TRAIN_END, VAL_END)
    clip = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("prediction")))
    out, gens, jobs = None, [], []
    for gen, feats in zip(MONTHLY_V1_V2, (FEATURE_COLUMNS_MONTHLY, FEATURE_COLUMNS_MONTHLY + RISK_LAG_COLUMNS)):
        a, b, c = (materialize(prepare(d, feats, keep=["gi", "gj", "period_str", "risk_score"])) for d in (tr, va, te))
        ests = candidate_models(a)
        ests["Model: Gradient Boosted Trees"] = boosted_trees(400, 6, 0.08)
        gens += [(gen, name, b, c) for name in ests]
        jobs += [(a, feats, est) for est in ests.values()]
    made = fitted_all(spark, jobs)
    for (gen, name, b, c), (model, _) in zip(gens, made):
        for part, d in (("val", b), ("test", c)):
            p = model.transform(d).select(F.lit(gen).alias("generation"), F.lit(name).alias("model"), F.lit(part).alias("part"),
                                          "gi", "gj", "period_str", F.col("risk_score").alias("y"), clip.alias("pred"))
            out = p if out is None else out.unionByName(p)
    out = materialize(out)
    release(model for model, _ in made)
    return out


@memo("monthly_metrics")
def _monthly_metrics(spark, sf_dir):
    from cellrisk.operators.evaluate import metrics
    m = metrics(_monthly_predictions(spark, sf_dir), ["generation", "model", "part"])
    val = m.filter(F.col("part") == "val").groupBy("generation").agg(F.min_by("model", F.struct("MAE", "model")).alias("_best"))
    return m.join(val, "generation").withColumn("chosen", (F.col("model") == F.col("_best")).cast("int")).drop("_best")


@query("monthly_models")
def q_monthly_models(spark, sf_dir):
    """Both monthly generations' candidates, the best on validation MAE marked,
    measured on the validation and test months."""
    return r4(_monthly_metrics(spark, sf_dir))


def _monthly_chosen(spark, sf_dir):
    """Test predictions of each generation's chosen model."""
    best = _monthly_metrics(spark, sf_dir).filter("chosen = 1 and part = 'test'").select("generation", "model")
    return _monthly_predictions(spark, sf_dir).filter("part = 'test'").join(F.broadcast(best), ["generation", "model"])


@query("monthly_model_hard_cases")
def q_monthly_model_hard_cases(spark, sf_dir):
    """The chosen monthly models beside the baselines on the hard-case subsets."""
    own = _monthly_chosen(spark, sf_dir).select("generation", "model", "gi", "gj", "period_str", "pred")
    d = _hard_case_rows(spark, sf_dir).join(own, ["gi", "gj", "period_str"])
    return r4(d.groupBy("generation", "model", "subset").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("y") - F.col("pred"))).alias("MAE_model"),
        F.avg(F.abs(F.col("y") - F.col("CellMean"))).alias("MAE_cellmean"),
        F.avg(F.abs(F.col("y") - F.col("Persistence"))).alias("MAE_persistence")))


@query("monthly_model_tier_accuracy")
def q_monthly_model_tier_accuracy(spark, sf_dir):
    """Share of test rows whose tier the chosen monthly model hits."""
    from cellrisk.functions.score import tier_right_closed
    same = F.coalesce(tier_right_closed("y") == tier_right_closed("pred"), F.lit(False))
    return r6(_monthly_chosen(spark, sf_dir).groupBy("generation", "model").agg(F.avg(same.cast("double")).alias("tier_accuracy")))
