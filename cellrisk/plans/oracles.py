"""Oracle texts: plain DuckDB SQL written from each operator's formula,
starting from the adapter view text.  Kept separate from the Spark code on
purpose: the two are independent renderings of the same definition.

Conventions shared with the Spark side: computed doubles are rounded to 6
places, integer outputs are cast to the same width in both, and double
literals are written in exponent form (``1e-2``) so DuckDB does not read
them as decimals.
"""

from __future__ import annotations

import math

from cellrisk import params as P
from cellrisk.sources.adapters import oracle_with

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def dbl(x: float) -> str:
    return repr(float(x)) if "e" in repr(float(x)) else f"{float(x)!r}e0"


def sql_list(items) -> str:
    return ", ".join("'" + str(s).replace("'", "''") + "'" for s in items)


def tier_case(col: str) -> str:
    parts = [f"when {col} in ({sql_list(names)}) then {dbl(t)}" for t, names in P.SEVERITY_TIERS]
    return "case " + " ".join(parts) + f" else {dbl(P.TIER_DEFAULT)} end"


def mult_case(col: str) -> str:
    d = f"upper(coalesce({col}, ''))"
    return (f"least(greatest("
            f"(case when regexp_matches({d}, '{P.MULT_GUN_PATTERN}') then {dbl(P.MULT_GUN)} else 1e0 end)"
            f" * (case when regexp_matches({d}, '{P.MULT_AGG_PATTERN}') then {dbl(P.MULT_AGG)} else 1e0 end)"
            f" * (case when regexp_matches({d}, '{P.MULT_WEAPON_PATTERN}') then {dbl(P.MULT_WEAPON)} else 1e0 end)"
            f" * (case when regexp_matches({d}, '{P.MULT_SIMPLE_PATTERN}') then {dbl(P.MULT_SIMPLE)} else 1e0 end)"
            f", {dbl(P.MULT_MIN)}), {dbl(P.MULT_MAX)})")


def period_text(pidx: str) -> str:
    return f"printf('%04d-%02d', cast(floor({pidx} / 12) as int), cast({pidx} % 12 + 1 as int))"


MONTH_IDX = "cast(year(ts) * 12 + month(ts) - 1 as int)"

# ---------------------------------------------------------------------------
# minimum slice: monthly score
# ---------------------------------------------------------------------------
_decay_terms = " + ".join(
    f"coalesce(lag(harm, {k}) over w, 0e0) * {dbl(0.5 ** (k / P.TEMPORAL_HALFLIFE_MONTHS))}"
    if k else f"harm * {dbl(1.0)}" for k in range(P.TEMPORAL_WINDOW_MONTHS + 1))

MONTHLY_SCORE_SQL = oracle_with("inc_monthly") + f""",
f as (
  select gi, gj, {MONTH_IDX} as pidx,
    {tier_case("upper(trim(primary_type))")} * {mult_case("description")} as severity
  from inc_monthly where gi is not null and gj is not null and ts is not null),
obs as (select gi, gj, pidx, count(*) as n_crimes, sum(severity) as harm from f group by 1, 2, 3),
cells as (select distinct gi, gj from obs),
periods as (select distinct pidx from obs),
panel as (
  select c.gi, c.gj, p.pidx, coalesce(o.n_crimes, 0) as n_crimes, coalesce(o.harm, 0e0) as harm
  from cells c cross join periods p
  left join obs o on o.gi = c.gi and o.gj = c.gj and o.pidx = p.pidx),
dec as (
  select *, {_decay_terms} as harm_temporal
  from panel window w as (partition by gi, gj order by pidx)),
ker as (
  select a.gi, a.gj, a.pidx, any_value(a.n_crimes) as n_crimes, any_value(a.harm) as harm,
    any_value(a.harm_temporal) as harm_temporal,
    sum(b.harm_temporal * exp(-((b.gi - a.gi) * (b.gi - a.gi) + (b.gj - a.gj) * (b.gj - a.gj))
        / (2e0 * {dbl(P.SPATIAL_BANDWIDTH_CELLS)} * {dbl(P.SPATIAL_BANDWIDTH_CELLS)}))) as harm_spatial
  from dec a join dec b on b.pidx = a.pidx
    and b.gi between a.gi - {P.SPATIAL_RADIUS_CELLS} and a.gi + {P.SPATIAL_RADIUS_CELLS}
    and b.gj between a.gj - {P.SPATIAL_RADIUS_CELLS} and a.gj + {P.SPATIAL_RADIUS_CELLS}
  group by 1, 2, 3),
r as (select *, ln(1 + greatest(harm_spatial, 0e0)) as r from ker),
cap as (select quantile_cont(r, {dbl(P.CLIP_PCTL_MONTHLY / 100)}) as cap, max(pidx) as pmax from r),
rc as (select r.*, least(greatest(r.r, 0e0), cap.cap) as rc, cap.pmax from r, cap),
mm as (select min(rc) as lo, max(rc) as hi from rc),
s as (select rc.*, case when mm.hi - mm.lo > 0 then (rc.rc - mm.lo) / (mm.hi - mm.lo) * 1e2 else 0e0 end as risk_score
  from rc, mm)
select gi, gj, {period_text("pidx")} as period_str, round(gi * 1e-2, 6) as glat, round(gj * 1e-2, 6) as glon,
  n_crimes, round(harm, 6) as harm, round(harm_temporal, 6) as harm_temporal,
  round(harm_spatial, 6) as harm_spatial, round(harm_spatial, 6) as risk_raw,
  round(risk_score, 6) as risk_score,
  case when risk_score > -0.01 and risk_score <= 50 then 'LOW'
       when risk_score > 50 and risk_score <= 80 then 'MEDIUM'
       when risk_score > 80 and risk_score <= 95 then 'HIGH'
       when risk_score > 95 and risk_score <= 100.01 then 'VERY HIGH' end as risk_tier,
  cast(pidx = pmax as int) as is_partial_period
from s
"""
oracle("monthly_risk_score", MONTHLY_SCORE_SQL)


# ---------------------------------------------------------------------------
# shared DuckDB fragments
# ---------------------------------------------------------------------------
def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def norm_text(x: str) -> str:
    return (f"regexp_replace(trim(regexp_replace(upper({x}), '\\s+', ' ', 'g')), "
            f"'\\s*/\\s*', ' / ', 'g')")


def values_table(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(
        ("'" + str(v).replace("'", "''") + "'") if isinstance(v, str) else dbl(v) for v in r) + ")"
        for r in rows)
    return f"(select * from (values {body}) as t({', '.join(cols)}))"


ANCHOR_VALUES = values_table([(t, d, float(v)) for t, d, v in P.SEVERITY_ANCHOR],
                             ["a_type", "a_desc", "a_sev"])
BASE_VALUES = values_table([(t, float(v)) for t, v in P.TYPE_BASE], ["b_type", "b_sev"])


def contains_any(d: str, words) -> str:
    return "(" + " or ".join(f"contains({d}, '{w}')" for w in words) + ")"


def keyword_adjust_sql(d: str, weapon_on: str = "true") -> str:
    dd = f"upper(coalesce({d}, ''))"
    return (f"(case when not ({weapon_on}) then 0 when {contains_any(dd, P.GUN_WORDS)} then {P.ADJ_GUN} "
            f"when {contains_any(dd, P.BLADE_WORDS)} then {P.ADJ_BLADE} else 0 end"
            f" + case when contains({dd}, 'AGGRAVATED') then {P.ADJ_AGGRAVATED} else 0 end"
            f" + case when contains({dd}, 'DOMESTIC') then {P.ADJ_DOMESTIC} else 0 end"
            f" + case when contains({dd}, 'CHILD') or contains({dd}, 'MINOR') then {P.ADJ_CHILD} else 0 end"
            f" + case when contains({dd}, 'ATTEMPT') then {P.ADJ_ATTEMPT} else 0 end)")


def severity_cte(src: str, t: str, d: str, name: str = "sev") -> str:
    """CTE adding severity and severity_layer to ``src`` (t, d already
    upper-stripped text expressions over src columns)."""
    ess = f"coalesce({t} in ({sql_list(P.WEAPON_IS_ESSENCE)}), false)"
    return f"""{name} as (
  select s.*, coalesce(an.a_sev, least(greatest(coalesce(bs.b_sev, {dbl(P.GLOBAL_DEFAULT_SEVERITY)})
      + {keyword_adjust_sql(d, 'not ' + ess)}, 1e0), 1e2)) as severity,
    case when an.a_sev is not null then '1-anchor' when bs.b_sev is not null then '2-base+modifier'
         else '3-default' end as sev_layer
  from {src} s
  left join {ANCHOR_VALUES} an on an.a_type = {t} and an.a_desc = {d}
  left join {BASE_VALUES} bs on bs.b_type = {t})"""


HOURLY_CLEAN_CTES = oracle_with("inc_hourly") + f""",
c0 as (select * from inc_hourly where lat is not null and lon is not null and ts is not null
  and lat between {dbl(P.LAT_MIN)} and {dbl(P.LAT_MAX)} and lon between {dbl(P.LON_MIN)} and {dbl(P.LON_MAX)}),
cnt as (select iucr, yr, primary_type, count(*) as n from c0 where iucr is not null group by all),
lasty as (select iucr, max(yr) as ly from cnt group by all),
rec as (select cnt.iucr, primary_type, sum(n) as n from cnt join lasty on cnt.iucr = lasty.iucr and cnt.yr = lasty.ly
  where primary_type is not null group by all),
cm as (select iucr, primary_type as canon from (
  select *, row_number() over (partition by iucr order by n desc, primary_type asc) as rk from rec) where rk = 1),
c1 as (select c0.*, {strip("upper(coalesce(cm.canon, c0.primary_type))")} as ptc,
  {norm_text("c0.description")} as dc,
  coalesce(lower({strip("arrest_str")}) = 'true', false) as arrest
  from c0 left join cm on cm.iucr = c0.iucr),
{severity_cte("c1", strip("upper(s.ptc)"), strip("upper(s.dc)"))},
refts as (select max(ts) as ref from c1),
ev as (select sev.*, round_even(lat * 1e2, 0) / 1e2 as lat_r, round_even(lon * 1e2, 0) / 1e2 as lon_r,
  cast(hour(ts) as int) as hour, cast(isodow(ts) - 1 as int) as dow,
  coalesce(ptc in ({sql_list(P.VIOLENT_TYPES)}), false) as is_violent,
  datediff('microsecond', ts, refts.ref) / 86400e6 as age_days
  from sev, refts),
ev2 as (select *, cast(lat_r as varchar) || '_' || cast(lon_r as varchar) as cell_id,
  cast(round_even(lat_r / 1e-2, 0) as int) as gx, cast(round_even(lon_r / 1e-2, 0) as int) as gy,
  pow(0.5e0, age_days / {dbl(P.HALF_LIFE_DAYS)}) as w_time,
  severity * pow(0.5e0, age_days / {dbl(P.HALF_LIFE_DAYS)}) as event_value
  from ev)"""

HAVERSINE = (f"2e0 * {dbl(P.EARTH_RADIUS_KM)} * asin(sqrt(pow(sin((radians(b.lat_r) - radians(a.lat_r)) / 2), 2)"
             f" + cos(radians(a.lat_r)) * cos(radians(b.lat_r)) * pow(sin((radians(b.lon_r) - radians(a.lon_r)) / 2), 2)))")

HOURLY_GRID_CTES = HOURLY_CLEAN_CTES + f""",
unit as (select cell_id, gx, gy, lat_r, lon_r, dow, hour, sum(event_value) as base_value, count(*) as crime_count,
  avg(cast(is_violent as double)) as violent_share, avg(cast(arrest as double)) as arrest_rate
  from ev2 group by all),
cells as (select cell_id, gx, gy, lat_r, lon_r, count(*) as cell_total_count from ev2 group by all),
pairs as (select a.cell_id, b.cell_id as nbr, {HAVERSINE} as d_km from cells a, cells b),
pw as (select cell_id, nbr, exp(-(d_km * d_km) / (2e0 * {dbl(P.SIGMA_KM)} * {dbl(P.SIGMA_KM)})) as w
  from pairs where d_km <= {dbl(P.CUTOFF_KM)}),
wsum as (select cell_id, sum(w) as ws from pw group by all),
raw as (select pw.cell_id, u.dow * 24 + u.hour as slot, sum(pw.w * u.base_value) as s
  from pw join unit u on u.cell_id = pw.nbr group by all),
spine as (select c.*, cast(r.slot as int) as slot from cells c, range(168) r(slot)),
nb as (select a.cell_id, u.dow * 24 + u.hour as slot, sum(u.crime_count) as s
  from cells a join unit u on abs(u.gx - a.gx) <= 1 and abs(u.gy - a.gy) <= 1
  and not (u.gx = a.gx and u.gy = a.gy) group by all),
g0 as (select sp.cell_id, sp.lat_r, sp.lon_r, cast(sp.slot // 24 as int) as dow, cast(sp.slot % 24 as int) as hour,
  coalesce(u.base_value, 0e0) as base_value, cast(coalesce(u.crime_count, 0) as double) as crime_count,
  coalesce(u.violent_share, 0e0) as violent_share, coalesce(u.arrest_rate, 0e0) as arrest_rate,
  cast(sp.cell_total_count as double) as cell_total_count,
  coalesce(nb.s, 0) / 8e0 as neighbor_count_mean,
  coalesce(raw.s / wsum.ws, 0e0) as risk_raw
  from spine sp
  left join unit u on u.cell_id = sp.cell_id and u.dow * 24 + u.hour = sp.slot
  left join raw on raw.cell_id = sp.cell_id and raw.slot = sp.slot
  left join wsum on wsum.cell_id = sp.cell_id
  left join nb on nb.cell_id = sp.cell_id and nb.slot = sp.slot),
clipv as (select quantile_cont(risk_raw, {dbl(P.CLIP_PERCENTILE)}) as clip from g0),
grid as (select g0.*, cast(dow >= 5 as int) as is_weekend,
  sin(2 * pi() * hour / 24e0) as hour_sin, cos(2 * pi() * hour / 24e0) as hour_cos,
  sin(2 * pi() * dow / 7e0) as dow_sin, cos(2 * pi() * dow / 7e0) as dow_cos,
  case when clipv.clip <= 0 then 0e0
       else 1e2 * pow(least(greatest(risk_raw, 0e0), clipv.clip) / clipv.clip, {dbl(P.SCORE_EXPONENT)}) end as risk_score
  from g0, clipv)"""

HOURLY_GRID_COLS = ["cell_id", "dow", "hour", "lat_r", "lon_r", "is_weekend", "hour_sin", "hour_cos",
                    "dow_sin", "dow_cos", "crime_count", "violent_share", "arrest_rate",
                    "cell_total_count", "neighbor_count_mean", "risk_score", "base_value", "risk_raw"]


def rsel(cols, dbl_cols=None, src="") -> str:
    """select list rounding the named double columns to 6 places."""
    dbl_cols = set(dbl_cols or [])
    return ", ".join(f"round({src}{c}, 6) as {c}" if c in dbl_cols else f"{src}{c}" for c in cols)


GRID_DOUBLES = ["lat_r", "lon_r", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "crime_count",
                "violent_share", "arrest_rate", "cell_total_count", "neighbor_count_mean",
                "risk_score", "base_value", "risk_raw"]
oracle("hourly_grid", HOURLY_GRID_CTES + f"\nselect {rsel(HOURLY_GRID_COLS, GRID_DOUBLES)} from grid")


# ---------------------------------------------------------------------------
# 2.3 projections, filters, predicates
# ---------------------------------------------------------------------------
H = oracle_with("inc_hourly")
MM = oracle_with("inc_monthly")


def in_box_sql(lat="lat", lon="lon", lat_max=P.LAT_MAX) -> str:
    return (f"coalesce({lat} between {dbl(P.LAT_MIN)} and {dbl(lat_max)} and "
            f"{lon} between {dbl(P.LON_MIN)} and {dbl(P.LON_MAX)}, false)")


def strict_bool(x):
    return f"coalesce(lower({strip(x)}) = 'true', false)"


def lenient_bool(x):
    return f"coalesce(lower({strip(x)}) in ('true', '1', 'yes', 't'), false)"


oracle("bool_parse", H + f"""select id,
  cast({strict_bool('arrest_str')} as int) as arrest_strict,
  cast({lenient_bool('arrest_str')} as int) as arrest_lenient,
  cast({strict_bool('domestic_str')} as int) as domestic_strict,
  cast({lenient_bool('domestic_str')} as int) as domestic_lenient
from inc_hourly""")

TS_F1 = "%m/%d/%Y %I:%M:%S %p"
oracle("ts_parse", H + f""", d as (select id, case when id % 13 = 0 then 'not a date'
  else strftime(ts, '{TS_F1}') end as date_str from inc_hourly)
select id, strftime(try_strptime(date_str, '{TS_F1}'), '%Y-%m-%d %H:%M:%S') as parsed from d""")

oracle("ts_parse_fallback", H + f""", d as (select id, case when id % 3 = 0 then strftime(ts, '{TS_F1}')
  else strftime(ts, '%Y-%m-%d %H:%M:%S') end as date_str from inc_hourly)
select id, strftime(coalesce(try_strptime(date_str, '{TS_F1}'), try_cast(date_str as timestamp)),
  '%Y-%m-%d %H:%M:%S') as parsed from d""")

oracle("bbox_predicate", H + f"""select id, cast({in_box_sql()} as int) as in_box,
  cast({in_box_sql(lat_max=P.LAT_MAX_MONTHLY)} as int) as in_box_monthly from inc_hourly""")

oracle("outlier_coords_nulled", H + f""", o as (select *, lat * 1e5 as x_coord, lon * 1e5 as y_coord,
  (lat is not null and lon is not null and not {in_box_sql(lat_max=P.LAT_MAX_MONTHLY)}) as outl from inc_hourly)
select id, round(case when outl then null else lat end, 6) as lat, round(case when outl then null else lon end, 6) as lon,
  round(case when outl then null else x_coord end, 6) as x_coord,
  round(case when outl then null else y_coord end, 6) as y_coord,
  cast((case when outl then null else lat end) is null as int) as coord_missing from o""")

oracle("missing_coord_flag", H + f"""select id, cast((id % 17 = 0) or lat is null or lon is null
  or not {in_box_sql(lat_max=P.LAT_MAX_MONTHLY)} as int) as coord_missing from inc_hourly""")

oracle("geocoded_dated_filter", H + f"""select id, cast(round_even(lat / 1e-2, 0) as int) as gi,
  cast(round_even(lon / 1e-2, 0) as int) as gj, {MONTH_IDX} as pidx
from inc_hourly where lat is not null and lon is not null and {in_box_sql(lat_max=P.LAT_MAX_MONTHLY)}
  and ts is not null""")

oracle("start_year_filter", MM + """select l_orderkey, l_linenumber, strftime(ts, '%Y-%m-%d') as d
from inc_monthly where year(ts) >= 1997""")

oracle("required_fields_drop", H + f""", c as (select count(*) as before,
  count(*) filter (where not (lat is not null and lon is not null and ts is not null and {in_box_sql()})) as removed,
  count(*) filter (where lat is not null and lon is not null and ts is not null and {in_box_sql()}) as after
  from inc_hourly)
select cast(before as bigint) as before, cast(removed as bigint) as removed, cast(after as bigint) as after,
  round(removed * 1e2 / before, 6) as pct_removed from c""")

oracle("partial_period_filter", MM + f""", a as (select gi, gj, {MONTH_IDX} as pidx, count(*) as n
  from inc_monthly where gi is not null and gj is not null and ts is not null group by all)
select gi, gj, pidx, n from a where pidx <> (select max(pidx) from a)""")

oracle("night_subset", HOURLY_GRID_CTES + f"""
select cell_id, dow, hour from grid where hour in ({', '.join(str(h) for h in P.NIGHT_HOURS)})""")

oracle("class_flags", H + f"""select id,
  cast(coalesce(upper(trim(primary_type)) in ({sql_list(P.VIOLENT_TYPES)}), false) as int) as is_violent,
  cast(coalesce(upper(trim(primary_type)) in ({sql_list(P.VIOLENT_TYPES_MONTHLY)}), false) as int) as is_violent_ho,
  cast(coalesce(upper(trim(primary_type)) in ({sql_list(P.PROPERTY_TYPES)}), false) as int) as is_property
from inc_hourly""")

_locked = []
for c in P.FEATURE_COLUMNS:
    if c == "arrest_rate":
        _locked.append("0e0 as arrest_rate")
    elif c == "violent_share":
        _locked.append("round(coalesce(case when hour = 3 then null else violent_share end, 0e0), 6) as violent_share")
    else:
        _locked.append(f"round(coalesce(cast({c} as double), 0e0), 6) as {c}")
oracle("locked_feature_projection", HOURLY_GRID_CTES + f"\nselect cell_id, {', '.join(_locked)} from grid")

_final = ["cell_id", "dow", "hour"] + [c for c in P.FEATURE_COLUMNS if c not in ("dow", "hour")] + ["risk_score"]
oracle("features_labels", HOURLY_GRID_CTES + f"\nselect {rsel(_final, GRID_DOUBLES)} from grid")

oracle("region_validation", H + f"""select id as idx, printf('points[%d]: (lat=%s, lon=%s) outside the model region (lat %s..%s, lon %s..%s)',
  id, cast(lat as varchar), cast(lon as varchar), '{P.LAT_MIN}', '{P.LAT_MAX}', '{P.LON_MIN}', '{P.LON_MAX}') as error
from inc_hourly where lat is not null and not {in_box_sql()}""")

# ---------------------------------------------------------------------------
# 2.9 text
# ---------------------------------------------------------------------------
_doc_norm = norm_text("replace(text, 'ß', 'ss')")
oracle("text_normalise", f"""select doc_id, sha256({_doc_norm}) as norm_sha, length({_doc_norm}) as norm_len
from documents""")

_loc = norm_text("location_description")
_alias_case = "case " + " ".join(f"when {_loc} = '{a}' then '{b}'" for a, b in P.PLACE_ALIASES) + f" else {_loc} end"
oracle("place_alias_replace", H + f"select id, {_alias_case} as location_clean from inc_hourly")

oracle("code_hygiene", H + f"""select id, nullif({strip('upper(iucr)')}, 'NAN') as iucr,
  {norm_text('description')} as description, {norm_text('primary_type')} as primary_type from inc_hourly""")

_t = strip("upper(s.primary_type)")
_d = strip(f"upper({norm_text('s.description')})")
oracle("severity_layered", H + f""", {severity_cte('inc_hourly', _t, _d)}
select s.id, {keyword_adjust_sql(_d.replace('s.', ''))} as adj,
  {keyword_adjust_sql(_d.replace('s.', ''), 'false')} as adj_no_weapon,
  an.a_sev as anchor, bs.b_sev as base, s.severity, s.sev_layer
from sev s
left join {ANCHOR_VALUES} an on an.a_type = {_t} and an.a_desc = {_d}
left join {BASE_VALUES} bs on bs.b_type = {_t}""")

oracle("severity_tier_modifier", H + f"""select id, {tier_case('upper(trim(primary_type))')} as sev_base,
  round({mult_case('description')}, 6) as mult,
  round({tier_case('upper(trim(primary_type))')} * {mult_case('description')}, 6) as severity from inc_hourly""")

# ---------------------------------------------------------------------------
# 2.10 time
# ---------------------------------------------------------------------------
def _cyc(v, p):
    return f"round(sin(2 * pi() * {v} / {dbl(p)}), 6)", f"round(cos(2 * pi() * {v} / {dbl(p)}), 6)"


_hg = ("case when hour(ts) > -1 and hour(ts) <= 5 then '00-05' when hour(ts) > 5 and hour(ts) <= 11 then '06-11' "
       "when hour(ts) > 11 and hour(ts) <= 17 then '12-17' when hour(ts) > 17 and hour(ts) <= 23 then '18-23' end")
oracle("time_parts", H + f"""select id, cast(year(ts) as int) as year, cast(month(ts) as int) as month,
  cast(day(ts) as int) as day, cast(isodow(ts) - 1 as int) as dow, cast(hour(ts) as int) as hour,
  cast(dayofyear(ts) as int) as doy, strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%Y-%m') as period_str,
  strftime(ts, '%Y-%m') || '-01' as period_start, cast(floor((month(ts) - 1) / 3) + 1 as int) as quarter,
  cast(hour(ts) >= 22 or hour(ts) < 5 as int) as is_night, cast(isodow(ts) - 1 >= 5 as int) as is_weekend,
  {_cyc('hour(ts)', 24)[0]} as hour_sin, {_cyc('hour(ts)', 24)[1]} as hour_cos,
  {_cyc('(isodow(ts) - 1)', 7)[0]} as dow_sin, {_cyc('(isodow(ts) - 1)', 7)[1]} as dow_cos,
  {_cyc('month(ts)', 12)[0]} as month_sin, {_cyc('month(ts)', 12)[1]} as month_cos,
  cast((isodow(ts) - 1) * 24 + hour(ts) as int) as slot, {_hg} as hour_group
from inc_hourly""")

oracle("age_days", HOURLY_CLEAN_CTES + f"""
select id, round(age_days, 6) as age_days, round(w_time, 6) as w_time,
  round(pow(0.5e0, age_days / 180e0), 6) as w_180, round(severity, 6) as severity,
  round(event_value, 6) as event_value from ev2""")

# ---------------------------------------------------------------------------
# 2.11 math, space, scores
# ---------------------------------------------------------------------------
oracle("grid_cell_id", H + """, g as (select id, lat, lon, round_even(lat * 1e2, 0) / 1e2 as lat_r,
  round_even(lon * 1e2, 0) / 1e2 as lon_r from inc_hourly where lat is not null)
select id, round(lat_r, 6) as lat_r, round(lon_r, 6) as lon_r, cast(lat_r as varchar) || '_' || cast(lon_r as varchar) as cell_id,
  cast(round_even(lat_r / 1e-2, 0) as int) as gx, cast(round_even(lon_r / 1e-2, 0) as int) as gy,
  cast(round_even(lat / 1e-2, 0) as int) as gi_raw, cast(round_even(lon / 1e-2, 0) as int) as gj_raw from g""")

_hv = HAVERSINE.replace("a.lat_r", "41.8781e0").replace("a.lon_r", "-87.6298e0") \
               .replace("b.lat_r", "lat").replace("b.lon_r", "lon")
oracle("haversine_gaussian", H + f""", d as (select id, {_hv} as d_km from inc_hourly where lat is not null and lat <> 0)
select id, round(d_km, 6) as d_km, round(exp(-(d_km * d_km) / (2e0 * 0.7e0 * 0.7e0)), 6) as w,
  round(exp(-(d_km * d_km) / 2e0), 6) as w_sigma1 from d""")


def _level(s):
    c = f"greatest(0e0, least(1e2, {s}))"
    return (f"case when {c} < 25 then 'Low' when {c} < 50 then 'Medium' when {c} < 75 then 'High' "
            f"else 'Very High' end")


def _tier_rc(s):
    return (f"case when {s} > -0.01 and {s} <= 50 then 'LOW' when {s} > 50 and {s} <= 80 then 'MEDIUM' "
            f"when {s} > 80 and {s} <= 95 then 'HIGH' when {s} > 95 and {s} <= 100.01 then 'VERY HIGH' end")


oracle("score_functions", HOURLY_GRID_CTES + f"""
select cell_id, dow, hour,
  round(1e2 * pow(least(greatest(risk_raw, 0e0), 5e0) / 5e0, 0.5e0), 6) as score_sqrt,
  round(1e2 * pow(least(greatest(risk_raw, 0e0), 5e0) / 5e0, 1e0), 6) as score_linear,
  0e0 as score_zero_clip, {_tier_rc('risk_score')} as tier, {_level('risk_score')} as level,
  round(greatest(0e0, least(1e2, risk_score * 1.3e0 - 20e0)), 6) as clamped
from grid""")


# ---------------------------------------------------------------------------
# monthly panel
# ---------------------------------------------------------------------------
MONTHLY_FEAT = MM + f""", mf as (select *, {MONTH_IDX} as pidx, upper(trim(primary_type)) as t,
  cast(coalesce(upper(trim(primary_type)) in ({sql_list(P.VIOLENT_TYPES_MONTHLY)}), false) as int) as is_violent,
  cast(coalesce(upper(trim(primary_type)) in ({sql_list(P.PROPERTY_TYPES)}), false) as int) as is_property,
  cast({lenient_bool('cast(arrest_flag as varchar)')} as int) as arrest_b,
  cast({lenient_bool('cast(domestic_flag as varchar)')} as int) as domestic_b,
  cast(hour(ts) >= 22 or hour(ts) < 5 as int) as is_night, cast(isodow(ts) - 1 >= 5 as int) as is_weekend
  from inc_monthly where gi is not null and gj is not null and ts is not null),
agg as (select gi, gj, pidx, count(*) as n_crimes, cast(sum(is_violent) as bigint) as n_violent,
  cast(sum(is_property) as bigint) as n_property, cast(sum(arrest_b) as bigint) as n_arrest,
  cast(sum(domestic_b) as bigint) as n_domestic, count(distinct t) as n_types,
  cast(sum(is_night) as bigint) as night, cast(sum(is_weekend) as bigint) as weekend
  from mf group by all),
agg2 as (select *, n_arrest / n_crimes as arrest_rate, n_domestic / n_crimes as domestic_rate,
  night / n_crimes as share_night, weekend / n_crimes as share_weekend from agg)"""

_roll = lambda k: (f"case when count(n_crimes) over (w rows between {k} preceding and 1 preceding) = {k} "
                   f"then avg(n_crimes) over (w rows between {k} preceding and 1 preceding) end")
PANEL_CTES = MONTHLY_FEAT + f""",
cells as (select distinct gi, gj from agg2), periods as (select distinct pidx from agg2),
y0 as (select min(floor(pidx / 12)) as y0 from agg2),
pn as (select c.gi, c.gj, p.pidx,
  coalesce(a.n_crimes, 0) as n_crimes, coalesce(a.n_violent, 0) as n_violent, coalesce(a.n_property, 0) as n_property,
  coalesce(a.n_arrest, 0) as n_arrest, coalesce(a.n_domestic, 0) as n_domestic, coalesce(a.n_types, 0) as n_types,
  coalesce(a.arrest_rate, 0e0) as arrest_rate, coalesce(a.domestic_rate, 0e0) as domestic_rate,
  coalesce(a.share_night, 0e0) as share_night, coalesce(a.share_weekend, 0e0) as share_weekend
  from cells c cross join periods p left join agg2 a on a.gi = c.gi and a.gj = c.gj and a.pidx = p.pidx),
pf as (select pn.*, gi * 1e-2 as glat, gj * 1e-2 as glon, {period_text('pidx')} as period_str,
  cast(floor(pidx / 12) - y0.y0 as int) as year_idx, cast(pidx % 12 + 1 as int) as pmonth,
  cast(floor((pidx % 12) / 3) + 1 as int) as pquarter,
  sin(2 * pi() * (pidx % 12 + 1) / 12e0) as pmonth_sin, cos(2 * pi() * (pidx % 12 + 1) / 12e0) as pmonth_cos,
  cast(lag(n_crimes, 1) over w as double) as lag_1, cast(lag(n_crimes, 3) over w as double) as lag_3,
  cast(lag(n_crimes, 12) over w as double) as lag_12,
  {_roll(3)} as roll3_mean, {_roll(6)} as roll6_mean, {_roll(12)} as roll12_mean,
  avg(n_crimes) over (w rows between unbounded preceding and 1 preceding) as cell_hist_mean,
  cast(lag(n_violent, 1) over w as double) as n_violent_lag1, lag(arrest_rate, 1) over w as arrest_rate_lag1,
  lag(domestic_rate, 1) over w as domestic_rate_lag1, lag(share_night, 1) over w as share_night_lag1,
  lag(share_weekend, 1) over w as share_weekend_lag1
  from pn, y0 window w as (partition by gi, gj order by pidx)),
nbm as (select a.gi, a.gj, a.pidx, avg(b.lag_1) as nb from pf a join pf b on b.pidx = a.pidx
  and abs(b.gi - a.gi) <= 1 and abs(b.gj - a.gj) <= 1 and not (b.gi = a.gi and b.gj = a.gj)
  and b.lag_1 is not null group by all),
panel as (select pf.*, roll3_mean - roll12_mean as trend_3_12, nbm.nb as neighbor_lag1_mean
  from pf left join nbm on nbm.gi = pf.gi and nbm.gj = pf.gj and nbm.pidx = pf.pidx)"""

_feat_fill = set(P.FEATURE_COLUMNS_MONTHLY)
_panel_dbl = {"arrest_rate", "domestic_rate", "share_night", "share_weekend", "glat", "glon", "pmonth_sin",
              "pmonth_cos", "lag_1", "lag_3", "lag_12", "roll3_mean", "roll6_mean", "roll12_mean",
              "cell_hist_mean", "trend_3_12", "n_violent_lag1", "arrest_rate_lag1", "domestic_rate_lag1",
              "neighbor_lag1_mean", "share_night_lag1", "share_weekend_lag1"}
PANEL_COLS = ["gi", "gj", "period_str", "n_crimes", "n_violent", "n_property", "n_arrest", "n_domestic",
              "n_types", "arrest_rate", "domestic_rate", "share_night", "share_weekend", "glat", "glon",
              "year_idx", "pmonth", "pquarter", "pmonth_sin", "pmonth_cos", "lag_1", "lag_3", "lag_12",
              "roll3_mean", "roll6_mean", "roll12_mean", "cell_hist_mean", "trend_3_12", "n_violent_lag1",
              "arrest_rate_lag1", "domestic_rate_lag1", "neighbor_lag1_mean", "share_night_lag1",
              "share_weekend_lag1"]


def _panel_expr(c):
    e = c
    if c in _feat_fill and c in _panel_dbl:
        e = f"coalesce({c}, 0e0)"
    return f"round({e}, 6) as {c}" if c in _panel_dbl else c


PANEL_SELECT = ", ".join(_panel_expr(c) for c in PANEL_COLS)
oracle("gridmonth_panel", PANEL_CTES + f"\nselect {PANEL_SELECT} from panel")

oracle("grid_month_aggregate", MONTHLY_FEAT + f"""
select gi, gj, {period_text('pidx')} as period_str, n_crimes, n_violent, n_property, n_arrest, n_domestic, n_types,
  night, weekend, round(arrest_rate, 6) as arrest_rate, round(domestic_rate, 6) as domestic_rate,
  round(share_night, 6) as share_night, round(share_weekend, 6) as share_weekend from agg2""")

oracle("harm_table", MM + f""", f as (select gi, gj, {MONTH_IDX} as pidx,
  {tier_case("upper(trim(primary_type))")} * {mult_case("description")} as severity
  from inc_monthly where gi is not null and gj is not null and ts is not null)
select gi, gj, {period_text('pidx')} as period_str, round(sum(severity), 6) as harm, count(*) as n_inc,
  round(avg(severity), 6) as sev_mean from f group by gi, gj, pidx""")

_lab_sql = MONTHLY_SCORE_SQL.split("with inc_monthly as", 1)[1]
PANEL_SELECT_Q = ", ".join(_panel_expr(c).replace(c, "panel." + c, 1) if c not in _panel_dbl
                           else _panel_expr(c).replace(f"({c}", f"(panel.{c}", 1) for c in PANEL_COLS)
oracle("training_table", PANEL_CTES + ", lab0 as (with inc_monthly as" + _lab_sql + ")\nselect "
       + PANEL_SELECT_Q
       + ", lab0.risk_score, lab0.risk_tier, lab0.harm, lab0.harm_temporal, lab0.harm_spatial, lab0.risk_raw,"
         " lab0.is_partial_period from panel left join lab0 on lab0.gi = panel.gi and lab0.gj = panel.gj"
         " and lab0.period_str = panel.period_str")

# ---------------------------------------------------------------------------
# 2.5 aggregations / profiles
# ---------------------------------------------------------------------------
_mp_cols = ["lat", "lon", "ts", "location_description", "description", "value"]
oracle("missing_profile", H + ", " + "m as (" + " union all ".join(
    f"select '{c}' as column, count(*) filter (where {c} is null) as n_missing, count(*) as n from inc_hourly"
    for c in _mp_cols) + """)
select "column", cast(n_missing as bigint) as n_missing, round(n_missing * 1e2 / n, 6) as pct_missing
from m where n_missing > 0""")

oracle("missing_by_group", H + " " + " union all ".join(
    f"select event_type, '{c}' as column, round(avg(cast({c} is null as double)) * 1e2, 6) as pct_missing "
    f"from inc_hourly group by event_type" for c in ["lat", "lon", "location_description"]))

_cm = [("lat", "lon"), ("lat", "location_description"), ("lon", "location_description")]
oracle("co_missing", H + " " + " union all ".join(
    f"select '{a}&{b}' as pair, cast(count(*) filter (where {a} is null and {b} is null) as bigint) as n_both_missing "
    f"from inc_hourly" for a, b in _cm))

oracle("null_rate_by_category", H + """
(select primary_type as category, count(*) as n, round(avg(cast(location_description is null as double)) * 1e2, 6) as pct_null,
  'type' as by from inc_hourly group by 1 having count(*) >= 500 order by pct_null desc, category asc nulls first limit 15)
union all
(select description as category, count(*) as n, round(avg(cast(lat is null as double)) * 1e2, 6) as pct_null,
  'description' as by from inc_hourly group by 1 having count(*) >= 1000 order by pct_null desc, category asc nulls first limit 15)""")

_mcols = "l_orderkey, l_linenumber, gi, gj, ts, l_returnflag, l_quantity, l_extendedprice, primary_type, description, arrest_flag, domestic_flag"
oracle("key_uniqueness", MM + f""", g as (select {_mcols}, count(*) as c from inc_monthly group by all),
k as (select cast(sum(c) as bigint) as n_rows, count(distinct (l_orderkey, l_linenumber)) as n_distinct_keys,
  cast(sum(case when c > 1 then c - 1 else 0 end) as bigint) as full_row_dups from g)
select n_rows, n_distinct_keys, n_rows - n_distinct_keys as dup_keys, full_row_dups,
  cast(n_rows = n_distinct_keys as int) as is_unique from k""")

oracle("rows_per_key_histogram", MM + """, k as (select l_orderkey, l_linenumber, count(*) as rows_per_key
  from inc_monthly group by all) select rows_per_key, count(*) as n_keys from k group by 1""")

oracle("codes_per_duplicated_key", MM + """, k as (select l_orderkey, l_linenumber, count(*) as n,
  count(distinct l_returnflag) as codes from inc_monthly group by all having count(*) > 1)
select count(*) as dup_keys, count(*) filter (where codes = 1) as same_code,
  count(*) filter (where codes > 1) as different_code from k""")

oracle("duplicated_key_rows", MM + """, d as (select l_orderkey, l_linenumber from inc_monthly group by all having count(*) > 1)
select m.l_orderkey, m.l_linenumber, m.gi, m.gj, m.l_returnflag, round(m.l_quantity, 6) as l_quantity
from inc_monthly m semi join d on d.l_orderkey = m.l_orderkey and d.l_linenumber = m.l_linenumber""")

oracle("category_repetition", H + """, k as (select case_number, count(*) as n from inc_hourly
  where primary_type = 'THEFT' group by 1)
select cast(sum(n) as bigint) as rows, count(*) as distinct_keys, count(*) filter (where n > 1) as keys_repeated from k""")

oracle("consistency_counts", H + """, c as (select *, case when id % 11 = 0 then yr + 1 else yr end as year_col,
  case when id % 7 = 0 then ts - interval 1 day else ts + interval 1 day end as updated from inc_hourly)
select count(*) filter (where year_col <> year(ts)) as year_mismatch,
  count(*) filter (where ts > updated) as date_after_updated, count(*) filter (where ts is null) as null_dates from c""")

_canon_ctes = H + f""", cnt as (select iucr, yr, primary_type, count(*) as n from inc_hourly where iucr is not null group by all),
lasty as (select iucr, max(yr) as ly from cnt group by all),
rec as (select cnt.iucr, primary_type, sum(n) as n from cnt join lasty on cnt.iucr = lasty.iucr and cnt.yr = lasty.ly
  where primary_type is not null group by all),
cm as (select iucr, primary_type as canon from (
  select *, row_number() over (partition by iucr order by n desc, primary_type asc) as rk from rec) where rk = 1),
c1 as (select h.*, {strip('upper(coalesce(cm.canon, h.primary_type))')} as ptc from inc_hourly h left join cm on cm.iucr = h.iucr)"""
oracle("taxonomy_conflicts", _canon_ctes + """
select count(*) filter (where k > 1) as n_conflicts, 'before' as stage from (
  select iucr, count(distinct primary_type) as k from inc_hourly where iucr is not null group by 1)
union all
select count(*) filter (where k > 1), 'after' from (select iucr, count(distinct ptc) as k from c1 where iucr is not null group by 1)
union all
select count(*) filter (where ptc <> upper(trim(primary_type))), 'rows_relabelled' from c1""")

oracle("top_labels_per_code", H + """, c as (select iucr, primary_type, count(*) as n from inc_hourly where iucr is not null group by all),
k as (select iucr from c group by 1 having count(*) > 1),
r as (select c.*, row_number() over (partition by c.iucr order by n desc, primary_type asc) as rank
  from c semi join k on k.iucr = c.iucr)
select iucr, primary_type, n, cast(rank as int) as rank from r where rank <= 3""")

oracle("canonical_labels", _canon_ctes + "\nselect iucr, canon from cm")

oracle("incident_table_layout", _canon_ctes + f""", g as (select c1.*, not coalesce(lat is not null and lon is not null
  and {in_box_sql(lat_max=P.LAT_MAX_MONTHLY)}, false) as miss, upper(trim(primary_type)) as ty from c1),
g2 as (select *, case when not miss then cast(round_even(lat / 1e-2, 0) as int) end as gi,
  case when not miss then cast(round_even(lon / 1e-2, 0) as int) end as gj from g)
select strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, strftime(ts, '%Y-%m') as period_str, cast(year(ts) as int) as year,
  cast(month(ts) as int) as month, cast(hour(ts) as int) as hour, cast(isodow(ts) - 1 as int) as dow, primary_type,
  ptc as primary_type_canon, description, location_description, cast({lenient_bool('arrest_str')} as int) as arrest_b,
  cast({lenient_bool('domestic_str')} as int) as domestic_b, round(lat, 6) as lat, round(lon, 6) as lon,
  cast(miss as int) as coord_missing, cast(gi as double) as gi, cast(gj as double) as gj, round(gi * 1e-2, 6) as glat, round(gj * 1e-2, 6) as glon,
  cast(hour(ts) >= 22 or hour(ts) < 5 as int) as is_night, cast(isodow(ts) - 1 >= 5 as int) as is_weekend,
  cast(coalesce(ty in ({sql_list(P.VIOLENT_TYPES_MONTHLY)}), false) as int) as is_violent,
  cast(coalesce(ty in ({sql_list(P.PROPERTY_TYPES)}), false) as int) as is_property from g2""")

oracle("label_span", MM + """select primary_type, cast(min(year(ts)) as int) as first_year,
  cast(max(year(ts)) as int) as last_year, count(*) as n from inc_monthly group by 1""")

_desc = lambda c: (f"count({c}) as {c}_count, round(avg({c}), 6) as {c}_mean, round(stddev_samp({c}), 6) as {c}_std, "
                   f"round(min({c}), 6) as {c}_min, round(quantile_cont({c}, 0.25), 6) as {c}_p25, "
                   f"round(quantile_cont({c}, 0.5), 6) as {c}_p50, round(quantile_cont({c}, 0.75), 6) as {c}_p75, "
                   f"round(max({c}), 6) as {c}_max")
oracle("spatial_outliers", H + f"""select
  count(*) filter (where lat is not null and lon is not null and not ({in_box_sql()})) as n_out_of_box,
  count(*) filter (where lat is not null and lon is not null and abs(lat) < 1 and abs(lon) < 1) as n_near_zero,
  {_desc('lat')}, {_desc('lon')} from inc_hourly""")

oracle("grid_density", MM + """, p as (select gi, gj, count(*) as n from inc_monthly where gi is not null and gj is not null
  and ts is not null group by all)
select count(*) as cells, round(avg(n), 6) as mean, round(stddev_samp(n), 6) as std, min(n) as min,
  round(quantile_cont(n, 0.25), 6) as p25, round(quantile_cont(n, 0.5), 6) as p50, round(quantile_cont(n, 0.75), 6) as p75,
  max(n) as max, round(skewness(n), 6) as skew from p""")

oracle("cell_size_comparison", H + """, e as (select s.size, cast(floor(lat / s.size) as bigint) * 100000
  + cast(floor(lon / s.size) as bigint) as cell from inc_hourly,
  (select unnest([0.02e0, 0.01e0, 0.005e0]) as size) s where lat is not null),
p as (select size, count(*) as events, count(distinct cell) as active_cells from e group by 1)
select round(size, 6) as size, active_cells, cast(round(events / active_cells) as bigint) as events_per_cell,
  round(round(events / (active_cells * 168), 1), 6) as events_per_unit from p""")

_card_cols = ["id", "case_number", "iucr", "primary_type", "description", "location_description",
              "arrest_str", "domestic_str", "event_type"]
oracle("cardinality", H + " " + " union all ".join(
    f"select '{c}' as column, count(distinct {c}) as n_unique from inc_hourly" for c in _card_cols))

oracle("top_values", H + " " + " union all ".join(
    f"(select '{c}' as column, {c} as value, count(*) as n from inc_hourly group by 2 "
    f"order by n desc, value asc nulls first {'limit ' + str(n) if n else ''})"
    for c, n in [("primary_type", 20), ("location_description", 15), ("description", 15), ("event_type", None)]))

oracle("calendar_counts", MM + """, t as (select * from inc_monthly where ts is not null)
select 'year' as part, cast(year(ts) as int) as value, count(*) as n from t group by 2
union all select 'month', cast(month(ts) as int), count(*) from t group by 2
union all select 'dow', cast(isodow(ts) - 1 as int), count(*) from t group by 2
union all select 'hour', cast(hour(ts) as int), count(*) from t group by 2""")

oracle("hour_weekday_pivot", H + ", c as (select cast(isodow(ts) - 1 as int) as dow, hour(ts) as h, count(*) as n "
       "from inc_hourly where ts is not null group by all)\nselect d.dow, "
       + ", ".join(f"cast(coalesce(sum(n) filter (where h = {h}), 0) as bigint) as h{h:02d}" for h in range(24))
       + " from (select cast(range as int) as dow from range(7)) d left join c on c.dow = d.dow group by d.dow")

oracle("mean_per_calendar_month", """with o as (select * from orders where o_orderdate is not null),
y as (select count(distinct year(o_orderdate)) as ny from o)
select cast(month(o_orderdate) as int) as month, round(count(*) / any_value(y.ny), 6) as mean_count from o, y group by 1""")

oracle("hourly_profile_per_day", H + """, s as (select cast(isodow(ts) - 1 >= 5 as int) as is_weekend,
  cast(hour(ts) as int) as hour, cast(ts as date) as d from inc_hourly where ts is not null),
days as (select is_weekend, count(distinct d) as nd from s group by 1)
select s.is_weekend, s.hour, round(count(*) / any_value(days.nd), 6) as per_day from s
join days on days.is_weekend = s.is_weekend group by 1, 2""")

oracle("density_bins", H + """, b as (select * from inc_hourly where ts is not null and lat is not null and lon is not null),
e as (select 'year=' || cast(year(ts) as varchar) as slice, cast(floor(lat / 1e-2) as int) as bi,
  cast(floor(lon / 1e-2) as int) as bj from b
  union all select case when hour(ts) between 6 and 17 then 'half=day' else 'half=night' end,
  cast(floor(lat / 1e-2) as int), cast(floor(lon / 1e-2) as int) from b)
select slice, bi, bj, round(ln(count(*)), 6) as log_count from e group by all""")

oracle("rates_by_category", H + f"""select primary_type, count(*) as n,
  round(avg(cast({strict_bool('arrest_str')} as double)) * 100, 1) as arrest_pct,
  round(avg(cast({lenient_bool('domestic_str')} as double)) * 100, 1) as domestic_pct
from inc_hourly group by 1 order by n desc, primary_type asc nulls first limit 20""")

oracle("pair_frequency", H + """, p as (select primary_type, description, count(*) as n from inc_hourly group by all)
select p.*, (select count(*) from p) as n_groups from p order by n desc, primary_type asc nulls first,
  description asc nulls first limit 25""")

oracle("unit_aggregate", HOURLY_GRID_CTES + """
select cell_id, gx, gy, round(lat_r, 6) as lat_r, round(lon_r, 6) as lon_r, dow, hour, round(base_value, 6) as base_value,
  crime_count, round(violent_share, 6) as violent_share, round(arrest_rate, 6) as arrest_rate from unit""")

oracle("severity_diagnostics", MM + f""", s as (select upper(trim(primary_type)) as ptc,
  {tier_case('upper(trim(primary_type))')} as sev_base, {mult_case('description')} as desc_mult,
  {tier_case('upper(trim(primary_type))')} * {mult_case('description')} as severity from inc_monthly),
sh as (select avg(cast(desc_mult <> 1e0 as double)) * 1e2 as pct from s)
select ptc, round(min(sev_base), 6) as base, round(avg(severity), 6) as final_mean, round(max(severity), 6) as final_max,
  count(*) as n, round(any_value(sh.pct), 6) as pct_modified from s, sh group by 1
order by final_mean desc, ptc asc limit 12""")

oracle("severity_layer_coverage", HOURLY_CLEAN_CTES + """, t as (select count(*) as tot from ev2)
select sev_layer, count(*) as n, round(count(*) * 1e2 / any_value(t.tot), 6) as pct from ev2, t group by 1""")

oracle("decay_mass_by_year", MM + """, r as (select max(ts) as ref from inc_monthly),
a as (select year(ts) as year, datediff('microsecond', ts, r.ref) / 86400e6 as age from inc_monthly, r),
e as (select h.H, cast(year as int) as year, sum(pow(0.5e0, age / h.H)) as w from a,
  (select unnest([180e0, 365e0, 730e0]) as H) h group by all),
t as (select H, sum(w) as tw from e group by 1)
select round(e.H, 6) as H, e.year, round(e.w / t.tw * 1e2, 6) as pct from e join t on t.H = e.H""")

_lab_body = MONTHLY_SCORE_SQL
oracle("score_summary", "with lab as (" + _lab_body + """)
select count(risk_score) as n, round(avg(risk_score), 4) as mean, round(quantile_cont(risk_score, 0.5), 4) as median,
  round(skewness(risk_score), 4) as skew, round(stddev_samp(risk_score), 4) as std, round(min(risk_score), 4) as min,
  round(quantile_cont(risk_score, 0.25), 4) as p25, round(quantile_cont(risk_score, 0.75), 4) as p75,
  round(max(risk_score), 4) as max, round(corr(risk_score, harm), 4) as corr_harm,
  round(corr(risk_score, risk_raw), 4) as corr_risk_raw from lab""")

oracle("tier_counts", "with lab as (" + _lab_body + ")\nselect risk_tier, count(*) as n from lab group by 1")

_curves = {"A_linear": "1e2 * pow(least(greatest(risk_raw, 0e0), c.clip) / c.clip, 1e0)",
           "B_sqrt": "1e2 * pow(least(greatest(risk_raw, 0e0), c.clip) / c.clip, 0.5e0)",
           "C_pow035": "1e2 * pow(least(greatest(risk_raw, 0e0), c.clip) / c.clip, 0.35e0)",
           "D_log1p": "1e2 * ln(1 + least(greatest(risk_raw, 0e0), c.clip)) / ln(1 + c.clip)"}
oracle("normaliser_comparison", HOURLY_GRID_CTES + ", clipc as (select quantile_cont(risk_raw, 0.99) as clip from grid), v as ("
       + " union all ".join(f"select '{k}' as curve, {e} as v from grid, clipc c" for k, e in _curves.items())
       + """) select curve, round(quantile_cont(v, 0.5), 6) as median, round(quantile_cont(v, 0.25), 6) as q1,
  round(quantile_cont(v, 0.75), 6) as q3, round(avg(cast(v < 25 as double)) * 100, 6) as pct_lt25,
  round(avg(cast(v > 75 as double)) * 100, 6) as pct_gt75 from v group by 1""")

oracle("hotspots", "with lab as (" + _lab_body + """)
select glat, glon, round(avg(risk_score), 6) as mean_score from lab group by 1, 2
order by mean_score desc, glat asc, glon asc limit 5""")

oracle("quiet_busy_slots", HOURLY_GRID_CTES + """, q as (select 'quiet' as subset, count(*) as n,
  round(quantile_cont(risk_score, 0.5), 6) as median_score from grid where crime_count = 0 and neighbor_count_mean = 0),
b0 as (select * from grid order by crime_count desc, risk_score desc, cell_id, dow, hour
  limit (select cast(floor(0.01 * count(*)) as bigint) from grid)),
b as (select 'busiest_1pct' as subset, count(*) as n, round(quantile_cont(risk_score, 0.5), 6) as median_score from b0)
select * from q union all select * from b""")


def avg_rank_sql(src: str, col: str, out: str) -> str:
    return (f"(rank() over (order by {col}) + (count(*) over (partition by {col}) - 1) / 2e0) as {out}")


oracle("spearman_score_count", HOURLY_GRID_CTES + f""", r as (select risk_score, crime_count,
  {avg_rank_sql('grid', 'risk_score', 'rx')}, {avg_rank_sql('grid', 'crime_count', 'ry')} from grid)
select round(corr(risk_score, crime_count), 6) as pearson, round(corr(rx, ry), 6) as spearman from r""")

oracle("run_summary", H + f"""select count(*) as rows, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_ts,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_ts, count(distinct primary_type) as n_types,
  round(avg(cast(lat is null as double)) * 100, 6) as pct_missing_lat,
  round(avg(cast({strict_bool('arrest_str')} as double)) * 100, 6) as arrest_pct,
  round(avg(cast({lenient_bool('domestic_str')} as double)) * 100, 6) as domestic_pct from inc_hourly""")


oracle("run_checks", H + f""", c as (
  select 'time_present' as "check", count(*) filter (where ts is null) as seen from inc_hourly
  union all select 'code_present', count(*) filter (where iucr is null) from inc_hourly
  union all select 'type_present', count(*) filter (where primary_type is null) from inc_hourly
  union all select 'coordinates_present', count(*) filter (where lat is null or lon is null) from inc_hourly
  union all select 'coordinates_in_region', count(*) filter (where lat is not null and lon is not null and not {in_box_sql()}) from inc_hourly
  union all select 'key_unique', count(*) from (select id from inc_hourly group by id having count(*) > 1))
select "check", seen, cast(seen = 0 as int) as passed from c""")

_bounds = [0.0] + list(P.RISK_LEVEL_BOUNDS) + [100.0]
oracle("risk_level_table", HOURLY_GRID_CTES + """, lv as (select * from (values """ + ", ".join(
    f"('{lab}', {dbl(_bounds[i])}, {dbl(_bounds[i + 1])})" for i, lab in enumerate(P.RISK_LEVEL_LABELS)) + f""") v(level, min, max))
select lv.level, lv.min, lv.max, count(g.l) as n_slots from lv
left join (select {_level('risk_score')} as l from grid) g on g.l = lv.level group by all""")


# ---------------------------------------------------------------------------
# 2.12 splits, baselines (hour-of-week grid)
# ---------------------------------------------------------------------------
def md5u(seed, *cols) -> str:
    key = " || '|' || ".join([f"'{seed}'"] + [f"cast({c} as varchar)" for c in cols])
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296e0)"


PROT_CTES = HOURLY_GRID_CTES + f""",
pt as (select grid.*, case when {md5u(42, 'cell_id', 'dow', 'hour')} < 0.2 then 'test' else 'train' end as split_A,
  case when {md5u(42, 'cell_id')} < 0.2 then 'test' else 'train' end as split_B from grid),
pt2 as (select *, case when split_B = 'train' then 'train'
  when hour in ({', '.join(str(h) for h in P.NIGHT_HOURS)}) then 'test' end as split_C from pt)"""

oracle("protocol_splits", PROT_CTES + "\nselect cell_id, dow, hour, split_A, split_B, split_C from pt2")

oracle("unseen_cell_fraction", PROT_CTES + "\n" + " union all ".join(
    f"""select '{p}' as protocol,
  round(100e0 * (select count(*) from pt2 t where split_{p} = 'test' and cell_id not in
     (select cell_id from pt2 where split_{p} = 'train')) / (select count(*) from pt2 where split_{p} = 'test'), 6)
     as unseen_cell_pct,
  (select count(*) from pt2 where split_{p} = 'train') as train_rows,
  (select count(*) from pt2 where split_{p} = 'test') as test_rows""" for p in ("A", "B", "C")))

_MGRID = ", ".join(f"({i}, {dbl(m)})" for i, m in enumerate(P.SHRINKAGE_GRID))


def ladder_ctes(p: str) -> str:
    """train/test of protocol p and the four baseline predictions (long)."""
    return f""",
tr_{p} as (select * from pt2 where split_{p} = 'train'), te_{p} as (select * from pt2 where split_{p} = 'test'),
inner_{p} as (select * from tr_{p} where {md5u(43, 'cell_id', 'dow', 'hour')} >= 0.2),
val_{p} as (select * from tr_{p} where {md5u(43, 'cell_id', 'dow', 'hour')} < 0.2),
ist_{p} as (select cell_id, hour, sum(risk_score) as s, count(*) as n from inner_{p} group by all),
ipm_{p} as (select cell_id, avg(risk_score) as pm from inner_{p} group by all),
igm_{p} as (select avg(risk_score) as gm from inner_{p}),
mt_{p} as (select mg.i, mg.m, avg(abs(v.risk_score - coalesce((st.s + mg.m * pm.pm) / (st.n + mg.m), pm.pm, igm_{p}.gm)))
  as mae_val from val_{p} v cross join (select * from (values {_MGRID}) as t(i, m)) mg
  left join ist_{p} st on st.cell_id = v.cell_id and st.hour = v.hour
  left join ipm_{p} pm on pm.cell_id = v.cell_id cross join igm_{p} group by all),
bm_{p} as (select m from mt_{p} order by mae_val, i limit 1),
gm_{p} as (select avg(risk_score) as gm from tr_{p}),
cm_{p} as (select cell_id, avg(risk_score) as v from tr_{p} group by all),
hd_{p} as (select dow, hour, avg(risk_score) as v from tr_{p} group by all),
st_{p} as (select cell_id, hour, sum(risk_score) as s, count(*) as n from tr_{p} group by all),
lad_{p} as (select te.cell_id, te.dow, te.hour, te.risk_score as y, gm_{p}.gm as p_global,
  coalesce(cm.v, gm_{p}.gm) as p_cell, coalesce(hd.v, gm_{p}.gm) as p_hour_dow,
  coalesce((st.s + bm_{p}.m * cm.v) / (st.n + bm_{p}.m), cm.v, gm_{p}.gm) as p_cell_hour_shrunk
  from te_{p} te cross join gm_{p} cross join bm_{p}
  left join cm_{p} cm on cm.cell_id = te.cell_id
  left join hd_{p} hd on hd.dow = te.dow and hd.hour = te.hour
  left join st_{p} st on st.cell_id = te.cell_id and st.hour = te.hour),
long_{p} as (select cell_id, dow, hour, y, unnest(['Baseline: global mean', 'Baseline: cell mean',
  'Baseline: hour and weekday mean', 'Baseline: cell and hour, shrunk']) as predictor,
  unnest([p_global, p_cell, p_hour_dow, p_cell_hour_shrunk]) as pred from lad_{p})"""


oracle("shrinkage_m_selection", PROT_CTES + ladder_ctes("B") + """
select round(m, 6) as m, round(mae_val, 6) as mae_val, round((select m from bm_B), 6) as best_m from mt_B""")

oracle("baseline_ladder", PROT_CTES + ladder_ctes("B") + """
select cell_id, dow, hour, round(y, 6) as y, predictor, round(pred, 6) as pred from long_B""")


def metrics_sql(src: str, groups: list[str], y: str = "y", p: str = "pred", digits: int = 4) -> str:
    g = ", ".join(groups)
    part = f"partition by {g}" if groups else ""
    return f"""(select {g + ',' if g else ''} count(*) as n, round(avg(abs({y} - {p})), {digits}) as MAE,
  round(sqrt(avg(({y} - {p}) * ({y} - {p}))), {digits}) as RMSE,
  round(case when var_pop({y}) > 0 then 1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*)) end, {digits}) as R2,
  round(corr(rp, ry), {digits}) as Spearman
  from (select *, rank() over ({part} order by {p}) + (count(*) over ({part}{',' if g else 'partition by'} {p}) - 1) / 2e0 as rp,
    rank() over ({part} order by {y}) + (count(*) over ({part}{',' if g else 'partition by'} {y}) - 1) / 2e0 as ry
    from {src}) {'group by ' + g if g else ''})"""


_allp = " union all ".join(f"select '{p}' as protocol, * from long_{p}" for p in ("A", "B", "C"))
oracle("baseline_comparison", PROT_CTES + ladder_ctes("A") + ladder_ctes("B") + ladder_ctes("C") + f""",
allp as (select *, 'baseline' as predictor_type from ({_allp})),
mt as {metrics_sql('allp', ['protocol', 'predictor', 'predictor_type'], digits=12)},
best as (select protocol, min(MAE) as b from mt where predictor_type = 'baseline' group by 1)
select mt.protocol, mt.predictor, mt.predictor_type, mt.n, round(mt.MAE, 4) as MAE, round(mt.RMSE, 4) as RMSE,
  round(mt.R2, 4) as R2, round(mt.Spearman, 4) as Spearman,
  round((1 - mt.MAE / best.b) * 100, 4) as improvement_vs_strongest_baseline_pct
from mt left join best on best.protocol = mt.protocol""")

oracle("target_encoding", PROT_CTES + """, tr as (select * from pt2 where split_B = 'train'),
g as (select avg(risk_score) as g from tr)
select cell_id, round((sum(risk_score) + 10e0 * any_value(g.g)) / (count(*) + 10e0), 6) as cell_risk_mean,
  round(any_value(g.g), 6) as global_mean from tr, g group by cell_id""")


def qcut_sql(x: str, src: str, labels) -> str:
    lab = "[" + ", ".join(f"'{l}'" for l in labels) + "]"
    return f"""(select *, {lab}[1 + len(list_filter(e[2:len(e) - 1], lambda v: {x} > v))] as quantile
  from {src}, (select list_sort(list_distinct(quantile_cont({x}, [0e0, 0.2e0, 0.4e0, 0.6e0, 0.8e0, 1e0]))) as e
  from {src}) qe)"""


oracle("quantile_bins", HOURLY_GRID_CTES + f"\nselect cell_id, dow, hour, quantile from {qcut_sql('risk_score', 'grid', P.QUINTILE_LABELS)}")

SEG_CTES = PROT_CTES + ladder_ctes("B") + f""",
seg0 as (select cell_id, dow, hour, y, p_cell_hour_shrunk as pred_model, p_hour_dow as pred_baseline,
  abs(y - p_cell_hour_shrunk) as err_model, abs(y - p_hour_dow) as err_baseline from lad_B),
seg as {qcut_sql('y', 'seg0', P.QUINTILE_LABELS)}"""
oracle("segmented_by_quintile", SEG_CTES + """
select quantile, round(avg(err_model), 6) as err_model, round(avg(err_baseline), 6) as err_baseline,
  round((1 - avg(err_model) / avg(err_baseline)) * 100, 6) as improvement_pct from seg group by 1""")
oracle("segmented_by_hour_group", SEG_CTES + """
select case when hour > -1 and hour <= 5 then '00-05' when hour > 5 and hour <= 11 then '06-11'
  when hour > 11 and hour <= 17 then '12-17' when hour > 17 and hour <= 23 then '18-23' end as hour_group,
  round(avg(err_model), 6) as err_model, round(avg(err_baseline), 6) as err_baseline from seg group by 1""")
oracle("large_error_shares", SEG_CTES + "\nselect " + ", ".join(
    f"round(avg(cast(err_model > {t} as double)) * 100, 6) as model_gt{t}, "
    f"round(avg(cast(err_baseline > {t} as double)) * 100, 6) as baseline_gt{t}"
    for t in P.LARGE_ERROR_THRESHOLDS) + " from seg")
oracle("segmented_spearman", SEG_CTES + f""", sr as (select {avg_rank_sql('seg', 'y', 'ry')}, {avg_rank_sql('seg', 'pred_model', 'rm')},
  {avg_rank_sql('seg', 'pred_baseline', 'rb')} from seg)
select 'model' as predictor, round(corr(ry, rm), 4) as spearman from sr union all select 'baseline', round(corr(ry, rb), 4) from sr""")
oracle("worst_cells", SEG_CTES + """
select cell_id, round(avg(err_model), 6) as mean, count(*) as count from seg group by 1 having count(*) >= 10
order by mean desc, cell_id asc limit 5""")

# ---------------------------------------------------------------------------
# monthly training table protocol
# ---------------------------------------------------------------------------
_TT_TRAIN_END, _TT_VAL_END = "1995-12", "1996-12"


def _tt_expr(c):
    return f"coalesce(panel.{c}, 0e0) as {c}" if (c in _feat_fill and c in _panel_dbl) else f"panel.{c}"


TT_CTES = PANEL_CTES + ", lab0 as (with inc_monthly as" + _lab_sql + "),\ntt0 as (select " + ", ".join(
    _tt_expr(c) for c in PANEL_COLS) + """, lab0.risk_score, lab0.risk_tier, lab0.is_partial_period
  from panel left join lab0 on lab0.gi = panel.gi and lab0.gj = panel.gj and lab0.period_str = panel.period_str
  where lab0.is_partial_period = 0),
ttg as (select avg(risk_score) as gm from tt0 where period_str <= '""" + _TT_TRAIN_END + """'),
tt as (select tt0.*, coalesce(lag(risk_score, 1) over w, ttg.gm) as risk_lag_1,
  coalesce(lag(risk_score, 3) over w, ttg.gm) as risk_lag_3, coalesce(lag(risk_score, 12) over w, ttg.gm) as risk_lag_12,
  lag(risk_score, 1) over w as prev_risk from tt0, ttg window w as (partition by gi, gj order by period_str))"""

oracle("chrono_split", TT_CTES + f"""
select 'train' as split, count(*) as rows, min(period_str) as first_period, max(period_str) as last_period
  from tt where period_str <= '{_TT_TRAIN_END}'
union all select 'val', count(*), min(period_str), max(period_str) from tt
  where period_str > '{_TT_TRAIN_END}' and period_str <= '{_TT_VAL_END}'
union all select 'test', count(*), min(period_str), max(period_str) from tt where period_str > '{_TT_VAL_END}'""")

oracle("disjoint_periods", TT_CTES + f""", a as (select distinct period_str from tt where period_str <= '{_TT_TRAIN_END}'),
b as (select distinct period_str from tt where period_str > '{_TT_TRAIN_END}' and period_str <= '{_TT_VAL_END}'),
c as (select distinct period_str from tt where period_str > '{_TT_VAL_END}')
select count(*) as n, 'train&val' as pair from (select * from a intersect select * from b)
union all select count(*), 'val&test' from (select * from b intersect select * from c)
union all select count(*), 'train&test' from (select * from a intersect select * from c)""")

oracle("risk_lags", TT_CTES + """
select gi, gj, period_str, round(risk_score, 6) as risk_score, round(risk_lag_1, 6) as risk_lag_1,
  round(risk_lag_3, 6) as risk_lag_3, round(risk_lag_12, 6) as risk_lag_12 from tt""")

MB_CTES = TT_CTES + f""",
mtr as (select * from tt where period_str <= '{_TT_TRAIN_END}'), mte as (select * from tt where period_str > '{_TT_VAL_END}'),
mgm as (select avg(risk_score) as gm from mtr),
mcm as (select gi, gj, avg(risk_score) as v from mtr group by all),
mp as (select te.gi, te.gj, te.period_str, te.risk_score as y, mgm.gm as GlobalMean, coalesce(mcm.v, mgm.gm) as CellMean,
  coalesce(te.prev_risk, mgm.gm) as Persistence from mte te cross join mgm left join mcm on mcm.gi = te.gi and mcm.gj = te.gj)"""

oracle("monthly_baseline_metrics", MB_CTES + """,
ml as (select y, unnest(['GlobalMean', 'CellMean', 'Persistence']) as model, unnest([GlobalMean, CellMean, Persistence]) as pred from mp)
select * from """ + metrics_sql("ml", ["model"]))

oracle("hard_cases", MB_CTES + """,
d as (select *, abs(y - Persistence) as chg from mp),
thr as (select quantile_cont(chg, 0.75) as t from d),
vol as (select gi, gj, stddev_samp(risk_score) as sd from mtr group by all),
vthr as (select quantile_cont(sd, 0.75) as t from vol),
d2 as (select d.*, coalesce(vol.sd, 0e0) as sd from d left join vol on vol.gi = d.gi and vol.gj = d.gj),
tg as (select y, Persistence, CellMean, 'all' as subset from d2
  union all select y, Persistence, CellMean, 'large_change' from d2, thr where chg >= thr.t
  union all select y, Persistence, CellMean, 'volatile_cells' from d2, vthr where sd >= vthr.t)
select subset, count(*) as n, round(avg(abs(y - CellMean)), 4) as MAE_cellmean,
  round(avg(abs(y - Persistence)), 4) as MAE_persistence from tg group by 1""")

oracle("tier_accuracy", MB_CTES + f"""
select round(avg(cast(coalesce({_tier_rc('y')} = {_tier_rc('Persistence')}, false) as double)), 6) as tier_accuracy from mp""")

oracle("last_periods_holdout", TT_CTES + """
select distinct period_str from tt where period_str <= '1997-12' order by period_str desc limit 6""")

oracle("challenger_windows", TT_CTES + """, per as (select period_str, count(*) as n from tt group by 1),
bt as (select distinct substr(period_str, 1, 4) as batch from per where period_str > '1995-12'),
w as (select bt.batch, per.period_str, per.n, row_number() over (partition by bt.batch order by per.period_str desc) as place
  from bt join per on per.period_str <= bt.batch || '-12')
select batch, period_str, case when place <= 6 then 'holdout' else 'train' end as role, n from w""")

oracle("batch_slice_by_year", TT_CTES + """
select substr(period_str, 1, 4) as batch, count(*) as rows, count(distinct period_str) as periods from tt group by 1""")


# ---------------------------------------------------------------------------
# 2.14 drift
# ---------------------------------------------------------------------------
def psi_sql(ref: str, act: str, features: list[str], bins: int = P.PSI_BINS) -> str:
    """CTE body list computing (feature, psi) from two sources."""
    qs = "[" + ", ".join(dbl(i / bins) for i in range(bins + 1)) + "]"
    stack = lambda src: " union all ".join(
        f"select '{f}' as feature, cast({f} as double) as value from {src}" for f in features)
    return f"""rl as ({stack(ref)}), al as ({stack(act)}),
ed as (select feature, list_sort(list_distinct(quantile_cont(value, {qs}))) as e from rl group by 1),
ed2 as (select feature, len(e) - 1 as n_bins, e[2:len(e) - 1] as inner_e from ed),
rb as (select rl.feature, len(list_filter(inner_e, lambda x: rl.value >= x)) as bin from rl join ed2 on ed2.feature = rl.feature where n_bins >= 1),
ab as (select al.feature, len(list_filter(inner_e, lambda x: al.value >= x)) as bin from al join ed2 on ed2.feature = al.feature where n_bins >= 1),
rn as (select feature, count(*) as n from rl group by 1), an as (select feature, count(*) as n from al group by 1),
rc as (select feature, bin, count(*) as c from rb group by all), ac as (select feature, bin, count(*) as c from ab group by all),
sp as (select feature, unnest(range(n_bins)) as bin from ed2 where n_bins >= 1),
sh as (select sp.feature, greatest(coalesce(rc.c, 0) / greatest(rn.n, 1), 1e-6) as e,
  greatest(coalesce(ac.c, 0) / greatest(an.n, 1), 1e-6) as a from sp
  left join rc on rc.feature = sp.feature and rc.bin = sp.bin left join ac on ac.feature = sp.feature and ac.bin = sp.bin
  left join rn on rn.feature = sp.feature left join an on an.feature = sp.feature),
ps as (select feature, sum((a - e) * ln(a / e)) as psi from sh group by 1),
psi as (select ed2.feature, coalesce(ps.psi, 0e0) as psi from ed2 left join ps on ps.feature = ed2.feature)"""


oracle("psi_events", H + f""", hv as (select value, k, hour(ts) as hour, day(ts) as day from inc_hourly),
href as (select * from hv where day <= 15), hact as (select * from hv where day > 15),
{psi_sql('href', 'hact', ['value', 'k', 'hour'])}
select feature, round(psi, 6) as psi from psi""")

_DRIFT_FEATS = [f for f in P.FEATURE_COLUMNS_MONTHLY + P.RISK_LAG_COLUMNS if f not in P.DRIFT_EXCLUDE]
_forder = "[" + ", ".join(f"'{f}'" for f in _DRIFT_FEATS) + "]"


def drift_profile_ctes() -> str:
    """(batch, feature) PSI against one reference, every batch in one pass."""
    qs = "[" + ", ".join(dbl(i / P.PSI_BINS) for i in range(P.PSI_BINS + 1)) + "]"
    rl = " union all ".join(f"select '{f}' as feature, cast({f} as double) as value from dref" for f in _DRIFT_FEATS)
    al = " union all ".join(f"select substr(period_str, 1, 4) as batch, '{f}' as feature, cast({f} as double) as value "
                            f"from tt where period_str > '{_TT_TRAIN_END}'" for f in _DRIFT_FEATS)
    return f"""drl as ({rl}), dal as ({al}),
ded as (select feature, list_sort(list_distinct(quantile_cont(value, {qs}))) as e from drl group by 1),
ded2 as (select feature, len(e) - 1 as n_bins, e[2:len(e) - 1] as inner_e from ded),
drb as (select drl.feature, len(list_filter(inner_e, lambda x: drl.value >= x)) as bin from drl join ded2 using (feature) where n_bins >= 1),
dab as (select dal.batch, dal.feature, len(list_filter(inner_e, lambda x: dal.value >= x)) as bin from dal join ded2 using (feature) where n_bins >= 1),
drn as (select feature, count(*) as n from drl group by 1), dan as (select batch, feature, count(*) as n from dal group by all),
drc as (select feature, bin, count(*) as c from drb group by all), dac as (select batch, feature, bin, count(*) as c from dab group by all),
dbt as (select distinct batch from dal),
dsp as (select dbt.batch, ded2.feature, unnest(range(n_bins)) as bin from ded2, dbt where n_bins >= 1),
dsh as (select dsp.batch, dsp.feature, greatest(coalesce(drc.c, 0) / greatest(drn.n, 1), 1e-6) as e,
  greatest(coalesce(dac.c, 0) / greatest(dan.n, 1), 1e-6) as a from dsp
  left join drc on drc.feature = dsp.feature and drc.bin = dsp.bin
  left join dac on dac.batch = dsp.batch and dac.feature = dsp.feature and dac.bin = dsp.bin
  left join drn on drn.feature = dsp.feature left join dan on dan.batch = dsp.batch and dan.feature = dsp.feature),
dps as (select batch, feature, sum((a - e) * ln(a / e)) as psi from dsh group by all),
dpsi as (select dbt.batch, ded2.feature, coalesce(dps.psi, 0e0) as psi from ded2 cross join dbt
  left join dps on dps.feature = ded2.feature and dps.batch = dbt.batch),
prof as (select batch, max(psi) as psi_max, avg(psi) as psi_mean,
  array_to_string(list(feature || '=' || printf('%.2f', psi) order by psi desc, list_position({_forder}, feature))[1:3], ', ')
  as top_drift from dpsi group by batch)"""


DRIFT_CTES = TT_CTES + f""", dref as (select * from tt where period_str <= '{_TT_TRAIN_END}'),
{drift_profile_ctes()}"""

oracle("drift_profile", DRIFT_CTES + """
select batch, round(psi_max, 4) as psi_max, round(psi_mean, 4) as psi_mean, top_drift from prof""")

oracle("drift_decision", DRIFT_CTES + f""",
dtr as (select * from tt where period_str <= '{_TT_TRAIN_END}'), dgm as (select avg(risk_score) as gm from dtr),
dcm as (select gi, gj, avg(risk_score) as v from dtr group by all),
dp as (select t.*, coalesce(dcm.v, dgm.gm) as p from tt t cross join dgm left join dcm on dcm.gi = t.gi and dcm.gj = t.gj),
refm as (select avg(abs(risk_score - p)) as ref_mae from dp where period_str <= '{_TT_TRAIN_END}'),
mon as (select substr(period_str, 1, 4) as batch, avg(abs(risk_score - p)) as mae from dp group by 1)
select prof.batch, round(psi_max, 4) as psi_max, round(mon.mae, 4) as MAE_batch, round(refm.ref_mae, 4) as ref_mae,
  cast(psi_max >= {dbl(P.PSI_THRESHOLD)} or coalesce(mon.mae >= {dbl(1 + P.DEGRADE_TOL)} * refm.ref_mae, false) as int)
  as drift_detected from prof left join mon on mon.batch = prof.batch cross join refm""")


# ---------------------------------------------------------------------------
# 2.4 radius join, serving, zones
# ---------------------------------------------------------------------------
oracle("radius_pairs", HOURLY_GRID_CTES + """
select p.cell_id, p.nbr, round(p.d_km, 6) as d_km, round(w.w, 6) as w from pairs p
join pw w on w.cell_id = p.cell_id and w.nbr = p.nbr""")

REQ_CTES = f""", req as (select id as idx, lat, lon,
  case when id % 5 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
       when id % 3 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+07:00'
       when id % 11 = 0 then strftime(ts, '%Y-%m-%d')
       when id % 13 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || ' America/New_York'
       when id % 17 = 0 then year(ts) || '-13-40'
       when id % 19 = 0 then '2025-03-09T02:30:00'
       when id % 23 = 0 then '2025-11-02T01:30:00'
       else strftime(ts, '%Y-%m-%dT%H:%M:%S') end as datetime from inc_hourly where lat is not null and lat <> 0),
rq0 as (select *, case when datetime like '%America%' or datetime like '%-13-40' then 'unparsable'
  when datetime = '2025-03-09T02:30:00' then 'dst_gap' when datetime = '2025-11-02T01:30:00' then 'dst_ambiguous' end as time_error from req),
rqa as (select *, case when time_error is not null then null
  when id5 then cast(timezone('{P.REGION_TIMEZONE}', cast(datetime as timestamptz)) as timestamp)
  else cast(datetime as timestamp) end as local_ts from (select *, (datetime like '%Z' or datetime like '%+07:00') as id5 from rq0)),
rqe as (select *, coalesce(time_error, case when not coalesce({in_box_sql()}, false) then 'outside_region' end) as error from rqa),
rq as (select * from rqe where error is null)"""

oracle("zone_resolution", H + REQ_CTES + """
select idx, datetime, strftime(local_ts, '%Y-%m-%d %H:%M:%S') as local_ts, time_error from rqa""")

oracle("batch_rejects", H + REQ_CTES + """
select idx, error from rqe where error is not null""")

_sf_cols = ", ".join(f"round({c}, 6) as {c}" for c in P.FEATURE_COLUMNS if c not in ("hour", "dow", "is_weekend"))
oracle("serve_batch_features", HOURLY_GRID_CTES.replace(oracle_with("inc_hourly"), oracle_with("inc_hourly"), 1)
       + REQ_CTES + f""",
rf as (select rq.idx, round_even(lat * 1e2, 0) / 1e2 as lat_r, round_even(lon * 1e2, 0) / 1e2 as lon_r,
  cast(hour(local_ts) as int) as hour, cast(isodow(local_ts) - 1 as int) as dow from rq),
rf2 as (select rf.*, cast(lat_r as varchar) || '_' || cast(lon_r as varchar) as cell_id,
  cast(dow >= 5 as int) as is_weekend, sin(2 * pi() * hour / 24e0) as hour_sin, cos(2 * pi() * hour / 24e0) as hour_cos,
  sin(2 * pi() * dow / 7e0) as dow_sin, cos(2 * pi() * dow / 7e0) as dow_cos from rf),
sv as (select rf2.*, coalesce(g.crime_count, 0e0) as crime_count, coalesce(g.violent_share, 0e0) as violent_share,
  coalesce(g.arrest_rate, 0e0) as arrest_rate, coalesce(g.cell_total_count, 0e0) as cell_total_count,
  coalesce(g.neighbor_count_mean, 0e0) as neighbor_count_mean
  from rf2 left join grid g on g.cell_id = rf2.cell_id and g.dow = rf2.dow and g.hour = rf2.hour)
select idx, cell_id, hour, dow, is_weekend, {_sf_cols},
  case when cell_total_count > 0 then 'historical_data' else 'no_historical_data' end as data_coverage from sv""")


# ---------------------------------------------------------------------------
# 2.1 sources / 2.2 sinks: the files hold the view's rows, so the oracle is
# the view itself
# ---------------------------------------------------------------------------
oracle("csv_scan_declared", H + """select id, case_number, iucr, primary_type, description, location_description,
  arrest_str as arrest, domestic_str as domestic, round(lat, 6) as lat, round(lon, 6) as lon,
  round(cast(yr as double), 6) as year from inc_hourly""")

oracle("csv_profile_subset", H + """select id, strftime(ts, '%m/%d/%Y %I:%M:%S %p') as date, iucr, primary_type,
  description, round(lat, 6) as lat, round(lon, 6) as lon, round(cast(yr as double), 6) as year from inc_hourly""")

oracle("parquet_first_existing", """select l_returnflag, count(*) as n, 'lineitem.parquet' as source
from lineitem group by 1""")

oracle("csv_second_choice", H + """select iucr, count(*) as n, count(lat) as n_lat, 'csv' as source
from inc_hourly group by 1""")

oracle("recursive_lookup", "select l_returnflag, count(*) as n from lineitem group by 1")

oracle("hash_sample", H + f"select id, event_type from inc_hourly where {md5u(42, 'id')} < 0.1")

oracle("parquet_sink_roundtrip", "with lab as (" + MONTHLY_SCORE_SQL + """)
select gi, gj, period_str, n_crimes, risk_score, risk_tier from lab""")

oracle("csv_sink_roundtrip", HOURLY_GRID_CTES + """
select cell_id, dow, hour, round(crime_count, 6) as crime_count, round(risk_score, 6) as risk_score from grid""")

oracle("export_sample_sorted", HOURLY_GRID_CTES + f"""
select cell_id, dow, hour, round(risk_score, 6) as risk_score from grid
order by {md5u(42, 'cell_id', 'dow', 'hour')}, cell_id, dow, hour limit 5000""")


# ---------------------------------------------------------------------------
# 2.6-2.8 remaining
# ---------------------------------------------------------------------------
oracle("moving_avg_30", """with daily as (select cast(o_orderdate as date) as d, count(*) as n from orders group by 1)
select strftime(d, '%Y-%m-%d') as d, n, round(avg(n) over (order by d rows between 29 preceding and current row), 6) as ma30
from daily""")

oracle("group_max_per_code", H + """, mx as (select iucr, max(yr) as last_year from inc_hourly where iucr is not null group by 1)
select h.id, h.iucr, mx.last_year from inc_hourly h left join mx on mx.iucr = h.iucr""")

oracle("per_group_sample", HOURLY_GRID_CTES + f""", cmean as (select cell_id, avg(risk_score) as cell_mean from grid group by 1),
cq as {qcut_sql('cell_mean', 'cmean', ['Q1', 'Q2', 'Q3', 'Q4', 'Q5'])}
select quantile, cell_id from (select *, row_number() over (partition by quantile order by {md5u(42, 'cell_id')}, cell_id) as rn
  from cq) where rn <= 5""")

oracle("concat_dedupe_sorted", MB_CTES + """,
ml as (select y, unnest(['GlobalMean', 'CellMean', 'Persistence']) as model, unnest([GlobalMean, CellMean, Persistence]) as pred from mp),
m as """ + metrics_sql("ml", ["model"]) + """
select model, MAE, RMSE from m""")

oracle("distinct_cells_periods", MONTHLY_FEAT + """
select count(*) as n, 'cells' as what from (select distinct gi, gj from mf)
union all select count(*), 'periods' from (select distinct pidx from mf)""")

_sweep_hv = HAVERSINE.replace("a.lat_r", "lat").replace("a.lon_r", "lon").replace("b.lat_r", "lat_r").replace("b.lon_r", "lon_r")
oracle("decay_kernel_sweep", HOURLY_CLEAN_CTES + f""", sw as (select severity, age_days, {_sweep_hv} as d_km from ev2),
pg as (select * from (values {', '.join(f'({dbl(h)}, {dbl(s)})' for h in (180, 365, 730) for s in (0.5, 0.7, 1.0))}) as t(H, sigma))
select round(pg.H, 6) as H, round(pg.sigma, 6) as sigma,
  round(sum(severity * pow(0.5e0, age_days / pg.H) * exp(-(d_km * d_km) / (2e0 * pg.sigma * pg.sigma))), 6) as total_value
from sw cross join pg group by all""")


oracle("decay_scenarios", HOURLY_CLEAN_CTES + f""", sw as (select age_days, {_sweep_hv} as d_km from ev2),
pg as (select * from (values {', '.join(f'({dbl(h)}, {dbl(s)})' for h in (180, 365, 730) for s in (0.7, 1.0))}) as t(H, sigma))
select round(pg.H, 6) as H, round(pg.sigma, 6) as sigma, 100e0 as yesterday_same_cell,
  round(100e0 * pow(0.5e0, 729e0 / pg.H), 6) as two_years_same_cell,
  round(100e0 * exp(-(1.11e0 * 1.11e0) / (2e0 * pg.sigma * pg.sigma)), 6) as yesterday_next_cell, 0e0 as no_incident,
  round(100e0 * avg(pow(0.5e0, age_days / pg.H) * exp(-(d_km * d_km) / (2e0 * pg.sigma * pg.sigma))), 6) as mean_incident,
  case when pg.H = 365e0 and pg.sigma = 0.7e0 then 1 else 0 end as used
from sw cross join pg group by pg.H, pg.sigma""")

oracle("average_rank", HOURLY_GRID_CTES + """
select cell_id, dow, hour, rank() over (order by crime_count) + (count(*) over (partition by crime_count) - 1) / 2e0 as rank
from grid""")

oracle("score_anchor", HOURLY_GRID_CTES + """
select count(*) as n_rows, count(distinct cell_id) as n_cells, round(quantile_cont(risk_raw, 0.99), 6) as score_clip_value
from grid""")

oracle("label_params_record", HOURLY_GRID_CTES + f"""
select (select strftime(max(ts), '%Y-%m-%d %H:%M:%S') from ev2) as reference_date, {P.GRID_DECIMALS} as grid_decimals,
  {dbl(P.HALF_LIFE_DAYS)} as half_life_days, {dbl(P.SIGMA_KM)} as sigma_km, {dbl(P.CUTOFF_KM)} as cutoff_km,
  {dbl(P.CLIP_PERCENTILE)} as clip_percentile, round(quantile_cont(risk_raw, 0.99), 6) as score_clip_value,
  {dbl(P.SCORE_EXPONENT)} as score_exponent, count(distinct cell_id) as n_cells, count(*) as n_rows,
  '{",".join(P.FEATURE_COLUMNS)}' as feature_columns, 'risk_score' as target,
  'base_value,risk_raw' as label_ingredient_columns, 'risk_lag_1,risk_lag_3,risk_lag_12' as risk_lag_cols
from grid""")

oracle("grid_key_fingerprint", HOURLY_GRID_CTES + """
select count(*) as n_rows, cast(sum(('0x' || substr(md5(concat_ws('|', cell_id, cast(dow as varchar), cast(hour as varchar),
  cast(cast(crime_count as bigint) as varchar), cast(cast(cell_total_count as bigint) as varchar))), 1, 15))::bigint) as varchar) as digest
from grid""")

oracle("champion_order", "with c as (" + ORACLES["baseline_comparison"] + f"""), near as (
select *, min(MAE) over (partition by protocol) as best from c)
select protocol, predictor as champion, MAE from near where MAE <= best + {dbl(P.MAE_TIE_MARGIN)}
qualify row_number() over (partition by protocol order by RMSE, n, predictor) = 1""")

oracle("json_sink_sanitized", "select protocol, predictor, MAE, Spearman from (" + ORACLES["baseline_comparison"] + ")")

oracle("feature_table_load", ORACLES["features_labels"])
