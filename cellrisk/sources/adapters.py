"""Adapter views over the driver tables.

The driver ships TPC-H-like tables, not incident records.  Two views turn
them into incident-shaped tables; their SQL text runs unchanged in Spark SQL
and DuckDB, so every oracle query can start from the same text.

``inc_hourly``  (from ``events``): one row per event with time, place, type,
    description, codes and flags -> hour-of-week generation.
``inc_monthly`` (from ``lineitem``): integer grid cells (gi, gj) and a
    timestamp -> monthly generation.  ``(l_orderkey, l_linenumber)`` repeats,
    which serves the duplicate-key operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]

# Incident-shaped view over events.  Types of different severity per event
# type (one with two spellings, one unknown to the type tables), eight
# descriptions (handgun, knife, simple, attempt, domestic, child, untrimmed
# spaces, $500 and under), string booleans in several spellings, codes with a
# 'nan' text, and coordinates with nulls and (0, 0) points.
INC_HOURLY_SQL = """
select b.*,
  cast(year(ts) as int) as yr,
  case event_type
    when 'error' then case when k % 4 = 0 then 'CRIM SEXUAL ASSAULT' else 'CRIMINAL SEXUAL ASSAULT' end
    when 'purchase' then 'THEFT'
    when 'signup' then 'BATTERY'
    when 'click' then 'ROBBERY'
    else 'PUBLIC NUISANCE' end as primary_type,
  case k % 8
    when 0 then 'ARMED: HANDGUN'
    when 1 then 'ARMED: KNIFE / CUTTING INSTRUMENT'
    when 2 then 'SIMPLE'
    when 3 then 'ATTEMPT ARMED: HANDGUN'
    when 4 then 'DOMESTIC BATTERY SIMPLE'
    when 5 then 'AGGRAVATED: CHILD'
    when 6 then '  from   person/ pocket '
    else '$500 AND UNDER' end as description,
  case when k % 50 = 7 then 'nan'
       else concat(upper(substr(event_type, 1, 1)), cast(k % 3 as string)) end as iucr,
  case k % 5
    when 0 then 'street'
    when 1 then 'RESIDENCE-GARAGE'
    when 2 then 'school, public, building'
    when 3 then 'SIDEWALK'
    else null end as location_description,
  case k % 3 when 0 then 'true' when 1 then 'false' else ' True ' end as arrest_str,
  case k % 5 when 0 then 'yes' when 1 then '1' when 2 then 'T' else 'false' end as domestic_str,
  concat('C', cast(cast(floor(id / 3) as bigint) as string)) as case_number
from (
  select event_id as id, ts, cast(regexp_extract(props,'([0-9]+)',1) as int) as k, event_type,
    case when event_id % 97 = 0 then null when event_id % 101 = 0 then 0e0
         else 418e-1 + (user_id*37 % 121)/1e3 end as lat,
    case when event_id % 97 = 0 then null when event_id % 101 = 0 then 0e0
         else -877e-1 + (user_id*53 % 127)/1e3 end as lon, value
  from events
) b
"""

# Grid-month incident view over lineitem, with a type and description derived
# from the return flag and the quantity so severity has something to score.
INC_MONTHLY_SQL = """
select m.*,
  case l_returnflag when 'A' then 'ROBBERY' when 'N' then 'THEFT' else 'BATTERY' end as primary_type,
  case cast(l_quantity as int) % 6
    when 0 then 'ARMED: HANDGUN'
    when 1 then 'SIMPLE'
    when 2 then 'AGGRAVATED: KNIFE'
    when 3 then 'STRONG ARM - NO WEAPON'
    when 4 then 'PETTY'
    else 'OVER $500' end as description,
  cast(l_orderkey % 3 = 0 as int) as arrest_flag,
  cast(l_linenumber % 4 = 0 as int) as domestic_flag
from (
  select l_orderkey, l_linenumber, cast(l_suppkey % 32 as int) as gi,
    cast(floor(l_suppkey/32) as int) % 32 as gj, l_shipdate as ts,
    l_returnflag, l_quantity, l_extendedprice
  from lineitem
) m
"""

VIEWS = {"inc_hourly": INC_HOURLY_SQL, "inc_monthly": INC_MONTHLY_SQL}


def register_tables(spark: SparkSession, sf_dir: str,
                    tables: list[str] | None = None) -> None:
    """Register driver tables (lazy parquet scans) and the adapter views."""
    pin_utc(spark)
    for t in tables or TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)


def pin_utc(spark: SparkSession) -> None:
    """Calendar time is naive wall time stored as timestamp_ntz; the session
    zone must be UTC so instant parsing and literals do not shift."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # plan text of deep reuse graphs is capped (it is only for display)
    if str(spark.conf.get("spark.sql.maxPlanStringLength", "2147483632")).startswith("2147483"):
        spark.conf.set("spark.sql.maxPlanStringLength", "1000000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table or adapter view as a DataFrame."""
    pin_utc(spark)
    if name in VIEWS:
        base = "lineitem" if name == "inc_monthly" else "events"
        spark.read.parquet(f"{sf_dir}/{base}.parquet").createOrReplaceTempView(base)
        return spark.sql(VIEWS[name])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inc_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "inc_hourly")


def inc_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "inc_monthly")


def oracle_with(*views: str) -> str:
    """``WITH`` prefix defining adapter views for a DuckDB oracle text."""
    parts = [f"{v} as ({VIEWS[v]})" for v in views]
    return "with " + ",\n".join(parts) + "\n"
