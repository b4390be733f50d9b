"""Time column expressions: calendar parts, month periods, cyclic encodings,
flags, hour-of-week slots, ages, tolerant parsing and zone resolution."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellrisk.params import HOUR_GROUP_EDGES, HOUR_GROUP_LABELS, REGION_TIMEZONE

INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_parts(ts) -> dict[str, Column]:
    """year, month, day, dow (Mon=0), hour, day of year, date."""
    t = _c(ts)
    return {
        "year": F.year(t).cast("int"),
        "month": F.month(t).cast("int"),
        "day": F.dayofmonth(t).cast("int"),
        "dow": F.weekday(t).cast("int"),
        "hour": F.hour(t).cast("int"),
        "doy": F.dayofyear(t).cast("int"),
        "date": F.to_date(t),
    }


def month_index(ts) -> Column:
    """Integer month key ``year*12 + month - 1``: cheap join / order key."""
    t = _c(ts)
    return (F.year(t) * 12 + F.month(t) - 1).cast("int")


def period_str(pidx) -> Column:
    """``'yyyy-MM'`` text from a month index."""
    p = _c(pidx)
    return F.format_string("%04d-%02d", F.floor(p / 12).cast("int"), (p % 12 + 1).cast("int"))


def period_of_ts(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")


def period_start(period) -> Column:
    """First day of a ``'yyyy-MM'`` period."""
    return F.to_date(F.concat(_c(period), F.lit("-01")))


def quarter_of_month(month) -> Column:
    return (F.floor((_c(month) - 1) / 3) + 1).cast("int")


def cyclic(v, period: float) -> tuple[Column, Column]:
    """(sin, cos) of ``2*pi*v/period``."""
    rad = F.lit(2.0 * math.pi) * _c(v).cast("double") / F.lit(float(period))
    return F.sin(rad), F.cos(rad)


def is_night(hour) -> Column:
    """Monthly generation night: hour >= 22 or hour < 5."""
    h = _c(hour)
    return ((h >= 22) | (h < 5)).cast("int")


def is_weekend(dow) -> Column:
    return (_c(dow) >= 5).cast("int")


def time_features(ts) -> dict[str, Column]:
    """``build_time_features``: hour, dow, is_weekend and the four encodings."""
    hour = F.hour(_c(ts)).cast("int")
    dow = F.weekday(_c(ts)).cast("int")
    hs, hc = cyclic(hour, 24)
    ds, dc = cyclic(dow, 7)
    return {"hour": hour, "dow": dow, "is_weekend": is_weekend(dow),
            "hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc}


def hour_slot(dow, hour) -> Column:
    return (_c(dow) * 24 + _c(hour)).cast("int")


def hour_group(hour, edges=HOUR_GROUP_EDGES, labels=HOUR_GROUP_LABELS) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2], ...``; outside -> null."""
    h = _c(hour)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (h > lo) & (h <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def age_days(ts, ref) -> Column:
    """Fractional days from ``ts`` to ``ref``."""
    return F.expr("timestampdiff(MICROSECOND, {}, {})".format(_sql(ts), _sql(ref))) / F.lit(86400e6)


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("age_days takes column names")


def parse_ts(text, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """Tolerant parse: a value that does not match gives null (never throws)."""
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def parse_ts_two_formats(text, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """First format, else Spark's free-format cast (the second-choice parse)."""
    return F.coalesce(F.try_to_timestamp(_c(text), F.lit(fmt)), F.try_to_timestamp(_c(text)))


def resolve_request_time(text, zone: str = REGION_TIMEZONE) -> dict[str, Column]:
    """Zone resolution of request times.

    * no offset  -> the text is local wall time in ``zone`` (a date alone is
      its midnight);
    * an offset after a time -> converted to ``zone`` wall time;
    * unparsable, a suffix other than an offset, or a local time in the DST gap or the doubled hour -> error.

    Returns ``local_ts`` (timestamp_ntz wall time, null when rejected) and
    ``time_error`` (null when accepted).
    """
    s = F.trim(_c(text))
    clock = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?"
    has_offset = F.coalesce(s.rlike(clock + r" ?(Z|[+-]\d{2}(:?\d{2})?)$"), F.lit(False))
    plain = s.rlike(clock + "$") | s.rlike(r"^\d{4}-\d{2}(-\d{2})?$")
    naive = F.when(plain, F.try_to_timestamp(s)).cast("timestamp_ntz")
    # with an offset: parse as an instant (session zone UTC), then shift to zone
    instant = F.try_to_timestamp(s)
    from_offset = F.convert_timezone(F.lit("UTC"), F.lit(zone), instant.cast("timestamp_ntz"))
    # naive wall time: round trip through UTC detects the gap; the doubled
    # hour is when wall +/- 1h maps to the same wall time
    utc_of_wall = F.to_utc_timestamp(naive, zone)
    back = F.from_utc_timestamp(utc_of_wall, zone).cast("timestamp_ntz")
    in_gap = back != naive
    plus = F.from_utc_timestamp(utc_of_wall + F.expr("INTERVAL 1 HOUR"), zone).cast("timestamp_ntz")
    minus = F.from_utc_timestamp(utc_of_wall - F.expr("INTERVAL 1 HOUR"), zone).cast("timestamp_ntz")
    doubled = (plus == naive) | (minus == naive)
    local = F.when(has_offset, from_offset).otherwise(
        F.when(in_gap | doubled, F.lit(None)).otherwise(naive))
    err = (F.when(F.when(has_offset, instant).otherwise(naive).isNull(), F.lit("unparsable"))
           .when(~has_offset & in_gap, F.lit("dst_gap"))
           .when(~has_offset & doubled, F.lit("dst_ambiguous")))
    return {"local_ts": local.cast("timestamp_ntz"), "time_error": err}
