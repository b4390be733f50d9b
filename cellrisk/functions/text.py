"""Text column expressions: normaliser, alias replace, code hygiene and
boolean parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellrisk.params import PLACE_ALIASES

_WS_EDGES = r"^\s+|\s+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: drop leading/trailing whitespace of any kind."""
    return F.regexp_replace(_c(c), _WS_EDGES, "")


def normalize_text(c) -> Column:
    """Upper case, trim, collapse whitespace runs, ``' / '`` around slashes.
    Null stays null."""
    collapsed = F.regexp_replace(F.upper(_c(c)), r"\s+", " ")
    return F.regexp_replace(F.trim(collapsed), r"\s*/\s*", " / ")


def upper_strip(c) -> Column:
    return strip(F.upper(_c(c)))


def alias_replace(c, aliases=PLACE_ALIASES) -> Column:
    """Exact whole-value replacement from a small fixed map (map literal
    lookup, no join)."""
    m = F.create_map(*[F.lit(x) for pair in aliases for x in pair])
    return F.coalesce(F.try_element_at(m, _c(c)), _c(c))


def code_hygiene(c) -> Column:
    """trim + upper, the text ``'NAN'`` becomes null."""
    v = upper_strip(c)
    return F.when(v == "NAN", F.lit(None).cast("string")).otherwise(v)


def parse_bool_strict(c) -> Column:
    """``strip().lower() == 'true'``; null -> false."""
    return F.coalesce(F.lower(strip(_c(c).cast("string"))) == "true", F.lit(False))


def parse_bool_lenient(c, truthy=("true", "1", "yes", "t")) -> Column:
    """true / 1 / yes / t (any case, padded) -> true; everything else false."""
    return F.coalesce(F.lower(strip(_c(c).cast("string"))).isin(*truthy), F.lit(False))
