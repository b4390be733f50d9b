"""Severity expressions.

Two schemes:

* layered 1-100 scale (hour-of-week generation): (type, description)
  anchor -> clip(base(type) + keyword modifier, 1, 100) -> default 25;
* tier x modifier (monthly generation): tier(type) times a product of
  description multipliers clipped to [0.8, 2.2].

The lookup tables are small and fixed, so they are map literals evaluated
inside generated code: no join, no broadcast, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions.text import upper_strip

_SEP = "\u001f"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def _contains_any(d: Column, words) -> Column:
    """Spark evaluates a projection with a lambda beside the generated method of
    the scan and aggregate around it, so neither outgrows what the JVM compiles."""
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: d.contains(w))


def keyword_adjust(desc, apply_weapon_modifier=True) -> Column:
    """Additive modifier: gun +18, else blade/armed +10 (weapon modifier on);
    aggravated +10; domestic +5; child/minor +8; attempt -8."""
    return _adjust(F.upper(F.coalesce(_c(desc).cast("string"), F.lit(""))), apply_weapon_modifier)


def _adjust(d: Column, apply_weapon_modifier) -> Column:
    """``keyword_adjust`` of an upper-case description; null has no keyword."""
    weapon = (F.when(_contains_any(d, P.GUN_WORDS), P.ADJ_GUN)
              .when(_contains_any(d, P.BLADE_WORDS), P.ADJ_BLADE).otherwise(0))
    if isinstance(apply_weapon_modifier, bool):
        weapon = weapon if apply_weapon_modifier else F.lit(0)
    else:
        weapon = F.when(apply_weapon_modifier, weapon).otherwise(0)
    return (weapon
            + F.when(d.contains("AGGRAVATED"), P.ADJ_AGGRAVATED).otherwise(0)
            + F.when(d.contains("DOMESTIC"), P.ADJ_DOMESTIC).otherwise(0)
            + F.when(_contains_any(d, ("CHILD", "MINOR")), P.ADJ_CHILD).otherwise(0)
            + F.when(d.contains("ATTEMPT"), P.ADJ_ATTEMPT).otherwise(0))


def _anchor(t: Column, d: Column) -> Column:
    m = _map([(t + _SEP + d, float(v)) for t, d, v in P.SEVERITY_ANCHOR])
    return F.try_element_at(m, F.concat(t, F.lit(_SEP), d))


def _base(t: Column) -> Column:
    return F.try_element_at(_map([(t, float(v)) for t, v in P.TYPE_BASE]), t)


def anchor_severity(ptype, desc) -> Column:
    """Layer-1 anchor for (type, description), null when absent."""
    return _anchor(upper_strip(ptype), upper_strip(desc))


def type_base(ptype) -> Column:
    return _base(upper_strip(ptype))


def stripped_severity(ptype, desc) -> Column:
    """``layered_severity`` of columns that are upper-cased and stripped already.

    Over raw rows, strip in a projection of its own first: each use of a column
    here repeats what made it, and with the strips inside, the generated method
    outgrows what the JVM compiles and runs some ten times slower."""
    t, d = _c(ptype), _c(desc)
    base = F.coalesce(_base(t), F.lit(float(P.GLOBAL_DEFAULT_SEVERITY)))
    essence = F.coalesce(t.isin(*P.WEAPON_IS_ESSENCE), F.lit(False))
    layer2 = F.least(F.greatest(base + _adjust(d, ~essence), F.lit(1.0)), F.lit(100.0))
    return F.coalesce(_anchor(t, d), layer2).cast("double")


def layered_severity(ptype, desc) -> Column:
    """``compute_severity``: anchor, else clip(base + modifier, 1, 100); unknown
    or null type uses the global default as base."""
    return stripped_severity(upper_strip(ptype), upper_strip(desc))


def stripped_layer(ptype, desc) -> Column:
    """``severity_layer`` of columns that are upper-cased and stripped already."""
    t, d = _c(ptype), _c(desc)
    return (F.when(_anchor(t, d).isNotNull(), F.lit("1-anchor"))
            .when(_base(t).isNotNull(), F.lit("2-base+modifier"))
            .otherwise(F.lit("3-default")))


def severity_layer(ptype, desc) -> Column:
    """'1-anchor' / '2-base+modifier' / '3-default'."""
    return stripped_layer(upper_strip(ptype), upper_strip(desc))


def tier_base(ptype) -> Column:
    """Monthly tier per type (16/8/4/2), unknown -> 1."""
    m = _map([(n, float(t)) for t, names in P.SEVERITY_TIERS for n in names])
    return F.coalesce(F.try_element_at(m, _c(ptype)), F.lit(P.TIER_DEFAULT))


def description_multiplier(desc) -> Column:
    """Product of gun / aggravated / weapon / light multipliers, clipped.
    ``NO WEAPON`` matches the weapon pattern and ``ARMED`` counts as gun,
    as in the surveyed scheme."""
    d = F.upper(F.coalesce(_c(desc).cast("string"), F.lit("")))
    m = (F.when(d.rlike(P.MULT_GUN_PATTERN), P.MULT_GUN).otherwise(1.0)
         * F.when(d.rlike(P.MULT_AGG_PATTERN), P.MULT_AGG).otherwise(1.0)
         * F.when(d.rlike(P.MULT_WEAPON_PATTERN), P.MULT_WEAPON).otherwise(1.0)
         * F.when(d.rlike(P.MULT_SIMPLE_PATTERN), P.MULT_SIMPLE).otherwise(1.0))
    return F.least(F.greatest(m, F.lit(P.MULT_MIN)), F.lit(P.MULT_MAX))


def tier_severity(ptype, desc) -> Column:
    return tier_base(ptype) * description_multiplier(desc)
