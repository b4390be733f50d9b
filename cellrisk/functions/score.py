"""Score expressions: decay weights, anchored power score, tiers, levels,
clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellrisk import params as P
from cellrisk.functions.space import gaussian_weight


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(x) -> Column:
    return F.lit(float(x)) if isinstance(x, (int, float)) else _c(x)


def temporal_weight(age, half_life=P.HALF_LIFE_DAYS) -> Column:
    """``0.5 ** (age / H)``, no cutoff."""
    return F.pow(F.lit(0.5), _c(age) / _lit(half_life))


def scenario_shares(half_life, sigma) -> list[Column]:
    """One column for each case of ``SCENARIOS``: its weight in percent of the
    first case's; a case without an incident is 0."""
    def weight(age, km):
        return temporal_weight(F.lit(age), half_life) * gaussian_weight(F.lit(km), sigma)
    _, *first = P.SCENARIOS[0]
    return [(F.lit(0.0) if age is None else F.lit(100.0) * weight(age, km) / weight(*first)).alias(name) for name, age, km in P.SCENARIOS]


def power_score(raw, clip_value, exponent=P.SCORE_EXPONENT) -> Column:
    """``100 * (clip(raw, 0, c) / c) ** exponent``; ``c <= 0`` -> 0."""
    c = _lit(clip_value)
    ratio = F.least(F.greatest(_c(raw), F.lit(0.0)), c) / c
    return F.when(c <= 0, F.lit(0.0)).otherwise(F.lit(100.0) * F.pow(ratio, _lit(exponent)))


def log_anchor_score(raw, clip_value) -> Column:
    """``100 * log1p(clip(raw, 0, c)) / log1p(c)`` (compared normaliser)."""
    c = _lit(clip_value)
    return F.lit(100.0) * F.log1p(F.least(F.greatest(_c(raw), F.lit(0.0)), c)) / F.log1p(c)


def tier_right_closed(score, edges=P.TIER_EDGES_MONTHLY, labels=P.TIER_LABELS_MONTHLY) -> Column:
    """``pd.cut`` bins ``(e0, e1], (e1, e2], ...``; outside -> null."""
    s = _c(score)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (s > lo) & (s <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def clamp(c, lo=0.0, hi=100.0) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), _c(c)))


def risk_level(score, bounds=P.RISK_LEVEL_BOUNDS, labels=P.RISK_LEVEL_LABELS) -> Column:
    """Left-closed levels after clamping to [0, 100] (``bisect_right``)."""
    s = clamp(score)
    expr = None
    for b, lab in zip(bounds, labels):
        expr = F.when(s < b, F.lit(lab)) if expr is None else expr.when(s < b, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))
