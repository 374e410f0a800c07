"""Scalar scoring rules as Catalyst expressions (no Python runs per row)."""

from __future__ import annotations

from math import inf

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardgrid.catalog import ascending


def present(value: Column) -> Column:
    """True where a value is neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def nonzero(c: Column) -> Column:
    """A divisor: NULL instead of 0, so that a division gives NULL instead of an error."""
    return F.when(c != 0, c)


def threshold_score(value: Column, thresholds: list[float], scores: list[int]) -> Column:
    """Ordinal score of a value.

    A value on a threshold belongs to the interval above it, values outside the table get the
    nearest end score, missing stays missing. Tables may be written descending.
    """
    if not thresholds or not scores:
        raise ValueError("empty threshold table")
    t, s = ascending(thresholds, scores)
    v = value.cast("double")
    expr = F.when(~present(v), None).when(v == F.lit(inf), F.lit(float(s[-1])))
    for i in range(min(len(t), len(s)) - 1, 0, -1):
        expr = expr.when(v >= F.lit(float(t[i])), F.lit(float(s[i])))
    return expr.otherwise(F.lit(float(s[0])))


def minmax_score(value: Column, lo: Column, hi: Column) -> Column:
    """Linear 0–100 score between two bounds, clipped.

    Without usable bounds (missing or equal) every cell scores 0, missing ones too. The scale is
    not turned round for hazards where a low value is the severe one.
    """
    scaled = (value - lo) / nonzero(hi - lo) * F.lit(100.0)
    clipped = F.when(present(scaled), F.least(F.greatest(scaled, F.lit(0.0)), F.lit(100.0)))
    return F.when(lo.isNull() | hi.isNull() | (lo == hi), F.lit(0.0)).otherwise(clipped)


def protect(score: Column, protection: Column, factor: float) -> Column:
    """Score lowered by flood protection, not below 0; missing if either side is missing."""
    lowered = score - protection * F.lit(float(factor))
    # greatest() skips NULL and would turn a missing score into 0.
    return F.when(lowered.isNotNull(), F.greatest(lowered, F.lit(0.0)))


def composite(a: Column, b: Column) -> Column:
    """Product of two scores or variables."""
    return a * b


def rp_weight(score: Column, weights: dict[int, float]) -> Column:
    """Return-period weight of an integer score; 0 and fractional scores have none."""
    pairs = iter(weights.items())
    key, weight = next(pairs)
    expr = F.when(score == F.lit(float(key)), F.lit(weight))
    for key, weight in pairs:
        expr = expr.when(score == F.lit(float(key)), F.lit(weight))
    return expr


def rescore_quantiles(x: Column, q20: float, q40: float, q60: float, q80: float) -> Column:
    """Class 1–5 of a weighted risk; 0 when missing or not positive. Upper ends are inclusive."""
    return (
        F.when(x.isNull() | F.isnan(x) | (x <= 0), 0)
        .when(x <= F.lit(q20), 1)
        .when(x <= F.lit(q40), 2)
        .when(x <= F.lit(q60), 3)
        .when(x <= F.lit(q80), 4)
        .otherwise(5)
    )


def round_stat(value: Column, scale: str, stat: str) -> Column:
    """Half-to-even rounding of a zonal statistic: whole numbers, 2 or 4 places."""
    if stat == "score_stdev":
        return F.bround(value, 4)
    return F.bround(value, 2 if str(scale) == "100" else 0)


def rescale_hundred(value: Column, lo: Column, hi: Column) -> Column:
    """Stretch a non-zero value between shared bounds to 0–100; others pass unchanged."""
    stretched = F.least(F.greatest((value - lo) / (hi - lo) * 100.0, F.lit(0.0)), F.lit(100.0))
    return F.when((value != 0) & lo.isNotNull(), F.bround(stretched, 2)).otherwise(value)
