"""Scoring of cells on several scales, min-max bounds and data-driven thresholds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardgrid.functions import minmax_score, threshold_score
from hazardgrid.operators.prepare import label_preference, wanted_scenarios, wanted_times
from hazardgrid.schema import SCENARIOS, SPATIAL, TIMES, labels_of


def fan_out(df: DataFrame, scores: dict[str, Column]) -> DataFrame:
    """One row per input row and scale, from a single scan of the input; every label is kept."""
    if not scores:
        raise ValueError("at least one scale is needed")
    keep = [*labels_of(df, without=("scoring",)), *[c for c in SPATIAL if c in df.columns]]
    cells = [F.struct(F.lit(str(k)).alias("scoring"), v.cast("double").alias("score")) for k, v in scores.items()]
    return df.select(*keep, F.inline(F.array(*cells)))


def score_scales(df: DataFrame, value: str, tables: dict[str, tuple[list[float], list[int]]]) -> DataFrame:
    """Threshold scores of one variable on several scales."""
    return fan_out(df, {k: threshold_score(F.col(value), *t) for k, t in tables.items()})


def minmax_bounds(
    df: DataFrame,
    value: str,
    ref_scenario: str | None = None,
    ref_time: str | None = None,
    by: tuple[str, ...] = ("hazard",),
) -> DataFrame:
    """``lo`` and ``hi`` of a variable, one row per hazard.

    lo is the minimum of the mild slice (RCP45/Cc unless overridden), or of HISTORICAL when that
    slice has no value; hi is the maximum of the severe slice (RCP85/Lt unless overridden). One
    pass reduces the cells to one row per hazard × scenario × time, the slices are picked there.
    """
    keys = [c for c in by if c in df.columns]
    axes = [c for c in ("scenario", "time") if c in df.columns]
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    return bounds_of(df.groupBy(*keys, *axes).agg(F.min(v).alias("_min"), F.max(v).alias("_max")), keys, ref_scenario, ref_time)


def bounds_of(slices: DataFrame, keys: list[str], ref_scenario: str | None = None, ref_time: str | None = None) -> DataFrame:
    """``minmax_bounds`` from the least and greatest value (``_min``, ``_max``) of each slice."""
    axes = [c for c in ("scenario", "time") if c in slices.columns]
    wanted = {
        "mild": (ref_scenario or "RCP45", ref_time or "Cc"),
        "severe": (ref_scenario or "RCP85", ref_time or "Lt"),
        "historical": ("HISTORICAL", ref_time or "Cc"),
    }
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    is_slice = {}
    for name, (scenario, time) in wanted.items():
        tests = [F.lit(True)]
        if "scenario" in axes:
            pref = label_preference("scenario", wanted_scenarios(scenario), SCENARIOS, any_case=True)
            tests.append(F.col("scenario").eqNullSafe(F.max_by("scenario", pref).over(whole)))
        if "time" in axes:
            pref = label_preference("time", wanted_times(time), TIMES, any_case=False)
            tests.append(F.col("time").eqNullSafe(F.max_by("time", pref).over(whole)))
        is_slice[name] = reduce(lambda a, b: a & b, tests)
    flagged = slices.select("*", *[c.alias(f"_{n}") for n, c in is_slice.items()])
    lo = F.coalesce(F.min(F.when(F.col("_mild"), F.col("_min"))), F.min(F.when(F.col("_historical"), F.col("_min"))))
    hi = F.max(F.when(F.col("_severe"), F.col("_max")))
    return flagged.groupBy(*keys).agg(lo.alias("lo"), hi.alias("hi"))


def with_bounds(df: DataFrame, bounds: DataFrame, by: tuple[str, ...] = ("hazard",)) -> DataFrame:
    """Add the bounds as columns ``_lo`` and ``_hi``."""
    keys = [c for c in by if c in df.columns]
    if not keys:
        row = bounds.select(F.struct("lo", "hi")).scalar()
        return df.withColumn("_b", row).select("*", F.col("_b.lo").alias("_lo"), F.col("_b.hi").alias("_hi")).drop("_b")
    renamed = bounds.select(*keys, F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    # One row per hazard, so this side always broadcasts.
    return df.join(F.broadcast(renamed), keys, "left")


def score_minmax(df: DataFrame, value: str, ref_scenario: str | None = None, ref_time: str | None = None) -> DataFrame:
    """0–100 score of one variable against the bounds of its reference slices."""
    bounded = with_bounds(df, minmax_bounds(df, value, ref_scenario, ref_time))
    return fan_out(bounded, {"100": minmax_score(F.col(value), F.col("_lo"), F.col("_hi"))})


def threshold_join(cells: DataFrame, thresholds: DataFrame, value: str = "value", scale: str = "scale") -> DataFrame:
    """Score many hazards in one pass with the bins as data.

    The catalogue holds about 300 rows whatever the data size; grouped, it is one row per hazard and
    scale with the bins as an array, broadcast and hashed on the hazard. The join makes a row per cell
    and scale, and the bin is found in the array. Missing values keep a NULL score.
    """
    parts = [c for c in ("metric", "threshold_type") if c in thresholds.columns]
    bins = thresholds.groupBy("hazard", F.col(scale).alias("scoring"), *parts).agg(
        F.sort_array(F.collect_list(F.struct("bin", "lo", "hi", F.col("score").cast("double").alias("score")))).alias("_bins")
    )
    v = F.when(~F.isnan(F.col(value)), F.col(value))
    joined = cells.join(F.broadcast(bins.drop(*parts)), "hazard").withColumn("_v", v)
    held = F.filter("_bins", lambda b: (F.col("_v") >= b["lo"]) & (b["hi"].isNull() | (F.col("_v") < b["hi"])))
    joined = joined.withColumn("_bin", F.get(held, F.lit(0)))
    # A value that no bin holds has no row, a missing one has.
    return joined.filter(F.col("_v").isNull() | F.col("_bin").isNotNull()).withColumn("score", F.col("_bin.score")).drop("_bins", "_bin", "_v")


def concat_scales(parts: list[DataFrame]) -> DataFrame:
    """Stack per-scale results; columns missing on one side become NULL."""
    if not parts:
        raise ValueError("at least one scale is needed")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
