"""Variable alignment, ensemble mean, historical fill and the land mask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.schema import CELL, SPATIAL, labels_of


def align(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner match of two variables on the dimensions they share.

    The variable with fewer dimensions (a static raster) is matched to every label combination
    of the other. Join keys are the integer cell indexes and shared labels, never coordinates.
    """
    shared = [c for c in (*labels_of(left, without=("hazard",)), *CELL) if c in left.columns and c in right.columns]
    spare = [c for c in ("hazard", "lat", "lon") if c in left.columns]
    return left.join(right.drop(*spare), shared)


def ensemble_mean(df: DataFrame, value: str, over: str = "model") -> DataFrame:
    """Mean over the models, missing ones ignored, labelled ``statistic = 'mean'``.

    Every other label stays a label of the result; only ``over`` and ``statistic`` are averaged over.
    """
    if over not in df.columns:
        return df
    keep = [*labels_of(df, without=(over, "statistic")), *[c for c in SPATIAL if c in df.columns]]
    return df.groupBy(*keep).agg(F.avg(value).alias(value)).withColumn("statistic", F.lit("mean"))


def fill_current_climate(
    df: DataFrame, historical: str = "HISTORICAL", current: str = "Cc", labels: DataFrame | None = None
) -> DataFrame:
    """Use the historical current climate for every other scenario, then drop the historical one.

    Replaces the other scenarios' own ``Cc`` rows even where they hold a value. Without a
    historical scenario nothing changes. A single scan: each row names the scenarios it serves.
    ``labels`` is where the scenario labels are listed from, if that is cheaper than ``df``.
    """
    if "scenario" not in df.columns or "time" not in df.columns:
        return df
    is_hist = F.col("scenario") == historical
    # A handful of labels; scalar subquery, so no join and no driver round trip.
    names = (labels or df).agg(F.sort_array(F.collect_set("scenario"))).scalar()
    has_hist = F.array_contains(names, historical)
    others = F.array_remove(names, historical)
    none = F.array().cast("array<string>")
    serves = (
        F.when(is_hist & (F.col("time") == current), others)
        .when(is_hist | ((F.col("time") == current) & has_hist), none)
        .otherwise(F.array("scenario"))
    )
    columns = [c for c in df.columns if c != "scenario"]
    served = df.select(*columns, F.explode(serves).alias("scenario"))
    return served.select(*df.columns)


def land_mask(df: DataFrame, coast: DataFrame, value: str = "score") -> DataFrame:
    """Keep the score only where the aligned coast mask is positive."""
    mask = coast.select(*CELL, F.col("mask").alias("_mask"))
    return df.join(mask, list(CELL), "left").withColumn(value, F.when(F.col("_mask") > 0, F.col(value))).drop("_mask")
