"""Parquet tables and CSV exports."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid.operators.prepare import morton
from hazardgrid.schema import AREA, HAZARD_STATS, SCALE_FOLDER, SCORED, labels_of
from hazardgrid.sources.readers import CSV


#: Files that a task writing statistics has open at once, and the bytes of the row group each fills.
OPEN_FILES = 20
ROW_GROUP = 8 << 20


_OPEN = threading.Lock()
_WRITES: list[str] = []


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """The session's writes keep their files open while any write inside is under way; levels are written side by side."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    with _OPEN:
        # What the first one found is what the last one leaves.
        _WRITES.append(_WRITES[0] if _WRITES else spark.conf.get(key))
        spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        with _OPEN:
            before = _WRITES.pop()
            if not _WRITES:
                spark.conf.set(key, before)


def _overwrite_partitions(df: DataFrame, path: str, *columns: str, **options) -> None:
    """Replace the partitions present in the frame, leave the others as they are."""
    df.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **options).partitionBy(*columns).parquet(path)


def _balanced(df: DataFrame, *by) -> DataFrame:
    """Rows brought together by a key before a write.

    A rebalance, unlike a plain repartition, lets adaptive execution split a key that holds too
    much and join those that hold little, and needs no sampling pass as a range split would.
    """
    return df.hint("rebalance", *by)


def write_scored(df: DataFrame, path: str) -> None:
    """Upsert scores by hazard and scale.

    A scale that exists is replaced, a new one is added, the files of all others stay untouched.
    Scores are stored as FLOAT. Rows are gathered by squares of the raster and sorted along a curve that
    fills it, so that row groups and pages span few rows and columns and bounding boxes skip the others.
    """
    z = morton(F.col("lat_idx"), F.col("lon_idx"))
    # Squares of 64 blocks; a rebalance splits and joins them by size.
    rows = df.withColumn("score", F.col("score").cast("float")).withColumn("_z", z).withColumn("_square", F.shiftright("_z", 6))
    ordered = _balanced(rows, "hazard", "scoring", "_square").sortWithinPartitions("hazard", "scoring", "_z", "lat_idx", "lon_idx")
    _overwrite_partitions(ordered.drop("_z", "_square"), path, "hazard", "scoring")


def read_scored(spark: SparkSession, path: str, hazard: str | None = None, scales: list[str] | None = None) -> DataFrame:
    """Scores of a table written by ``write_scored``; both filters prune partitions.

    Hazards differ in their labels: those of the vocabulary are always there, NULL where a hazard
    lacks them, and any other label that a hazard was written with as well (file footers tell).
    """
    part = path if hazard is None else f"{path}/hazard={hazard}"
    found = spark.read.option("basePath", path).option("mergeSchema", True).parquet(part)
    extra = [found.schema[c] for c in labels_of(found) if c not in SCORED.fieldNames()]
    df = spark.read.schema(T.StructType([*extra, *SCORED.fields])).parquet(path)
    if hazard is not None:
        df = df.filter(F.col("hazard") == hazard)
    if scales is not None:
        df = df.filter(F.col("scoring").isin(*scales))
    return df.withColumn("score", F.col("score").cast("double"))


def write_hazard_stats(df: DataFrame, path: str) -> None:
    """Upsert zonal statistics by hazard and level.

    A task keeps the files of all its hazards open instead of sorting its rows by hazard (beyond ``OPEN_FILES`` it
    sorts), each with a small row group to fill, so that its memory is theirs at most.
    """
    with _open_files(df.sparkSession):
        _overwrite_partitions(df, path, "hazard", "gadm_level", **{"parquet.block.size": ROW_GROUP})


def export_hazard_stats(df: DataFrame, base: str, hazard: str, level: int) -> str:
    """CSV of one hazard and level: ``{base}/{CODE}_adm{L}.csv``, with header, its files compressed."""
    path = f"{base}/{hazard}_adm{level}.csv"
    columns = [f.name for f in HAZARD_STATS.fields if f.name in df.columns]
    rows = df.filter((F.col("hazard") == hazard) & (F.col("gadm_level") == level)).select(*columns)
    rows.write.mode("overwrite").options(**CSV).csv(path, compression="gzip")
    return path


def combined_path(base: str, scale: str, stat: str, scenario: str, level: int) -> str:
    """``{base}/five/hazard_score_province_mean_45.csv`` and so on; each level has its own name."""
    folder = SCALE_FOLDER.get(str(scale), f"scale{scale}")
    area = AREA[level]
    return f"{base}/{folder}/hazard_score_{area}_{stat}_{scenario.upper().replace('RCP', '')}.csv"


def write_combined(df: DataFrame, base: str, scale: str, stat: str, scenario: str, level: int, single: bool = False) -> str:
    """CSV of one wide table, written in parallel and compressed; ``single`` gathers it into one file.

    Missing values are written as ``\\N``, so that empty texts come back as such (``readers.CSV``).
    """
    path = combined_path(base, scale, stat, scenario, level)
    (df.coalesce(1) if single else df).write.mode("overwrite").options(**CSV).csv(path, compression="gzip")
    return path


def partition_zones(zones: DataFrame, base: str, level: int) -> str:
    """Write boundaries once with one partition per country."""
    path = f"{base}/adm{level}"
    _balanced(zones, "GID_0").write.mode("overwrite").partitionBy("GID_0").parquet(path)
    return path
