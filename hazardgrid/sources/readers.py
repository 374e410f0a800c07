"""Parquet and CSV sources."""

from __future__ import annotations

import logging
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.operators.geometry import bbox_filter
from hazardgrid.operators.prepare import normalize_numeric
from hazardgrid.schema import HAZARD_STATS, HAZARDS, SPATIAL, labels_of

#: CSV options of all exports: a missing value differs from an empty text.
CSV = {"header": "true", "nullValue": "\\N"}

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_cells(
    spark: SparkSession,
    path: str,
    variables: list[str],
    hazard: str | None = None,
    scenarios: list[str] | None = None,
    times: list[str] | None = None,
) -> DataFrame:
    """Cells of a grid table: needed variables only, all labels, label filters pruning partitions."""
    df = spark.read.parquet(path)
    if hazard is not None and "hazard" in df.columns:
        df = df.filter(F.col("hazard") == hazard)
    if scenarios is not None:
        df = df.filter(F.col("scenario").isin(*scenarios))
    if times is not None:
        df = df.filter(F.col("time").isin(*times))
    labels = [c for c in labels_of(df) if c not in variables]
    return normalize_numeric(df.select(*labels, *[c for c in SPATIAL if c in df.columns], *variables))


def read_zones(spark: SparkSession, base: str, level: int, iso3: str | None = None) -> DataFrame:
    """Zones of one level, of one country when named (one partition is read).

    Level 2 is only read by country.
    """
    if level not in (0, 1, 2):
        raise ValueError(f"unsupported boundary level {level}")
    if level == 2 and iso3 is None:
        raise ValueError("level 2 needs a country")
    df = spark.read.parquet(f"{base}/adm{level}")
    return df if iso3 is None else df.filter(F.col("GID_0") == iso3)


def list_countries(spark: SparkSession, base: str, level: int, skip: tuple[str, ...] = ("ATA",)) -> DataFrame:
    """Country ids without the skipped ones; only the id column is read."""
    ids = spark.read.parquet(f"{base}/adm{level}").select("GID_0").distinct()
    return ids.filter(~F.col("GID_0").isin(*skip)) if skip else ids


def read_coast(spark: SparkSession, path: str, bounds: tuple[float, float, float, float], pad: float = 1.0) -> DataFrame:
    """Coast mask inside bounds (minx, miny, maxx, maxy) widened by ``pad`` degrees."""
    return bbox_filter(spark.read.parquet(path), *bounds, pad=pad)


def read_hazard_stats(spark: SparkSession, base: str, level: int, codes: tuple[str, ...] = HAZARDS) -> DataFrame | None:
    """Exported per-hazard statistics of one level, in one staged frame.

    A missing table is skipped with a warning, one that can't be read with an error in the log, whether
    that shows at its header or only at a block in an executor; None when none is left. Columns
    are matched by name, so files may lack some of them. All tables are read in one job, whose result is
    staged, so that nothing breaks later; only if it fails is each looked through to find the one to blame.
    """
    from hazardgrid.plans.concurrent import run_each
    from hazardgrid.sources.stage import stage

    paths = {code: f"{base}/{code}_adm{level}.csv" for code in codes}
    there = {code: path for code, path in paths.items() if path_exists(spark, path)}
    for code in codes:
        if code not in there:
            log.warning("%s: no statistics at %s, skipped", code, paths[code])
    frames, _ = run_each("statistics", {code: (lambda path=path: _by_name(spark.read.options(**CSV).csv(path))) for code, path in there.items()})
    while frames:
        try:
            return stage(reduce(DataFrame.unionByName, frames.values()), f"statistics-adm{level}", reuse=False)
        except (PySparkException, Py4JJavaError) as error:
            log.warning("statistics of level %s can't be read together, each is tried: %s", level, str(error).splitlines()[0])
            read = {code: (lambda df=df: df.write.format("noop").mode("overwrite").save()) for code, df in frames.items()}
            broken = run_each("statistics", read)[1]
            if not broken:
                raise
            frames = {code: df for code, df in frames.items() if code not in broken}
    return None


def _by_name(raw: DataFrame) -> DataFrame:
    """Text columns cast to the statistics schema; absent ones are NULL."""
    return raw.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in HAZARD_STATS.fields
        ]
    )
