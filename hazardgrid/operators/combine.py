"""From long per-hazard statistics to fixed-schema wide tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.functions import rescale_hundred, round_stat
from hazardgrid.operators.prepare import prefer_statistic
from hazardgrid.schema import HAZARD_COLUMNS, HAZARDS, META_COLUMNS, TIMES, ZONE_ID, position

log = logging.getLogger(__name__)

#: Fields of a wide row with three statistics, its keys and metadata, and some to spare.
WIDE_FIELDS = 400


def select_stats(stats: DataFrame, scale: str, scenario: str | None) -> DataFrame:
    """Rows of one scale (matched as a string) and scenario (any case).

    A frame without a scale or scenario column is not filtered on it.
    """
    if "scoring" in stats.columns:
        stats = stats.filter(F.col("scoring").cast("string") == str(scale))
    if scenario is not None and "scenario" in stats.columns:
        stats = stats.filter(F.upper("scenario") == scenario.upper())
    return stats


def merge_hazards(frames: list[DataFrame]) -> DataFrame:
    """All hazards in one long frame: one union and a single pivot instead of 13 outer joins."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _first_value(value: str, ord_by: tuple[str, ...]) -> Column:
    """First non-missing value in a stated order; the smallest when no order is stated."""
    if not ord_by:
        return F.min(value)
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(*ord_by)))


def pivot_time(long: DataFrame, value: str, ord_by: tuple[str, ...] = (), id_col: str = "gadm_id") -> DataFrame:
    """One row per zone, one ``{HAZARD}_{TIME}`` column for each of the 56 combinations.

    The columns are named up front, so the pivot needs no extra pass to find them.
    """
    key = F.concat_ws("_", "hazard", "time")
    named = long.withColumn("_key", key)
    return named.groupBy(id_col).pivot("_key", list(HAZARD_COLUMNS)).agg(_first_value(value, ord_by))


def attach_metadata(meta: DataFrame, wide: DataFrame, id_col: str) -> DataFrame:
    """Every zone of the metadata; zones unknown to it are dropped."""
    return meta.join(wide, id_col, "left")


def _tidy(stats: DataFrame, stat: str) -> DataFrame | None:
    """Statistics with the columns a wide table needs, or None when one of them is missing."""
    lacking = [c for c in ("gadm_id", "time", stat) if c not in stats.columns]
    if lacking:
        log.warning("skipped: no column %s", ", ".join(lacking))
        return None
    return prefer_statistic(stats)


def _by_zone(tidy: DataFrame, stat: str, keys: list[str], ord_by: tuple[str, ...]) -> DataFrame:
    return tidy.groupBy(*keys).agg(_first_value(stat, ord_by).alias("_v"))


def _finish(meta: DataFrame, wide: DataFrame, level: int, whole: bool, fill: float) -> DataFrame:
    """Metadata columns first, hazards in alphabetical order, times in theirs; gaps filled."""
    kind = "int" if whole else "double"
    meta_columns = [c for c in META_COLUMNS[level] if c in meta.columns]
    filled = [F.coalesce(F.col(c), F.lit(fill)).cast(kind).alias(c) for c in HAZARD_COLUMNS]
    table = attach_metadata(meta.select(*meta_columns), wide.withColumnRenamed("gadm_id", ZONE_ID[level]), ZONE_ID[level])
    return table.select(*meta_columns, *filled)


def build_combined(
    stats: DataFrame,
    meta: DataFrame,
    scale: str,
    stat: str,
    scenario: str,
    level: int = 1,
    fill: float = 0,
    ord_by: tuple[str, ...] = (),
    empty_without_data: bool = True,
) -> DataFrame | None:
    """Wide table of one threshold scale, statistic and scenario; empty when there is no data.

    The test for data looks at the statistics a second time, which is nothing on a written table;
    where they are still to be computed and known to exist, it can be left out.
    """
    tidy = _tidy(select_stats(stats, scale, scenario), stat)
    if tidy is None:
        return None
    rounded = tidy.withColumn(stat, round_stat(F.col(stat), scale, stat))
    wide = pivot_time(rounded, stat, ord_by)
    table = _finish(meta, wide, level, whole=stat != "score_stdev" and str(scale) != "100", fill=fill)
    return table.filter(tidy.exists()) if empty_without_data else table


def hundred_bounds(
    long: DataFrame, mild: str = "RCP45", severe: str = "RCP85", value: str = "score_mean"
) -> DataFrame:
    """Shared bounds per hazard: least non-zero Cc of the mild scenario, greatest non-zero Lt of
    the severe one. Hazards where either is absent or both are equal are left out."""
    v = F.when(F.col(value) != 0, F.col(value))
    scenario = F.upper("scenario")
    lo = F.min(F.when((scenario == mild.upper()) & (F.col("time") == "Cc"), v))
    hi = F.max(F.when((scenario == severe.upper()) & (F.col("time") == "Lt"), v))
    bounds = long.groupBy("hazard").agg(lo.alias("lo"), hi.alias("hi"))
    return bounds.filter(F.col("lo").isNotNull() & F.col("hi").isNotNull() & (F.col("lo") != F.col("hi")))


def normalize_hundred(long: DataFrame, bounds: DataFrame, value: str = "score_mean") -> DataFrame:
    """Stretch non-zero values between their hazard's bounds; other rows pass unchanged."""
    # At most one row per hazard, so this side always broadcasts.
    joined = long.join(F.broadcast(bounds), "hazard", "left")
    return joined.withColumn(value, rescale_hundred(F.col(value), F.col("lo"), F.col("hi"))).drop("lo", "hi")


def build_hundred(
    stats: DataFrame,
    meta: DataFrame,
    stat: str,
    scenarios: tuple[str, ...] = ("RCP45", "RCP85"),
    level: int = 1,
    fill: float = 0,
    ord_by: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """Wide 0–100 tables by scenario, on bounds shared by all of them.

    Everything up to the pivot stays long: one aggregate to a value per zone, hazard, scenario
    and time, the bounds of it, the stretch, then one pivot per scenario.
    """
    tidy = _tidy(select_stats(stats, "100", None), stat)
    if tidy is None:
        return {}
    known = meta.select(F.col(ZONE_ID[level]).alias("gadm_id")).distinct()
    long = (
        _by_zone(tidy, stat, ["gadm_id", "hazard", "scenario", "time"], ord_by)
        .join(known, "gadm_id", "left_semi")
        .filter(F.col("hazard").isin(*HAZARDS))
        .withColumn("_v", round_stat(F.col("_v"), "100", stat))
    )
    mild = next((s for s in scenarios if "45" in s), None)
    severe = next((s for s in scenarios if "85" in s), None)
    if mild and severe:
        long = normalize_hundred(long, hundred_bounds(long, mild, severe, "_v"), "_v")
    tables = {}
    for scenario in scenarios:
        rows = select_stats(long, "100", scenario)
        has_data = select_stats(tidy, "100", scenario).exists()
        tables[scenario] = _finish(meta, pivot_time(rows, "_v"), level, whole=False, fill=fill).filter(has_data)
    return tables


def _dealt(long: DataFrame) -> DataFrame:
    """Long rows by what becomes a wide row, whose size partitions can't tell: as many as the session's."""
    return long.repartition(int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")), "gadm_id", "scoring", "scenario")


def long_statistics(
    stats: DataFrame, scales: tuple[str, ...], scenarios: tuple[str, ...], columns: dict[str, str], ord_by: tuple[str, ...] = (), dealt: bool = False,
    grouped: bool = True,
) -> DataFrame | None:
    """One rounded row per zone, scale, scenario, hazard and time, with a column for each statistic.

    ``columns`` names the statistics (``mean``) and their columns (``score_mean``); those that are missing are
    left out, and without zone, time or any of them there is nothing. What ``select_stats``
    chooses for one scale and scenario is chosen here for all asked for, from one scan. With ``dealt`` the rows
    are where ``wide_statistics`` wants them, in one shuffle for both. Without ``grouped`` (and without an order) each row
    is rounded as it is: the least of several, which the wide ones take, is the same before and after.
    """
    lacking = [c for c in ("gadm_id", "time") if c not in stats.columns]
    there = {name: c for name, c in columns.items() if c in stats.columns}
    for c in [*lacking, *(c for c in columns.values() if c not in stats.columns)]:
        log.warning("skipped: no column %s", c)
    if lacking or not there:
        return None

    def labelled(df: DataFrame, name: str, wanted: list[str], label: Column) -> DataFrame:
        if name not in df.columns:
            return df.withColumn(name, F.explode(F.array(*map(F.lit, wanted))))
        return df.withColumn(name, label).filter(F.col(name).isin(*wanted))

    rows = labelled(stats, "scoring", [str(k) for k in scales], F.col("scoring").cast("string"))
    # Of the 0–100 scale one statistic is chosen for all scenarios, which share their bounds.
    if "statistic" in rows.columns:
        scenario = F.upper("scenario") if "scenario" in rows.columns else F.lit("")
        rows = rows.withColumn("_slice", F.when(F.col("scoring") != "100", scenario).otherwise(""))
        rows = prefer_statistic(rows, by=("hazard", "scoring", "_slice")).drop("_slice")
    rows = labelled(rows, "scenario", [c.upper() for c in scenarios], F.upper("scenario"))

    def rounded(c: str, first: Column) -> Column:
        return F.when(F.col("scoring") == "100", round_stat(first, "100", c)).otherwise(round_stat(first, "5", c))

    keys = ["gadm_id", "scoring", "scenario", "hazard", "time"]
    if not grouped and not ord_by:
        rows = rows.select(*keys, *[rounded(c, F.col(c)).alias(name) for name, c in there.items()])
        return _dealt(rows) if dealt else rows
    rows = _dealt(rows) if dealt else rows
    return rows.groupBy(*keys).agg(*[rounded(c, _first_value(c, ord_by)).alias(name) for name, c in there.items()])


def stretch_hundred(wide: DataFrame, names: list[str], mild: str, severe: str) -> DataFrame:
    """The 0–100 rows of ``wide_statistics`` between the bounds of their hazard, each statistic on its own.

    Bounds come from the zones that are known and are shared by the scenarios; other scales pass as they are. They are
    found in one scan, a number for each hazard, statistic and end to the driver, and go into the plan as literals.
    """
    hundred = F.col("scoring") == "100"

    def end(pick: Callable, scenario: str, column: str) -> Column:
        return pick(F.when((F.col("scenario") == scenario.upper()) & (F.col(column) != 0), F.col(column)))

    pairs = [(h, name) for h in HAZARDS for name in names]
    ends = [c for h, name in pairs for c in (end(F.min, mild, f"{h}_Cc_{name}"), end(F.max, severe, f"{h}_Lt_{name}"))]
    base = wide.filter(hundred & F.col("_known") & F.col("scenario").isin(mild.upper(), severe.upper()))
    found = base.agg(*[c.alias(f"_{i}") for i, c in enumerate(ends)]).first()
    stretched = {}
    for i, (h, name) in enumerate(pairs):
        lo, hi = found[2 * i], found[2 * i + 1]
        if lo is None or hi is None or lo == hi or (lo != lo and hi != hi):
            continue
        for c in (f"{h}_{t}_{name}" for t in TIMES):
            stretched[c] = F.when(hundred, rescale_hundred(F.col(c), F.lit(lo), F.lit(hi))).otherwise(F.col(c))
    return wide.withColumns(stretched) if stretched else wide


def wide_statistics(long: DataFrame, names: list[str], dealt: bool = False, zones: DataFrame | None = None) -> DataFrame:
    """One row per zone, scale and scenario, with columns ``{HAZARD}_{TIME}_{statistic}`` for all 56 pairs.

    The long rows are dealt by what becomes a row. Dealt by hazard and time as well, as the pivot would, each
    task has a few values of nearly every zone and holds (and shuffles) a wide row for them. Wide rows
    take more memory than what is shuffled tells, so partitions stay as many as the session's. Rows that
    ``long_statistics`` has dealt are not dealt again.

    Hazard and time are one number, the column's place, and each column the least of its values: one grouped aggregate,
    where a pivot would group by hazard and time first. With ``zones`` (``gadm_id``, ``scoring``, ``scenario`` and other columns) rows
    carry these columns, once for each of its rows; zones without statistics come out as well (``_there`` is not true),
    and so do those it doesn't know (``_known``).
    """
    keys = ["gadm_id", "scoring", "scenario"]
    place = position(F.col("hazard"), HAZARDS) * len(TIMES) + position(F.col("time"), TIMES)
    known = F.col("hazard").isin(*HAZARDS) & F.col("time").isin(*TIMES)
    rows = long.select(*keys, F.when(known, place).alias("_at"), *names)
    rows = rows if dealt else _dealt(rows)
    conf, fields = long.sparkSession.conf, "spark.sql.codegen.maxFields"
    if int(conf.get(fields)) < WIDE_FIELDS:  # wider rows than this are not compiled
        conf.set(fields, str(WIDE_FIELDS))
    each = [F.min(F.when(F.col("_at") == i, F.col(name))).alias(f"{c}_{name}") for i, c in enumerate(HAZARD_COLUMNS) for name in names]
    wide = rows.groupBy(*keys).agg(*each)
    if zones is None:
        return wide
    held = _dealt(zones.withColumn("_known", F.lit(True)))
    return held.join(wide.withColumn("_there", F.lit(True)), keys, "full_outer")


def wide_zones(meta: DataFrame, scales: tuple[str, ...], scenarios: tuple[str, ...], level: int = 1) -> DataFrame:
    """The rows of a level's metadata for every scale and scenario, as ``wide_statistics`` takes them."""
    slices = [F.struct(F.lit(str(k)).alias("scoring"), F.lit(c.upper()).alias("scenario")) for k in scales for c in scenarios]
    columns = [F.col(c) for c in META_COLUMNS[level] if c in meta.columns]
    return meta.select(F.col(ZONE_ID[level]).alias("gadm_id"), *columns, F.inline(F.array_distinct(F.array(*slices))))


def wide_table(wide: DataFrame, scale: str, name: str, scenario: str, level: int = 1, fill: float = 0) -> DataFrame:
    """One table of ``wide_statistics`` (with zones) in the fixed schema: a scan of its columns, no join.

    As many tasks as the cluster has cores, each over many of the stage's files: a slice of a stage is small.
    """
    kind = "int" if name != "std" and str(scale) != "100" else "double"
    rows = wide.filter((F.col("scoring") == str(scale)) & (F.col("scenario") == scenario.upper()) & F.col("_known"))
    meta_columns = [c for c in META_COLUMNS[level] if c in wide.columns]
    table = rows.select(*meta_columns, *[F.coalesce(F.col(f"{c}_{name}"), F.lit(fill)).cast(kind).alias(c) for c in HAZARD_COLUMNS])
    return table.coalesce(wide.sparkSession.sparkContext.defaultParallelism)


__all__ = [
    "attach_metadata",
    "build_combined",
    "build_hundred",
    "hundred_bounds",
    "long_statistics",
    "merge_hazards",
    "normalize_hundred",
    "pivot_time",
    "select_stats",
    "stretch_hundred",
    "wide_statistics",
    "wide_table",
    "wide_zones",
]
