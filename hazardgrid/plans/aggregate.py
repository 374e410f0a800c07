"""Aggregation jobs: scores to statistics per administrative zone."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.catalog import QUANTILE_BINS
from hazardgrid.operators.combine import merge_hazards
from hazardgrid.operators.prepare import axis_of, dedupe_coords, drop_singleton_dims, prefer_statistic, scored_dims, tidy_hazards, tidy_scored
from hazardgrid.operators.regrid import coast_on_grid
from hazardgrid.operators.weighted import flood_statistics
from hazardgrid.operators.zonal import clip_to_zones, zonal_stats
from hazardgrid.plans.concurrent import run_each
from hazardgrid.schema import HAZARD_STATS
from hazardgrid.sources.stage import stage, unstage
from hazardgrid.sources.writers import write_hazard_stats

log = logging.getLogger(__name__)

WEIGHTED = ("CF", "RF")
#: Countries left out of every aggregation unless asked for.
SKIPPED = ("ATA",)


def _tidy(df: DataFrame, hazard: str | None, level: int) -> DataFrame:
    out = df if hazard is None else df.withColumn("hazard", F.lit(hazard))
    out = out.withColumn("gadm_level", F.lit(level))
    first = [f.name for f in HAZARD_STATS.fields if f.name in out.columns]
    return out.select(*first, *[c for c in out.columns if c not in first])


def prepare_scored(scored: DataFrame) -> DataFrame:
    """One statistic, no leftover single-label dims, one row per coordinate; for several hazards.

    Each of the three steps looks at the table; ``aggregate_hazard`` needs one look for all.
    """
    df = drop_singleton_dims(prefer_statistic(scored))
    return dedupe_coords(df) if {"lat", "lon"} <= set(df.columns) else df


def in_countries(zones: DataFrame, countries: tuple[str, ...] | None = None, skip: tuple[str, ...] = SKIPPED) -> DataFrame:
    """Zones (or their cells) of the countries named, by default of all but those skipped."""
    if countries is not None:
        return zones.filter(F.col("gid0").isin(*countries))
    return zones.filter(~F.col("gid0").isin(*skip)) if skip else zones


def aggregate_hazard(
    scored: DataFrame,
    zone_cells: DataFrame,
    hazard: str,
    level: int = 1,
    coast: DataFrame | None = None,
    coast_aligned: bool = False,
    clip: bool = False,
    countries: tuple[str, ...] | None = None,
    skip: tuple[str, ...] = SKIPPED,
    zones: DataFrame | None = None,
    order: tuple[str, ...] = (),
    bins: dict = QUANTILE_BINS,
    dims: DataFrame | None = None,
    calibrate: bool = False,
) -> DataFrame:
    """Statistics of one hazard for all zones of a level at once.

    Most hazards: plain zonal statistics with missing cells as 0. CF and RF: return-period
    weighting for the threshold scales (CF over coastal cells) and plain statistics without zero
    filling for the 0–100 scale.

    The scores are read twice at most: once for ``dims``, the small table of their labels and axes
    (``scored_dims``, staged by the caller or here), and once joined with the zones. The choice of the
    statistic, of labels to drop and of coordinates is made on the whole table; ``clip`` narrows only
    the cells that enter the join to the box the zones cover. ``countries`` names those to work on
    (default: all but ``skip``), ``zones`` (``gadm_id``, ``gid0``) adds zones without cells to the weighted
    statistics, ``order`` is the order of the statistics labels where ``mean`` is missing, and ``bins``
    takes calibrated bins (``bins_of``); with ``calibrate`` the floods' scales without bins get those of this run.
    """
    df = scored.filter(F.col("hazard") == hazard) if "hazard" in scored.columns else scored
    dims = stage(scored_dims(df), f"dims-{hazard}", reuse=False) if dims is None else dims
    df, combos = tidy_scored(df, dims, order)
    cells = in_countries(zone_cells, countries, skip)
    df = clip_to_zones(df, cells) if clip else df
    if hazard not in WEIGHTED:
        return _tidy(zonal_stats(df, cells, missing="zero", combos=combos), hazard, level)
    if hazard == "CF":
        if coast is None:
            raise ValueError("CF needs the coast mask")
        coast = coast if coast_aligned else coast_on_grid(coast, axes=(axis_of(dims, "lat"), axis_of(dims, "lon")))
    listed = None if zones is None else in_countries(zones, countries, skip)
    return _tidy(flood_statistics(df, cells, hazard, combos, level, coast if hazard == "CF" else None, bins, listed, calibrate=calibrate), hazard, level)


def aggregate_hazards(
    scored: DataFrame,
    zone_cells: DataFrame,
    hazards: tuple[str, ...],
    level: int = 1,
    coast: DataFrame | None = None,
    coast_aligned: bool = False,
    clip: bool = False,
    countries: tuple[str, ...] | None = None,
    skip: tuple[str, ...] = SKIPPED,
    zones: DataFrame | None = None,
    order: tuple[str, ...] = (),
    bins: dict = QUANTILE_BINS,
    dims: DataFrame | None = None,
    calibrate: bool = False,
) -> DataFrame:
    """Statistics of several hazards of one table of scores, as ``aggregate_hazard`` gives for each.

    The hazard is a label like the others: one join with the zones' cells and one grouped aggregate
    serve all hazards without weights, another join the floods, however many there are. (Hazards that
    keep labels of their own, as several models, are joined apart from the others.)
    """
    df = scored.filter(F.col("hazard").isin(*hazards))
    dims = stage(scored_dims(df), "dims", reuse=False) if dims is None else dims.filter(F.col("hazard").isin(*hazards))
    cells = in_countries(zone_cells, countries, skip)
    df = clip_to_zones(df, cells) if clip else df
    listed = None if zones is None else in_countries(zones, countries, skip)
    parts = []
    for codes, rows, combos in tidy_hazards(df, dims, order):
        plain = [c for c in codes if c not in WEIGHTED]
        floods = [c for c in codes if c in WEIGHTED]
        if plain:
            parts.append(zonal_stats(rows.filter(F.col("hazard").isin(*plain)), cells, missing="zero", combos=combos.filter(F.col("hazard").isin(*plain))))
        if floods:
            shore = None
            if "CF" in floods:
                if coast is None:
                    raise ValueError("CF needs the coast mask")
                own = dims.filter(F.col("hazard") == "CF")
                shore = coast if coast_aligned else coast_on_grid(coast, axes=(axis_of(own, "lat"), axis_of(own, "lon")))
            some = F.col("hazard").isin(*floods)
            parts.append(flood_statistics(rows.filter(some), cells, tuple(floods), combos.filter(some), level, shore, bins, listed, calibrate=calibrate))
    if not parts:
        raise ValueError(f"no scores of {', '.join(hazards)}")
    return _tidy(merge_hazards(parts), None, level)


def aggregate_all(
    scored: dict[str, DataFrame],
    zone_cells: dict[int, DataFrame],
    levels=(1,),
    coast: DataFrame | None = None,
    out: str | None = None,
    zones: dict[int, DataFrame] | None = None,
    table: DataFrame | None = None,
    **options,
) -> tuple[dict[tuple[str, int], DataFrame], dict[tuple[str, int], Exception]]:
    """Aggregate every hazard and level; one that fails is logged and the rest go on.

    With ``out`` all hazards of a level are aggregated together (``aggregate_hazards``) and written there,
    levels side by side, and what was staged for them is deleted; ``table`` holds the scores of all of them
    where they are one table (``read_scored``), which else is their union. Only where that fails is
    each hazard tried on its own, so that the one to blame is found and the others are done.
    """
    if not scored:
        return {}, {}
    if out is None:
        return _each_hazard(scored, zone_cells, levels, coast, None, zones, **options)
    spark = next(iter(scored.values())).sparkSession
    try:
        if table is None:
            table = merge_hazards([df.withColumn("hazard", F.lit(code)) for code, df in scored.items()])
        table = table.filter(F.col("hazard").isin(*scored))
        dims = stage(scored_dims(table), "dims", reuse=False)
    except Exception as error:  # noqa: BLE001 - each hazard is tried below
        log.warning("the hazards can't be read together: %s", error)
        return _each_hazard(scored, zone_cells, levels, coast, out, zones, **options)

    def together(level: int) -> DataFrame:
        stats = aggregate_hazards(table, zone_cells[level], tuple(scored), level, coast, zones=(zones or {}).get(level), dims=dims, **options)
        write_hazard_stats(stats, out)
        return stats

    joint, broken = run_each("aggregation", {level: (lambda level=level: together(level)) for level in levels})
    done = {(code, level): joint[level].filter(F.col("hazard") == code) for level in joint for code in scored}
    failed = {}
    if broken:
        log.warning("levels %s are aggregated hazard by hazard", ", ".join(map(str, broken)))
        some, failed = _each_hazard(scored, zone_cells, tuple(broken), coast, out, zones, **options)
        done |= some
    unstage(spark, dims)
    return done, failed


def _each_hazard(scored, zone_cells, levels, coast, out, zones, **options) -> tuple[dict, dict]:
    """Every hazard on its own, some side by side."""

    def one(code: str) -> dict[int, DataFrame | Exception]:
        dims = stage(scored_dims(scored[code]), f"dims-{code}", reuse=False)
        found: dict[int, DataFrame | Exception] = {}
        for level in levels:
            try:
                found[level] = aggregate_hazard(scored[code], zone_cells[level], code, level, coast, zones=(zones or {}).get(level), dims=dims, **options)
                if out is not None:
                    write_hazard_stats(found[level], out)
            except Exception as error:  # noqa: BLE001 - one hazard must not stop the others
                log.error("%s, level %s: aggregation failed: %s", code, level, error)
                found[level] = error
        if out is not None:
            unstage(scored[code].sparkSession, dims)
        return found

    results, unread = run_each("aggregation", {code: (lambda code=code: one(code)) for code in scored})
    every = {(code, level): stats for code, found in results.items() for level, stats in found.items()}
    done = {k: v for k, v in every.items() if not isinstance(v, Exception)}
    failed = {k: v for k, v in every.items() if isinstance(v, Exception)}
    return done, failed | {(code, level): error for code, error in unread.items() for level in levels}
