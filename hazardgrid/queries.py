"""One query per operator and job, over the driver's tables recast as grids and zones."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.catalog import SETTINGS, threshold_table, thresholds
from hazardgrid.fixtures import raster, view
from hazardgrid.functions import protect, rescore_quantiles, round_stat, threshold_score
from hazardgrid.operators import align as al
from hazardgrid.operators import combine as cb
from hazardgrid.operators import gapfill as gf
from hazardgrid.operators import geometry as geo
from hazardgrid.operators import prepare as pr
from hazardgrid.operators import quantiles as qt
from hazardgrid.operators import regrid as rg
from hazardgrid.operators import scoring as sc
from hazardgrid.operators import weighted as wt
from hazardgrid.operators import zonal as zn
from hazardgrid.plans import (
    aggregate_hazard,
    combine,
    full_run,
    score_cf,
    score_hazard,
    score_ls,
    score_many,
    score_rf,
    score_sub,
    score_wf,
)
from hazardgrid.schema import CELL, HAZARD_COLUMNS, HAZARDS
from hazardgrid.sources import readers, stage, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STANDARD = tuple(code for code, s in SETTINGS.items() if s.kind == "standard")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for each run of a query that writes."""
    return f"{stage.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _round(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _rounded_stats(df: DataFrame) -> DataFrame:
    return _round(df, "score_mean", "score_max", "score_stdev")


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "cells_fx")


def _single(df: DataFrame, *columns: str) -> DataFrame:
    """The whole table as one hazard with one variable."""
    return df.select("scenario", "time", *[c for c in columns if c in df.columns], *CELL, "lat", "lon")


# --- sources and sinks -------------------------------------------------------------------------


@query
def read_cells(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "cells")
    _cells(spark, sf).write.partitionBy("hazard", "scenario", "time").parquet(path)
    return readers.read_cells(spark, path, ["value", "rp"], hazard="HS", scenarios=["RCP45", "RCP85"])


@query
def read_zones_country(spark: SparkSession, sf: str) -> DataFrame:
    base = _folder(spark, "zones")
    writers.partition_zones(view(spark, sf, "zones_fx"), base, 1)
    return readers.read_zones(spark, base, 1, "NATION_7")


@query
def list_countries(spark: SparkSession, sf: str) -> DataFrame:
    base = _folder(spark, "zones")
    writers.partition_zones(view(spark, sf, "zones_fx"), base, 1)
    return readers.list_countries(spark, base, 1, skip=("NATION_3",))


@query
def zones_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    base = _folder(spark, "zones")
    writers.partition_zones(view(spark, sf, "zones_fx"), base, 1)
    return readers.read_zones(spark, base, 1)


@query
def coast_clip(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "coast")
    pr.sort_grid(view(spark, sf, "coast_fx")).write.parquet(path)
    return readers.read_coast(spark, path, (3.2, 8.0, 40.7, 30.2))


@query
def threshold_table_use(spark: SparkSession, sf: str) -> DataFrame:
    bins = threshold_table(spark)
    cells = _cells(spark, sf).select("hazard", F.coalesce("rp", "value").alias("v")).filter("v IS NOT NULL")
    in_bin = (F.col("v") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("v") < F.col("hi")))
    used = cells.join(F.broadcast(bins), "hazard").filter(in_bin)
    return used.groupBy("hazard", "threshold_type", "scale", "bin", "score").agg(F.count(F.lit(1)).alias("n"))


QUERIES["threshold_table"] = QUERIES.pop("threshold_table_use")


def _stats_table(spark: SparkSession, sf: str) -> str:
    path = _folder(spark, "hazard-stats")
    writers.write_hazard_stats(view(spark, sf, "stats_fx"), path)
    return path


_STATS_COLUMNS = ("hazard", "gadm_level", "gadm_id", "scoring", "scenario", "time", "score_mean", "score_max", "score_stdev")


@query
def read_hazard_stats(spark: SparkSession, sf: str) -> DataFrame:
    written = spark.read.parquet(_stats_table(spark, sf))
    base = _folder(spark, "aggregations")
    for code in HAZARDS:
        if code != "TS":  # a missing table is skipped
            writers.export_hazard_stats(written, base, code, 1)
    return readers.read_hazard_stats(spark, base, 1).select(*_STATS_COLUMNS)


@query
def write_hazard_stats(spark: SparkSession, sf: str) -> DataFrame:
    path = _stats_table(spark, sf)
    # A second run of some hazards replaces them and leaves the others.
    changed = view(spark, sf, "stats_fx").filter(F.col("hazard").isin("HS", "CS"))
    writers.write_hazard_stats(changed.withColumn("score_mean", F.col("score_mean") + 1), path)
    return spark.read.schema(view(spark, sf, "stats_fx").schema).parquet(path).select(*_STATS_COLUMNS)


@query
def scored_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "scored")
    cells = view(spark, sf, "hazard_grid_fx").drop("rp")
    tables = {k: thresholds("HS", k) for k in ("5", "10")}
    writers.write_scored(sc.score_scales(cells, "value", tables), path)
    # Replace one scale, add one; the other keeps its files.
    replaced = sc.fan_out(cells, {"10": F.col("value") / 5, "100": F.col("value") * 2})
    writers.write_scored(replaced, path)
    out = writers.read_scored(spark, path)
    return _round(out.select("hazard", "scoring", "scenario", "time", *CELL, "score"), "score", places=4)


@query
def stage_reuse(spark: SparkSession, sf: str) -> DataFrame:
    cells = view(spark, sf, "grid_fx").select("scenario", "time", *CELL, "value")
    stage.stage(cells, "grid")
    return stage.stage(view(spark, sf, "grid_fx").select("scenario", "time", *CELL, "value"), "grid")


@query
def write_combined(spark: SparkSession, sf: str) -> DataFrame:
    table = combined_mean(spark, sf)
    path = writers.write_combined(table, _folder(spark, "combined"), "5", "mean", "RCP85", 1)
    return spark.read.schema(table.schema).options(**readers.CSV).csv(path)


# --- projections and filters -------------------------------------------------------------------


@query
def metric_select(spark: SparkSession, sf: str) -> DataFrame:
    return pr.select_metric(_cells(spark, sf).drop("lat", "lon"), "p5")


@query
def scale_factor(spark: SparkSession, sf: str) -> DataFrame:
    return pr.scale_values(_cells(spark, sf).select("hazard", "l_orderkey", "l_linenumber", "value"), "value", 100)


@query
def drop_singletons(spark: SparkSession, sf: str) -> DataFrame:
    one = _cells(spark, sf).withColumns({"statistic": F.lit("mean"), "metric": F.lit("p95"), "scoring": F.lit("5")})
    return pr.drop_singleton_dims(one.select("scoring", "scenario", "time", "statistic", "metric", "model", *CELL, "value"))


@query
def score_multi(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf).drop("lat", "lon")
    return sc.score_scales(cells, "value", {k: thresholds("HS", k) for k in ("5", "10")})


@query
def fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    return pr.fill_missing(_cells(spark, sf).select("hazard", "l_orderkey", "l_linenumber", "value"), "value")


@query
def normalize_numeric(spark: SparkSession, sf: str) -> DataFrame:
    raw = _cells(spark, sf).select(
        F.encode("hazard", "UTF-8").alias("hazard"), "l_orderkey", "l_linenumber",
        F.coalesce(F.col("value"), F.lit(float("nan"))).cast("float").alias("value"),
        F.coalesce(F.col("rp"), F.lit(float("nan"))).alias("rp"),
    )
    return pr.normalize_numeric(raw)


@query
def prefer_statistic(spark: SparkSession, sf: str) -> DataFrame:
    return pr.prefer_statistic(_cells(spark, sf).drop("lat", "lon"), "MEAN")


@query
def reference_slice(spark: SparkSession, sf: str) -> DataFrame:
    # The scenario matches in any case; the time does not, so the last one is taken.
    return pr.reference_slice(_cells(spark, sf).drop("lat", "lon"), "rcp45", "cc")


@query
def bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf).select("hazard", "l_orderkey", "l_linenumber", "lat", "lon")
    return geo.bbox_filter(cells, 3.2, 4.1, 40.7, 41.4)


@query
def clip_to_zones(spark: SparkSession, sf: str) -> DataFrame:
    country = view(spark, sf, "edges_fx").filter(F.col("gid0") == "NATION_7")
    cells = geo.zone_cells(country, raster(spark, sf), "center")
    return zn.clip_to_zones(_cells(spark, sf).select("hazard", "l_orderkey", "l_linenumber", *CELL), cells)


@query
def split_scales(spark: SparkSession, sf: str) -> DataFrame:
    discrete, hundred = pr.split_hundred(view(spark, sf, "stats_fx").select("hazard", "gadm_id", "scoring", "scenario", "time"))
    return discrete.withColumn("part", F.lit("threshold")).unionByName(hundred.withColumn("part", F.lit("hundred")))


@query
def select_stats(spark: SparkSession, sf: str) -> DataFrame:
    return cb.select_stats(view(spark, sf, "stats_fx"), 5, "rcp45")


@query
def land_mask(spark: SparkSession, sf: str) -> DataFrame:
    grid = view(spark, sf, "grid_fx").select("scenario", "time", *CELL, F.col("value").alias("score"))
    return al.land_mask(grid, view(spark, sf, "coast_fx"))


@query
def dedupe_coords(spark: SparkSession, sf: str) -> DataFrame:
    doubled = view(spark, sf, "hazard_grid_fx").withColumns(
        {"lat": F.floor(F.col("lat_idx") / 2) + 0.5, "lon": F.floor(F.col("lon_idx") / 3) + 0.5}
    )
    return pr.dedupe_coords(doubled).select("hazard", "scenario", "time", *CELL, "lat", "lon", "value")


@query
def zones_in_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return geo.zones_in_bbox(view(spark, sf, "edges_fx"), 3.3, 20.2, 8.1, 26.4)


# --- joins -------------------------------------------------------------------------------------


@query
def align_product(spark: SparkSession, sf: str) -> DataFrame:
    grid = view(spark, sf, "grid_fx").select("scenario", "time", *CELL, "value")
    both = al.align(grid, view(spark, sf, "static_fx"))
    return both.select("scenario", "time", *CELL, (F.col("value") * F.col("protection")).alias("product"))


def _zone_cells(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    return geo.zone_cells(view(spark, sf, "edges_fx"), raster(spark, sf), mode)


def _boundaries(spark: SparkSession, sf: str) -> DataFrame:
    """Zones with their boundary as WKB, made from the edges."""
    rings = view(spark, sf, "edges_fx").groupBy("gadm_id", "part", "ring")
    rings = rings.agg(F.sort_array(F.collect_list(F.struct("seq", "x1", "y1"))).alias("points"))
    zones = rings.groupBy("gadm_id").agg(F.collect_list(F.struct("part", "ring", "points")).alias("rings"))

    write_wkb = geo.write_wkb

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = [
                write_wkb([(r["part"], r["ring"], np.array([(p["x1"], p["y1"]) for p in r["points"]])) for r in rings])
                for rings in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shapes, pa.binary())], names=["GID_1", "geometry"])

    shapes = zones.mapInArrow(encode, "GID_1 string, geometry binary")
    return view(spark, sf, "zones_fx").join(shapes, "GID_1", "left")


@query
def zones_to_edges(spark: SparkSession, sf: str) -> DataFrame:
    base = _folder(spark, "zones")
    writers.partition_zones(_boundaries(spark, sf), base, 1)
    return geo.ring_edges(geo.zone_rings(readers.read_zones(spark, base, 1), "GID_1"))


@query
def zone_cells_wkb(spark: SparkSession, sf: str) -> DataFrame:
    edges = geo.ring_edges(geo.zone_rings(_boundaries(spark, sf), "GID_1"))
    return _round(geo.zone_cells(edges, raster(spark, sf), "coverage"), "coverage")


@query
def zone_cells_winding(spark: SparkSession, sf: str) -> DataFrame:
    return _round(geo.zone_cells(view(spark, sf, "windings_fx"), raster(spark, sf), "coverage"), "coverage")


def _staged(df: DataFrame, name: str) -> DataFrame:
    """Aggregation reads written tables: scores, and zone cells that all hazards of a grid share."""
    return stage.stage(df, name, reuse=False)


def _zones(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    """Zone cells as aggregation takes them: runs."""
    return _staged(geo.zone_runs(view(spark, sf, "edges_fx"), raster(spark, sf), mode), f"zone-runs-{mode}")


@query
def zone_runs(spark: SparkSession, sf: str) -> DataFrame:
    """How many cells and how much weight the runs of each zone's rows stand for."""
    runs = geo.zone_runs(view(spark, sf, "edges_fx"), raster(spark, sf), "all_touched")
    width = F.col("lon_end") - F.col("lon_idx") + 1
    return runs.groupBy("gadm_id", "lat_idx").agg(F.count(F.lit(1)).alias("runs"), F.sum(width).alias("cells"), F.min("lon_idx").alias("first"), F.max("lon_end").alias("last"))


@query
def zone_cells_center(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_cells(spark, sf, "center")


@query
def zone_cells_touched(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_cells(spark, sf, "all_touched")


@query
def zone_cells_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_zone_cells(spark, sf, "coverage"), "coverage")


@query
def nearest_grid(spark: SparkSession, sf: str) -> DataFrame:
    target = view(spark, sf, "grid_fx").select("scenario", "time", *CELL, "lat", "lon")
    return rg.nearest_grid(target, view(spark, sf, "coarse_coast_fx"), "mask")


@query
def coast_on_grid(spark: SparkSession, sf: str) -> DataFrame:
    return rg.coast_on_grid(view(spark, sf, "coarse_coast_fx"), view(spark, sf, "grid_fx"))


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    return cb.pivot_time(cb.select_stats(view(spark, sf, "stats_fx"), "5", "RCP85"), "score_mean")


@query
def pivot_time(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf)


@query
def attach_metadata(spark: SparkSession, sf: str) -> DataFrame:
    wide = _wide(spark, sf).withColumnRenamed("gadm_id", "GID_1")
    return cb.attach_metadata(view(spark, sf, "zones_fx").drop("zone_no"), wide, "GID_1")


@query
def merge_hazards(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.schema(view(spark, sf, "stats_fx").schema).parquet(_stats_table(spark, sf))
    frames = [cb.select_stats(table.filter(F.col("hazard") == code), "10", "RCP45") for code in HAZARDS]
    return cb.pivot_time(cb.merge_hazards(frames), "score_max")


@query
def threshold_join(spark: SparkSession, sf: str) -> DataFrame:
    bins = threshold_table(spark).filter(F.col("threshold_type").isin("scoring", "thresholds", "thresholds_final"))
    cells = _cells(spark, sf).select("hazard", "l_orderkey", "l_linenumber", "value")
    return sc.threshold_join(cells, bins)


@query
def historical_fill(spark: SparkSession, sf: str) -> DataFrame:
    return al.fill_current_climate(_cells(spark, sf).select("hazard", "scenario", "time", *CELL, "value"))


# --- aggregations ------------------------------------------------------------------------------


@query
def ensemble_mean(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf).select("hazard", "scenario", "time", "model", *CELL, "value")
    return _round(al.ensemble_mean(cells, "value"), "value")


@query
def ensemble_extra_dim(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension outside the vocabulary stays one."""
    cells = _cells(spark, sf).select("hazard", "scenario", "time", "model", F.col("metric").alias("percentile"), *CELL, "value")
    return _round(al.ensemble_mean(cells, "value"), "value")


@query
def minmax_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return sc.minmax_bounds(_cells(spark, sf), "value")


def _heat_scores(spark: SparkSession, sf: str) -> DataFrame:
    grid = view(spark, sf, "grid_fx").drop("rp")
    return sc.score_scales(grid, "value", {"5": thresholds("HS", "5")})


@query
def zonal_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = zn.zonal_stats(_heat_scores(spark, sf), _zones(spark, sf, "center"), missing="zero")
    return _rounded_stats(out)


@query
def zonal_stats_weighted(spark: SparkSession, sf: str) -> DataFrame:
    scored = sc.score_minmax(view(spark, sf, "grid_fx"), "value")
    return _rounded_stats(zn.zonal_stats(scored, _zones(spark, sf, "coverage"), missing="skip"))


@query
def zonal_multi(spark: SparkSession, sf: str) -> DataFrame:
    grid = view(spark, sf, "grid_fx")
    wide = grid.withColumns({f"s{k}": threshold_score(F.col("value"), *thresholds("HS", k)) for k in ("5", "10")})
    out = zn.zonal_multi(wide, _zones(spark, sf, "all_touched"), {"5": "s5", "10": "s10"}, missing="zero")
    return _rounded_stats(out)


def _flood_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return _single(_cells(spark, sf), "model", "rp"), view(spark, sf, "static_fx")


def _flood_scores(spark: SparkSession, sf: str, job, scales=("5", "10", "100")) -> DataFrame:
    cells, static = _flood_inputs(spark, sf)
    return job(cells, static, "rp", "protection", scales)


@query
def rp_weighted_rf(spark: SparkSession, sf: str) -> DataFrame:
    scored = _flood_scores(spark, sf, score_rf, ("5",))
    # Zones that cover no cell's centre are reported, too: here one beside every province.
    zones = view(spark, sf, "zones_fx").select("GID_1", F.col("GID_0").alias("gid0"))
    names = F.explode(F.array(F.col("GID_1"), F.concat("GID_1", F.lit("_islet")))).alias("gadm_id")
    zones = zones.select(names, "gid0")
    return _round(wt.rp_weighted(scored, _zones(spark, sf, "center"), "RF", zones=zones), "score_max")


@query
def rp_weighted_cf(spark: SparkSession, sf: str) -> DataFrame:
    scored = _flood_scores(spark, sf, score_cf, ("5",))
    coast = view(spark, sf, "coast_fx")
    return _round(wt.rp_weighted(scored, _zones(spark, sf, "center"), "CF", 1, coast), "score_max")


@query
def weighted_risk(spark: SparkSession, sf: str) -> DataFrame:
    # Read for its labels and for its scores.
    scored = _staged(_flood_scores(spark, sf, score_rf, ("5", "10")), "scored")
    return _round(wt.weighted_risk(scored, _zones(spark, sf, "coverage")), "weighted_risk", "score_max", places=7)


@query
def calibrate_bins(spark: SparkSession, sf: str) -> DataFrame:
    scored = _flood_scores(spark, sf, score_rf, ("5", "10"))
    risk = wt.weighted_risk(scored, _zones(spark, sf, "center"))
    return _round(wt.calibrate_bins(risk, ("scoring",)), "q20", "q40", "q60", "q80", places=7)


@query
def quantiles_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of all cells by hazard and scenario, more values in a group than a sketch holds."""
    cells = _cells(spark, sf).select("hazard", "scenario", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("double").alias("v"))
    found = qt.exact_quantiles(cells.withColumn("hazard", F.when(F.col("hazard") != "WS", F.col("hazard"))), "v", ["hazard", "scenario"], [0.0, 0.25, 0.5, 0.9, 1.0])
    return found.select("hazard", "scenario", *[F.element_at("quantiles", i + 1).alias(n) for i, n in enumerate(("least", "q25", "q50", "q90", "most"))])


@query
def hundred_bounds(spark: SparkSession, sf: str) -> DataFrame:
    long = cb.select_stats(view(spark, sf, "stats_fx"), "100", None)
    return cb.hundred_bounds(long)


# --- windows, sorts, sets ----------------------------------------------------------------------


def _sparse_fwi(spark: SparkSession, sf: str) -> DataFrame:
    """Fire weather over its whole range, with gaps of one cell and of twelve, by the cell's place."""
    grid = view(spark, sf, "grid_fx")
    there = ((F.col("lat_idx") * 7 + F.col("lon_idx") * 3) % 5 != 0) & ((F.floor(F.col("lon_idx") / 12) + F.col("lat_idx")) % 3 != 0)
    return grid.select("scenario", "time", *CELL, F.when(there, F.col("value")).alias("fwi"))


@query
def densify(spark: SparkSession, sf: str) -> DataFrame:
    grid = raster(spark, sf)
    return gf.densify(_sparse_fwi(spark, sf), "fwi", grid.n_lat, grid.n_lon)


@query
def gap_fill_lon(spark: SparkSession, sf: str) -> DataFrame:
    return gf.fill_along(_sparse_fwi(spark, sf), "fwi", "lon_idx", 10)


@query
def gap_fill_2d(spark: SparkSession, sf: str) -> DataFrame:
    grid = raster(spark, sf)
    return gf.gap_fill(_sparse_fwi(spark, sf), "fwi", grid.n_lat, grid.n_lon, 5)


@query
def gap_fill_present(spark: SparkSession, sf: str) -> DataFrame:
    """The cells that have a value after both passes, without a dense grid."""
    grid = raster(spark, sf)
    return gf.fill_gaps(_sparse_fwi(spark, sf), "fwi", grid.n_lat, grid.n_lon, 5)


@query
def sort_grid(spark: SparkSession, sf: str) -> DataFrame:
    return pr.sort_grid(view(spark, sf, "grid_fx").select("scenario", "time", *CELL, "value"))


@query
def concat_scales(spark: SparkSession, sf: str) -> DataFrame:
    grid = view(spark, sf, "grid_fx").drop("lat", "lon")
    five = sc.score_scales(grid, "value", {"5": thresholds("HS", "5")})
    hundred = sc.score_minmax(grid, "value").withColumn("statistic", F.lit("mean"))
    return _round(sc.concat_scales([five, hundred]), "score")


# --- scalar functions --------------------------------------------------------------------------


def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf).select("hazard", "l_orderkey", "l_linenumber", "value", "rp")


@query
def score_asc(spark: SparkSession, sf: str) -> DataFrame:
    df = _keyed(spark, sf)
    return df.select("l_orderkey", "l_linenumber", threshold_score(F.col("value"), *thresholds("ER", "5")).alias("score"))


@query
def score_desc(spark: SparkSession, sf: str) -> DataFrame:
    df = _keyed(spark, sf)
    return df.select("l_orderkey", "l_linenumber", threshold_score(F.col("rp"), *thresholds("CF", "5")).alias("score"))


EDGE_TABLES = (("HS", "10", None), ("CF", "10", None), ("CS", "5", None), ("LS", "5", "thresholds_ari"), ("LS", "10", "thresholds_final"))


@query
def score_edges(spark: SparkSession, sf: str) -> DataFrame:
    # Values on, below and above the thresholds, both infinities and missing ones.
    odd = F.when(F.isnan("rp") | F.col("rp").isNull(), F.col("rp")).when(F.col("rp") > 1e9, F.col("rp"))
    v = odd.when(F.col("l_linenumber") == 1, F.lit(float("-inf"))).otherwise(F.col("value") - 20)
    df = _keyed(spark, sf).withColumn("v", v)
    cols = {f"s_{h.lower()}_{k}": threshold_score(F.col("v"), *thresholds(h, k, threshold_type=t)) for h, k, t in EDGE_TABLES}
    return df.withColumns(cols).select("l_orderkey", "l_linenumber", *cols)


@query
def score_minmax(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf).drop("lat", "lon")
    return _round(sc.score_minmax(cells, "value", "RCP85"), "score")


@query
def protect_clamp(spark: SparkSession, sf: str) -> DataFrame:
    both = al.align(view(spark, sf, "grid_fx").select("scenario", "time", *CELL, "value"), view(spark, sf, "static_fx"))
    score = threshold_score(F.col("value"), *thresholds("HS", "10"))
    return both.select("scenario", "time", *CELL, protect(score, F.col("protection"), 2).alias("score"))


@query
def rescore_quantile_classes(spark: SparkSession, sf: str) -> DataFrame:
    x = (F.col("value") - 10) / 10000
    return _keyed(spark, sf).select(
        "l_orderkey", "l_linenumber", rescore_quantiles(x, 0.0005, 0.001, 0.002, 0.003).alias("class")
    )


QUERIES["rescore_quantiles"] = QUERIES.pop("rescore_quantile_classes")


@query
def round_scores(spark: SparkSession, sf: str) -> DataFrame:
    stats = view(spark, sf, "stats_fx")
    return stats.select(
        "hazard", "gadm_id", "scoring", "scenario", "time",
        *[
            F.when(F.col("scoring") == "100", round_stat(F.col(c), "100", c)).otherwise(round_stat(F.col(c), "5", c)).alias(c)
            for c in ("score_mean", "score_max", "score_stdev")
        ],
    )


@query
def normalize_hundred(spark: SparkSession, sf: str) -> DataFrame:
    long = cb.select_stats(view(spark, sf, "stats_fx"), "100", None).select("hazard", "gadm_id", "scenario", "time", "score_mean")
    return cb.normalize_hundred(long, cb.hundred_bounds(long))


# --- jobs --------------------------------------------------------------------------------------

ALL_SCALES = ("5", "10", "100")


@query
def score_standard_hazards(spark: SparkSession, sf: str) -> DataFrame:
    return _round(score_many(_cells(spark, sf).drop("lat", "lon"), STANDARD, "value", ALL_SCALES), "score")


QUERIES["score_standard"] = QUERIES.pop("score_standard_hazards")


@query
def score_subsidence(spark: SparkSession, sf: str) -> DataFrame:
    cells = _cells(spark, sf).withColumn("subsidence", F.col("value") / 10)
    return _round(score_sub(cells.drop("hazard", "lat", "lon"), "subsidence", ALL_SCALES), "score")


QUERIES["score_sub"] = QUERIES.pop("score_subsidence")


@query
def score_landslide(spark: SparkSession, sf: str) -> DataFrame:
    grid = view(spark, sf, "grid_fx").select("scenario", "time", *CELL, F.col("value").alias("ari"))
    return _round(score_ls(grid, view(spark, sf, "static_fx"), ALL_SCALES, "ari", "protection"), "score")


QUERIES["score_ls"] = QUERIES.pop("score_landslide")


@query
def score_wildfire(spark: SparkSession, sf: str) -> DataFrame:
    grid = raster(spark, sf)
    burn = view(spark, sf, "static_fx").withColumnRenamed("protection", "burnability")
    scored = score_wf(_sparse_fwi(spark, sf), burn, grid.n_lat, grid.n_lon, ALL_SCALES)
    return _round(scored, "score")


QUERIES["score_wf"] = QUERIES.pop("score_wildfire")


@query
def score_river_flood(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_flood_scores(spark, sf, score_rf).drop("lat", "lon"), "score")


QUERIES["score_rf"] = QUERIES.pop("score_river_flood")


@query
def score_coastal_flood(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_flood_scores(spark, sf, score_cf).drop("lat", "lon"), "score")


QUERIES["score_cf"] = QUERIES.pop("score_coastal_flood")


@query
def score_one_hazard(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "scored")
    cells = _cells(spark, sf).withColumn("extremes", F.col("value") / 64).drop("hazard")
    score_hazard("HP", cells, scales=ALL_SCALES, out=path)
    out = writers.read_scored(spark, path, "HP")
    return _round(out.select("hazard", "scoring", "scenario", "time", *CELL, "score"), "score", places=3)


QUERIES["score_hazard"] = QUERIES.pop("score_one_hazard")


@query
def aggregate_standard(spark: SparkSession, sf: str) -> DataFrame:
    grid = view(spark, sf, "grid_fx").withColumns({"statistic": F.lit("mean"), "model": F.lit("ENSEMBLE")})
    scored = sc.score_scales(grid, "value", {k: thresholds("HS", k) for k in ("5", "10")})
    cells = _zones(spark, sf, "coverage")
    return _rounded_stats(aggregate_hazard(_staged(scored, "scored"), cells, "HS"))


def _heat_of_countries(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Scores with two statistics and doubled coordinates: what tidying decides must not depend on a clip."""
    grid = view(spark, sf, "grid_fx").drop("rp")
    both = grid.select("*", F.explode(F.array(F.lit("max"), F.lit("min"))).alias("statistic"))
    both = both.withColumn("value", F.when(F.col("statistic") == "max", F.col("value")).otherwise(F.col("value") / 2))
    both = both.withColumn("lat", F.when(F.col("lat_idx") == 41, 40.5).otherwise(F.col("lat")))
    scored = sc.score_scales(both, "value", {"5": thresholds("HS", "5")})
    return _rounded_stats(aggregate_hazard(_staged(scored, "scored"), _zones(spark, sf, "center"), "HS", **options))


@query
def aggregate_clip(spark: SparkSession, sf: str) -> DataFrame:
    return _heat_of_countries(spark, sf, countries=("NATION_7", "NATION_8"), clip=True)


@query
def aggregate_countries(spark: SparkSession, sf: str) -> DataFrame:
    # Without ``mean`` the first statistic in the stated order counts.
    return _heat_of_countries(spark, sf, skip=("NATION_3", "NATION_5"), order=("min", "max"))


@query
def combined_first(spark: SparkSession, sf: str) -> DataFrame:
    """Several values for a zone, hazard and time: the first one present in a stated order."""
    stats = view(spark, sf, "stats_fx").withColumn("rank", F.when(F.col("scenario") == "RCP45", 1).otherwise(2))
    doubled = stats.filter("scenario <> 'HISTORICAL'").withColumn("scenario", F.lit("RCP85"))
    doubled = doubled.withColumn("score_mean", F.when((F.col("rank") == 2) | (F.col("time") != "Mt"), F.col("score_mean")))
    tables = combine({1: _staged(doubled, "stats")}, {1: view(spark, sf, "zones_fx")}, (1,), ("RCP85",), ("5",), ord_by=("rank",), stat_names=("mean",))
    return tables[1, "5", "mean", "RCP85"]


@query
def aggregate_rf(spark: SparkSession, sf: str) -> DataFrame:
    scored = _staged(_flood_scores(spark, sf, score_rf), "scored")
    cells = _zones(spark, sf, "center")
    return _rounded_stats(aggregate_hazard(scored, cells, "RF"))


@query
def aggregate_cf(spark: SparkSession, sf: str) -> DataFrame:
    scored = _staged(_flood_scores(spark, sf, score_cf), "scored")
    cells = _zones(spark, sf, "center")
    return _rounded_stats(aggregate_hazard(scored, cells, "CF", 1, view(spark, sf, "coarse_coast_fx")))


def _combined(spark: SparkSession, sf: str, scale: str, stat: str, scenario: str, level: int = 1) -> DataFrame:
    # The job reads the statistics that aggregation wrote.
    stats = _staged(view(spark, sf, "stats_fx" if level == 1 else "country_stats_fx"), "stats")
    meta = view(spark, sf, "zones_fx" if level == 1 else "countries_fx")
    scenarios = ("RCP45", "RCP85") if scale == "100" else (scenario,)
    return combine({level: stats}, {level: meta}, (level,), scenarios, (scale,))[level, scale, stat, scenario]


@query
def combined_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _combined(spark, sf, "5", "mean", "RCP85")


@query
def combined_max(spark: SparkSession, sf: str) -> DataFrame:
    return _combined(spark, sf, "10", "max", "RCP45")


@query
def combined_std(spark: SparkSession, sf: str) -> DataFrame:
    return _combined(spark, sf, "10", "std", "RCP85")


@query
def combined_hundred(spark: SparkSession, sf: str) -> DataFrame:
    return _combined(spark, sf, "100", "mean", "RCP45")


@query
def combined_country(spark: SparkSession, sf: str) -> DataFrame:
    return _combined(spark, sf, "5", "mean", "RCP45", level=0)


@query
def combined_district(spark: SparkSession, sf: str) -> DataFrame:
    """Level 2: districts rasterised, aggregated and combined under their own ids."""
    zones = view(spark, sf, "districts_fx").drop("half")
    cells = _staged(geo.zone_runs(view(spark, sf, "district_edges_fx"), raster(spark, sf), "center"), "zone-cells-adm2")
    stats = _staged(aggregate_hazard(_staged(_heat_scores(spark, sf), "scored"), cells, "HS", 2), "stats")
    return combine({2: stats}, {2: zones}, (2,), ("RCP85",), ("5",))[2, "5", "mean", "RCP85"]


#: Hazards scored from the return period of the cells; the others are from their value.
RETURN_PERIODS = ("CF", "RF", "TC", "TS")


def _run_inputs(spark: SparkSession, sf: str) -> dict[str, Callable[[], dict]]:
    """Every hazard's cells with its own variable, and the static rasters of those that need one."""
    grid = stage.stage(view(spark, sf, "hazard_grid_fx"), "hazard-grid", reuse=False)
    static = view(spark, sf, "static_fx")

    def opened(code: str) -> dict:
        cells = grid.filter(F.col("hazard") == code).drop("hazard")
        variable = "rp" if code in RETURN_PERIODS else "value"
        cells = cells.withColumn("v", F.col(variable) / {"HP": 64, "SUB": 10}.get(code, 1))
        out = {"cells": cells.select("scenario", "time", *CELL, "lat", "lon", "v"), "value": "v"}
        if SETTINGS[code].kind.startswith("special_"):
            out |= {"static": static, "static_col": "protection"}
        if code == "WF":
            out |= {"raster": raster(spark, sf)}
        return out

    return {code: lambda code=code: opened(code) for code in HAZARDS}


def _full_run(spark: SparkSession, sf: str, scales: tuple[str, ...], scenarios: tuple[str, ...], stats: tuple[str, ...], **options) -> dict[tuple[str, str, str], DataFrame]:
    """The tables a whole run has written, by scale, statistic and scenario."""
    zones = view(spark, sf, "zones_fx")
    with stage.staging(spark):  # the grid that the inputs are read from goes with the run
        tables = full_run(
            spark, _run_inputs(spark, sf), {1: geo.zone_runs(view(spark, sf, "edges_fx"), raster(spark, sf), "center")}, {1: zones}, _folder(spark, "run"), scales, coast=view(spark, sf, "coarse_coast_fx"),
            scenarios=scenarios, stat_names=stats, zones={1: zones.select(F.col("GID_1").alias("gadm_id"), F.col("GID_0").alias("gid0"))}, **options,
        )
    return {key[1:]: table for key, table in tables.items()}


@query
def full_run_five(spark: SparkSession, sf: str) -> DataFrame:
    return _full_run(spark, sf, ("5",), ("RCP85",), ("mean",))["5", "mean", "RCP85"]


@query
def full_run_hundred(spark: SparkSession, sf: str) -> DataFrame:
    return _full_run(spark, sf, ("100",), ("RCP45", "RCP85"), ("mean",))["100", "mean", "RCP85"]


@query
def full_run_ten(spark: SparkSession, sf: str) -> DataFrame:
    """The floods on the 10-point scale, whose bins are calibrated from the run's own risk."""
    return _full_run(spark, sf, ("10",), ("RCP85",), ("mean",), hazards=("CF", "RF"), calibrate=True)["10", "mean", "RCP85"]


@query
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run: score every hazard, aggregate to provinces, combine to all twelve wide tables."""
    tables = _full_run(spark, sf, ("5", "100"), ("RCP45", "RCP85"), ("mean", "max", "std"))
    named = [
        table.select(F.lit(scale).alias("scale"), F.lit(stat).alias("stat"), F.lit(scenario).alias("scenario"),
                     *[F.col(c).cast("double") if c in HAZARD_COLUMNS else c for c in table.columns])
        for (scale, stat, scenario), table in tables.items()
    ]
    return reduce(DataFrame.unionByName, named)
