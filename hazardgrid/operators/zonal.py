"""Zonal statistics of scores."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid.functions import nonzero
from hazardgrid.schema import CELL, ZONE, labels_of

log = logging.getLogger(__name__)

TILE = 32  # raster rows and columns of a tile


def join_cells(cells: DataFrame, zone_cells: DataFrame, tiles: bool = False) -> DataFrame:
    """Cells with the zones they belong to and their weight; with ``tiles`` also their tile (``_row``, ``_column``).

    Both sides meet by square tiles of the raster: a task then sees few zones, so the aggregate that
    follows combines nearly everything before its shuffle, where cells scattered one by one would
    leave a row per zone in every task. Tiles hold the same number of cells, so none is hot. The
    session must accept a partitioning by part of the join keys for that; one that doesn't is set to.
    Moments made in a tile take more memory than what is shuffled tells, so with ``tiles`` partitions stay as many as the session's.

    Zones as runs (``zone_runs``) are cut at the tiles and joined as runs: a cell meets the few runs of its
    raster row within its tile, and those that hold its column stay. They are never widened to cells.
    """
    cells.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    tile = {"_row": F.floor(F.col("lat_idx") / TILE), "_column": F.floor(F.col("lon_idx") / TILE)}
    gone = [] if tiles else [*tile]
    weights = zone_columns(zone_cells)
    parts = [int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))] if tiles else []
    left = cells.withColumns(tile).repartition(*parts, *tile)
    if "lon_end" not in weights.columns:
        return left.join(weights.withColumns(tile).repartition(*parts, *tile), [*tile, *CELL]).drop(*gone)
    crossed = F.sequence(F.floor(F.col("lon_idx") / TILE), F.floor(F.col("lon_end") / TILE))
    cut = weights.select(*ZONE, "coverage", F.col("lat_idx").alias("_lat"), "lon_idx", "lon_end", tile["_row"].alias("_of_row"), F.explode(crossed).alias("_of_column"))
    start, stop = F.col("_of_column") * TILE, F.col("_of_column") * TILE + (TILE - 1)
    runs = cut.withColumns({"_from": F.greatest(F.col("lon_idx"), start), "_to": F.least(F.col("lon_end"), stop)}).drop("lon_idx", "lon_end")
    runs = runs.repartition(*parts, "_of_row", "_of_column")
    same = (F.col("_row") == F.col("_of_row")) & (F.col("_column") == F.col("_of_column")) & (F.col("lat_idx") == F.col("_lat"))
    return left.join(runs, same & F.col("lon_idx").between(F.col("_from"), F.col("_to"))).drop(*gone, "_of_row", "_of_column", "_lat", "_from", "_to")


def zone_columns(zones: DataFrame) -> DataFrame:
    """The columns of zone cells, or of runs of them."""
    return zones.select(*ZONE, *CELL, *[c for c in ("lon_end",) if c in zones.columns], "coverage")


def cell_count(zones: DataFrame) -> Column:
    """How many cells a row of zone cells stands for."""
    return F.col("lon_end") - F.col("lon_idx") + 1 if "lon_end" in zones.columns else F.lit(1)


def zone_box(zone_cells: DataFrame) -> dict[str, int] | None:
    """Rows and columns that the zones cover, one row to the driver; None without cells."""
    box = zone_cells.agg(
        F.min("lat_idx").alias("top"), F.max("lat_idx").alias("bottom"),
        F.min("lon_idx").alias("left"), F.max("lon_end" if "lon_end" in zone_cells.columns else "lon_idx").alias("right"),
    ).first()
    return None if box["top"] is None else box.asDict()


def clip_to_zones(cells: DataFrame, zone_cells: DataFrame) -> DataFrame:
    """Cells inside the box of rows and columns that the zones cover.

    For runs over some countries of a global grid: the bounds come back as one row and go into the
    plan as literals, so that Parquet skips every row group outside. Zones without cells keep none.
    """
    box = zone_box(zone_cells)
    if box is None:
        log.warning("no zone has a cell: nothing to clip to")
        return cells.filter(F.lit(False))
    return cells.filter(F.col("lat_idx").between(box["top"], box["bottom"]) & F.col("lon_idx").between(box["left"], box["right"]))


def labels_by_zone(zones: DataFrame, df: DataFrame, labels: list[str]) -> DataFrame:
    """Every zone with every label combination of a frame.

    The combinations are a few dozen at most; they travel as one scalar array, not as a join.
    """
    combos = df.select(*labels).distinct().agg(F.collect_list(F.struct(*labels))).scalar()
    return zones.select("*", F.inline(combos))


def label_codes(combos: DataFrame, labels: list[str]) -> tuple[DataFrame, Column]:
    """Label combinations with a number each (``_code``), and all of them as one scalar array to look a number up in.

    Grouping and shuffling a number costs a fraction of what several texts do. The combinations, a few dozen a hazard,
    come to the driver; a row with a missing label joins none of them.
    """
    rows = sorted({tuple(r) for r in combos.select(*labels).collect()}, key=str)
    schema = T.StructType([T.StructField("_code", T.IntegerType()), *[combos.schema[c] for c in labels]])
    codes = combos.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    return codes, codes.agg(F.sort_array(F.collect_list(F.struct("_code", *labels)))).scalar()


def moments(value: str, name: str) -> list[Column]:
    """One-pass aggregates of a weighted value, all combinable."""
    s, w = F.col(value), F.col("coverage")
    w = F.when(s.isNotNull(), w)
    return [
        F.count(s).alias(f"n_{name}"),
        F.sum(w).alias(f"w_{name}"),
        F.sum(w * s).alias(f"ws_{name}"),
        F.max(s).alias(f"max_{name}"),
        F.covar_pop(w * s, s).alias(f"c2_{name}"),
        F.covar_pop(w, s).alias(f"c1_{name}"),
    ]


def _squares(n: Column, name: str) -> Column:
    """Σw(s-μ)² = n·(cov(ws, s) - μ·cov(w, s)): centred co-moments have no cancellation, as a difference of squares has."""
    mean = F.col(f"ws_{name}") / nonzero(F.col(f"w_{name}"))
    return F.greatest(n * (F.col(f"c2_{name}") - mean * F.col(f"c1_{name}")), F.lit(0.0))


def zone_moments(
    cells: DataFrame, zone_cells: DataFrame, labels: list[str], values: dict[str, str], others: dict[str, tuple[Callable, Column]] | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Moments of columns by zone and labels: ``n``, ``w``, ``ws``, ``max`` and ``m2`` (Σw(s-μ)²) of each, with its name behind.

    ``values`` maps names to columns of ``cells``; ``others`` maps names to sums or maxima of expressions. A tile's rows are
    where the join left them, so its moments are whole before anything is shuffled. Only these five
    numbers move, once, to their zone, where what is joined by zone lies as well; tiles are
    merged there, by their means. Partitions stay as many as the session's there, too.

    ``wanted`` names the zones and labels to report, with columns of their own (``zone_weight``): its rows are gathered with those
    of the tiles, which is a join on all keys without a sort of either side. Rows without a key meet none of the tiles'.
    """
    others = others or {}
    keys = [*ZONE, *labels]
    first = [m for name, c in values.items() for m in moments(c, name)] + [f(c).alias(name) for name, (f, c) in others.items()]
    tiles = join_cells(cells, zone_cells, tiles=True).groupBy("_row", "_column", *keys).agg(*first)
    whole = [c for name in values for c in (f"n_{name}", f"w_{name}", f"ws_{name}", f"max_{name}", _squares(F.col(f"n_{name}"), name).alias(f"m2_{name}"))]
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.select(*keys, *whole, *others)
    own = [] if wanted is None else [c for c in wanted.columns if c not in keys]
    dealt = (dealt if wanted is None else dealt.dropna("any", subset=keys)).repartition(parts, *ZONE)
    if wanted is not None:
        dealt = dealt.unionByName(wanted.withColumn("_wanted", F.lit(True)), allowMissingColumns=True)
    merged = [F.max(c).alias(c) for c in (*own, "_wanted") if wanted is not None]
    for name in values:
        n, w, ws = (f"{c}_{name}" for c in ("n", "w", "ws"))
        mean = F.col(ws) / nonzero(F.col(w))
        merged += [F.sum(n).alias(n), F.sum(w).alias(w), F.sum(ws).alias(ws), F.max(f"max_{name}").alias(f"max_{name}"), F.sum(f"m2_{name}").alias(f"m2_{name}")]
        merged += [F.count(mean).alias(f"k_{name}"), F.covar_pop(F.col(ws), mean).alias(f"c2_{name}"), F.covar_pop(F.col(w), mean).alias(f"c1_{name}")]
    zones = dealt.groupBy(*keys).agg(*merged, *[f(name).alias(name) for name, (f, _) in others.items()])
    zones = zones if wanted is None else zones.filter("_wanted").drop("_wanted")
    between = {f"m2_{name}": F.col(f"m2_{name}") + _squares(F.col(f"k_{name}"), name) for name in values}
    return zones.withColumns(between).drop(*[f"{c}_{name}" for name in values for c in ("k", "c1", "c2")])


def statistics(name: str, missing: str) -> list[Column]:
    """Mean, max and population standard deviation from the moments of ``zone_moments``.

    Zero filling needs no extra rows: the absent part of the zone is one block of zeros, merged in closed form.
    """
    n, w, mean = F.col(f"n_{name}"), F.col(f"w_{name}"), F.col(f"ws_{name}") / nonzero(F.col(f"w_{name}"))
    m2 = F.col(f"m2_{name}")
    peak = F.col(f"max_{name}")
    if missing == "zero":
        total = F.col("zone_weight")
        w, mean, m2 = (F.coalesce(c, F.lit(0.0)) for c in (w, mean, m2))
        partial = F.coalesce(n, F.lit(0)) < F.col("zone_cells")
        absent = F.when(partial, total - w).otherwise(0.0)
        m2 = m2 + w * absent / total * mean * mean
        peak = F.when(partial, F.greatest(F.coalesce(peak, F.lit(0.0)), F.lit(0.0))).otherwise(peak)
        # The sum over the whole weight, not the mean of a part scaled down: exact where the sum is.
        w, mean = total, F.when(partial, F.coalesce(F.col(f"ws_{name}"), F.lit(0.0)) / total).otherwise(mean)
    spread = F.sqrt(m2 / nonzero(w))
    return [mean.alias("score_mean"), peak.cast("double").alias("score_max"), spread.alias("score_stdev")]


def zonal_multi(
    df: DataFrame,
    zone_cells: DataFrame,
    values: dict[str, str],
    missing: str = "skip",
    labels: list[str] | None = None,
    combos: DataFrame | None = None,
) -> DataFrame:
    """Zonal statistics of several columns from one join and one grouped aggregate.

    ``values`` maps the ``scoring`` label of the result to the column it comes from. Keeping the
    scales as columns until the statistics are small saves a shuffle of the cells per scale.

    ``zone_cells`` (cells or runs) is read twice when zeros are filled in; hazards share it, so stage it first.

    ``missing='skip'`` leaves missing cells out, and zones without a value with them;
    ``missing='zero'`` counts every cell of the zone, missing or absent ones as 0, for every label
    combination in ``combos`` (a frame that lists them more cheaply than ``df``, by default ``df``).
    """
    if missing not in ("skip", "zero"):
        raise ValueError(f"unknown missing mode {missing!r}")
    labels = labels_of(df) if labels is None else labels
    columns = list(dict.fromkeys(values.values()))
    some = F.coalesce(*[F.col(c).cast("double") for c in columns]).isNotNull()
    cells = df.filter(some).select(*CELL, *labels, *columns)
    weights, width = zone_columns(zone_cells), cell_count(zone_cells)
    shown = [F.col(c) for c in labels]
    names, wanted = labels, None
    if missing == "zero":
        zones = weights.groupBy(*ZONE).agg(F.sum(F.col("coverage") * width).alias("zone_weight"), F.sum(width).alias("zone_cells"))
        # Few rows, dealt as the moments are; the labels are made where they meet them.
        zones = zones.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *ZONE)
        if combos is not None and labels:
            codes, coded = label_codes(combos, labels)
            cells, names = cells.join(F.broadcast(codes), labels).drop(*labels), ["_code"]
            shown = [coded[F.col("_code")][c].alias(c) for c in labels]
            wanted = zones.select("*", F.posexplode(coded).alias("_code", "_labels")).drop("_labels")
        else:
            wanted = labels_by_zone(zones, df, labels) if labels else zones
    sums = zone_moments(cells, weights, names, {c: c for c in columns}, wanted=wanted)
    results = [
        F.struct(F.lit(label).alias("scoring"), *statistics(column, missing)) for label, column in values.items()
    ]
    out = sums.select(*ZONE, *shown, F.inline(F.array(*results)))
    return out if missing == "zero" else out.filter(F.col("score_mean").isNotNull())


def zonal_stats(
    scored: DataFrame, zone_cells: DataFrame, missing: str = "skip", value: str = "score", combos: DataFrame | None = None
) -> DataFrame:
    """Mean, max and standard deviation per zone and label combination, weighted by coverage.

    The join key is the cell, which no zone or hazard can skew; the aggregate by zone combines
    before its shuffle, so a zone that holds a third of all cells costs no more than another.
    """
    labels = labels_of(scored)
    stats = zonal_multi(scored.withColumnRenamed("scoring", "_scale"), zone_cells, {"": value}, missing,
                        ["_scale" if c == "scoring" else c for c in labels],
                        None if combos is None else combos.withColumnRenamed("scoring", "_scale"))
    return stats.drop("scoring").withColumnRenamed("_scale", "scoring")
