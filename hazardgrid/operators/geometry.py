"""Polygon ↔ cell joins on ring edges, by relational scanline.

Zones come as one row per ring edge (``gadm_id, gid0, part, ring, seq, x1, y1, x2, y2``, in
degrees; ring 0 of a part is its outline, the others are its holes). Edges are dealt by zone and band of raster rows; only
there every edge is exploded over the rows it crosses and contributes a change of coverage at a column, so that no
task's memory hangs on how the edges' files are split or how far an edge reaches. A running sum
along the row, from one sort, gives the coverage, and runs of equal coverage are widened to cells.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardgrid.functions import nonzero
from hazardgrid.schema import ZONE, GridSpec

# The readers below run on executors, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-9  # running sums of fractions leave rounding dust
BAND = 32  # raster rows of a band


def read_wkb(wkb: bytes) -> list[tuple[int, int, np.ndarray]]:
    """Rings of a WKB polygon or multipolygon: part, ring and its points as an n × 2 array.

    Further coordinates (height, measure) are read over; an empty geometry has no rings.
    """
    rings, at, part = [], 0, 0

    def number(order: str) -> int:
        nonlocal at
        at += 4
        return int(np.frombuffer(wkb, f"{order}u4", 1, at - 4)[0])

    def geometry() -> None:
        nonlocal at, part
        order = "<" if wkb[at] else ">"
        at += 1
        kind = number(order)
        if kind & 0x20000000:  # a reference system comes first
            number(order)
        width = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        kind &= 0x0FFFFFFF
        width, kind = max(width, {0: 2, 1: 3, 2: 3, 3: 4}[kind // 1000]), kind % 1000
        if kind == 6:
            for _ in range(number(order)):
                geometry()
        elif kind == 3:
            for ring in range(number(order)):
                n = number(order)
                points = np.frombuffer(wkb, f"{order}f8", n * width, at).reshape(n, width)[:, :2]
                at += 8 * n * width
                rings.append((part, ring, points.astype("<f8")))
            part += 1
        else:
            raise ValueError(f"geometry type {kind} is no polygon")

    if wkb:
        geometry()
    return rings


def write_wkb(rings: list[tuple[int, int, np.ndarray]]) -> bytes:
    """A WKB multipolygon of rings given as part, ring and points; rings are closed if they aren't."""
    parts: dict[int, list[np.ndarray]] = {}
    for part, _, points in sorted(rings, key=lambda r: r[:2]):
        points = np.asarray(points, "<f8").reshape(-1, 2)
        closed = len(points) and (points[0] == points[-1]).all()
        parts.setdefault(part, []).append(points if closed else np.concatenate([points, points[:1]]))
    head = np.array([6, len(parts)], "<u4").tobytes()
    body = [b"\x01" + np.array([3, len(held)], "<u4").tobytes() + b"".join(np.array([len(p)], "<u4").tobytes() + p.tobytes() for p in held) for held in parts.values()]
    return b"\x01" + head + b"".join(body)


def zone_rings(zones: DataFrame, zone_id: str, geometry: str = "geometry") -> DataFrame:
    """Rings of zones whose boundary is a WKB polygon or multipolygon: the input of ``ring_edges``.

    One zone at a time, its points as arrays; a zone without geometry has no rings.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, wkb in enumerate(batch.column(2)):
                rings = read_wkb(wkb.as_py() or b"")
                if not rings:
                    continue
                sizes = np.cumsum([0, *[len(p) for _, _, p in rings]])
                points = np.concatenate([p for _, _, p in rings])
                pairs = pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], ["x", "y"])
                owner = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.repeat(owner.column(k)[0], len(rings)) for k in range(2)],
                        pa.array([p for p, _, _ in rings], pa.int32()), pa.array([r for _, r, _ in rings], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs),
                    ],
                    names=[*ZONE, "part", "ring", "points"],
                )

    rows = zones.select(F.col(zone_id).cast("string").alias("gadm_id"), F.col("GID_0").cast("string").alias("gid0"), geometry)
    return rows.mapInArrow(parse, "gadm_id string, gid0 string, part int, ring int, points array<struct<x double, y double>>")


def ring_edges(rings: DataFrame) -> DataFrame:
    """Edges of rings given as one row per ring with ``points ARRAY<STRUCT<x, y>>``.

    Rings may or may not repeat their first point at the end; zero-length edges are dropped.
    """
    pts = F.col("points")
    following = F.concat(F.slice(pts, 2, F.size(pts) - 1), F.slice(pts, 1, 1))
    pairs = F.arrays_zip(pts.alias("a"), following.alias("b"))
    edge = rings.select(*ZONE, "part", "ring", F.posexplode(pairs).alias("seq", "e"))
    return edge.select(
        *ZONE, "part", "ring", "seq",
        F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"),
    ).filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def zone_bounds(edges: DataFrame) -> DataFrame:
    """Bounding box of every zone."""
    return edges.groupBy(*ZONE).agg(
        F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"),
        F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"),
    )


def bbox_filter(cells: DataFrame, minx: float, miny: float, maxx: float, maxy: float, pad: float = 0.5) -> DataFrame:
    """Cells inside a box widened by ``pad`` degrees; literal bounds reach the Parquet scan."""
    return cells.filter(F.col("lat").between(miny - pad, maxy + pad) & F.col("lon").between(minx - pad, maxx + pad))


def _grid_units(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Edges in grid units, pointing upwards, with the original direction as ``sign``."""
    x1, y1 = grid.x(F.col("x1")), grid.y(F.col("y1"))
    x2, y2 = grid.x(F.col("x2")), grid.y(F.col("y2"))
    rest = [c for c in ("part", "ring") if c in edges.columns]
    up = edges.select(*ZONE, *rest, x1.alias("ax"), y1.alias("ay"), x2.alias("bx"), y2.alias("by"))
    flip = F.col("ay") > F.col("by")

    def pick(a: str, b: str) -> Column:
        return F.when(flip, F.col(b)).otherwise(F.col(a))

    return up.select(
        *ZONE, *rest,
        F.when(flip, -1.0).otherwise(1.0).alias("sign"),
        pick("ax", "bx").alias("x1"), pick("ay", "by").alias("y1"),
        pick("bx", "ax").alias("x2"), pick("by", "ay").alias("y2"),
    )


def _wound(e: DataFrame) -> DataFrame:
    """Edges in grid units signed so that outlines add coverage and holes take it away.

    Files don't agree on which way round rings run. The signed area of a ring, one grouped
    aggregate, tells; a ring without area has no sign and no effect.
    """
    ring = [*ZONE, "part", "ring"]
    twice = F.col("sign") * (F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    # Dealt once for the aggregate and the join; summed where they are read, short rings would fill a split's memory.
    e = _dealt(e, *ring)
    turns = e.groupBy(*ring).agg(F.signum(F.sum(twice)).alias("_turn"))
    # An edge covers what lies to its right, so an outline counts when it runs clockwise.
    wanted = F.when(F.col("ring") == 0, -1.0).otherwise(1.0)
    return e.join(turns, ring).withColumn("sign", F.col("sign") * F.col("_turn") * wanted).drop("_turn")


def _whole(c: Column) -> Column:
    return c.cast("int")


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to as many partitions as the session has: what becomes of a row takes more memory than what is shuffled tells."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _over(lo: Column, hi: Column, size: int) -> Column:
    """Integers lo…hi that lie on the raster; an empty list when there are none."""
    first, last = F.greatest(lo, F.lit(0)), F.least(hi, F.lit(size - 1))
    return F.when(first <= last, F.sequence(first, last))


def _banded(e: DataFrame, grid: GridSpec) -> DataFrame:
    """Edges (grid units) dealt by zone and band of raster rows, once for each band they touch.

    All that is made of an edge row by row stays in its zone's band, where the windows find it; what moves
    is the edges, however many rows and columns they cross.
    """
    first, last = _whole(F.floor("y1")), F.greatest(_whole(F.floor("y1")), _whole(F.ceil("y2")) - 1)
    first, last = F.greatest(first, F.lit(0)), F.least(last, F.lit(grid.n_lat - 1))
    bands = F.when(first <= last, F.sequence(_whole(F.floor(first / BAND)), _whole(F.floor(last / BAND))))
    return _dealt(e.withColumn("_band", F.explode(bands)), *ZONE, "_band")


def _rows_of_band(lo: Column, hi: Column, grid: GridSpec) -> Column:
    """Rows lo…hi that lie on the raster and in the edge's band."""
    start = F.col("_band") * BAND
    return _over(F.greatest(lo, start), F.least(hi, start + (BAND - 1)), grid.n_lat)


def _row_pieces(e: DataFrame, grid: GridSpec) -> DataFrame:
    """Every edge (``_banded``) cut at the raster rows: column range and height inside each row."""
    rows = _rows_of_band(_whole(F.floor("y1")), F.greatest(_whole(F.floor("y1")), _whole(F.ceil("y2")) - 1), grid)
    slope = (F.col("x2") - F.col("x1")) / nonzero(F.col("y2") - F.col("y1"))
    e = e.withColumn("slope", slope).withColumn("lat_idx", F.explode(rows))
    ya, yb = F.greatest("y1", F.col("lat_idx").cast("double")), F.least("y2", (F.col("lat_idx") + 1).cast("double"))
    level = F.col("slope").isNull()
    xa = F.when(level, F.col("x1")).otherwise(F.col("x1") + (ya - F.col("y1")) * F.col("slope"))
    xb = F.when(level, F.col("x2")).otherwise(F.col("x1") + (yb - F.col("y1")) * F.col("slope"))
    return e.select(
        *ZONE, "_band", "lat_idx", "sign", (yb - ya).alias("dy"), F.least(xa, xb).alias("xlo"), F.greatest(xa, xb).alias("xhi")
    )


def _center_changes(e: DataFrame, grid: GridSpec) -> DataFrame:
    """Where a row's centre line crosses an edge (``_banded``): +1 from the first cell centre at or behind it."""
    rows = _rows_of_band(_whole(F.ceil(F.col("y1") - 0.5)), _whole(F.ceil(F.col("y2") - 0.5)) - 1, grid)
    e = e.withColumn("lat_idx", F.explode(rows))
    x = F.col("x1") + (F.col("lat_idx") + 0.5 - F.col("y1")) * (
        (F.col("x2") - F.col("x1")) / nonzero(F.col("y2") - F.col("y1"))
    )
    column = F.greatest(_whole(F.ceil(x - 0.5)), F.lit(0))
    return e.select(*ZONE, "_band", "lat_idx", column.alias("lon_idx"), F.lit(1.0).alias("change")).filter(
        F.col("lon_idx") < grid.n_lon
    )


def _covered_right(column: Column) -> Column:
    """Area of one cell that lies to the right of an edge piece, per unit of signed height."""
    xlo, xhi = F.col("xlo"), F.col("xhi")
    width = nonzero(xhi - xlo)

    def share_below(x: Column) -> Column:  # share of the piece's height where it runs left of x
        part = F.least(F.greatest((x - xlo) / width, F.lit(0.0)), F.lit(1.0))
        return F.when(xhi > xlo, part).otherwise(F.when(xlo < x, 1.0).otherwise(0.0))

    left_edge, right_edge = column.cast("double"), (column + 1).cast("double")
    before, upto = share_below(left_edge), share_below(right_edge)
    middle = (F.least(F.greatest(xlo, left_edge), right_edge) + F.greatest(F.least(xhi, right_edge), left_edge)) / 2
    return before + (upto - before) * (right_edge - middle)


def _coverage_changes(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Change of the exact covered area from one cell to the next along a raster row."""
    pieces = _row_pieces(_banded(_wound(_grid_units(edges, grid)), grid), grid).filter("dy > 0")
    first, last = _whole(F.floor("xlo")), _whole(F.floor("xhi")) + 1
    columns = _over(F.least(first, F.lit(grid.n_lon)), F.greatest(last, F.lit(0)), grid.n_lon)
    at = pieces.withColumn("lon_idx", F.explode(columns))
    here = _covered_right(F.col("lon_idx"))
    before = F.when(F.col("lon_idx") == 0, 0.0).otherwise(_covered_right(F.col("lon_idx") - 1))
    return at.select(*ZONE, "_band", "lat_idx", "lon_idx", (F.col("sign") * F.col("dy") * (here - before)).alias("change"))


def _runs(changes: DataFrame, grid: GridSpec, coverage) -> DataFrame:
    """Sum changes up to each column of the row: stretches of cells with one coverage.

    One sort, where the edges were dealt. Summing by column first would hold all that a task's edges
    cover; changes of one column are peers of the running sum instead, of which the last stays.
    """
    row = [*ZONE, "lat_idx"]
    along = Window.partitionBy(*ZONE, "_band", "lat_idx").orderBy("lon_idx")
    return (
        changes.select(
            *row, "lon_idx",
            F.sum("change").over(along.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("level"),
            (F.lead("lon_idx", 1, grid.n_lon).over(along) - 1).alias("lon_end"),
        )
        .filter(F.col("lon_end") >= F.col("lon_idx"))
        .select(*row, "lon_idx", "lon_end", coverage(F.col("level")).alias("coverage"))
        .filter(F.col("coverage") > _TINY)
    )


def _merged(runs: DataFrame) -> DataFrame:
    """Runs that overlap or touch as one, from one shuffle and one sort."""
    row = [*ZONE, "lat_idx"]
    along = Window.partitionBy(*row).orderBy("lon_idx")
    before = F.max("lon_end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    end = F.max("lon_end").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    placed = _dealt(runs.select(*row, "lon_idx", "lon_end"), *row).withColumns({"_before": before, "_end": end})
    first = placed.filter(F.col("_before").isNull() | (F.col("lon_idx") > F.col("_before") + 1))
    return first.select(*row, "lon_idx", F.coalesce(F.lead("_before").over(along), F.col("_end")).alias("lon_end"))


def cells_of(zones: DataFrame) -> DataFrame:
    """Zone cells one by one, from runs or from cells."""
    if "lon_end" not in zones.columns:
        return zones
    return zones.withColumn("lon_idx", F.explode(F.sequence("lon_idx", "lon_end"))).drop("lon_end")


def runs_of(cells: DataFrame) -> DataFrame:
    """Zone cells as runs: neighbours in a raster row that have one coverage."""
    alike = Window.partitionBy(*ZONE, "lat_idx", "coverage").orderBy("lon_idx")
    island = cells.withColumn("_island", F.col("lon_idx") - F.row_number().over(alike))
    runs = island.groupBy(*ZONE, "lat_idx", "coverage", "_island").agg(F.min("lon_idx").alias("lon_idx"), F.max("lon_idx").alias("lon_end"))
    return runs.select(*ZONE, "lat_idx", "lon_idx", "lon_end", "coverage")


def zone_runs(edges: DataFrame, grid: GridSpec, mode: str = "coverage") -> DataFrame:
    """``zone_cells`` as runs: ``gadm_id, gid0, lat_idx, lon_idx, lon_end, coverage``, both ends included.

    The inside of a zone is one run per raster row, and only cells that an edge passes through are runs of their
    own: a table that grows with the length of the boundaries instead of the area. Zonal statistics
    take it in place of the cells.
    """
    if mode == "coverage":
        return _runs(_coverage_changes(edges, grid), grid, lambda level: F.least(level, F.lit(1.0)))
    banded = _banded(_grid_units(edges, grid), grid)
    inside = _runs(_center_changes(banded, grid), grid, lambda level: level % 2)
    if mode == "center":
        return inside
    if mode == "all_touched":
        first, last = F.greatest(_whole(F.floor("xlo")), F.lit(0)), F.least(_whole(F.floor("xhi")), F.lit(grid.n_lon - 1))
        touched = _row_pieces(banded, grid).select(*ZONE, "lat_idx", first.alias("lon_idx"), last.alias("lon_end"))
        touched = touched.filter(F.col("lon_idx") <= F.col("lon_end"))
        return _merged(inside.drop("coverage").unionByName(touched)).withColumn("coverage", F.lit(1.0))
    raise ValueError(f"unknown mode {mode!r}")


def zone_cells(edges: DataFrame, grid: GridSpec, mode: str = "coverage") -> DataFrame:
    """Cells of every zone with their weight: ``gadm_id, gid0, lat_idx, lon_idx, coverage``.

    * ``center`` – cells whose centre lies inside (even-odd rule), weight 1;
    * ``all_touched`` – these and every cell an edge passes through, weight 1;
    * ``coverage`` – every cell with the exact share of its area inside. Which way round a ring runs
      does not matter; ring 0 of a part is its outline, the others are holes in it.
    """
    return cells_of(zone_runs(edges, grid, mode))


def zones_in_bbox(edges: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Zones that intersect a box, touching included: an edge meets the box, or the box lies inside.

    One grouped aggregate over the edges; no zone's outline is gathered anywhere.
    """
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    dx, dy = x2 - x1, y2 - y1

    def slab(a: Column, d: Column, lo: float, hi: float) -> tuple[Column, Column]:
        """Part of the edge (0…1) within one slab of the box; an empty range when outside."""
        t1, t2 = (F.lit(lo) - a) / nonzero(d), (F.lit(hi) - a) / nonzero(d)
        within = a.between(lo, hi)
        enter = F.when(d == 0, F.when(within, 0.0).otherwise(2.0)).otherwise(F.least(t1, t2))
        leave = F.when(d == 0, F.when(within, 1.0).otherwise(-1.0)).otherwise(F.greatest(t1, t2))
        return enter, leave

    (ex, lx), (ey, ly) = slab(x1, dx, minx, maxx), slab(y1, dy, miny, maxy)
    meets = F.greatest(ex, ey, F.lit(0.0)) <= F.least(lx, ly, F.lit(1.0))
    straddles = (y1 <= miny) != (y2 <= miny)
    left_of_corner = x1 + (F.lit(miny) - y1) * dx / nonzero(dy) <= minx
    return (
        edges.groupBy(*ZONE)
        .agg(F.bool_or(meets).alias("_meets"), F.count(F.when(straddles & left_of_corner, 1)).alias("_crossings"))
        .filter(F.col("_meets") | (F.col("_crossings") % 2 == 1))
        .select(*ZONE)
    )
