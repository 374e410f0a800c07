"""Near-duplicate vectors by PCA-ordered tiled comparison."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import components, local_components, saved

_SLACK = 1e-9  # bounds are loosened and close calls settled again by this much


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, safe from overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Axes of the unit vectors' second moments, strongest first, from all vectors of ``dim`` components.

    A task adds up its own dim × dim moments; Spark adds up the tasks'. The driver gets dim² numbers.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if len(batch):
                u = unit_rows(_matrix(batch.column(0)))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["at", "moment"])

    sums = vectors.filter(F.size("embedding") == dim).select("embedding").mapInArrow(moments, "at long, moment double")
    table = sums.groupBy("at").agg(F.sum("moment").alias("moment")).toArrow().sort_by("at")
    if not len(table):
        return np.eye(dim)
    # Sums come in any order: round, so that a rerun cuts the cells alike.
    moment = np.round(table.column("moment").to_numpy().reshape(dim, dim), 6)
    return np.linalg.eigh(moment)[1][:, ::-1].copy()


def scaled(v: np.ndarray) -> tuple[np.ndarray, float]:
    """A vector times a power of two, which changes no digit, and its length, rounded once."""
    v = np.ldexp(v, -int(np.frexp(np.abs(v).max())[1]))
    return v, math.sqrt(math.fsum(v * v))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two vectors as they are given: what it is doesn't depend on any other vector."""
    (a, length_a), (b, length_b) = scaled(a), scaled(b)
    return math.fsum(a * b) / (length_a * length_b)


def tile_links(ids: np.ndarray, weight: np.ndarray, x: np.ndarray, y_from: int, least: float, lead: int = 16, rows: int = 512, given: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles (or within one, ``y_from`` 0) of rotated unit vectors.

    Returns each vector's number of links, counted with ``weight``, and its root in the links found.
    The products of the leading axes come first; what the others can add is at most the product of
    the two suffix norms. A block none of whose pairs can reach the threshold stops there; where few
    can, only those go on, one block of axes after another, and pairs drop out as soon as the
    bound falls below the threshold. Products within rounding of it are settled by the cosine of the
    ``given`` vectors, unrotated (by default ``x``).
    """
    given = x if given is None else given
    n, dim = x.shape
    edges = list(range(0, dim, lead)) + [dim]
    suffix = np.sqrt(np.maximum(np.cumsum((x * x)[:, ::-1], 1)[:, ::-1], 0))
    suffix = np.concatenate([suffix, np.zeros((n, 1))], 1)
    within = y_from == 0
    right = np.arange(y_from, n)
    counts, roots = np.zeros(n), np.arange(n)
    for at in range(0, n if within else y_from, rows):
        a = np.arange(at, min(at + rows, n if within else y_from))
        # Within a tile each pair once: rows meet later rows only.
        b = right[at:] if within else right
        product_, k = np.zeros((len(a), len(b))), 0
        i = j = None
        while k < len(edges) - 1:
            lo, hi = edges[k], edges[k + 1]
            product_ += x[a, lo:hi] @ x[b, lo:hi].T
            k += 1
            possible = product_ + np.outer(suffix[a, hi], suffix[b, hi]) >= least - _SLACK
            if within:
                possible &= a[:, None] < b[None, :]
            some = int(possible.sum())
            if some * 8 < possible.size:
                i, j = np.nonzero(possible)
                break
        if i is None:
            i, j = np.nonzero(possible)
        value = product_[i, j]
        i, j = a[i], b[j]
        while k < len(edges) - 1 and len(i):
            lo, hi = edges[k], edges[k + 1]
            value = value + np.einsum("ij,ij->i", x[i, lo:hi], x[j, lo:hi])
            k += 1
            alive = value + suffix[i, hi] * suffix[j, hi] >= least - _SLACK
            i, j, value = i[alive], j[alive], value[alive]
        close = np.abs(value - least) <= _SLACK
        for p in np.flatnonzero(close):
            value[p] = cosine(given[i[p]], given[j[p]])
        real = value >= least
        i, j = i[real], j[real]
        counts += np.bincount(i, weight[j], n) + np.bincount(j, weight[i], n)
        live = roots[i] != roots[j]
        kept = np.flatnonzero(roots != np.arange(n))
        roots = local_components(n, np.concatenate([i[live], kept]), np.concatenate([j[live], roots[kept]]))
    return counts.astype(np.int64), roots


def embedding_links(classes: DataFrame, axes: dict[int, np.ndarray], least: float, cell_axes: int, tile: int) -> DataFrame:
    """Per tile pair and vector class: ``cid``, ``links`` found there, ``root`` (a class linked with it).

    Vectors lie in cells of the leading axes whose width is the largest distance of a linked pair,
    so linked vectors lie in cells that touch. Cells are dealt into tiles of about ``tile`` vectors, and
    every two tiles of touching cells meet in one task, which holds these two tiles.
    """
    width = math.sqrt(2 - 2 * least) + 1e-6
    cells = cell_axes

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                u = unit_rows(_matrix(part.column(2))) @ axes.get(int(dim), np.eye(dim))
                lead = np.zeros((len(u), cells), np.int64)
                lead[:, : min(cells, dim)] = np.floor(u[:, :cells] / width)
                cell = np.concatenate([np.full((len(u), 1), dim), lead], 1)
                lists_ = [pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel())) for w in (cell, _matrix(part.column(2)))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists_], names=["cid", "n", "cell", "v"])

    placed = saved(classes.select("cid", "n", "embedding").mapInArrow(place, "cid long, n long, cell array<long>, v array<double>"), "placed")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("long").alias("tiles"))
    # Touching cells, each two once: steps of -1, 0, 1 along the leading axes whose first other than 0 is 1.
    steps = [s for s in product((-1, 0, 1), repeat=cells) if s >= (0,) * cells]
    near = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(v).cast("long") for v in s]) for s in steps])
    moved = sizes.select(F.col("cell").alias("cell_a"), F.col("tiles").alias("tiles_a"), F.explode(near).alias("step"))
    moved = moved.withColumn("cell_b", F.zip_with("cell_a", "step", lambda a, b: a + b)).drop("step")
    met = moved.join(sizes.select(F.col("cell").alias("cell_b"), F.col("tiles").alias("tiles_b")), "cell_b")
    # One side, spread over the cluster, then the other: no row makes more than one cell's tiles.
    numbers = {c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"tiles_{c}") - 1)).alias(f"t{c}") for c in "ab"}
    pairs = met.select("cell_a", "cell_b", "tiles_b", numbers["a"]).repartition("cell_a", "ta").select("cell_a", "cell_b", "ta", numbers["b"])
    pairs = pairs.filter((F.col("cell_a") != F.col("cell_b")) | (F.col("ta") <= F.col("tb")))
    pairs = saved(pairs.withColumn("pair", F.monotonically_increasing_id()), "tile-pairs")
    same = (F.col("cell_a") == F.col("cell_b")) & (F.col("ta") == F.col("tb"))
    sides = pairs.select("pair", F.inline(F.when(same, F.array(F.struct(F.lit(2).alias("side"), F.col("cell_a").alias("cell"), F.col("ta").alias("t")))).otherwise(F.array(
        F.struct(F.lit(0).alias("side"), F.col("cell_a").alias("cell"), F.col("ta").alias("t")),
        F.struct(F.lit(1).alias("side"), F.col("cell_b").alias("cell"), F.col("tb").alias("t")),
    ))))
    dealt = placed.join(sizes, "cell").withColumn("t", F.pmod(F.xxhash64("cid"), F.col("tiles"))).drop("tiles")

    nothing = pa.table({c: pa.array([], pa.int64()) for c in ("cid", "links", "root")})

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("cid", "ascending")]).combine_chunks()
        ids, weight, side = (table.column(c).to_numpy() for c in ("cid", "n", "side"))
        # Side 2 is a tile with itself; of two tiles one may have come out empty.
        within = side[0] == 2
        if not within and side[0] == side[-1]:
            return nothing
        v = _matrix(table.column("v").chunk(0))
        u = unit_rows(v) @ axes.get(v.shape[1], np.eye(v.shape[1]))
        counts, roots = tile_links(ids, weight, u, 0 if within else int(np.searchsorted(side, 1)), least, given=v)
        found = counts > 0
        return pa.table({"cid": ids[found], "links": counts[found], "root": ids[roots[found]]})

    return dealt.join(sides, ["cell", "t"]).select("pair", "side", "cid", "n", "v").groupBy("pair").applyInArrow(compare, "cid long, links long, root long")


def embedding_dedup(vectors: DataFrame, least: float = 0.95, tile: int = 4096) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    All vectors (``vec_id``, ``embedding``) are compared by cosine in double precision; pairs of at
    least ``least`` are linked and ``component_id`` is the smallest id reachable. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing, and vectors of different
    lengths don't link. Equal vectors are one class with a weight, so a group of copies is never
    compared with itself. Repeated rows are vectors of their own, linked with each other. A null id
    counts as a vector; its component has the smallest id there is, if any. An empty table gives an
    empty one.

    The number of leading axes that cut the space into cells grows with the table (one more whenever
    it is four times larger), so tiles stay of one size and a tile meets the tiles around it. Axes are
    computed for the eight most frequent lengths of up to 4096 components, whose moments (the square of the length)
    fit the driver; vectors of other lengths are compared along the axes they are given in, which
    bounds less and finds the same links. Whether two vectors link depends on these two alone.
    """
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.coalesce(good & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), good.alias("good"))
    classes = rows.filter("good").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    dims = {r["d"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(8).collect()}
    axes = {d: principal_axes(classes, d) for d in dims if d <= 4096}
    cell_axes = max(1, min(8, round(math.log(max(dims.values(), default=1) / tile + 1, 4))))
    found = saved(embedding_links(classes, axes, least, cell_axes, tile), "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "cid")
    nodes = classes.join(links, "cid", "left").join(joined, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = nodes.groupBy("component").agg(F.min("first").alias("smallest"))
    nodes = nodes.join(smallest, "component").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "smallest")
    out = rows.filter("good").join(nodes, "embedding").select("vec_id", F.col("links").alias("n_links"), F.col("smallest").alias("component_id"))
    alone = rows.filter(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
