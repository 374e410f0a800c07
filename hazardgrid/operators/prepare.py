"""Preparation of cells: metric choice, scaling, singleton dims, label choice, clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid.schema import SCENARIOS, TIMES, labels_of, position


def select_metric(df: DataFrame, name: str | None) -> DataFrame:
    """Keep one ``metric`` label and drop the column; unchanged if there is no such column."""
    if name is None or "metric" not in df.columns:
        return df
    return df.filter(F.col("metric") == name).drop("metric")


def scale_values(df: DataFrame, value: str, factor: float | None) -> DataFrame:
    """Multiply a variable by a constant."""
    return df if factor is None else df.withColumn(value, F.col(value) * F.lit(float(factor)))


def drop_singleton_dims(df: DataFrame, keep: tuple[str, ...] = ("hazard", "scenario", "time", "scoring")) -> DataFrame:
    """Drop label columns that hold one label or none, except those whose meaning later steps need.

    The schema of the result depends on the data, so this runs one aggregate over the label
    columns (nothing else is read) that returns a single row.
    """
    candidates = labels_of(df, without=keep)
    if not candidates:
        return df
    single = df.agg(*[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in candidates]).first()
    return df.drop(*[c for c in candidates if single[c]])


def fill_missing(df: DataFrame, value: str = "score", fill: float = 0.0) -> DataFrame:
    """Missing means no exposure: replace it by a constant."""
    return df.withColumn(value, F.coalesce(F.col(value), F.lit(fill).cast(df.schema[value].dataType)))


def normalize_numeric(df: DataFrame) -> DataFrame:
    """Numbers as DOUBLE with NULL for NaN, byte labels as strings; integers are left alone."""

    def clean(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.BinaryType):
            return F.decode(c, "UTF-8").alias(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return F.when(~F.isnan(c), c.cast("double")).alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        return c

    return df.select(*[clean(f) for f in df.schema.fields])


def prefer_statistic(df: DataFrame, name: str = "mean", by: tuple[str, ...] = ("hazard",), order: tuple[str, ...] = ()) -> DataFrame:
    """Keep the preferred ``statistic`` label (any case), else the first one, for each hazard."""
    if "statistic" not in df.columns:
        return df
    rank = F.struct(
        F.when(F.lower("statistic") == name.lower(), 0).otherwise(1),
        position(F.col("statistic"), order) if order else F.lit(0),
        F.col("statistic"),
    )
    return keep_label(df, F.min_by("statistic", rank), "statistic", by)


def keep_label(df: DataFrame, pick: Column, column: str, by: tuple[str, ...]) -> DataFrame:
    """Keep the rows whose label equals the one an aggregate picks per hazard."""
    keys = [c for c in by if c in df.columns]
    if not keys:
        return df.filter(F.col(column).eqNullSafe(df.agg(pick).scalar()))
    # One row per hazard, so this side always broadcasts.
    chosen = df.groupBy(*keys).agg(pick.alias("_label"))
    # A hazard without such labels keeps its rows: NULL equals NULL here.
    return df.join(F.broadcast(chosen), keys).filter(F.col(column).eqNullSafe(F.col("_label"))).drop("_label")


def label_preference(column: str, wanted: tuple[str, ...], order: tuple[str, ...], any_case: bool) -> Column:
    """Sortable preference: wanted labels first in their order, else the last label available."""
    label = F.lower(column) if any_case else F.col(column)
    names = [w.lower() for w in wanted] if any_case else list(wanted)
    score = reduce(
        lambda expr, pair: expr.when(label == pair[1], F.lit(1000 - pair[0])),
        enumerate(names[1:], start=1),
        F.when(label == names[0], F.lit(1000)),
    ).otherwise(F.lit(0))
    return F.struct(score, position(F.col(column), order), F.col(column))


def wanted_scenarios(ref_scenario: str | None) -> tuple[str, ...]:
    return ("RCP85", "RCP45") if ref_scenario is None else (ref_scenario,)


def wanted_times(ref_time: str | None) -> tuple[str, ...]:
    return ("Lt",) if ref_time is None else (ref_time,)


def reference_slice(
    df: DataFrame,
    ref_scenario: str | None = None,
    ref_time: str | None = None,
    by: tuple[str, ...] = ("hazard",),
) -> DataFrame:
    """Rows of the calibration slice.

    The scenario is matched in any case, the time exactly. Without a request RCP85, then RCP45,
    and Lt are taken; a label that is absent gives the last one available.
    """
    picks = {}
    if "scenario" in df.columns:
        pref = label_preference("scenario", wanted_scenarios(ref_scenario), SCENARIOS, any_case=True)
        picks["scenario"] = F.max_by("scenario", pref)
    if "time" in df.columns:
        picks["time"] = F.max_by("time", label_preference("time", wanted_times(ref_time), TIMES, any_case=False))
    if not picks:
        return df
    keys = [c for c in by if c in df.columns]
    chosen = df.groupBy(*(keys or [F.lit(0).alias("_all")])).agg(*[p.alias(f"_{c}") for c, p in picks.items()])
    left = df if keys else df.withColumn("_all", F.lit(0))
    # One row per hazard, so this side always broadcasts.
    matched = left.join(F.broadcast(chosen), keys or ["_all"])
    for c in picks:
        matched = matched.filter(F.col(c).eqNullSafe(F.col(f"_{c}")))
    return matched.drop("_all", *[f"_{c}" for c in picks])


def dedupe_coords(df: DataFrame, by: tuple[str, ...] = ("hazard",)) -> DataFrame:
    """Rows of the first index of every latitude and longitude label.

    Works on the axes, which hold as many labels as the raster is high or wide; adaptive execution
    broadcasts them when they turn out small, and the cells are then kept without a shuffle.
    """
    keys = [c for c in by if c in df.columns]
    kept = df
    for label, index in (("lat", "lat_idx"), ("lon", "lon_idx")):
        unlabelled = F.when(F.col(label).isNull(), F.col(index))  # cells without coordinates all stay
        first = df.groupBy(*keys, label, unlabelled).agg(F.min(index).alias(index)).select(*keys, index)
        kept = kept.join(first, [*keys, index], "left_semi")
    return kept


def scored_dims(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """What labels and axes of a table of scores hold, from a scan of its labels and one of its columns.

    One row for each combination of labels (``kind = 'labels'``) and for each latitude and longitude
    of a hazard (``kind = 'lat'`` or ``'lon'``, ``coord``, least and greatest index ``first`` and ``last``).
    Its size is that of the axes, not of the table: stage it and answer from it. Labels and latitudes are counted
    together, which combines to a few rows per raster row, and longitudes apart.
    """
    labels = labels_of(df) if labels is None else labels
    own = [c for c in labels if c == "hazard"]

    def marked(rows: DataFrame, kind: str, shown: list[str], coord: Column | None = None) -> DataFrame:
        names = [F.col(c) if c in shown else F.lit(None).cast("string").alias(c) for c in labels]
        ends = [F.col(c) if coord is not None else F.lit(None).cast("int").alias(c) for c in ("first", "last")]
        place = F.lit(None).cast("double") if coord is None else coord.cast("double")
        return rows.select(F.lit(kind).alias("kind"), *names, place.alias("coord"), *ends)

    def ends(rows: DataFrame, keys: list[str], c: str) -> DataFrame:
        index = F.col(f"{c}_idx").cast("int")
        return rows.groupBy(*keys, F.col(c).alias("_coord")).agg(F.min(index).alias("first"), F.max(index).alias("last"))

    parts = []
    if "lat" in df.columns:
        by_lat = ends(df, labels, "lat")
        parts.append(marked(by_lat.groupBy(*labels).agg(F.lit(1).alias("_")), "labels", labels))
        lats = by_lat.groupBy(*own, "_coord").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        parts.append(marked(lats, "lat", own, F.col("_coord")))
    else:
        parts.append(marked(df.groupBy(*labels).agg(F.lit(1).alias("_")), "labels", labels))
    if "lon" in df.columns:
        parts.append(marked(ends(df, own, "lon"), "lon", own, F.col("_coord")))
    return reduce(DataFrame.unionByName, parts)


def tidy_scored(df: DataFrame, dims: DataFrame, order: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Scores of one hazard made ready for zones, and the label combinations left, from its ``dims``.

    One statistic (``mean`` in any case, else the first in ``order``, else in alphabetical order), no
    label with a single value beyond those that later steps need, one index per coordinate. The
    table itself isn't read: the label combinations, a few dozen, come to the driver from ``dims``,
    and the axes are consulted only if a coordinate has several indexes.
    """
    labels = [c for c in dims.columns if c not in ("kind", "coord", "first", "last")]
    doubled = F.max(F.col("coord").isNotNull() & (F.col("first") < F.col("last"))).alias("doubled")
    found = dims.groupBy("kind", *[F.when(F.col("kind") == "labels", F.col(c)).alias(c) for c in labels]).agg(doubled).collect()
    combos = [{c: r[c] for c in labels} for r in found if r["kind"] == "labels"]
    uneven = {r["kind"] for r in found if r["kind"] != "labels" and r["doubled"]}
    if "statistic" in labels and combos:
        rank = {s: i for i, s in enumerate(order)}
        names = {r["statistic"] for r in combos}
        pick = min(names, key=lambda s: ((s or "").lower() != "mean", rank.get(s, len(rank)), s is None, s or ""))
        df = df.filter(F.col("statistic").eqNullSafe(F.lit(pick)))
        combos = [r for r in combos if r["statistic"] == pick]
    keep = ("hazard", "scenario", "time", "scoring")
    gone = [c for c in labels if c not in keep and len({r[c] for r in combos}) <= 1]
    left = [c for c in labels if c not in gone]
    for coord in ("lat", "lon"):
        if coord in df.columns and coord in uneven:
            axis = dims.filter((F.col("kind") == coord) & F.col("coord").isNotNull())
            firsts = axis.groupBy(F.col("coord").alias("_coord")).agg(F.min("first").alias("_first"))
            df = df.join(firsts, F.col(coord) == F.col("_coord"), "left")
            df = df.filter(F.col(coord).isNull() | (F.col(f"{coord}_idx") == F.col("_first"))).drop("_coord", "_first")
    spark = df.sparkSession
    rows = sorted({tuple(r[c] for c in left) for r in combos}, key=str)
    return df.drop(*gone), spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in left]))


def tidy_hazards(df: DataFrame, dims: DataFrame, order: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], DataFrame, DataFrame]]:
    """``tidy_scored`` for every hazard of a table at once.

    Hazards that keep the same labels come out as one frame: their codes, their scores and their label
    combinations (with ``hazard``). The choice of the statistic, of labels to drop and of coordinates is each hazard's
    own. Only ``dims`` is read: the label combinations, a few dozen a hazard, come to the driver.
    """
    labels = [c for c in dims.columns if c not in ("kind", "coord", "first", "last")]
    doubled = F.max(F.col("coord").isNotNull() & (F.col("first") < F.col("last"))).alias("doubled")
    shown = [F.when((F.col("kind") == "labels") | F.lit(c == "hazard"), F.col(c)).alias(c) for c in labels]
    found = dims.groupBy("kind", *shown).agg(doubled).collect()
    uneven = {c: sorted({r["hazard"] for r in found if r["kind"] == c and r["doubled"]}) for c in ("lat", "lon")}
    picks: dict[str | None, list[str]] = {}
    groups: dict[tuple[str, ...], dict[str, list[dict]]] = {}
    keep = ("hazard", "scenario", "time", "scoring")
    for hazard in sorted({r["hazard"] for r in found if r["kind"] == "labels"}):
        combos = [{c: r[c] for c in labels} for r in found if r["kind"] == "labels" and r["hazard"] == hazard]
        if "statistic" in labels:
            rank = {s: i for i, s in enumerate(order)}
            names = {r["statistic"] for r in combos}
            pick = min(names, key=lambda s: ((s or "").lower() != "mean", rank.get(s, len(rank)), s is None, s or ""))
            picks.setdefault(pick, []).append(hazard)
            combos = [r for r in combos if r["statistic"] == pick]
        left = tuple(c for c in labels if c in keep or len({r[c] for r in combos}) > 1)
        groups.setdefault(left, {})[hazard] = combos
    if picks:
        df = df.filter(reduce(lambda a, b: a | b, [F.col("hazard").isin(*codes) & F.col("statistic").eqNullSafe(F.lit(pick)) for pick, codes in picks.items()]))
    out = []
    for left, hazards in groups.items():
        rows = df.filter(F.col("hazard").isin(*hazards)).drop(*[c for c in labels if c not in left])
        for coord in ("lat", "lon"):
            codes = [h for h in uneven[coord] if h in hazards]
            if coord in df.columns and codes:
                axis = dims.filter((F.col("kind") == coord) & F.col("coord").isNotNull() & F.col("hazard").isin(*codes))
                firsts = axis.groupBy(F.col("hazard").alias("_hazard"), F.col("coord").alias("_coord")).agg(F.min("first").alias("_first"))
                rows = rows.join(firsts, (F.col("hazard") == F.col("_hazard")) & (F.col(coord) == F.col("_coord")), "left")
                even = F.col(coord).isNull() | ~F.col("hazard").isin(*codes)
                rows = rows.filter(even | (F.col(f"{coord}_idx") == F.col("_first"))).drop("_hazard", "_coord", "_first")
        shown = sorted({tuple(r[c] for c in left) for combos in hazards.values() for r in combos}, key=str)
        combos = df.sparkSession.createDataFrame(shown, T.StructType([T.StructField(c, T.StringType()) for c in left]))
        out.append((tuple(hazards), rows, combos))
    return out


def axis_of(dims: DataFrame, coord: str) -> DataFrame:
    """``{coord}_idx`` and ``{coord}`` of every coordinate in ``dims`` (its first index)."""
    rows = dims.filter((F.col("kind") == coord) & F.col("coord").isNotNull())
    return rows.groupBy(F.col("coord").alias(coord)).agg(F.min("first").alias(f"{coord}_idx"))


def split_hundred(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The threshold scales and the 0–100 scale as two frames."""
    return df.filter(F.col("scoring") != "100"), df.filter(F.col("scoring") == "100")


#: Raster rows and columns of a block of cells that lie together in a file.
BLOCK = 16


def morton(row: Column, column: Column) -> Column:
    """Place of a cell's block on a curve that fills the raster: the bits of both indexes in turn.

    Blocks that lie near each other on the curve lie near each other on the raster, along both axes.
    Indexes may have 31 bits; negative ones count as 0.
    """

    def spread(index: Column) -> Column:
        x = F.floor(F.greatest(index, F.lit(0)) / BLOCK).cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
        return x

    return F.shiftleft(spread(row), 1).bitwiseOR(spread(column))


def sort_grid(df: DataFrame) -> DataFrame:
    """Cells along a curve that fills the raster, range-partitioned by it: once written, row groups and
    pages span few rows and few columns, so a bounding box skips the others on both axes."""
    z = morton(F.col("lat_idx"), F.col("lon_idx"))
    return df.withColumn("_z", z).repartitionByRange("_z", "lat_idx", "lon_idx").sortWithinPartitions("_z", "lat_idx", "lon_idx").drop("_z")
