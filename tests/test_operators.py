from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardgrid.operators.align import align, ensemble_mean, fill_current_climate, land_mask
from hazardgrid.operators.gapfill import densify, fill_along, fill_gaps, gap_fill
from hazardgrid.operators.prepare import (
    dedupe_coords,
    drop_singleton_dims,
    fill_missing,
    morton,
    normalize_numeric,
    prefer_statistic,
    reference_slice,
    scale_values,
    scored_dims,
    select_metric,
    sort_grid,
    tidy_scored,
)
from hazardgrid.operators.regrid import coast_on_grid, nearest_axis, nearest_grid, nearest_index
from hazardgrid.operators.scoring import concat_scales, fan_out, minmax_bounds, score_scales, threshold_join, with_bounds
from hazardgrid.schema import GridSpec


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_scales_from_one_scan(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (25.0,)], "value double")
    out = score_scales(df, "value", {"5": ([0, 10, 20], [1, 2, 3]), "10": ([0, 10, 20], [2, 4, 6])})
    assert rows(out, "scoring", "score") == [("10", 2), ("10", 4), ("10", 6), ("5", 1), ("5", 2), ("5", 3)]
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    with pytest.raises(ValueError):
        fan_out(df, {})
    with pytest.raises(ValueError):
        concat_scales([])


def test_preparation(spark):
    df = spark.createDataFrame([("p5", 1.0), ("p95", 2.0)], "metric string, value double")
    assert rows(scale_values(select_metric(df, "p95"), "value", 100), "value") == [(200.0,)]
    assert select_metric(df.drop("metric"), "p5").count() == 2
    raw = spark.createDataFrame([(bytearray(b"RCP45"), float("nan")), (bytearray(b"RCP85"), 2.0)], "scenario binary, v float")
    clean = normalize_numeric(raw)
    assert rows(clean.orderBy("scenario"), "scenario", "v") == [("RCP45", None), ("RCP85", 2.0)] and clean.schema["v"].dataType.typeName() == "double"
    assert rows(fill_missing(clean, "v"), "v") == [(0.0,), (2.0,)]


def test_singletons(spark):
    df = spark.createDataFrame([("A", "Cc", "M1", "mean"), ("A", "Cc", "M2", "mean")], "scenario string, time string, model string, statistic string")
    assert drop_singleton_dims(df).columns == ["scenario", "time", "model"]


@pytest.mark.parametrize("labels, kept", [(["MAX", "Mean"], "Mean"), (["b", "a"], "a")])
def test_preferred_statistic(spark, labels, kept):
    df = spark.createDataFrame([("HS", x) for x in labels], "hazard string, statistic string")
    assert rows(prefer_statistic(df), "statistic") == [(kept,)]
    assert rows(prefer_statistic(df.drop("hazard")), "statistic") == [(kept,)]


@pytest.mark.parametrize(
    "ref, expected",
    [
        ((None, None), ("RCP85", "Lt")),
        (("rcp45", "Cc"), ("RCP45", "Cc")),
        (("nope", "cc"), ("RCP85", "Lt")),  # absent labels, also by case of the time: the last one
        (("historical", None), ("HISTORICAL", "Lt")),
    ],
)
def test_reference_slice(spark, ref, expected):
    data = [(s, t) for s in ("RCP45", "HISTORICAL", "RCP85") for t in ("Mt", "Cc", "Lt")]
    df = spark.createDataFrame(data, "scenario string, time string")
    assert rows(reference_slice(df, *ref), "scenario", "time") == [expected]


def test_reference_slice_prefers_rcp45_without_rcp85(spark):
    df = spark.createDataFrame([("RCP45", "St"), ("HISTORICAL", "Mt")], "scenario string, time string")
    assert rows(reference_slice(df.filter("time = 'St' OR scenario = 'HISTORICAL'")), "scenario", "time") == []
    assert rows(reference_slice(df.drop("time")), "scenario") == [("RCP45",)]


def test_bounds(spark):
    data = [
        ("HS", "RCP45", "Cc", 3.0), ("HS", "RCP45", "Cc", 1.0), ("HS", "RCP85", "Lt", 9.0), ("HS", "RCP85", "Cc", 99.0),
        ("RF", "RCP45", "Cc", None), ("RF", "HISTORICAL", "Cc", 2.0), ("RF", "RCP85", "Lt", 5.0),
        ("TC", "RCP85", "St", 4.0),
    ]
    df = spark.createDataFrame(data, "hazard string, scenario string, time string, v double")
    assert rows(minmax_bounds(df, "v"), "hazard", "lo", "hi") == [("HS", 1.0, 9.0), ("RF", 2.0, 5.0), ("TC", 4.0, 4.0)]
    one = df.filter("hazard = 'HS'").drop("hazard")
    assert rows(with_bounds(one, minmax_bounds(one, "v")), "_lo", "_hi")[0] == (1.0, 9.0)


def test_duplicate_coordinates_keep_the_first(spark):
    data = [(i, j, (0, 0, 2)[i] + 0.5, float(j)) for i in range(3) for j in range(2)]
    df = spark.createDataFrame(data, "lat_idx int, lon_idx int, lat double, lon double")
    assert rows(dedupe_coords(df), "lat_idx") == [(0,), (0,), (2,), (2,)]


def test_align_is_inner_and_broadcasts_the_static_side(spark):
    left = spark.createDataFrame([("A", 0, 0, 2.0), ("B", 0, 0, None), ("A", 0, 1, 3.0)], "scenario string, lat_idx int, lon_idx int, a double")
    right = spark.createDataFrame([(0, 0, 5.0)], "lat_idx int, lon_idx int, b double")
    assert rows(align(left, right).withColumn("p", F.col("a") * F.col("b")).orderBy("scenario"), "scenario", "p") == [("A", 10.0), ("B", None)]


def test_ensemble(spark):
    data = [("A", "M1", 0, 0, 2.0), ("A", "M2", 0, 0, None), ("A", "M1", 0, 1, 1.0), ("A", "M2", 0, 1, 4.0)]
    df = spark.createDataFrame(data, "scenario string, model string, lat_idx int, lon_idx int, v double")
    assert rows(ensemble_mean(df, "v"), "lon_idx", "v", "statistic") == [(0, 2.0, "mean"), (1, 2.5, "mean")]
    assert "statistic" not in ensemble_mean(df.drop("model"), "v").columns


def test_current_climate(spark):
    data = [("HISTORICAL", "Cc", 1.0), ("HISTORICAL", "Lt", 7.0), ("RCP45", "Cc", 5.0), ("RCP45", "Lt", 6.0), ("RCP85", "Lt", 8.0)]
    df = spark.createDataFrame(data, "scenario string, time string, v double")
    assert rows(fill_current_climate(df), "scenario", "time", "v") == [
        ("RCP45", "Cc", 1.0), ("RCP45", "Lt", 6.0), ("RCP85", "Cc", 1.0), ("RCP85", "Lt", 8.0)
    ]
    future = df.filter("scenario <> 'HISTORICAL'")
    assert rows(fill_current_climate(future), "v") == rows(future, "v")


def test_land_mask(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (0, 2, 3.0)], "lat_idx int, lon_idx int, score double")
    coast = spark.createDataFrame([(0, 0, 1.0), (0, 1, 0.0)], "lat_idx int, lon_idx int, mask double")
    assert rows(land_mask(cells, coast).orderBy("lon_idx"), "lon_idx", "score") == [(0, 1.0), (1, None), (2, None)]


def fill_loop(line, limit):
    """Forward, then backward fill of a list, cell by cell."""
    for step in (1, -1):
        out, last, gap = list(line), None, 0
        order = range(len(line)) if step == 1 else range(len(line) - 1, -1, -1)
        for i in order:
            if line[i] is not None:
                last, gap = line[i], 0
            elif last is not None:
                gap += 1
                out[i] = last if gap <= limit else None
        line = out
    return line


@pytest.mark.parametrize("seed, limit", [(1, 2), (2, 3), (3, 30)])
def test_gap_fill_equals_a_loop(spark, seed, limit):
    rng = np.random.default_rng(seed)
    grid = [[float(rng.integers(1, 99)) if rng.random() < 0.15 else None for _ in range(23)] for _ in range(17)]
    data = [("A", r, c, v) for r, line in enumerate(grid) for c, v in enumerate(line) if v is not None]
    df = spark.createDataFrame(data, "scenario string, lat_idx int, lon_idx int, v double")
    by_row = [fill_loop(line, limit) for line in grid]
    both = list(zip(*[fill_loop(list(col), limit) for col in zip(*by_row, strict=True)], strict=True))
    out = {(r["lat_idx"], r["lon_idx"]): r["v"] for r in gap_fill(df, "v", 17, 23, limit).collect()}
    assert out == {(r, c): both[r][c] for r in range(17) for c in range(23)}
    present = fill_gaps(df, "v", 17, 23, limit)
    assert {(r["lat_idx"], r["lon_idx"]): r["v"] for r in present.collect()} == {k: v for k, v in out.items() if v is not None}
    assert densify(df, "v", 17, 23).count() == 17 * 23


def test_dense_grid_refuses_what_does_not_fit(spark):
    schema = "scenario string, lat_idx int, lon_idx int, v double"
    fits = spark.createDataFrame([("A", 0, 0, 1.0), ("A", 1, 2, None)], schema)
    assert densify(fits, "v", 2, 3).count() == 6
    for bad in (("A", 2, 0, 1.0), ("A", 0, 3, 1.0), ("A", -1, 0, 1.0), ("A", None, 0, 1.0)):
        with pytest.raises(Exception, match="outside the raster"):
            densify(fits.union(spark.createDataFrame([bad], schema)), "v", 2, 3).collect()
    with pytest.raises(Exception, match="more than one row for cell 0, 0"):
        densify(fits.union(fits), "v", 2, 3).collect()
    placed = densify(fits, "v", 2, 3, GridSpec(10.0, -1.0, 2, 0.5, 2.0, 3))
    assert rows(placed.filter("lat_idx = 1 AND lon_idx = 2"), "lat", "lon") == [(9.0, 4.5)]


def test_every_dimension_is_kept(spark):
    data = [("A", "p5", "M1", 0, 0, 1.0), ("A", "p95", "M1", 0, 0, 9.0), ("A", "p95", "M2", 0, 0, 7.0)]
    df = spark.createDataFrame(data, "scenario string, percentile string, model string, lat_idx int, lon_idx int, v double")
    assert rows(ensemble_mean(df, "v"), "percentile", "v") == [("p5", 1.0), ("p95", 8.0)]
    out = score_scales(df, "v", {"5": ([0, 5], [1, 2])})
    assert rows(out, "percentile", "model", "score") == [("p5", "M1", 1), ("p95", "M1", 2), ("p95", "M2", 2)]
    assert rows(densify(df.filter("model = 'M1'").drop("model"), "v", 1, 1), "percentile", "v") == [("p5", 1.0), ("p95", 9.0)]


def test_tidy_scores_from_their_dimensions(spark):
    data = [("Cc", s, "M1", i, 0, (0.5, 0.5, 2.5)[i], 0.5, float(i)) for s in ("q1", "max") for i in range(3)] + [("Lt", "max", "M1", 3, 0, None, None, 9.0)]
    df = spark.createDataFrame(data, "time string, statistic string, model string, lat_idx int, lon_idx int, lat double, lon double, score double")
    dims = scored_dims(df)
    assert {r["kind"]: r["n"] for r in dims.groupBy("kind").agg(F.count("*").alias("n")).collect()} == {"labels": 3, "lat": 3, "lon": 2}
    tidy, combos = tidy_scored(df, dims)
    assert rows(tidy, "time", "lat_idx") == [("Cc", 0), ("Cc", 2), ("Lt", 3)] and "model" not in tidy.columns
    assert rows(combos, "time") == [("Cc",), ("Lt",)]
    first, combos = tidy_scored(df, dims, order=("q1", "max"))
    assert rows(first, "score") == [(0.0,), (2.0,)] and rows(combos, "time") == [("Cc",)]


def test_gaps_make_only_the_rows_they_fill(spark):
    # Two values on a raster of 10^12 cells: no grid is made.
    far = spark.createDataFrame([("A", 5, 7, 1.0), ("A", 5, 900000, 2.0), ("B", 999999, 0, None)], "scenario string, lat_idx int, lon_idx int, v double")
    out = fill_gaps(far, "v", 10**6, 10**6, 30)
    assert out.count() == (38 + 61) * 36 and out.filter("v = 1").count() == 38 * 36
    for bad in (("A", 5, 10**6, 3.0), ("A", 5, 7, 4.0)):
        with pytest.raises(Exception, match="outside the raster|more than one row"):
            fill_gaps(far.union(spark.createDataFrame([bad], far.schema)), "v", 10**6, 10**6, 30).collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_gap_fill_shuffles_once_per_axis(spark):
    df = spark.range(10).selectExpr("'A' AS scenario", "CAST(id AS INT) AS lat_idx", "CAST(id AS INT) AS lon_idx", "CAST(id AS DOUBLE) AS v")
    plan = fill_along(fill_along(df, "v", "lon_idx"), "v", "lat_idx")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_nearest_index_prefers_the_larger_coordinate(column):
    v = F.col("v")
    assert column(nearest_index(v, 0.0, 10.0, 3), [-9.0, 4.9, 5.0, 15.0, 99.0]) == [0, 0, 1, 2, 2]
    assert column(nearest_index(v, 20.0, -10.0, 3), [15.0, 5.0, 4.9]) == [0, 1, 2]


def test_morton_order(spark):
    cells = spark.range(64 * 64).selectExpr("CAST(id DIV 64 AS INT) AS r", "CAST(id % 64 AS INT) AS c").withColumn("z", morton(F.col("r"), F.col("c")))
    got = {(r["r"], r["c"]): r["z"] for r in cells.collect()}
    assert got == {(r, c): sum(((r // 16) >> b & 1) << 2 * b + 1 | ((c // 16) >> b & 1) << 2 * b for b in range(3)) for r in range(64) for c in range(64)}
    far = spark.sql("SELECT 2147483647 AS r, -5 AS c").select(morton(F.col("r"), F.col("c"))).first()[0]
    assert far == sum((2147483647 // 16 >> b & 1) << 2 * b + 1 for b in range(31))


def test_a_box_reads_little_of_a_sorted_grid(spark, tmp_path):
    side = 640
    cells = spark.range(side * side).selectExpr(f"CAST(id DIV {side} AS INT) AS lat_idx", f"CAST(id % {side} AS INT) AS lon_idx", "CAST(id AS DOUBLE) AS v")
    path = str(tmp_path / "grid")
    sort_grid(cells).write.option("parquet.block.size", 64 * 1024).option("parquet.page.row.count.limit", 1000).parquet(path)
    # A tenth of the rows and a tenth of the columns.
    box = spark.read.parquet(path).filter(F.col("lat_idx").between(320, 383) & F.col("lon_idx").between(64, 127))
    assert len(box.collect()) == 64 * 64
    scan = box._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().apply("numOutputRows").value()
    assert 64 * 64 <= read <= 0.03 * side * side


def test_nearest_axis_over_gaps(spark):
    # Clusters far apart: most buckets hold no source label.
    known = [0.0, 0.5, 1.0, 1000.0, 1000.25, 5000.0]
    wanted = [-7.0, 0.2, 0.25, 0.75, 3.0, 499.0, 500.5, 501.0, 999.0, 1000.125, 2999.0, 3001.0, 4999.0, 9000.0]
    source = spark.createDataFrame([(x,) for x in known], "lat double")
    target = spark.createDataFrame(list(enumerate(wanted)), "lat_idx int, lat double")
    got = {r["lat"]: r["src_lat"] for r in nearest_axis(target, source, "lat").collect()}
    assert got == {x: min(known, key=lambda k: (abs(k - x), -k)) for x in wanted}
    assert {r["src_lat"] for r in nearest_axis(target, source.filter("lat = 0.5"), "lat").collect()} == {0.5}


def test_threshold_join_makes_a_row_per_cell_and_scale(spark):
    from hazardgrid.catalog import threshold_table

    cells = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 'HS' ELSE 'CS' END AS hazard", "id", "CASE WHEN id % 10 > 0 THEN CAST(id AS DOUBLE) / 10 END AS value")
    bins = threshold_table(spark).filter(F.col("threshold_type").isin("scoring", "thresholds") & F.col("scale").isin("5", "10"))
    out = threshold_join(cells, bins)
    assert out.count() == 2000 and out.filter("score IS NULL").count() == out.filter("value IS NULL").count()


def test_nearest_grid_on_uneven_axes(spark):
    source = spark.createDataFrame([(a, o, a * 100 + o) for a in (0.0, 3.0, 10.0) for o in (0.0, 1.0)], "lat double, lon double, mask double")
    cells = [(i, j, lat, lon) for i, lat in enumerate((-5.0, 1.5, 6.5, 6.6, 50.0)) for j, lon in enumerate((0.5, 0.4))]
    target = spark.createDataFrame(cells, "lat_idx int, lon_idx int, lat double, lon double")
    expected = [(i, j, {0: 0.0, 1: 3.0, 2: 10.0, 3: 10.0, 4: 10.0}[i] * 100 + (1.0 if j == 0 else 0.0)) for i in range(5) for j in range(2)]
    assert rows(nearest_grid(target, source, "mask"), "lat_idx", "lon_idx", "mask") == expected
    assert rows(coast_on_grid(source, target), "lat_idx", "lon_idx", "mask") == expected
