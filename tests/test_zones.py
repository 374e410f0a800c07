from __future__ import annotations

import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardgrid.fixtures import view
from hazardgrid.operators.geometry import bbox_filter, cells_of, read_wkb, ring_edges, runs_of, write_wkb, zone_bounds, zone_cells, zone_rings, zone_runs, zones_in_bbox
from hazardgrid.operators.quantiles import exact_quantiles
from hazardgrid.operators.weighted import bins_of, calibrate_bins, flood_statistics, rp_weighted, weighted_risk
from hazardgrid.operators.zonal import clip_to_zones, zonal_multi, zonal_stats
from hazardgrid.schema import GridSpec

GRID = GridSpec(0.5, 1.0, 30, 0.5, 1.0, 40)
RING = "gadm_id string, gid0 string, part int, ring int, points array<struct<x double, y double>>"
P1 = [(3.2, 4.1), (40.7, 9.3), (33.3, 30.2), (20.1, 18.8), (6.6, 41.4)]
P2 = [(50, 10), (90, 10), (90, 50), (50, 50)]


def edges_of(spark, zones):
    data = [(z, "C", p, r, [(float(x), float(y)) for x, y in pts]) for z, p, r, pts in zones]
    return ring_edges(spark.createDataFrame(data, RING))


def star(seed, n=9, cx=20.0, cy=15.0, far=13.0):
    """A simple polygon round a point."""
    rng = np.random.default_rng(seed)
    angles = 2 * np.pi * (np.arange(n) + rng.uniform(0, 1, n)) / n
    radius = rng.uniform(2, far, n)
    return [(cx + r * np.cos(a), cy + r * np.sin(a)) for a, r in zip(angles, radius, strict=True)]


def inside(poly, x, y):
    hits = 0
    for (x1, y1), (x2, y2) in zip(poly, poly[1:] + poly[:1], strict=True):
        if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) <= x:
            hits += 1
    return hits % 2 == 1


def area(poly):
    x, y = np.array(poly).T
    return abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2


def test_known_polygons(spark):
    grid = GridSpec(0.5, 1.0, 60, 0.5, 1.0, 100)
    assert zone_cells(edges_of(spark, [("P1", 0, 0, P1), ("P2", 0, 0, P2)]), grid, "center").count() == 2305


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_modes_against_brute_force(spark, seed):
    poly = star(seed)
    edges = edges_of(spark, [("Z", 0, 0, poly)])
    center = {(r["lat_idx"], r["lon_idx"]) for r in zone_cells(edges, GRID, "center").collect()}
    assert center == {(r, c) for r in range(30) for c in range(40) if inside(poly, c + 0.5, r + 0.5)}
    cover = {(r["lat_idx"], r["lon_idx"]): r["coverage"] for r in zone_cells(edges, GRID, "coverage").collect()}
    assert sum(cover.values()) == pytest.approx(area(poly), abs=1e-6)
    # A fine raster of points approaches the exact share.
    fine = [(i + 0.5) / 20 for i in range(20)]
    for (r, c), share in list(cover.items())[::7]:
        assert share == pytest.approx(sum(inside(poly, c + u, r + v) for u in fine for v in fine) / 400, abs=0.08)
    touched = {(r["lat_idx"], r["lon_idx"]) for r in zone_cells(edges, GRID, "all_touched").collect()}
    assert set(cover) <= touched and center <= touched


def test_holes_parts_and_direction(spark):
    outer, hole, island = [(2, 2), (12, 2), (12, 12), (2, 12)], [(4, 4), (4, 8), (8, 8), (8, 4)], [(20, 20), (22.5, 20), (22.5, 22), (20, 22)]
    zones = [("Z", 0, 0, outer), ("Z", 0, 1, hole), ("Z", 1, 0, island)]
    back = [(z, p, r, pts[::-1]) for z, p, r, pts in zones]
    for rings in (zones, back):
        edges = edges_of(spark, rings)
        cells = zone_cells(edges, GRID, "coverage")
        assert cells.agg({"coverage": "sum"}).first()[0] == pytest.approx(100 - 16 + 5)
        assert zone_cells(edges, GRID, "center").count() == 84 + 4  # centres on a right-hand edge are outside


def turned(rings, mask):
    return [(z, p, r, pts[::-1] if mask >> i & 1 else pts) for i, (z, p, r, pts) in enumerate(rings)]


@pytest.mark.parametrize("mask", range(16))
def test_ring_directions_do_not_matter(spark, mask):
    """A hole that runs its outline's way, parts that share cells, a part inside another's hole."""
    square = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    rings = [("Z", 0, 0, square(2, 2, 10, 10)), ("Z", 0, 1, square(4, 4, 6, 6)), ("Z", 1, 0, square(5.25, 5.5, 3, 2.5)), ("Z", 2, 0, square(12, 3.5, 1.5, 2))]
    cells = {(r["lat_idx"], r["lon_idx"]): r["coverage"] for r in zone_cells(edges_of(spark, turned(rings, mask)), GRID, "coverage").collect()}
    assert sum(cells.values()) == pytest.approx(100 - 36 + 7.5 + 3)
    assert cells[5, 5] == pytest.approx(0.75 * 0.5) and (4, 4) not in cells and cells[3, 12] == pytest.approx(0.5)
    assert max(cells.values()) <= 1 + 1e-9


def test_boundaries_as_wkb(spark):
    poly, hole, island = star(3), [(18.0, 14.0), (18.5, 14.0), (18.5, 14.5)], [(1.0, 1.0), (3.0, 1.0), (3.0, 4.0)]
    multi = write_wkb([(0, 0, np.array(poly)), (0, 1, np.array(hole)), (1, 0, np.array(island))])
    assert [(p, r, len(x)) for p, r, x in read_wkb(multi)] == [(0, 0, 10), (0, 1, 4), (1, 0, 4)]
    # A big-endian polygon with heights and a reference system, as other writers make it.
    ring = np.array([(0.0, 0.0, 7.0), (4.0, 0.0, 7.0), (4.0, 3.0, 7.0), (0.0, 0.0, 7.0)], ">f8")
    other = b"\x00" + np.array([0xA0000003, 4326, 1, 4], ">u4").tobytes() + ring.tobytes()
    assert read_wkb(other)[0][2].tolist() == [[0, 0], [4, 0], [4, 3], [0, 0]]
    iso = b"\x01" + np.array([1003, 1, 4], "<u4").tobytes() + ring.astype("<f8").tobytes()
    assert read_wkb(iso)[0][2].shape == (4, 2) and read_wkb(b"") == []
    with pytest.raises(ValueError):
        read_wkb(b"\x01" + np.array([1], "<u4").tobytes())
    zones = spark.createDataFrame([("A", "C", bytearray(multi)), ("B", "C", bytearray(other)), ("E", "C", None)], "GID_1 string, GID_0 string, geometry binary")
    edges = ring_edges(zone_rings(zones, "GID_1"))
    same = edges_of(spark, [("A", 0, 0, poly), ("A", 0, 1, hole), ("A", 1, 0, island), ("B", 0, 0, [(0, 0), (4, 0), (4, 3)])])
    columns = ("gadm_id", "part", "ring", "x1", "y1", "x2", "y2")
    assert sorted(map(tuple, edges.select(*columns).collect())) == sorted(map(tuple, same.select(*columns).collect()))


def test_zones_partly_outside_the_raster(spark):
    box = [(-5.0, -5.0), (3.5, -5.0), (3.5, 2.0), (-5.0, 2.0)]
    edges = edges_of(spark, [("Z", 0, 0, box)])
    assert zone_cells(edges, GRID, "coverage").agg({"coverage": "sum"}).first()[0] == pytest.approx(7.0)
    far = edges_of(spark, [("Z", 0, 0, [(100.0, 100.0), (110.0, 100.0), (110.0, 110.0)])])
    assert all(zone_cells(far, GRID, m).count() == 0 for m in ("center", "all_touched", "coverage"))


def test_descending_latitudes(spark):
    down = GridSpec(29.5, -1.0, 30, 0.5, 1.0, 40)
    poly = star(5)
    up_cells = {(29 - r["lat_idx"], r["lon_idx"], round(r["coverage"], 9)) for r in zone_cells(edges_of(spark, [("Z", 0, 0, poly)]), GRID).collect()}
    down_cells = {(r["lat_idx"], r["lon_idx"], round(r["coverage"], 9)) for r in zone_cells(edges_of(spark, [("Z", 0, 0, poly)]), down).collect()}
    assert up_cells == down_cells


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        zone_cells(edges_of(spark, [("Z", 0, 0, P2)]), GRID, "fuzzy")


def test_boxes(spark):
    edges = edges_of(spark, [("A", 0, 0, P1), ("B", 0, 0, P2), ("H", 0, 0, [(0, 0), (30, 0), (30, 30), (0, 30)]), ("H", 0, 1, [(5, 5), (5, 25), (25, 25), (25, 5)])])
    found = lambda *box: sorted(r["gadm_id"] for r in zones_in_bbox(edges, *box).collect())
    assert found(60, 20, 70, 30) == ["B"]  # box inside
    assert found(0, -5, 100, 60) == ["A", "B", "H"]  # zones inside
    assert found(10, 10, 11, 11) == ["A"]  # in the hole of H
    assert found(30, 40, 50, 60) == ["B"]  # touching a side
    assert found(200, 200, 210, 210) == []
    bounds = {r["gadm_id"]: (r["minx"], r["maxy"]) for r in zone_bounds(edges).collect()}
    assert bounds["A"] == (3.2, 41.4)
    cells = spark.createDataFrame([(1.0, 1.0), (3.4, 1.0), (3.6, 1.0)], "lat double, lon double")
    assert bbox_filter(cells, 0, 0, 3, 3).count() == 2


def dense_case(spark, seed=11):
    rng = np.random.default_rng(seed)
    score = np.where(rng.random((30, 40)) < 0.6, rng.integers(0, 11, (30, 40)).astype(float), np.nan)
    score[0, :5] = np.nan
    data = [("10", "RCP45", "Cc", r, c, float(score[r, c])) for r in range(30) for c in range(40) if not np.isnan(score[r, c])]
    scored = spark.createDataFrame(data, "scoring string, scenario string, time string, lat_idx int, lon_idx int, score double")
    zones = [("A", 0, 0, star(1)), ("B", 0, 0, star(2, cx=30, cy=20, far=9)), ("E", 0, 0, [(0, 0), (4, 0), (4, 1), (0, 1)])]
    weights = zone_cells(edges_of(spark, zones), GRID, "coverage")
    w = {}
    for r in weights.collect():
        w.setdefault(r["gadm_id"], np.zeros((30, 40)))[r["lat_idx"], r["lon_idx"]] = r["coverage"]
    return scored, weights, score, w


@pytest.mark.parametrize("missing", ["zero", "skip"])
def test_zonal_statistics_against_arrays(spark, missing):
    scored, weights, score, w = dense_case(spark)
    out = {r["gadm_id"]: r for r in zonal_stats(scored, weights, missing).collect()}
    for zone, weight in w.items():
        s = np.nan_to_num(score) if missing == "zero" else score
        use = (weight > 0) & ~np.isnan(s)
        if not use.any():
            assert zone not in out
            continue
        mean = np.average(s[use], weights=weight[use])
        std = np.sqrt(np.average((s[use] - mean) ** 2, weights=weight[use]))
        got = out[zone]
        assert (got["score_mean"], got["score_max"], got["score_stdev"]) == pytest.approx((mean, s[use].max(), std), abs=1e-9)


def test_cells_and_weights_meet_by_tile_in_every_session(spark):
    scored, weights, _, _ = dense_case(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")  # Spark's default
    try:
        tiled = zonal_stats(scored, weights, "zero")
        plan = tiled._jdf.queryExecution().executedPlan().toString()
        by_tile = [line for line in plan.splitlines() if "Exchange hashpartitioning(_row" in line]
        # Both sides are exchanged by tile and not again by cell.
        assert len(by_tile) == 2 and "hashpartitioning(lat_idx" not in plan and tiled.count() == 3
        risk = weighted_risk(scored, weights)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(_row" in risk
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clipping_reaches_the_scan(spark, tmp_path):
    scored, weights, _, _ = dense_case(spark)
    path = str(tmp_path / "scored")
    scored.write.parquet(path)
    some = weights.filter("gadm_id = 'E'")
    clipped = clip_to_zones(spark.read.parquet(path), some)
    assert "GreaterThanOrEqual(lat_idx,0" in clipped._jdf.queryExecution().executedPlan().toString()
    assert clipped.count() == 0  # the zone's only row holds no value in its columns
    assert clip_to_zones(scored, weights.limit(0)).count() == 0
    whole = clip_to_zones(scored, weights)
    assert zonal_stats(whole, weights).count() == zonal_stats(scored, weights).count()


def test_deviation_keeps_its_digits_far_from_zero(spark):
    data = [(0, c, 1e9 + (c % 2)) for c in range(8)]
    scored = spark.createDataFrame(data, "lat_idx int, lon_idx int, score double")
    cells = spark.createDataFrame([("A", "C", 0, c, 1.0 / (1 + c % 3)) for c in range(8)], "gadm_id string, gid0 string, lat_idx int, lon_idx int, coverage double")
    got = zonal_stats(scored, cells).first()
    s, w = np.array([c % 2 for c in range(8)], float), np.array([1.0 / (1 + c % 3) for c in range(8)])
    mean = np.average(s, weights=w)
    assert got["score_stdev"] == pytest.approx(np.sqrt(np.average((s - mean) ** 2, weights=w)), rel=1e-5)
    assert zonal_stats(scored.selectExpr("lat_idx", "lon_idx", "5.1 + 0 * score AS score"), cells).first()["score_stdev"] == 0


def test_several_columns_at_once(spark):
    scored, weights, _, _ = dense_case(spark)
    wide = scored.drop("scoring").withColumnRenamed("score", "a").selectExpr("*", "2 * a AS b")
    both = zonal_multi(wide, weights, {"5": "a", "10": "b"}, "zero")
    five = {r["gadm_id"]: r["score_mean"] for r in both.filter("scoring = '5'").collect()}
    ten = {r["gadm_id"]: r["score_mean"] for r in both.filter("scoring = '10'").collect()}
    assert ten == pytest.approx({k: 2 * v for k, v in five.items()})
    with pytest.raises(ValueError):
        zonal_multi(wide, weights, {"5": "a"}, "drop")


def weighted_case(spark):
    scores = {0: 5.0, 1: 1.0, 2: 0.0, 3: None, 4: 3.5}
    data = [("5", "RCP85", "Cc", 0, c, v) for c, v in scores.items()]
    scored = spark.createDataFrame(data, "scoring string, scenario string, time string, lat_idx int, lon_idx int, score double")
    members = {"mix": (0, 1, 2, 3, 4), "zeros": (2, 3), "low": (1, 2), "none": (9,), "half": (4, 1)}
    cells = spark.createDataFrame(
        [(z, "C", 0, c, 1.0) for z, cs in members.items() for c in cs],
        "gadm_id string, gid0 string, lat_idx int, lon_idx int, coverage double",
    )
    coast = spark.createDataFrame([(0, 0, 0.5, 0.5, 1.0), (0, 3, 0.5, 3.5, 1.0), (0, 1, 0.5, 1.5, 0.0)], "lat_idx int, lon_idx int, lat double, lon double, mask double")
    return scored, cells, coast


def test_weighted_risk_over_present_cells(spark):
    scored, cells, _ = weighted_case(spark)
    risk = {r["gadm_id"]: (r["weighted_risk"], r["score_max"]) for r in weighted_risk(scored, cells).collect()}
    assert risk["mix"] == (pytest.approx((0.4 + 0.001) / 4), 5.0)
    assert risk["zeros"] == (None, 0.0)  # a highest score of 0 has no weight
    assert risk["low"] == (pytest.approx(0.0005), 1.0)
    assert risk["none"] == (None, None)
    assert risk["half"] == (pytest.approx(0.0005), 3.5)  # the fraction has no weight, its cell counts
    classes = {r["gadm_id"]: r["score_mean"] for r in rp_weighted(scored, cells, "RF").collect()}
    assert classes == {"mix": 5, "zeros": 0, "low": 3, "none": 0, "half": 3}


def test_weighted_risk_over_coastal_cells(spark):
    scored, cells, coast = weighted_case(spark)
    risk = {r["gadm_id"]: r["weighted_risk"] for r in weighted_risk(scored, cells, coast).collect()}
    assert risk["mix"] == pytest.approx((0.4 + 0.001) / 2)
    assert risk["low"] is None  # no coast


def test_risk_is_capped_by_the_highest_score(spark):
    scored, cells, coast = weighted_case(spark)
    few = scored.filter("lon_idx IN (0, 1)")
    one = coast.filter("lon_idx = 0")
    risk = {r["gadm_id"]: r["weighted_risk"] for r in weighted_risk(few, cells, one).collect()}
    assert risk["mix"] == 0.4  # (0.4 + 0.001) / 1 capped at the weight of score 5


@pytest.mark.parametrize("mode", ["center", "all_touched", "coverage"])
def test_runs_stand_for_the_cells(spark, mode):
    edges = edges_of(spark, [("A", 0, 0, P1), ("B", 0, 0, star(3)), ("C", 0, 0, star(4, far=14.0))])
    runs, cells = zone_runs(edges, GRID, mode), zone_cells(edges, GRID, mode)
    rounded = lambda df: sorted((r["gadm_id"], r["lat_idx"], r["lon_idx"], round(r["coverage"], 9)) for r in df.collect())
    assert rounded(cells_of(runs)) == rounded(cells) == rounded(cells_of(runs_of(cells)))
    assert runs.count() < cells.count() / (1.2 if mode == "coverage" else 4)
    assert runs_of(cells).count() <= runs.count()
    scored = spark.range(30 * 40).selectExpr("'5' AS scoring", "CAST(id % 30 AS INT) AS lat_idx", "CAST(id DIV 30 AS INT) AS lon_idx", "CASE WHEN id % 7 > 0 THEN CAST(id % 5 AS DOUBLE) END AS score")
    for missing in ("zero", "skip"):
        both = [sorted((r["gadm_id"], *(round(r[c], 9) for c in ("score_mean", "score_max", "score_stdev"))) for r in zonal_stats(scored, z, missing).collect()) for z in (runs, cells)]
        assert both[0] == both[1] and len(both[0]) == 3
    assert clip_to_zones(scored, runs).count() == clip_to_zones(scored, cells).count()


def test_uncalibrated_scale(spark):
    scored, cells, _ = weighted_case(spark)
    with pytest.raises(ValueError):
        rp_weighted(scored, cells, "RF", bins={("RF", 1, "5"): None})


def test_calibration(spark):
    risk = spark.createDataFrame([("RF", "5", float(v)) for v in (0, 1, 2, 3, 4, 5, 6)], "hazard string, scoring string, weighted_risk double")
    cuts = calibrate_bins(risk)
    assert tuple(cuts.first()) == ("RF", "5", 2.0, 3.0, 4.0, 5.0)
    assert bins_of(cuts, "RF", 1)["RF", 1, "5"] == tuple(cuts.first())[2:]
    assert calibrate_bins(risk.filter("weighted_risk <= 0")).count() == 0


def test_exact_quantiles_of_more_values_than_a_sketch_holds(spark):
    # 200 000 distinct values in one group beside small ones, ties, a missing key and missing values.
    rows = spark.range(200000).selectExpr("'big' AS k", "CAST((id * 7919) % 200003 AS DOUBLE) / 7 AS v")
    small = [("tie", 5.0)] * 7 + [("tie", 1.0)] * 3 + [("one", -2.5), (None, 8.0), (None, 9.0), ("none", None)]
    both = rows.unionByName(spark.createDataFrame(small, "k string, v double"))
    shares = [0.0, 0.2, 0.3, 0.5, 0.999, 1.0]
    values = {}
    for r in both.filter("v IS NOT NULL").collect():
        values.setdefault(r["k"], []).append(r["v"])
    want = {k: [sorted(v)[max(-(-round(p * 1000) * len(v) // 1000), 1) - 1] for p in shares] for k, v in values.items()}
    for ranges in (1, 5, 40):
        assert {r["k"]: r["quantiles"] for r in exact_quantiles(both, "v", ["k"], shares, ranges).collect()} == want
    assert exact_quantiles(both, "v", [], [0.5]).first()["quantiles"] == [sorted(sum(values.values(), []))[-(-sum(map(len, values.values())) // 2) - 1]]
    assert exact_quantiles(both.limit(0), "v", ["k"], shares).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(both, "v", ["k"], [1.5])


def test_calibration_within_the_aggregate(spark):
    scored, cells, coast = weighted_case(spark)
    both = scored.withColumn("hazard", F.explode(F.array(F.lit("RF"), F.lit("CF"))))
    combos = both.select("hazard", "scoring", "scenario", "time").distinct()
    open_bins = {("RF", 1, "5"): None, ("CF", 1, "5"): None}
    out = flood_statistics(both, cells, ("RF", "CF"), combos, coast=coast, bins=open_bins, calibrate=True)
    for code, shore in (("RF", None), ("CF", coast)):
        risk = weighted_risk(scored, cells, shore).withColumn("weighted_risk", F.round("weighted_risk", 12)).withColumn("hazard", F.lit(code)).withColumn("gadm_level", F.lit(1))
        alone = rp_weighted(scored, cells, code, 1, shore, bins_of(calibrate_bins(risk), code, 1))
        columns = ("gadm_id", "scenario", "time", "score_mean", "score_max")
        assert sorted(map(tuple, out.filter(F.col("hazard") == code).select(*columns).collect()), key=str) == sorted(map(tuple, alone.select(*columns).collect()), key=str)


def test_floods_in_one_pass_equal_the_parts(spark, caplog):
    scored, cells, coast = weighted_case(spark)
    ten, hundred = (scored.withColumn("scoring", F.lit(k)) for k in ("10", "100"))
    every = scored.unionByName(ten).unionByName(hundred)
    combos = every.select("scoring", "scenario", "time").distinct()
    zones = spark.createDataFrame([("islet", "C"), ("mix", "C")], "gadm_id string, gid0 string")
    with caplog.at_level("WARNING"):
        out = flood_statistics(every, cells, "RF", combos, zones=zones)
    assert "scale 10 skipped" in caplog.text
    columns = ["gadm_id", "gid0", "scoring", "scenario", "time", "score_mean", "score_max", "score_stdev"]
    parts = rp_weighted(scored, cells, "RF", zones=zones).select(columns).unionByName(zonal_stats(hundred, cells, "skip").select(columns))
    rounded = lambda df: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(columns).collect()), key=str)
    assert rounded(out) == rounded(parts)
    assert ("islet", "5", 0.0, None) in {(r["gadm_id"], r["scoring"], r["score_mean"], r["score_max"]) for r in out.collect()}
    caplog.clear()
    with caplog.at_level("WARNING"):
        coastal = flood_statistics(scored, cells, "CF", combos.filter("scoring = '5'"), coast=coast)
    assert "skipped" not in caplog.text
    assert rounded(coastal) == rounded(rp_weighted(scored, cells, "CF", coast=coast))


@pytest.mark.parametrize("mode", ["center", "all_touched", "coverage"])
def test_edges_are_dealt_before_they_are_summed(spark, mode):
    # An aggregate on the input splits would hold all cells that a split's edges pass.
    plan = zone_runs(edges_of(spark, [("Z", 0, 0, star(5))]), GRID, mode)._jdf.queryExecution().executedPlan().toString()
    assert plan.rfind("Exchange") > plan.rfind("Aggregate")


@pytest.mark.parametrize("mode", ["center", "all_touched", "coverage"])
def test_edges_are_dealt_before_they_are_cut_at_rows(spark, mode):
    # The task that reads the edges must not hold a row for every raster row they cross.
    plan = zone_runs(edges_of(spark, [("Z", 0, 0, star(5))]), GRID, mode)._jdf.queryExecution().executedPlan().toString().splitlines()
    rows = [i for i, line in enumerate(plan) if "Generate" in line and "lat_idx" in line]
    dealt = [i for i, line in enumerate(plan) if re.search(r"Exchange hashpartitioning\(gadm_id[^)]*_band", line)]
    assert rows and dealt and max(rows) < max(dealt) and all("REPARTITION_BY_NUM" in plan[i] for i in dealt)


def test_zones_are_dealt_before_their_edges_are_made(spark, sf_dir):
    for name in ("edges_fx", "windings_fx", "districts_fx", "district_edges_fx"):
        edges = view(spark, sf_dir, name)
        assert "Exchange hashpartitioning(c_custkey" in edges._jdf.queryExecution().executedPlan().toString()


def test_tables_are_read_in_small_splits(spark, sf_dir, tmp_path):
    # A split's groups are held by the task that reads it: at 24 MB four tasks would read six row groups.
    rows = spark.range(3_000_000).select("id", F.xxhash64("id").alias("v")).coalesce(1)
    rows.write.option("parquet.block.size", 4 << 20).parquet(f"{tmp_path}/part.parquet")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    before = spark.read.parquet(f"{tmp_path}/part.parquet").rdd.getNumPartitions()
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        view(spark, sf_dir, "zones_fx")
        assert spark.read.parquet(f"{tmp_path}/part.parquet").rdd.getNumPartitions() > before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_zones_over_several_bands(spark):
    tall = GridSpec(0.5, 1.0, 100, 0.5, 1.0, 40)
    poly = [(4.2, -6.3), (33.1, 20.7), (30.6, 70.2), (36.4, 108.9), (2.9, 97.3), (11.7, 50.1)]
    edges = edges_of(spark, [("Z", 0, 0, poly), ("Y", 0, 0, [(1.2, 30.4), (9.8, 30.4), (9.8, 33.6), (1.2, 33.6)])])
    found = {mode: zone_cells(edges, tall, mode).collect() for mode in ("center", "all_touched", "coverage")}
    cells = {mode: {(r["lat_idx"], r["lon_idx"]) for r in rows if r["gadm_id"] == "Z"} for mode, rows in found.items()}
    assert all(len({(r["gadm_id"], r["lat_idx"], r["lon_idx"]) for r in rows}) == len(rows) for rows in found.values())
    assert cells["center"] == {(r, c) for r in range(100) for c in range(40) if inside(poly, c + 0.5, r + 0.5)}
    assert cells["center"] <= cells["all_touched"] and cells["coverage"] <= cells["all_touched"]
    box = [r["coverage"] for r in found["coverage"] if r["gadm_id"] == "Y"]
    assert sum(box) == pytest.approx(8.6 * 3.2, abs=1e-9)
    assert {r["lat_idx"] for r in found["all_touched"] if r["gadm_id"] == "Y"} == {30, 31, 32, 33}


def test_touched_runs_are_merged(spark):
    zones = [("Z", 0, 0, [(2.5, 2.2), (9.5, 2.4), (9.5, 4.6), (2.5, 4.6)]), ("Z", 1, 0, [(10.2, 2.2), (12.4, 2.3), (12.4, 3.4)]), ("Z", 2, 0, [(20.1, 2.2), (21.4, 2.3), (21.4, 2.8)])]
    runs = zone_runs(edges_of(spark, zones), GRID, "all_touched").filter("lat_idx = 2").sort("lon_idx").collect()
    assert [(r["lon_idx"], r["lon_end"], r["coverage"]) for r in runs] == [(2, 12, 1.0), (20, 21, 1.0)]


def _zones_over_tiles(spark, sizes):
    """Zones as cells: each one row of cells from column 0, and a score for every cell."""
    cells = [(f"Z{k}", "N", 0, c, 0.25 + 0.5 * (c % 2)) for k, n in enumerate(sizes) for c in range(n)]
    weights = spark.createDataFrame(cells, "gadm_id string, gid0 string, lat_idx int, lon_idx int, coverage double")
    scores = spark.createDataFrame([(0, c, t, 1e6 + c % 7) for c in range(max(sizes)) for t in ("Cc", "Lt")], "lat_idx int, lon_idx int, time string, score double")
    return scores, weights


def test_moments_of_tiles_merge_to_the_zone(spark):
    sizes = (5, 40, 200)  # within a tile, over two, over seven
    scores, weights = _zones_over_tiles(spark, sizes)
    for zones in (weights, runs_of(weights)):
        got = {(r["gadm_id"], r["time"]): r for r in zonal_stats(scores.withColumn("scoring", F.lit("5")), zones).collect()}
        assert len(got) == 2 * len(sizes)
        for k, n in enumerate(sizes):
            w, s = np.array([0.25 + 0.5 * (c % 2) for c in range(n)]), np.array([1e6 + c % 7 for c in range(n)])
            mean = (w * s).sum() / w.sum()
            for time in ("Cc", "Lt"):
                r = got[f"Z{k}", time]
                assert r["score_mean"] == pytest.approx(mean, rel=1e-12) and r["score_max"] == s.max()
                assert r["score_stdev"] == pytest.approx(np.sqrt((w * (s - mean) ** 2).sum() / w.sum()), rel=1e-6)


def test_zonal_sums_move_once(spark):
    scores, weights = _zones_over_tiles(spark, (5, 40))
    found = zonal_stats(scores.withColumn("scoring", F.lit("5")), weights, missing="zero")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The cells and the zones by tile, moments and totals by zone; nothing is dealt by zone and label.
    assert plan.count("hashpartitioning(gadm_id") == 2 and not re.search(r"hashpartitioning\(gadm_id[^)]*time", plan)


def test_weighted_sums_keep_the_sessions_partitions(spark):
    weights = spark.createDataFrame([("Z", "A", 0, 0, 40, 1.0)], "gadm_id string, gid0 string, lat_idx int, lon_idx int, lon_end int, coverage double")
    scored = spark.createDataFrame([("5", 0, 3, 2.0), ("5", 0, 40, 4.0)], "scoring string, lat_idx int, lon_idx int, score double")
    risk = weighted_risk(scored, weights)
    plan = risk._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [line for line in plan if "Exchange" in line and re.search(r"hashpartitioning\((_row|_of_row|_column|_of_column)#", line)]
    moved = [line for line in plan if "Exchange" in line and "hashpartitioning(gadm_id" in line and "REPARTITION_BY_NUM" in line]
    # Rows meet by tile and sums move by zone, in as many partitions as the session has, whatever adaptive execution would join.
    assert len(dealt) == 2 and all("REPARTITION_BY_NUM" in line for line in dealt) and len(moved) == 1
    # The zone's sums span two tiles.
    whole = weighted_risk(scored.withColumn("lon_idx", F.col("lon_idx") % 32), weights).collect()
    assert risk.collect() == whole and len(whole) == 1 and whole[0]["score_max"] == 4.0


def test_zones_and_labels_to_report_meet_the_moments_without_a_join(spark):
    # Both sides of a join on all zones and labels were sorted by six texts.
    cells = [("RCP85", "Cc", 0, 0, 4.0), ("RCP85", "Cc", 0, 1, 2.0), ("RCP85", "Lt", 0, 0, 1.0), (None, "Cc", 0, 0, 9.0), ("RCP45", "Cc", 0, 0, 9.0)]
    scored = spark.createDataFrame(cells, "scenario string, time string, lat_idx int, lon_idx int, score double")
    zones = spark.createDataFrame([("A", "X", 0, 0, 1.0), ("A", "X", 0, 1, 1.0), ("A", "X", 0, 2, 2.0), ("B", "X", 5, 5, 1.0), (None, "X", 0, 0, 1.0)], "gadm_id string, gid0 string, lat_idx int, lon_idx int, coverage double")
    combos = spark.createDataFrame([("RCP85", "Cc"), ("RCP85", "Lt"), (None, "Cc")], "scenario string, time string")
    stats = zonal_stats(scored, zones, missing="zero", combos=combos)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" not in plan and "_code" in plan
    found = {(r["gadm_id"], r["scenario"], r["time"]): (r["score_mean"], r["score_max"], round(r["score_stdev"], 9)) for r in stats.collect()}
    # Labels and zones without a name meet nothing, combinations that aren't asked for are left out.
    nothing = (0.0, 0.0, 0.0)
    assert found == {
        ("A", "RCP85", "Cc"): (1.5, 4.0, round((11 / 4) ** 0.5, 9)), ("A", "RCP85", "Lt"): (0.25, 1.0, round(0.1875**0.5, 9)),
        ("A", None, "Cc"): nothing, ("B", "RCP85", "Cc"): nothing, ("B", "RCP85", "Lt"): nothing, ("B", None, "Cc"): nothing,
        (None, "RCP85", "Cc"): nothing, (None, "RCP85", "Lt"): nothing, (None, None, "Cc"): nothing,
    }
