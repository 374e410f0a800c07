from __future__ import annotations

import logging
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hazardgrid.operators.geometry import ring_edges, zone_cells
from hazardgrid.operators.prepare import scored_dims
from hazardgrid.plans import aggregate_hazard, combine_only, full_run, score_all, score_cf, score_hazard, score_ls, score_many, score_rf, score_standard, score_sub, score_wf
from hazardgrid.plans.aggregate import prepare_scored
from hazardgrid.plans.full import PartialRun
from hazardgrid.schema import HAZARD_STATS, GridSpec
from hazardgrid.sources import readers, writers
from hazardgrid.sources.stage import CLEANUP, shared_dir, stage, stage_name, staging, unstage

CELLS = "scenario string, time string, lat_idx int, lon_idx int, v double"
STATIC = "lat_idx int, lon_idx int, p double"


def by(df, *keys, value="score"):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r[value] for r in df.collect()}


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_standard_job_keeps_scenario_and_time(spark):
    df = spark.createDataFrame([("p95", "RCP85", "Cc", 0, 0, 0.1), ("p5", "RCP85", "Cc", 0, 0, 0.9)], "metric string, " + CELLS)
    out = score_standard(df, "HP", "v", ("5", "10"))
    assert out.columns[:3] == ["scenario", "time", "lat_idx"]
    assert by(out, "scoring") == {"5": 1.0, "10": 2.0}


def test_many_hazards_from_one_scan(spark):
    data = [(h, m, s, t, 0, c, v + c) for h, v in (("HP", 0.1), ("CS", -20.0), ("ER", 3.0), ("TC", 40.0)) for m in ("p5", "p95") for s in ("RCP45", "RCP85") for t in ("Cc", "St", "Lt") for c in range(3)]
    df = spark.createDataFrame(data, "hazard string, metric string, " + CELLS)
    codes, labels = ("HP", "CS", "ER", "TC"), ("hazard", "scenario", "time", "lon_idx", "scoring", "score")
    many = score_many(df, codes, "v", ("5", "10", "100"))
    each = [score_standard(df.filter(F.col("hazard") == c), c, "v", ("5", "10", "100")) for c in codes]
    key = lambda frames: sorted(tuple(r[c] for c in labels) for f in frames for r in f.collect())
    assert key([many]) == key(each)
    assert {r["hazard"] for r in many.filter("metric IS NULL").collect()} == {"HP", "CS"}
    assert score_many(df, codes, "v")._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_subsidence_doubles_only_the_ten_point_scale(spark):
    df = spark.createDataFrame([("RCP85", "Cc", 0, 0, 1.0), ("RCP85", "Lt", 0, 1, 2.5)], CELLS)
    out = by(score_sub(df, "v", ("5", "10", "100")), "scoring", "lon_idx")
    assert out == {("5", 0): 1, ("5", 1): 2, ("10", 0): 4, ("10", 1): 10, ("100", 0): 0, ("100", 1): 100}


def test_landslide(spark):
    ari = spark.createDataFrame([("RCP85", "Cc", 0, 0, 12.0), ("RCP85", "Lt", 0, 0, 30.0), ("RCP85", "Lt", 0, 1, 30.0)], CELLS)
    susceptibility = spark.createDataFrame([(0, 0, 4.0), (0, 1, None)], STATIC)
    out = by(score_ls(ari, susceptibility, ("5", "10", "100"), "v", "p"), "scoring", "time", "lon_idx")
    # 5-point: 3 × 4 = 12 → 3 and 5 × 4 = 20 → 5; 10-point: 5 × 8 = 40 → 4 and 10 × 8 = 80 → 8.
    assert out["5", "Cc", 0] == 3 and out["5", "Lt", 0] == 5
    assert out["10", "Cc", 0] == 4 and out["10", "Lt", 0] == 8
    assert out["100", "Cc", 0] == 0 and out["100", "Lt", 0] == 100
    assert out["5", "Lt", 1] is None and out["100", "Lt", 1] is None
    only = by(score_ls(ari, susceptibility, ("100",), "v", "p"), "scoring", "time", "lon_idx")
    assert only["100", "Lt", 0] == 100
    with pytest.raises(ValueError):
        score_ls(ari, susceptibility, (), "v", "p")


def test_wildfire_fills_gaps_on_the_footprint_only(spark):
    fwi = spark.createDataFrame([("RCP85", "Lt", 0, 0, 10.0), ("RCP85", "Lt", 2, 3, 2.0)], CELLS)
    burn = spark.createDataFrame([(0, 0, 1.0), (0, 2, 5.0), (2, 0, 1.0), (1, 1, None)], STATIC)
    out = by(score_wf(fwi, burn, 3, 4, ("5",), "v", "p"), "lat_idx", "lon_idx")
    assert out == {(0, 0): 2, (0, 2): 5, (2, 0): 1}


def flood(spark):
    data = [
        ("HISTORICAL", "Cc", "M1", 0, 0, 20.0), ("HISTORICAL", "Cc", "M2", 0, 0, 40.0), ("RCP45", "Cc", "M1", 0, 0, 900.0),
        ("RCP45", "Lt", "M1", 0, 0, 3.0), ("RCP85", "Lt", "M1", 0, 0, 600.0), ("RCP85", "Lt", "M1", 0, 1, None),
    ]
    cells = spark.createDataFrame(data, "scenario string, time string, model string, lat_idx int, lon_idx int, v double")
    return cells, spark.createDataFrame([(0, 0, 2.0), (0, 1, 1.0)], STATIC)


def test_river_flood(spark):
    cells, protection = flood(spark)
    out = by(score_rf(cells, protection, "v", "p", ("5", "10", "100")), "scoring", "scenario", "time", "lon_idx")
    # Mean return period 30 → 4 minus protection 2, for both scenarios' current climate.
    assert out["5", "RCP45", "Cc", 0] == out["5", "RCP85", "Cc", 0] == 2
    assert out["5", "RCP45", "Lt", 0] == 3 and out["5", "RCP85", "Lt", 0] == 0
    assert out["10", "RCP45", "Lt", 0] == 9 - 4 and out["10", "RCP45", "Cc", 0] == 6 - 4
    assert out["5", "RCP85", "Lt", 1] is None
    assert not any(k[1] == "HISTORICAL" for k in out)
    assert out["100", "RCP85", "Lt", 0] == 60  # 100 minus 2 × 20


def test_coastal_flood_keeps_the_historical_scenario(spark):
    cells, protection = flood(spark)
    out = by(score_cf(cells, protection, "v", "p", ("5",)), "scenario", "time", "lon_idx")
    assert out["HISTORICAL", "Cc", 0] == 2 and out["RCP45", "Cc", 0] == 0
    filled = by(score_cf(cells, protection, "v", "p", ("5",), current_from_historical=True), "scenario", "time", "lon_idx")
    assert filled["RCP45", "Cc", 0] == 2


def test_dispatch(spark, caplog):
    cells, protection = flood(spark)
    heat = spark.createDataFrame([("RCP85", "Cc", 0, 0, 40.0)], CELLS)
    assert by(score_hazard("HS", heat, value="v"), "hazard", "scoring") == {("HS", "5"): 4, ("HS", "10"): 8}
    for bad in (lambda: score_hazard("XX", heat), lambda: score_hazard("RF", cells), lambda: score_hazard("WF", heat, protection)):
        with pytest.raises(ValueError):
            bad()
    inputs = {
        "HS": lambda: {"cells": heat, "value": "v"},
        "WS": lambda: {"cells": heat, "value": "no_such_column"},
        "RF": lambda: {"cells": cells, "static": protection, "value": "v", "static_col": "p"},
    }
    with caplog.at_level(logging.ERROR):
        done, failed = score_all(inputs)
    assert set(done) == {"HS", "RF"} and set(failed) == {"WS"} and "WS" in caplog.text


def test_upsert_leaves_other_scales_untouched(spark, tmp_path):
    path = str(tmp_path / "scored")
    base = spark.createDataFrame([("RCP85", "Cc", 0, c, float(c)) for c in range(50)], CELLS)

    def scores(scale, hazard="HS", k=1):
        return base.selectExpr(f"'{hazard}' AS hazard", f"'{scale}' AS scoring", "scenario", "time", "lat_idx", "lon_idx", f"v * {k} AS score")

    writers.write_scored(scores("5").unionByName(scores("10")).unionByName(scores("5", "CS")), path)
    before = files(path)
    writers.write_scored(scores("10", k=3).unionByName(scores("100", k=2)), path)
    after = files(path)
    same = {f for f in before if "scoring=5" in f}
    assert same and all(after[f] == before[f] for f in same)
    assert not any("scoring=10/" in f and f in after for f in before)
    out = writers.read_scored(spark, path, "HS")
    assert by(out.groupBy("scoring").agg(F.max("score").alias("score")), "scoring") == {"5": 49, "10": 147, "100": 98}
    assert writers.read_scored(spark, path, scales=["5"]).count() == 100


def test_hazards_with_different_labels_share_a_table(spark, tmp_path):
    path = str(tmp_path / "scored")
    heat = spark.createDataFrame([("RCP85", "Cc", r, c, 40.0) for r in range(3) for c in range(4)], CELLS)
    flood_cells, protection = flood(spark)
    writers.write_scored(score_rf(flood_cells, protection, "v", "p", ("5",)).withColumn("hazard", F.lit("RF")), path)
    score_hazard("HS", heat, value="v", scales=("5",), out=path)
    for code, n in (("HS", 12), ("RF", 5)):
        scored = writers.read_scored(spark, path, code)
        assert "statistic" in scored.columns
        cells = prepare_scored(scored)
        # No label and no coordinate: nothing to choose from, so nothing is dropped.
        assert cells.count() == n and "statistic" not in cells.columns
    assert prepare_scored(writers.read_scored(spark, path)).count() == 17


def test_labels_outside_the_vocabulary_are_stored(spark, tmp_path):
    path = str(tmp_path / "scored")
    heat = spark.createDataFrame([("RCP85", "Cc", 0, c, 40.0, p) for c in range(2) for p in ("p5", "p95")], CELLS + ", percentile string")
    score_hazard("HS", heat, value="v", scales=("5",), out=path)
    score_hazard("WS", heat.drop("percentile").distinct(), value="v", scales=("5",), out=path)
    assert writers.read_scored(spark, path, "HS").select("percentile", "lon_idx").distinct().count() == 4
    assert "percentile" not in writers.read_scored(spark, path, "WS").columns
    assert writers.read_scored(spark, path).filter("percentile IS NULL").count() == 2


def scored_table(spark, path, n=24):
    cells = spark.range(n * n).selectExpr("CAST(id / 24 AS INT) AS lat_idx", "CAST(id % 24 AS INT) AS lon_idx").selectExpr("*", "lat_idx + 0.5D AS lat", "lon_idx + 0.5D AS lon")
    labels = spark.createDataFrame([(s, t, x) for s in ("RCP45", "RCP85") for t in ("Cc", "Lt") for x in ("mean", "max")], "scenario string, time string, statistic string")
    values = cells.crossJoin(labels).withColumn("value", F.col("lat_idx") * 40.0)
    static = cells.select("lat_idx", "lon_idx", F.lit(1.0).alias("p"))
    inputs = values.drop("statistic").filter("statistic = 'mean'").withColumn("model", F.lit("M"))
    score_hazard("HS", values, value="value", scales=("5", "10"), out=path)
    for code in ("RF", "CF"):
        score_hazard(code, inputs, static, "value", "p", ("5", "100"), out=path)
    rings = [(f"Z{i}", "C", 0, 0, [(4.0 * i, 0.0), (4.0 * i + 4, 0.0), (4.0 * i + 4, 24.0), (4.0 * i, 24.0)]) for i in range(6)]
    edges = ring_edges(spark.createDataFrame(rings, "gadm_id string, gid0 string, part int, ring int, points array<struct<x double, y double>>"))
    coast = cells.withColumn("mask", F.when(F.col("lon_idx") < 9, 1.0).otherwise(0.0))
    return stage(zone_cells(edges, GridSpec(0.5, 1.0, n, 0.5, 1.0, n)), "cells", reuse=False), coast


@pytest.mark.parametrize("code", ["HS", "RF", "CF"])
def test_scores_are_read_twice_at_most(spark, tmp_path, code):
    path = str(tmp_path / "scored")
    cells, coast = scored_table(spark, path)
    scored = writers.read_scored(spark, path, code)
    dims = stage(scored_dims(scored), "dims", reuse=False)
    stats = aggregate_hazard(scored, cells, code, coast=coast, dims=dims)
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [" in line and "score#" in line]
    # The scan for the dimensions is one, the one here the other.
    assert len(scans) == 1
    assert stats.count() > 0


def test_stage_is_reused_until_its_input_changes(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    double = lambda: spark.read.parquet(source).selectExpr("id * 2 AS x")
    name = stage_name(double(), "d")
    first = stage(double(), "d")
    again = stage(double(), "d")
    assert sorted(first.inputFiles()) == sorted(again.inputFiles())
    assert stage_name(double().filter("x > 2"), "d") != name != stage_name(double(), "d", ("v2",))
    assert sorted(stage(double(), "d", reuse=False).inputFiles()) != sorted(first.inputFiles())
    spark.range(6).write.mode("overwrite").parquet(source)
    assert stage_name(double(), "d") != name and stage(double(), "d").count() == 6
    folder = first.inputFiles()[0].split(":", 1)[-1].rsplit("/", 1)[0].replace("///", "/")
    assert Path(folder).exists()
    unstage(spark, first)
    assert not Path(folder).exists()
    kept = spark.read.parquet(source)
    unstage(spark, kept)  # not a stage
    assert kept.count() == 6
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_zone_sources(spark, tmp_path):
    base = str(tmp_path)
    zones = spark.createDataFrame([("AAA", "AAA.1"), ("AAA", "AAA.2"), ("BBB", "BBB.1"), ("ATA", "ATA.1")], "GID_0 string, GID_1 string")
    for level in (0, 1, 2):
        writers.partition_zones(zones, base, level)
    assert readers.read_zones(spark, base, 1).count() == 4
    one = readers.read_zones(spark, base, 2, "AAA")
    assert one.count() == 2 and len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(GID_0" in plan
    for args in ((3,), (2,)):
        with pytest.raises(ValueError):
            readers.read_zones(spark, base, *args)
    assert sorted(r[0] for r in readers.list_countries(spark, base, 1).collect()) == ["AAA", "BBB"]


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "cells")
    df = spark.range(100).selectExpr("'HS' AS hazard", "CAST(id AS DOUBLE) AS lat", "CAST(id AS DOUBLE) AS lon", "CAST(id AS DOUBLE) AS a", "id AS b")
    df.write.partitionBy("hazard").parquet(path)
    plan = readers.read_cells(spark, path, ["a"], hazard="HS")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hazard" in plan and "b:bigint" not in plan
    box = readers.read_coast(spark, path, (10, 10, 20, 20), 1)
    assert "GreaterThanOrEqual(lat,9.0)" in box._jdf.queryExecution().executedPlan().toString()
    assert box.count() == 13


def test_missing_and_broken_statistics_are_skipped(spark, tmp_path, caplog):
    (tmp_path / "HS_adm1.csv").write_text("gadm_id,gid0,scoring,scenario,time,score_mean,hazard,gadm_level\nA,B,5,RCP85,Cc,x,HS,1\n")
    (tmp_path / "WS_adm1.csv").mkdir()
    with caplog.at_level(logging.WARNING):
        stats = readers.read_hazard_stats(spark, str(tmp_path), 1, ("CS", "HS", "WS"))
    row = stats.first()
    assert stats.count() == 1 and row["scoring"] == "5" and row["score_mean"] is None and row["score_stdev"] is None
    assert "CS" in caplog.text and "WS" in caplog.text
    assert readers.read_hazard_stats(spark, str(tmp_path), 0) is None


def test_statistics_that_break_while_they_are_read_are_skipped(spark, tmp_path, caplog):
    import gzip

    head = "gadm_id,gid0,scoring,scenario,time,score_mean,hazard,gadm_level\n"
    for code in ("CS", "HS", "WS"):
        lines = head + "".join(f"Z{i},B,5,RCP85,Cc,{i % 5},{code},1\n" for i in range(20000))
        (tmp_path / f"{code}_adm1.csv").mkdir()
        whole = gzip.compress(lines.encode(), mtime=0)
        # The header of the torn one is there; a task finds the end missing.
        (tmp_path / f"{code}_adm1.csv" / "part-0.csv.gz").write_bytes(whole[: len(whole) * 2 // 3] if code == "HS" else whole)
    with caplog.at_level(logging.WARNING):
        stats = readers.read_hazard_stats(spark, str(tmp_path), 1, ("CS", "HS", "WS"))
    assert {r["hazard"]: r["n"] for r in stats.groupBy("hazard").agg(F.count("*").alias("n")).collect()} == {"CS": 20000, "WS": 20000}
    assert "HS failed" in caplog.text


def test_full_run(spark, tmp_path):
    grid = GridSpec(0.5, 1.0, 4, 0.5, 1.0, 6)
    rings = [("X.1", "X", 0, 0, [(0.0, 0.0), (3.0, 0.0), (3.0, 4.0), (0.0, 4.0)]), ("X.2", "X", 0, 0, [(3.0, 0.0), (6.0, 0.0), (6.0, 4.0), (3.0, 4.0)])]
    edges = ring_edges(spark.createDataFrame(rings, "gadm_id string, gid0 string, part int, ring int, points array<struct<x double, y double>>"))
    meta = spark.createDataFrame([("X", "Land", "X.1", "One", "P", ""), ("X", "Land", "X.2", "Two", "P", "")], ["GID_0", "COUNTRY", "GID_1", "NAME_1", "ENGTYPE_1", "VARNAME_1"])
    dims = [(s, t) for s in ("RCP45", "RCP85") for t in ("Cc", "Lt")]
    spots = [(r, c) for r in range(4) for c in range(6)]
    heat = spark.createDataFrame([(s, t, r, c, r + 0.5, c + 0.5, 30.0 if c < 3 else 50.0) for s, t in dims for r, c in spots], "scenario string, time string, lat_idx int, lon_idx int, lat double, lon double, v double")
    flood_cells = heat.withColumn("v", F.when(F.col("lon_idx") < 3, 3.0).otherwise(2000.0))
    protection = spark.createDataFrame([(r, c, 0.0) for r, c in spots], STATIC)
    coast = spark.createDataFrame([(r, c, r + 0.5, c + 0.5, 1.0 if c == 0 else 0.0) for r, c in spots], "lat_idx int, lon_idx int, lat double, lon double, mask double")
    inputs = {
        "HS": lambda: {"cells": heat, "value": "v"},
        "RF": lambda: {"cells": flood_cells, "static": protection, "value": "v", "static_col": "p"},
        "CF": lambda: {"cells": flood_cells, "static": protection, "value": "v", "static_col": "p"},
    }
    base = str(tmp_path / "run")
    stages = Path(shared_dir(spark).removeprefix("file:")) / "stages"
    before = set(stages.glob("*"))
    tables = full_run(spark, inputs, {1: zone_cells(edges, grid)}, {1: meta}, base, scales=("5", "100"), coast=coast)
    mean = {r["GID_1"]: r for r in tables[1, "5", "mean", "RCP85"].collect()}
    assert (mean["X.1"]["HS_Lt"], mean["X.2"]["HS_Lt"], mean["X.1"]["ER_Lt"]) == (2, 5, 0)
    assert (mean["X.1"]["RF_Cc"], mean["X.2"]["RF_Cc"]) == (5, 4)  # 0.4 and 0.001 as risk classes
    assert (mean["X.1"]["CF_Cc"], mean["X.2"]["CF_Cc"]) == (5, 0)  # the second has no coast
    assert (Path(base) / "combined/five/hazard_score_province_mean_85.csv").exists()
    assert (Path(base) / "combined/hundred/hazard_score_province_std_45.csv").exists()
    assert (Path(base) / "aggregations/RF_adm1.csv").exists()
    assert set(stages.glob("*")) == before  # no stage stays
    exported = readers.read_hazard_stats(spark, f"{base}/aggregations", 1)
    assert {r[0] for r in exported.select("hazard").distinct().collect()} == {"HS", "RF", "CF"}
    with pytest.raises(ValueError):
        aggregate_hazard(score_hazard("CF", **inputs["CF"]()), zone_cells(edges, grid), "CF")

    # A hazard that fails ends the run; where that is allowed, what an older run left isn't used.
    broken = inputs | {"HS": lambda: {"cells": heat, "value": "no_such_column"}}
    args = (spark, broken, {1: zone_cells(edges, grid)}, {1: meta}, base, ("5",))
    with pytest.raises(PartialRun, match="scoring failed for .'HS'"):
        full_run(*args, coast=coast)
    some = full_run(*args, coast=coast, allow_partial=True)
    assert {(r["HS_Lt"], r["RF_Cc"]) for r in some[1, "5", "mean", "RCP85"].collect()} == {(0, 5), (0, 4)}
    with pytest.raises(PartialRun, match="aggregation failed for .*CF"):
        full_run(spark, inputs, {1: zone_cells(edges, grid)}, {1: meta}, base, ("5",))
    older = combine_only(spark, {1: meta}, base, scales=("5",), hazards=("RF",))
    assert {r["HS_Lt"] for r in older[1, "5", "mean", "RCP85"].collect()} == {0}


def test_shuffle_files_of_a_run_go_with_their_query(spark):
    # They stayed until the driver's memory was cleared of them: a run's disk held the shuffles of all its phases.
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = manager.getAllFiles().mkString("\n").split("\n")
        return {n for n in names if "/shuffle_" in n and n.endswith(".data")}

    def work():
        return stage(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "shuffled", reuse=False)

    before = shuffled()
    with staging(spark):
        assert work().count() == 7
        until = time.time() + 30  # files are deleted a moment later, and none of this is held by the driver's memory
        while shuffled() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffled() - before
    assert spark.conf.get(CLEANUP) == "false"  # outside a run nothing changes


def test_statistics_of_many_hazards_are_written_without_a_sort(spark, tmp_path):
    rows = [(h, 1, f"Z{i}", "X", "5", "RCP85", "Cc", float(i), 1.0, 0.5) for h in ("HS", "WS", "CF") for i in range(20)]
    stats = spark.createDataFrame(rows, HAZARD_STATS)
    path = str(tmp_path / "stats")
    plans = []
    write = writers._overwrite_partitions

    def spied(df, *args, **options):
        plans.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        write(df, *args, **options)

    writers._overwrite_partitions = spied
    try:
        writers.write_hazard_stats(stats, path)
    finally:
        writers._overwrite_partitions = write
    assert plans[0] >= 14 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    writers.write_hazard_stats(stats.filter("hazard = 'HS'").limit(3), path)
    assert {r["hazard"]: r["count"] for r in spark.read.parquet(path).groupBy("hazard").count().collect()} == {"HS": 3, "WS": 20, "CF": 20}


def test_clip_and_countries_leave_the_choices_to_the_whole_table(spark):
    data = [("RCP85", "Cc", s, r, c, r + 0.5, c + 0.5, float(c + (s == "mean"))) for s in ("max", "mean") for r in range(2) for c in range(6) if s == "max" or c > 2]
    data += [("RCP85", "Lt", "mean", 0, 5, 0.5, 5.5, 4.0)]
    scored = spark.createDataFrame(data, "scenario string, time string, statistic string, lat_idx int, lon_idx int, lat double, lon double, score double").withColumn("scoring", F.lit("5"))
    cells = spark.createDataFrame([(f"Z{c}", "ATA" if c == 5 else f"C{c}", r, c, 1.0) for r in range(2) for c in range(6)], "gadm_id string, gid0 string, lat_idx int, lon_idx int, coverage double")
    stats = lambda **o: {(r["gadm_id"], r["time"]): r["score_mean"] for r in aggregate_hazard(scored, cells, "HS", **o).collect()}
    whole = stats(skip=())
    assert len(whole) == 12 and whole["Z0", "Lt"] == 0 and whole["Z4", "Cc"] == 5
    for wanted in (("C0",), ("C1", "C3")):
        part = {k: v for k, v in whole.items() if k[0].replace("Z", "C") in wanted}
        assert stats(countries=wanted, clip=True) == stats(countries=wanted) == part
    assert {z for z, _ in stats()} == {f"Z{c}" for c in range(5)}
    assert stats(countries=("none",), clip=True) == {}
