from __future__ import annotations

import re
from pathlib import Path

import pytest

from hazardgrid.operators.combine import (
    attach_metadata,
    build_combined,
    build_hundred,
    hundred_bounds,
    long_statistics,
    merge_hazards,
    pivot_time,
    select_stats,
    wide_statistics,
    wide_zones,
)
from hazardgrid.plans import combine
from hazardgrid.schema import HAZARD_COLUMNS, META_COLUMNS
from hazardgrid.sources.readers import CSV
from hazardgrid.sources.writers import combined_path, write_combined

STATS = "hazard string, gadm_id string, scenario string, scoring string, time string, score_mean double"


@pytest.fixture()
def meta(spark):
    rows = [("X", "Country", "X.1_1", "Prov", "Province", ""), ("X", "Country", "X.2_1", "Other", "Province", "")]
    return spark.createDataFrame(rows, list(META_COLUMNS[1]))


@pytest.fixture()
def heat(spark):
    return spark.createDataFrame([("HS", "X.1_1", "RCP85", "5", "Cc", 3.0)], STATS)


def test_fixed_schema_in_order(meta, heat):
    table = build_combined(heat, meta, "5", "score_mean", "RCP85")
    assert table.columns == [*META_COLUMNS[1], *HAZARD_COLUMNS]
    assert len(HAZARD_COLUMNS) == 56 and HAZARD_COLUMNS[:5] == ("CER_Cc", "CER_St", "CER_Mt", "CER_Lt", "CF_Cc")


@pytest.mark.parametrize("fill", [0, -9999])
def test_values_and_fill(meta, heat, fill):
    rows = {r["GID_1"]: r for r in build_combined(heat, meta, "5", "score_mean", "rcp85", fill=fill).collect()}
    assert rows["X.1_1"]["HS_Cc"] == 3
    assert {rows["X.1_1"][c] for c in HAZARD_COLUMNS if c != "HS_Cc"} == {fill}
    assert {rows["X.2_1"][c] for c in HAZARD_COLUMNS} == {fill}


def test_no_data_gives_an_empty_table(meta, heat):
    assert build_combined(heat, meta, "10", "score_mean", "RCP85").count() == 0
    assert build_combined(heat, meta, "5", "score_mean", "RCP45").count() == 0


def test_missing_columns_are_skipped(meta, heat):
    assert build_combined(heat, meta, "5", "score_stdev", "RCP85") is None
    assert build_combined(heat.drop("time"), meta, "5", "score_mean", "RCP85") is None
    assert set(combine({1: heat}, {1: meta}, scales=("5", "100"))) == {
        (1, s, "mean", c) for s in ("5", "100") for c in ("RCP45", "RCP85")
    }


def test_selection(spark, heat):
    assert select_stats(heat, 5, "rcp85").count() == 1
    assert select_stats(heat.drop("scoring", "scenario"), "10", "RCP45").count() == 1


def test_rounding_and_types(spark, meta):
    stats = spark.createDataFrame([("HS", "X.1_1", "RCP85", "5", "Cc", 2.5), ("WS", "X.1_1", "RCP85", "5", "Lt", 3.5)], STATS)
    table = build_combined(stats, meta, "5", "score_mean", "RCP85").filter("GID_1 = 'X.1_1'")
    assert (table.first()["HS_Cc"], table.first()["WS_Lt"]) == (2, 4)
    assert {t for c, t in table.dtypes if c in HAZARD_COLUMNS} == {"int"}


def test_duplicates_take_the_first_present_value(spark):
    data = [("HS", "Z", "Cc", 2, 7.0), ("HS", "Z", "Cc", 1, None), ("HS", "Z", "Cc", 3, 1.0)]
    long = spark.createDataFrame(data, "hazard string, gadm_id string, time string, ord int, v double")
    assert pivot_time(long, "v", ("ord",)).first()["HS_Cc"] == 7.0


def test_statistic_label(spark, meta):
    data = [("HS", "X.1_1", "RCP85", "5", "Cc", v, s) for v, s in ((1.0, "max"), (4.0, "mean"))]
    stats = spark.createDataFrame(data, STATS + ", statistic string")
    assert build_combined(stats, meta, "5", "score_mean", "RCP85").filter("HS_Cc = 4").count() == 1


def test_merge_and_metadata(spark, meta, heat):
    other = heat.selectExpr("'WS' AS hazard", "'new' AS gadm_id", "scenario", "scoring", "time", "score_mean")
    wide = pivot_time(merge_hazards([heat, other]), "score_mean")
    assert {r["gadm_id"]: (r["HS_Cc"], r["WS_Cc"]) for r in wide.collect()} == {"X.1_1": (3.0, None), "new": (None, 3.0)}
    joined = attach_metadata(meta, wide.withColumnRenamed("gadm_id", "GID_1"), "GID_1")
    assert sorted(r["GID_1"] for r in joined.collect()) == ["X.1_1", "X.2_1"]


def hundred(spark):
    data = [
        ("HS", "X.1_1", "RCP45", "100", "Cc", 20.0), ("HS", "X.2_1", "RCP45", "100", "Cc", 0.0),
        ("HS", "unknown", "RCP45", "100", "Cc", 1.0), ("HS", "X.1_1", "RCP85", "100", "Lt", 60.0),
        ("HS", "X.2_1", "RCP85", "100", "Lt", 40.0), ("HS", "X.2_1", "RCP85", "100", "Mt", 90.0),
        ("WS", "X.1_1", "RCP85", "100", "Lt", 33.333),
    ]
    return spark.createDataFrame(data, STATS)


def test_hundred_scale_shares_its_bounds(spark, meta):
    stats = hundred(spark)
    tables = build_hundred(stats, meta, "score_mean")
    mild = {r["GID_1"]: r for r in tables["RCP45"].collect()}
    severe = {r["GID_1"]: r for r in tables["RCP85"].collect()}
    # Bounds 20…60: zones unknown to the metadata and zeros do not count.
    assert (mild["X.1_1"]["HS_Cc"], mild["X.2_1"]["HS_Cc"]) == (0.0, 0.0)
    assert (severe["X.1_1"]["HS_Lt"], severe["X.2_1"]["HS_Lt"], severe["X.2_1"]["HS_Mt"]) == (100.0, 50.0, 100.0)
    assert severe["X.1_1"]["WS_Lt"] == 33.33  # no bounds: only rounded


def test_bounds_are_left_out_when_equal_or_absent(spark):
    data = [("HS", "a", "RCP45", "100", "Cc", 5.0), ("HS", "a", "RCP85", "100", "Lt", 5.0), ("WS", "a", "RCP45", "100", "Cc", 5.0)]
    assert hundred_bounds(spark.createDataFrame(data, STATS)).count() == 0


def test_country_level(spark, meta, heat):
    countries = meta.select("GID_0", "COUNTRY").distinct()
    stats = heat.selectExpr("hazard", "'X' AS gadm_id", "scenario", "scoring", "time", "score_mean")
    table = build_combined(stats, countries, "5", "score_mean", "RCP85", level=0)
    assert table.columns[:2] == ["GID_0", "COUNTRY"] and table.first()["HS_Cc"] == 3


def test_paths():
    assert combined_path("b", "5", "mean", "rcp45", 1) == "b/five/hazard_score_province_mean_45.csv"
    assert combined_path("b", "100", "std", "RCP85", 0) == "b/hundred/hazard_score_country_std_85.csv"
    assert combined_path("b", "3", "max", "RCP85", 1) == "b/scale3/hazard_score_province_max_85.csv"
    assert len({combined_path("b", "5", "mean", "RCP85", level) for level in (0, 1, 2)}) == 3


def test_long_rows_are_dealt_once_for_the_wide_ones(spark):
    # Dealt by hazard and time, every task would hold a wide row for nearly every zone.
    rows = [("Z1", "5", "RCP45", "HS", "Cc", 1.0), ("Z1", "5", "RCP45", "HS", "Lt", None), ("Z2", "5", "RCP45", "WS", "St", 3.0)]
    wide = wide_statistics(spark.createDataFrame(rows, "gadm_id string, scoring string, scenario string, hazard string, time string, mean double"), ["mean"])
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    found = {r["gadm_id"]: r for r in wide.collect()}
    assert found["Z1"]["HS_Cc_mean"] == 1.0 and found["Z1"]["HS_Lt_mean"] is None and found["Z2"]["WS_St_mean"] == 3.0


def test_exports_are_compressed_and_read_back(spark, tmp_path):
    table = spark.createDataFrame([("X.1", None), ("", 2)], "GID_1 string, HS_Cc int")
    path = write_combined(table, str(tmp_path), "5", "mean", "RCP85", 1)
    assert all(f.name.endswith(".csv.gz") for f in Path(path).glob("part-*"))
    back = spark.read.schema(table.schema).options(**CSV).csv(path)
    assert {tuple(r) for r in back.collect()} == {("X.1", None), ("", 2)}


def test_long_rows_are_dealt_once(spark, heat):
    long = long_statistics(heat, ("5",), ("RCP85",), {"mean": "score_mean"}, dealt=True)
    wide = wide_statistics(long, ["mean"], dealt=True)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(", plan)) == 1
    assert [r["HS_Cc_mean"] for r in wide.collect()] == [3.0]


def test_tables_of_a_run_are_scans_of_one_stage(spark, meta, heat):
    # Each table joined its slice with the metadata anew.
    more = heat.unionByName(heat.selectExpr("hazard", "'nowhere' AS gadm_id", "scenario", "scoring", "time", "9D AS score_mean"))
    more = more.unionByName(hundred(spark))
    doubled = meta.unionByName(meta.limit(1)).unionByName(meta.limit(1).selectExpr("GID_0", "COUNTRY", "CAST(NULL AS STRING) AS GID_1", "NAME_1", "ENGTYPE_1", "VARNAME_1"))
    tables = combine({1: more}, {1: doubled}, scales=("5", "100"))
    for table in tables.values():
        assert not re.search(r"Exchange|Join", table._jdf.queryExecution().executedPlan().toString())
    five = sorted((str(r["GID_1"]), r["HS_Cc"]) for r in tables[1, "5", "mean", "RCP85"].collect())
    assert five == [("None", 0), ("X.1_1", 3), ("X.1_1", 3), ("X.2_1", 0)]
    assert tables[1, "5", "mean", "RCP45"].count() == 0
    for scenario, table in build_hundred(hundred(spark), doubled, "score_mean").items():
        assert sorted(map(str, table.collect())) == sorted(map(str, tables[1, "100", "mean", scenario].collect()))


def test_wide_rows_take_one_grouped_aggregate(spark, meta, heat):
    # The pivot grouped by hazard and time first, then again.
    rows = heat.unionByName(heat.withColumn("score_mean", heat.score_mean - 1))
    long = long_statistics(rows, ("5",), ("RCP85",), {"mean": "score_mean"}, dealt=True, grouped=False)
    wide = wide_statistics(long, ["mean"], dealt=True, zones=wide_zones(meta, ("5",), ("RCP85",)))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(") == 2 and "pivotfirst" not in plan.lower()  # one, in two steps
    assert {(r["gadm_id"], r["_there"], r["HS_Cc_mean"]) for r in wide.collect()} == {("X.1_1", True, 2.0), ("X.2_1", None, None)}
