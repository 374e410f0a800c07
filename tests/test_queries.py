"""Every registered query against its SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import importlib.util
import math
import re
from pathlib import Path

import duckdb
import pytest

spec = importlib.util.spec_from_file_location("entry", Path(__file__).resolve().parents[1] / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

# Queries of the optional subpackage have tests of their own.
NAMES = sorted(entry.QUERIES)


@pytest.fixture(scope="module")
def database(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_every_query_has_its_counterpart():
    assert set(NAMES) == set(entry.ORACLES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sf_dir, database, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Everything but reading boundary files runs in the JVM, and no join compares all pairs.
    assert name in ("zones_to_edges", "zone_cells_wkb") or not re.search(r"Python|Pandas|Arrow", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    ours = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=key)
    cursor = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(norm(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=key)
    assert len(ours) == len(theirs) and ours == theirs


def test_entry(spark, sf_dir):
    assert entry.entry(spark).limit(1).count() == 1


def test_weighted_risk_scores_once(spark, sf_dir):
    plan = entry.queries()["weighted_risk"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan  # labels and scores are read from the written table
