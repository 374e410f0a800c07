from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from hazardgrid.session import tuned

    shared = tmp_path_factory.mktemp("shared")
    session = (
        tuned(SparkSession.builder)
        .master("local[4]")
        .appName("hazardgrid-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip("no test data here")
    return str(DATA)


@pytest.fixture()
def column(spark):
    """Evaluate an expression over a list of doubles (None stays NULL)."""

    def run(expr, values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v double").coalesce(1)
        return [r[0] for r in df.sort("i").select(expr).collect()]

    return run
