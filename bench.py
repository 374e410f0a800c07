"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the threads (default 8). Every
query is materialised through a no-op sink, once to warm the JVM at the smallest scale that is
there and once for the time reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from hazardgrid.queries import QUERIES  # noqa: E402
from hazardgrid.session import tuned  # noqa: E402

HEADLINE = (
    "flagship",
    "zonal_stats",
    "zonal_stats_weighted",
    "zone_cells_coverage",
    "gap_fill_2d",
    "score_multi",
    "score_rf",
    "score_wf",
    "rp_weighted_rf",
    "aggregate_cf",
    "combined_mean",
    "combined_hundred",
)


def session(cpus: str) -> SparkSession:
    spark = (
        tuned(SparkSession.builder)
        .master(f"local[{cpus}]")
        .appName("hazardgrid-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    warm_dir = Path(sf_dir).parent / "sf0.001"
    times = {}
    for name in names:
        if warm_dir.exists():
            run(spark, name, str(warm_dir))
        times[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
