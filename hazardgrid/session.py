"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes and splits shuffles at run time. The hash-map threshold lets it hash a
# shuffled join side instead of sorting both, but only where every partition of that side was
# measured to be small. The last setting accepts data that is partitioned by part of the join
# keys, which lets the zonal join work by raster tiles.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """A session builder with these settings."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
