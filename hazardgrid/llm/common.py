"""Helpers the operators share: written intermediates, Arrow text buffers, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of all contracts (fixed values): blank and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which is shared by its own definition.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, never the steps before. A column that
    must not change between uses (a partition number, a row number) is fixed by it, too.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the folder of a ``saved`` frame that nothing will read any more."""
    spark = df.sparkSession
    folder = df.inputFiles()[:1]
    if folder and "/llm/" in folder[0]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder[0].rsplit("/", 1)[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, so that extra columns of any name do no harm."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_last(c: str | Column) -> Column:
    """Sortable form of a column with NULL behind all values."""
    c = F.col(c) if isinstance(c, str) else c
    return F.struct(c.isNull().alias("missing"), c.alias("value"))


def one_row_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of every group of rows that agree in ``keys`` (repeated rows).

    The window works on the partitioning a join on the same keys has left behind. Groups are the
    repetitions of one row.
    """
    n = fresh(df, "_n")
    row = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return df.withColumn(n, row).filter(F.col(n) == 1).drop(n)


# -- Arrow ------------------------------------------------------------------------------------


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Batches cut so that one holds about ``most`` bytes of text (or one longer text), text without nulls."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "")
        if texts.type == pa.large_string():
            edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
        else:
            edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(edges, edges[at] + most, "right")) - 1)
            yield batch.slice(at, stop - at), texts.slice(at, stop - at)
            at = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the n + 1 offsets of the texts in them."""
    kind = np.int64 if texts.type == pa.large_string() else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, edges, data = texts.buffers()
    edges = np.frombuffer(edges, kind, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
    values = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
    return values, edges - edges[0]


def appended(batch: pa.RecordBatch, schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=schema)


def arrow_schema(df: DataFrame) -> pa.Schema:
    """Arrow form of a frame's schema, as ``mapInArrow`` hands it to the function."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema, timezone="UTC", prefers_large_types=df.sparkSession.conf.get("spark.sql.execution.arrow.useLargeVarTypes") == "true")


# -- connected components -----------------------------------------------------------------------


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n nodes under the links a-b, vectorised."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        live = low != high
        if not live.any():
            break
        a, b = a[live], b[live]
        np.minimum.at(label, high[live], low[live])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of links ``a``-``b`` (LONG): a row (``id``, ``component``) for each node.

    ``component`` is the smallest node that can be reached. Distributed union-find by alternating
    large-star and small-star steps: every node points its larger (then its smaller or equal)
    neighbours at the smallest neighbour. A step is one grouped minimum, which combines before its
    shuffle, and one join against one row a node, whose hot keys adaptive execution may split; no
    neighbourhood is gathered. The number of links never grows. Each round is written to the shared
    folder; the last one is a star around the smallest node of each component.
    """
    links = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    total = links.agg(F.count(F.lit(1)), F.sum(_mix("a", "b"))).first()
    for _ in range(rounds):
        if not total[0]:
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: links point downwards, so the least neighbour at or below a is the least b.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = saved(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        forget(links)
        links, before = new, total
        total = links.agg(F.count(F.lit(1)), F.sum(_mix("a", "b"))).first()
        if total == before:
            break
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    roots = links.select(F.col("b").alias("id")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def _mix(a: str, b: str) -> Column:
    return F.xxhash64(a, b).cast("decimal(20,0)")
