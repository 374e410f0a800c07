"""Shared working folder and staged intermediates."""

from __future__ import annotations

import hashlib
import logging
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from hazardgrid.sources.readers import path_exists

log = logging.getLogger(__name__)

#: Local property that names the run a job belongs to; threads of the run inherit it.
RUN = "hazardgrid.run"
#: With this setting a query's shuffle files go when it ends, not whenever the driver's memory is cleared of it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which all executors share by its own definition;
    never a machine-local one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def _roots(df: DataFrame) -> list[str]:
    """Folders and files the frame's plan names as its sources; no file list is made."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            found += [p for p in leaf.relation().location().rootPaths().mkString("\n").split("\n") if p]
    return sorted(set(found))


def _version(spark: SparkSession, root: str) -> str:
    """A root with the time it was last written: its own and that of its success mark."""
    marks = [root]
    for name in (root, f"{root}/_SUCCESS"):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(path):
            marks.append(str(system.getFileStatus(path).getModificationTime()))
    return "@".join(marks)


def stage_name(df: DataFrame, name: str, inputs: tuple[str, ...] = ()) -> str:
    """Stage name that changes with the plan and with the state of the tables it reads.

    A table counts as changed when its folder or its success mark was written later. For sources
    that change in another way, pass a version mark in ``inputs`` (a snapshot id, say).
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    parts = [name, str(df.semanticHash()), plan, df.schema.json(), *[_version(spark, r) for r in _roots(df)], *inputs]
    return f"{name}-{hashlib.sha256('|'.join(parts).encode()).hexdigest()[:32]}"


def stage(df: DataFrame, name: str, reuse: bool = True, inputs: tuple[str, ...] = ()) -> DataFrame:
    """Materialise an intermediate as a Parquet table in the shared folder and read it back.

    An identical stage that was finished before is reused; with ``reuse=False`` a new one is
    written beside it. Written tables survive the loss of executors and cut the lineage, which
    cached blocks do not. ``unstage`` deletes them; those of a run (``staging``) go with it.
    """
    spark = df.sparkSession
    run = spark.sparkContext.getLocalProperty(RUN)
    path = f"{shared_dir(spark)}/stages/{f'{run}/' if run else ''}{stage_name(df, name, inputs)}"
    if not reuse:
        path = f"{path}-{uuid.uuid4().hex}"
    if reuse and path_exists(spark, f"{path}/_SUCCESS"):
        log.info("stage %s reused from %s", name, path)
    else:
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A run: what is staged inside, in its threads as well, has a folder of its own that is deleted at the end.

    However the run ends, and whatever in it staged a table without a thought for it. Frames that read
    such a table must not leave the run. A run inside another belongs to the outer one. What a driver
    that was killed leaves is for ``sweep_stages``. Shuffle files go with the query they belong to, so that a run's
    disk holds its tables and the shuffles under way, not those of all its phases.
    """
    context = spark.sparkContext
    if context.getLocalProperty(RUN):
        yield
        return
    run = f"run-{int(time.time())}-{uuid.uuid4().hex}"
    context.setLocalProperty(RUN, run)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        context.setLocalProperty(RUN, None)
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
        _delete(spark, f"{shared_dir(spark)}/stages/{run}")


def sweep_stages(spark: SparkSession, hours: float = 48) -> list[str]:
    """Delete the folders of runs that began longer ago than any run lasts; returns their paths."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/stages")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    gone = []
    for entry in system.listStatus(root):
        name = entry.getPath().getName()
        if name.startswith("run-") and int(name.split("-")[1]) < time.time() - hours * 3600:
            _delete(spark, entry.getPath().toString())
            gone.append(entry.getPath().toString())
    return gone


def _delete(spark: SparkSession, folder: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception as error:  # noqa: BLE001 - clean-up must not fail the job
        log.warning("stage %s not deleted: %s", folder, error)


def unstage(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the stages the frames read, after the final write; a failure is only logged."""
    root = f"{shared_dir(spark)}/stages/".split(":", 1)[-1].lstrip("/")
    for folder in sorted({r for df in frames for r in _roots(df)}):
        if root not in folder:
            log.warning("%s is not a stage, kept", folder)
            continue
        _delete(spark, folder)
