"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join partition even when the next operator then needs its own shuffle:
    # a patient holding a third of all events must not run as one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a Python task holds of its input at once, where rows are whole texts.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
}


#: Keys pack to a byte or two a row in a shuffle: 64 MB of them are tens of millions of rows for one task to sort.
#: Not for queries on whole texts, whose shuffles have few rows a MB.
ROWS_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}


def tune(spark: SparkSession, texts: bool = False) -> SparkSession:
    """Apply the runtime settings the operators count on; `texts` leaves the session its size of a shuffle's parts. Cluster sizing stays with the user."""
    for key, value in (RUNTIME_CONF if texts else RUNTIME_CONF | ROWS_CONF).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship(spark)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python tasks find it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(root):
        return  # loaded from an archive that the executors were given already
    archive = os.path.join(tempfile.mkdtemp(prefix="cohortloom-code-"), "cohortloom_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a fresh local one in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortloom-"))
        current = sc.getCheckpointDir()
    return current


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so retries cannot meet old files."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    for noted in _NOTED:
        noted.append(path)
    return path


_NOTED: list[list[str]] = []


@contextlib.contextmanager
def noted_paths() -> Iterator[list[str]]:
    """A list that receives every path that `work_path` gives inside the block."""
    paths: list[str] = []
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        _NOTED[:] = [x for x in _NOTED if x is not paths]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, on whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and go on from there.

    Besides ending the lineage this gives the planner the table's true size. A checkpointed frame
    keeps its estimate, and the estimate of a join is a product that grows without end in a loop.
    """
    path = work_path(df.sparkSession, "table")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.cut_path = path
    return table


def drop_cut(df: DataFrame) -> None:
    """Remove the files behind a frame that `cut` returned, once a later table has taken its place."""
    path = getattr(df, "cut_path", None)
    if path is not None:
        remove(df.sparkSession, path)
        df.cut_path = None


def tasks_for(table: DataFrame, rows_per_task: int = 500_000) -> int:
    """Tasks for what every round of a loop passes over: by its rows, so that rounds over a small table are not hundreds of empty tasks."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // rows_per_task))


def even_keys(spark: SparkSession, tasks: int) -> list[int]:
    """`tasks` whole numbers that a shuffle by key into `tasks` parts puts into one part each: blocks with these keys are one task each."""
    found: dict[int, int] = {}
    at = 0
    while len(found) < tasks:
        some = spark.range(at, at + 16 * tasks, numPartitions=1).select(F.col("id").cast("int").alias("key"))
        for r in some.groupBy(F.pmod(F.hash("key"), F.lit(tasks)).alias("part")).agg(F.min("key").alias("key")).collect():
            found.setdefault(r["part"], r["key"])
        at += 16 * tasks
    return [found[part] for part in range(tasks)]


@contextlib.contextmanager
def planned(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Inside, plans are fixed before they run and shuffle into `tasks` parts: as rounds over placed tables need it, whose rows and tasks are known."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": str(tasks)}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def keep_placed(df: DataFrame) -> DataFrame:
    """Cache `df`, planned without runtime re-planning: later plans then know how it is partitioned and sorted."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*").persist()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: ends the lineage and keeps partitions and their row order as they are."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
