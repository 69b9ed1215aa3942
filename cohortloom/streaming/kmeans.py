"""Streaming k-means with decay.

Each micro-batch assigns its points to the current centres and moves every centre to
    n' = n * decay + m        c' = (c * n * decay + sum of its points) / n'
The centres are a table, one row per cluster; every batch reads the version before it and writes its
own, named by the batch number, so a batch that is run again overwrites the same version. They pass
from table to table: none comes to the driver, and no plan holds their values or grows with their number or width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.cluster import assign_nearest
from cohortloom.session import work_path

Centers = list[tuple[list[float], float]]


def start_centers(k: int, width: int) -> Centers:
    """Deterministic starting centres with weight 0."""
    return [([((i * 7 + c * 13) % 17 - 8) / 80.0 for i in range(width)], 0.0) for c in range(k)]


def updated(batch: DataFrame, centers: DataFrame, decay: float) -> DataFrame:
    """The centres (cluster, weight, center) after one batch (id, features)."""
    packed = centers.agg(F.array_sort(F.collect_list(F.struct("cluster", "center"))).alias("all")).select(F.col("all.center"))
    assigned = assign_nearest(batch, packed.scalar())
    sums = assigned.select("cluster", F.posexplode("features").alias("at", "value")).groupBy("cluster", "at").agg(
        F.sum("value").alias("s"), F.count("*").alias("m")
    )
    entries = centers.select("cluster", (F.col("weight") * decay).alias("n"), F.posexplode("center").alias("at", "c"))
    total = F.col("n") + F.coalesce("m", F.lit(0))
    moved = entries.join(sums, ["cluster", "at"], "left").select(
        "cluster", "at", total.alias("weight"), F.when(F.col("m").isNull(), F.col("c")).otherwise((F.col("c") * F.col("n") + F.col("s")) / total).alias("c")
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "c")))["c"]
    return moved.groupBy("cluster").agg(F.max("weight").alias("weight"), ordered.alias("center"))


def _table(spark: SparkSession, centers: Centers) -> DataFrame:
    rows = [(i, n, [float(v) for v in c]) for i, (c, n) in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster INT, weight DOUBLE, center ARRAY<DOUBLE>")


def run(stream: DataFrame, centers: Centers, decay: float = 1.0, root: str | None = None) -> str:
    """Consume all available data of `stream` (id, features) and return the path of the last centres."""
    spark = stream.sparkSession
    root = root or work_path(spark, "stream-kmeans")
    version = lambda b: f"{root}/centers/batch={b}"
    _table(spark, centers).write.parquet(version(-1))

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        before = batch.sparkSession.read.parquet(version(batch_id - 1))
        updated(batch, before, decay).write.mode("overwrite").parquet(version(batch_id))
        batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    last = (query.lastProgress or {}).get("batchId", -1)
    done = spark.read.parquet(f"{root}/centers").agg(F.max("batch")).first()[0]
    return version(min(last, done) if last >= 0 else done)


def centers_table(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, weight, center)"""
    return spark.read.parquet(path)
