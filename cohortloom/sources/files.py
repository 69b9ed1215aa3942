"""Readers for the file formats the pipelines take in."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.functions.columns import file_folder, number_or_null

EVENTS_DDL = "patient_id STRING, event_id STRING, event_description STRING, event_time DATE, value DOUBLE"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV with a stated schema: no pass over the data to guess types."""
    return spark.read.schema(schema).option("header", True).csv(path)


def create_csv_table(spark: SparkSession, name: str, path: str, ddl: str, sep: str = ",") -> DataFrame:
    """Bind headerless delimited text to a schema under a view name, replacing an earlier one."""
    spark.catalog.dropTempView(name)
    spark.sql(f"CREATE TEMPORARY VIEW {name} ({ddl}) USING csv OPTIONS (path '{path}', sep '{sep}', header 'false')")
    return spark.table(name)


def read_csv_permissive(spark: SparkSession, path: str, ddl: str, dates: list[str] | None = None) -> DataFrame:
    """Headerless CSV where a field that does not fit its type becomes NULL and the row stays."""
    rows = spark.read.schema(ddl).option("mode", "PERMISSIVE").csv(path)
    for c in dates or []:
        rows = rows.withColumn(c, F.try_to_date(c, "yyyy-MM-dd"))
    return rows


def csv_as_table(spark: SparkSession, path: str, name: str | None = None, schema: str | None = None) -> DataFrame:
    """Read a headered CSV and register it; the name defaults to the last word of the path."""
    reader = spark.read.option("header", True)
    rows = (reader.schema(schema) if schema else reader).csv(path)
    if name is None:
        found = re.search(r"(\w+)(\.csv)?$", path)
        name = found.group(1) if found else path
    rows.createOrReplaceTempView(name)
    return spark.table(name)


def read_svmlight(spark: SparkSession, path: str) -> DataFrame:
    """svmlight text in long form (line, label, idx, value); indices as written.

    `line` counts the lines from 0, file by file in the order of their names and from top to bottom in
    each. A line without pairs gives one row with null idx and value.
    """
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    rows = spark.read.text(path).select(*split, F.monotonically_increasing_id().alias("at"), F.split(F.trim("value"), r"\s+").alias("parts"))
    # One task reads a split from top to bottom: its first id and its number of lines place all its rows.
    sizes = rows.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    inside = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.groupBy("file").agg(F.sum("n").alias("lines")).select("file", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("start"))
    skipped = sizes.select("file", "block", "first", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("skip")).join(starts, "file")
    placed = rows.join(skipped, ["file", "block"]).withColumn("line", F.col("start") + F.col("skip") + F.col("at") - F.col("first"))
    pairs = F.filter(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), lambda p: p.contains(":"))
    long = placed.select("line", F.col("parts")[0].cast("double").alias("label"), F.explode_outer(pairs).alias("pair"))
    cell = F.split("pair", ":")
    return long.select("line", "label", cell[0].cast("int").alias("idx"), cell[1].cast("double").alias("value"))


def read_libsvm(spark: SparkSession, path: str, width: int) -> DataFrame:
    """(label, features) with one ml SparseVector per line; needs one-based indices."""
    return spark.read.format("libsvm").option("numFeatures", str(width)).load(path)


def read_wordlist(spark: SparkSession, path: str) -> DataFrame:
    """(code): distinct lower-cased lines."""
    return spark.read.text(path).select(F.lower("value").alias("code")).distinct()


def read_folder_tree(spark: SparkSession, glob: str, schema: str, level: int = 1, name: str = "patient_id") -> DataFrame:
    """One CSV folder per patient, read together; the folder's name becomes a column."""
    rows = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(glob)
    return rows.select(file_folder(level).alias(name), "*")


def episode_lookup(spark: SparkSession, predictions: DataFrame, episode_glob: str) -> DataFrame:
    """(stay, icustay_id): the first data row's first field of each predicted stay's episode file.

    Stays are named `patient_episode_...`; files lie at `patient/episode/`. The first row is found
    by offset: the block of the file it came from, then its position there.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(episode_glob).select(
        file_folder(2).alias("patient"),
        file_folder(1).alias("episode"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.split("value", ",")[0].alias("field"),
    )
    # Header rows start with a letter; ids are digits.
    data = lines.filter(F.col("field").rlike("^[0-9]+$"))
    first = data.groupBy("patient", "episode").agg(F.min(F.struct("block", "at", "field")).alias("first"))
    parts = F.split("stay", "_")
    named = predictions.select("stay", parts[0].alias("patient"), parts[1].alias("episode")).distinct()
    return named.join(first, ["patient", "episode"]).select(
        "stay", F.col("first.field").cast("bigint").alias("icustay_id")
    )


def read_positional(spark: SparkSession, path: str, label_at: int) -> DataFrame:
    """(id, label, features): headerless wide CSV with the id first and the label at a fixed position.

    Rows with a blank id drop out. Blank features are NULL; a blank label is 0.
    """
    cells = spark.read.text(path).select(F.split("value", ",").alias("c")).filter(F.trim(F.col("c")[0]) != "")
    before = F.slice("c", 2, label_at - 1)
    after = F.slice("c", label_at + 2, F.greatest(F.size("c") - label_at - 1, F.lit(0)))
    return cells.select(
        F.col("c")[0].try_cast("double").cast("bigint").alias("id"),
        F.coalesce(number_or_null(F.col("c")[label_at]), F.lit(0.0)).alias("label"),
        F.transform(F.concat(before, after), number_or_null).alias("features"),
    )
