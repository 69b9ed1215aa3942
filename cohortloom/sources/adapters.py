"""Clinical-shaped views over the given tables.

Each function takes (spark, sf_dir) and returns a lazy DataFrame; only the columns a query
uses are read from parquet. `plans/views.py` states the same views in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    return table(spark, sf_dir, "lineitem").join(orders, "l_orderkey")


def clinical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, event_id, event_time, value): one row per order line."""
    kind = F.when(F.col("l_partkey") % 3 == 0, "DIAG").when(F.col("l_partkey") % 3 == 1, "LAB").otherwise("DRUG")
    missing = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1)
    return _order_lines(spark, sf_dir).select(
        "patient_id",
        F.concat(kind, (F.col("l_partkey") % 60).cast("string")).alias("event_id"),
        F.col("order_date").alias("event_time"),
        F.when(~missing, F.col("l_quantity")).alias("value"),
    )


def mortality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, death_time, label): every fourth patient that has events."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_custkey") % 4 == 0)
        .groupBy(F.col("o_custkey").alias("patient_id"))
        .agg(F.max(F.col("o_orderdate").cast("date")).alias("death_time"))
        .withColumn("label", F.lit(1))
    )


def code_rank(event_id: str = "event_id") -> Column:
    """The digits of an event code."""
    return F.regexp_extract(event_id, "([0-9]+)$", 1).cast("int")


def _pick(key: Column, size: int, names: list[str], other: str) -> Column:
    """names[key % size], or `other` followed by the remainder."""
    slot = key % size
    out = F.when(slot == 0, names[0])
    for i, name in enumerate(names[1:], start=1):
        out = out.when(slot == i, name)
    return out.otherwise(F.concat(F.lit(other), slot.cast("string")))


DX_NAMES = ["250.00", "250.02", "250.01", "790.21", "250.*", "V77.1"]
MED_NAMES = ["Lantus", "Insulin NPH", "metformin", "Glipizide", "ACTOS", "glucatrol "]
LAB_NAMES = ["Glucose", "Fasting Glucose", "HbA1c", "glucose, serum", "glucose 2hr post dose"]


def diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, date, code)"""
    return _order_lines(spark, sf_dir).select(
        "patient_id",
        F.col("order_date").alias("date"),
        _pick(F.col("l_partkey"), 97, DX_NAMES, "4.").alias("code"),
    )


def medication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, date, medicine)"""
    return _order_lines(spark, sf_dir).select(
        "patient_id",
        F.date_add("order_date", F.col("l_linenumber")).alias("date"),
        _pick(F.col("l_partkey") * 7 + F.col("l_linenumber"), 83, MED_NAMES, "Drug").alias("medicine"),
    )


def lab_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, date, test_name, value); values fall on both sides of and exactly on the limits."""
    key = F.col("l_partkey") + F.col("l_linenumber")
    scale = F.when(key % 41 == 2, 0.25).otherwise(2.75)
    return _order_lines(spark, sf_dir).select(
        "patient_id",
        F.col("order_date").alias("date"),
        _pick(key, 41, LAB_NAMES, "Lab").alias("test_name"),
        (F.col("l_quantity") * scale).alias("value"),
    )


def graph_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id): every customer, with or without events."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("patient_id"))


def graph_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient_id, kind, item, date, value): the lab, medication and diagnosis rows of the graph.

    Labs are six hub items, medications a few dozen, diagnoses about one per part.
    """
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type")
    items = F.array(
        F.struct(F.lit("lab").alias("kind"), F.col("p_type").alias("item")),
        F.struct(F.lit("med").alias("kind"), F.col("p_name").alias("item")),
        F.struct(
            F.lit("diag").alias("kind"),
            F.concat("p_brand", F.lit("."), F.col("l_partkey").cast("string")).alias("item"),
        ),
    )
    return (
        _order_lines(spark, sf_dir)
        .select("patient_id", "l_partkey", F.col("order_date").alias("date"), F.col("l_quantity").alias("value"))
        .join(part, "l_partkey")
        .select("patient_id", "date", "value", F.inline(items))
        .select("patient_id", "kind", "item", "date", "value")
    )


def icu_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stay_id, subject_id, intime, care_unit)"""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("stay_id"),
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderdate").cast("date").alias("intime"),
        F.col("o_orderpriority").alias("care_unit"),
    )


def stay_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stay_id, flag)"""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("stay_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("flag"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features array<double>, class)"""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").alias("class"),
    )


def matrix_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row, col, value): absolute vector entries, long form."""
    return vectors(spark, sf_dir).select(
        F.col("id").alias("row"), F.posexplode(F.transform("features", F.abs)).alias("col", "value")
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y, s1, s2, s3): deterministic model scores with ties."""
    key = F.col("c_custkey")
    y = F.when((key * 7919) % 100 < 30, 1).otherwise(0)
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        y.alias("y"),
        ((key * 37 % 50 + y * 20) / F.lit(70.0)).alias("s1"),
        ((key * 53 % 40 + y * 5) / F.lit(45.0)).alias("s2"),
        ((key * 71 % 97) / F.lit(97.0)).alias("s3"),
    )


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, n_chars, n_words, n_lines, lang, label): label 1 marks a low-quality document."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        "lang",
    )
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (1 - F.col("quality")).alias("label"))
    return docs.join(labels, "id")
