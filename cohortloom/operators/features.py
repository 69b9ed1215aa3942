"""Clinical feature tuples (patient_id, source, name, value) and patient vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.ordered import dense_index
from cohortloom.operators.relational import keep_codes


def _named(rows: DataFrame, source: str) -> DataFrame:
    return rows.select("patient_id", F.lit(source).alias("source"), "name", "value")


def diagnostic_counts(diagnostic: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Occurrences per (patient, lower-cased code), for the codes in `only` when given."""
    rows = diagnostic if only is None else keep_codes(diagnostic, "code", only)
    counted = rows.groupBy("patient_id", F.lower("code").alias("name")).agg(F.count("*").cast("double").alias("value"))
    return _named(counted, "diag")


def medication_counts(medication: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Occurrences per (patient, lower-cased medicine)."""
    rows = medication if only is None else keep_codes(medication, "medicine", only)
    counted = rows.groupBy("patient_id", F.lower("medicine").alias("name")).agg(
        F.count("*").cast("double").alias("value")
    )
    return _named(counted, "med")


def lab_averages(labs: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Mean value per (patient, lower-cased test)."""
    rows = labs if only is None else keep_codes(labs, "test_name", only)
    return _named(rows.groupBy("patient_id", F.lower("test_name").alias("name")).agg(F.avg("value").alias("value")), "lab")


def construct(tuples: DataFrame) -> DataFrame:
    """(patient_id, idx, value): names numbered over (source, name) in sorted order.

    Keeping the source in the key means a code that is also a medicine name stays two features.
    """
    names = dense_index(tuples.select("source", "name").distinct(), ["source", "name"])
    return tuples.join(names, ["source", "name"]).select("patient_id", "idx", "value")
