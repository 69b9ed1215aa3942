"""Cohort split and descriptive statistics per cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.functions.columns import code_class


def dead_ids(mortality: DataFrame) -> DataFrame:
    """One row per deceased patient, so that repeated death records never multiply events."""
    return mortality.select("patient_id").distinct()


def split_cohort(events: DataFrame, mortality: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alive events, dead events) by presence in the mortality table.

    Semi and anti joins need no distinct right side; without it the runtime can split a hot patient.
    """
    dead = mortality.select("patient_id")
    return events.join(dead, "patient_id", "left_anti"), events.join(dead, "patient_id", "left_semi")


def with_cohort(rows: DataFrame, mortality: DataFrame) -> DataFrame:
    """Add `cohort` = 'alive' | 'dead'."""
    flag = dead_ids(mortality).withColumn("cohort", F.lit("dead"))
    return rows.join(flag, "patient_id", "left").withColumn("cohort", F.coalesce("cohort", F.lit("alive")))


def patient_profile(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """(patient_id, n_events, n_encounters, record_length, cohort), one row per patient.

    Counting per (patient, day) first gives all three measures from one scan, lets the map side
    combine, and spreads a patient with very many events over their days. The cohort is joined to
    patients, not to events.
    """
    per_day = events.groupBy("patient_id", "event_time").agg(F.count("event_id").alias("n"))
    per_patient = per_day.groupBy("patient_id").agg(
        F.sum("n").alias("n_events"),
        F.count("event_time").alias("n_encounters"),
        F.date_diff(F.max("event_time"), F.min("event_time")).alias("record_length"),
    )
    return with_cohort(per_patient, mortality)


def _spread(profile: DataFrame, measure: str, prefix: str) -> DataFrame:
    return profile.groupBy("cohort").agg(
        F.avg(measure).alias(f"avg_{prefix}"),
        F.min(measure).alias(f"min_{prefix}"),
        F.max(measure).alias(f"max_{prefix}"),
    )


def event_count_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    per_patient = events.groupBy("patient_id").agg(F.count("event_id").alias("n_events"))
    return _spread(with_cohort(per_patient, mortality), "n_events", "events")


def encounter_count_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    days = events.select("patient_id", "event_time").distinct()
    per_patient = days.groupBy("patient_id").agg(F.count("event_time").alias("n_encounters"))
    return _spread(with_cohort(per_patient, mortality), "n_encounters", "encounters")


def record_length_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """Average, median, min and max of the days between a patient's first and last event."""
    per_patient = events.groupBy("patient_id").agg(
        F.date_diff(F.max("event_time"), F.min("event_time")).alias("days")
    )
    # Counted by length before the exact median: at most one row per possible length.
    lengths = with_cohort(per_patient, mortality).groupBy("cohort", "days").agg(F.count("*").alias("n"))
    return lengths.groupBy("cohort").agg(
        (F.sum(F.col("days") * F.col("n")) / F.sum("n")).alias("avg_days"),
        F.percentile("days", F.lit(0.5), F.col("n")).alias("median_days"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
    )


def common_codes(events: DataFrame, mortality: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent codes per cohort and code class; ties go to the smaller code."""
    per_patient = events.groupBy("patient_id", "event_id").agg(F.count("*").alias("n"))
    totals = (
        with_cohort(per_patient, mortality)
        .groupBy("cohort", code_class("event_id").alias("code_class"), "event_id")
        .agg(F.sum("n").alias("n_events"))
    )
    order = W.partitionBy("cohort", "code_class").orderBy(F.desc("n_events"), "event_id")
    return totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def metrics_table(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """(measure, cohort, avg, min, max) in long form, ready to plot."""
    profile = patient_profile(events, mortality)
    long = profile.select(
        "cohort",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("measure"), F.col(name).cast("bigint").alias("x"))
                    for name in ("n_events", "n_encounters", "record_length")
                ]
            )
        ),
    )
    return long.groupBy("measure", "cohort").agg(
        F.avg("x").alias("avg_value"), F.min("x").alias("min_value"), F.max("x").alias("max_value")
    )
