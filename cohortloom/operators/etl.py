"""From raw events to normalised sparse features.

Stages: index dates -> time differences -> observation window -> counts per (patient, code) ->
code numbering -> normalised values -> one sparse line per patient.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import code_class, sparse_text
from cohortloom.functions.ordered import dense_index
from cohortloom.operators.cohort import dead_ids
from cohortloom.operators.relational import spread_lookup
from cohortloom.session import cut


def index_dates(events: DataFrame, mortality: DataFrame, lead_days: int = 30) -> DataFrame:
    """(patient_id, index_date, label): last event of the living, `lead_days` before death otherwise."""
    last = events.groupBy("patient_id").agg(F.max("event_time").alias("index_date"))
    alive = last.join(dead_ids(mortality), "patient_id", "left_anti").withColumn("label", F.lit(0))
    dead = (
        mortality.groupBy("patient_id")
        .agg(F.date_sub(F.max("death_time"), lead_days).alias("index_date"))
        .withColumn("label", F.lit(1))
    )
    return alive.unionByName(dead)


def time_difference(events: DataFrame, index: DataFrame) -> DataFrame:
    """(patient_id, event_id, value, label, time_difference) with days from the event to the index date."""
    return spread_lookup(events, index, "patient_id").select(
        "patient_id",
        "event_id",
        "value",
        "label",
        F.date_diff("index_date", "event_time").alias("time_difference"),
    )


def observation_window(timed: DataFrame, days: int = 2000) -> DataFrame:
    """Events with a value, from `days` before the index date up to the date itself, both included."""
    return timed.filter(F.col("time_difference").between(0, days) & F.col("value").isNotNull())


def feature_counts(windowed: DataFrame, value_mode: str = "count") -> DataFrame:
    """(patient_id, event_id, feature_value): events per code, or summed values for LAB codes."""
    n, total = F.count("*"), F.sum("value")
    if value_mode == "count":
        value = n
    elif value_mode == "sum_for_lab":
        value = F.when(code_class("event_id") == "LAB", total).otherwise(n.cast("double"))
    else:
        raise ValueError(f"unknown value_mode {value_mode!r}")
    return windowed.groupBy("patient_id", "event_id").agg(value.alias("feature_value"))


def window_counts(events: DataFrame, index: DataFrame, days: int = 2000, value_mode: str = "count") -> DataFrame:
    """`feature_counts(observation_window(time_difference(...)))`, counted by day before the join.

    Same result. Events are first combined per (patient, code, day), so a patient holding a large
    part of all events meets the index date with at most one row per code and day.
    """
    per_day = (
        events.filter(F.col("value").isNotNull())
        .groupBy("patient_id", "event_id", "event_time")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    )
    age = F.date_diff("index_date", "event_time")
    kept = per_day.join(index, "patient_id").filter(age.between(0, days))
    n, total = F.sum("n"), F.sum("total")
    if value_mode == "count":
        value = n
    elif value_mode == "sum_for_lab":
        value = F.when(code_class("event_id") == "LAB", total).otherwise(n.cast("double"))
    else:
        raise ValueError(f"unknown value_mode {value_mode!r}")
    return kept.groupBy("patient_id", "event_id").agg(value.alias("feature_value"))


def feature_index(counts: DataFrame) -> DataFrame:
    """(idx, event_id): distinct codes in ascending order, numbered from 0."""
    return dense_index(counts.select("event_id").distinct(), ["event_id"]).select("idx", "event_id")


def feature_map_join(counts: DataFrame, feature_map: DataFrame) -> DataFrame:
    """(patient_id, idx, feature_value); codes that are not in the map drop out."""
    return counts.join(feature_map, "event_id").select("patient_id", "idx", "feature_value")


def normalize_max(features: DataFrame) -> DataFrame:
    """(patient_id, idx, value) with value = feature value / largest value of that feature.

    The maximum is a combinable aggregate joined back, not a window: a feature every patient has
    would make a window partition as large as the population.
    """
    largest = features.groupBy("idx").agg(F.max("feature_value").alias("largest"))
    return spread_lookup(features, largest, "idx").select(
        "patient_id", "idx", (F.col("feature_value") / F.col("largest")).alias("value")
    )


def aggregate_events(
    events: DataFrame, index: DataFrame, feature_map: DataFrame, days: int = 2000, value_mode: str = "count"
) -> DataFrame:
    """(patient_id, feature_id, feature_value): windowed, mapped and normalised features."""
    mapped = feature_map_join(window_counts(events, index, days, value_mode), feature_map)
    return normalize_max(mapped).select(
        "patient_id", F.col("idx").alias("feature_id"), F.col("value").alias("feature_value")
    )


def patient_vectors(features: DataFrame, labels: DataFrame) -> DataFrame:
    """(patient_id, label, pairs): sorted (idx, value) pairs per patient; no label means 0.

    The array holds a patient's distinct features, so its length is bounded by the feature count.
    """
    pairs = F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("pairs")
    rows = features.groupBy("patient_id").agg(pairs)
    known = labels.groupBy("patient_id").agg(F.max("label").alias("label"))
    return rows.join(known, "patient_id", "left").select(
        "patient_id", F.coalesce("label", F.lit(0)).alias("label"), "pairs"
    )


def svmlight_lines(vectors: DataFrame, digits: int = 6) -> DataFrame:
    """(patient_id, label, line) with line = `label idx:value ...`."""
    text = F.concat_ws(" ", F.col("label").cast("string"), sparse_text("pairs", digits))
    return vectors.select("patient_id", "label", text.alias("line"))


def samples(features: DataFrame, index: DataFrame) -> DataFrame:
    """(patient_id, label, sparse) for patients that have features."""
    return patient_vectors(features, index).select("patient_id", "label", sparse_text("pairs").alias("sparse"))


def feature_pipeline(events: DataFrame, mortality: DataFrame, days: int = 2000) -> DataFrame:
    """(patient_id, idx, value): all stages with the code map built from the data.

    The counts feed both the code map and the features, so they are written once.
    """
    counts = cut(window_counts(events, index_dates(events, mortality), days))
    return normalize_max(feature_map_join(counts, feature_index(counts)))
