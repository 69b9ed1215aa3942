"""Features of intensive-care stays and the re-keying of their predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.ordered import running_count
from cohortloom.operators.relational import one_hot


def phenotype_score(diagnoses: DataFrame) -> DataFrame:
    """(stay_id, phenotype_score): flagged diagnoses per stay."""
    return diagnoses.groupBy("stay_id").agg(F.sum("flag").alias("phenotype_score"))


def cumulative_stays(stays: DataFrame) -> DataFrame:
    """(stay_id, icu_cum): how many stays the subject has had so far, this one included."""
    month = F.trunc("intime", "month")
    return running_count(stays, "subject_id", ["intime", "stay_id"], month, "icu_cum").select("stay_id", "icu_cum")


def stay_features(stays: DataFrame, diagnoses: DataFrame, care_units: list[str]) -> DataFrame:
    """(stay_id, icu_cum, one 0/1 column per care unit, phenotype_score) for stays with diagnoses."""
    units = one_hot(stays, "stay_id", "care_unit", care_units)
    return cumulative_stays(stays).join(units, "stay_id").join(phenotype_score(diagnoses), "stay_id")


def rekey_predictions(predictions: DataFrame, stays: DataFrame) -> DataFrame:
    """(icustay_id, prediction, y_true): predictions by stay file name, re-keyed to the stay id."""
    return predictions.join(stays.select("stay", "icustay_id"), "stay").select("icustay_id", "prediction", "y_true")
