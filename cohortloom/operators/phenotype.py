"""Rule-based type 2 diabetes phenotype."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import codes
from cohortloom.functions.columns import is_abnormal


def _flag(condition: Column) -> Column:
    """1 when any row of the group meets the condition."""
    return F.coalesce(F.max(condition.cast("int")), F.lit(0))


def medication_profile(medication: DataFrame) -> DataFrame:
    """(patient_id, first_t1, first_t2): earliest date on each kind of drug, NULL when never."""
    name = F.lower("medicine")
    relevant = medication.filter(name.isin(codes.T1DM_MED + codes.T2DM_MED))
    return relevant.groupBy("patient_id").agg(
        F.min(F.when(name.isin(codes.T1DM_MED), F.col("date"))).alias("first_t1"),
        F.min(F.when(name.isin(codes.T2DM_MED), F.col("date"))).alias("first_t2"),
    )


def case_patients(
    diagnostic: DataFrame, medication: DataFrame, exclude_t1: str = "row", require_dx: bool = False
) -> DataFrame:
    """(patient_id) of the cases.

    A case has a T2 diagnosis and either no T1 medication, or T1 without any T2 medication; or took
    a T2 medication before the first T1 one (`require_dx` then also asks for the diagnosis).
    `exclude_t1='row'` drops T1-coded rows only, 'patient' drops every patient with such a row.

    One profile row per patient and table; the rule is a filter over their join.
    """
    if exclude_t1 not in ("row", "patient"):
        raise ValueError(f"unknown exclude_t1 {exclude_t1!r}")
    relevant = diagnostic.filter(F.col("code").isin(codes.T2DM_DX + codes.T1DM_DX))
    dx = relevant.groupBy("patient_id").agg(
        _flag(F.col("code").isin(codes.T2DM_DX)).alias("t2_dx"), _flag(F.col("code").isin(codes.T1DM_DX)).alias("t1_dx")
    )
    both = dx.join(medication_profile(medication), "patient_id", "full_outer")
    has_dx = F.coalesce(F.col("t2_dx") == 1, F.lit(False))
    if exclude_t1 == "patient":
        has_dx = has_dx & (F.coalesce("t1_dx", F.lit(0)) == 0)
    by_diagnosis = has_dx & (F.col("first_t1").isNull() | F.col("first_t2").isNull())
    by_order = F.coalesce(F.col("first_t2") < F.col("first_t1"), F.lit(False))
    if require_dx:
        by_order = by_order & has_dx
    return both.filter(by_diagnosis | by_order).select("patient_id")


def abnormal_labs(labs: DataFrame) -> DataFrame:
    """Lab rows beyond the limit of their test."""
    return labs.filter(is_abnormal("test_name", "value", codes.ABNORMAL_LABS))


def control_patients(diagnostic: DataFrame, labs: DataFrame) -> DataFrame:
    """(patient_id) with a glucose test, no abnormal lab and no diabetes-related diagnosis."""
    profile = labs.groupBy("patient_id").agg(
        _flag(F.lower("test_name").isin(codes.GLUCOSE_LABS)).alias("glucose"),
        _flag(is_abnormal("test_name", "value", codes.ABNORMAL_LABS)).alias("abnormal"),
    )
    related = diagnostic.filter(F.lower("code").isin(codes.DM_RELATED_DX)).select("patient_id").distinct()
    measured = profile.filter((F.col("glucose") == 1) & (F.col("abnormal") == 0)).select("patient_id")
    return measured.join(related, "patient_id", "left_anti")


def phenotype_labels(
    diagnostic: DataFrame, medication: DataFrame, labs: DataFrame, allow_overlap: bool = False, **case_options
) -> DataFrame:
    """(patient_id, label): 1 case, 2 control, 3 any other patient with a diagnosis.

    A patient who is both counts as a case; `allow_overlap` keeps both rows.
    """
    cases = case_patients(diagnostic, medication, **case_options)
    controls = control_patients(diagnostic, labs)
    if not allow_overlap:
        controls = controls.join(cases, "patient_id", "left_anti")
    known = cases.withColumn("label", F.lit(1)).unionByName(controls.withColumn("label", F.lit(2)))
    others = diagnostic.select("patient_id").distinct().join(known, "patient_id", "left_anti")
    return known.unionByName(others.withColumn("label", F.lit(3)))
