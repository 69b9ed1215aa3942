"""Loading of the clinical and the graph input tables from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.columns import number_or_null, present
from cohortloom.sources.files import csv_as_table, read_csv

STAMP = "yyyy-MM-dd'T'HH:mm:ssX"


def load_clinical(
    spark: SparkSession, medication: str, labs: str, encounters: str, encounter_dx: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(medication, lab results, diagnoses); labs keep numeric values only, diagnoses lose null rows."""
    meds = read_csv(spark, medication, "Member_ID BIGINT, Order_Date STRING, Drug_Name STRING").select(
        F.col("Member_ID").alias("patient_id"),
        F.to_timestamp("Order_Date", STAMP).alias("date"),
        F.col("Drug_Name").alias("medicine"),
    )
    results = read_csv(
        spark, labs, "Member_ID BIGINT, Date_Resulted STRING, Result_Name STRING, Numeric_Result STRING"
    ).select(
        F.col("Member_ID").alias("patient_id"),
        F.to_timestamp("Date_Resulted", STAMP).alias("date"),
        F.col("Result_Name").alias("test_name"),
        number_or_null("Numeric_Result").alias("value"),
    ).filter(F.col("value").isNotNull())
    visits = read_csv(spark, encounters, "Encounter_ID BIGINT, Member_ID BIGINT, Encounter_DateTime STRING")
    dx = read_csv(spark, encounter_dx, "Encounter_ID BIGINT, code STRING")
    diagnoses = visits.join(dx, "Encounter_ID").select(
        F.col("Member_ID").alias("patient_id"), F.to_timestamp("Encounter_DateTime", STAMP).alias("date"), "code"
    ).na.drop()
    return meds, results, diagnoses


def load_graph_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(patient, lab, diagnostic, medication) from four CSV tables; labs need a value, dates are longs."""
    csv_as_table(spark, f"{root}/PATIENT.csv", schema="subject_id BIGINT, sex STRING, dob STRING, dod STRING")
    csv_as_table(spark, f"{root}/LAB.csv", schema="subject_id BIGINT, date BIGINT, lab_name STRING, value STRING")
    csv_as_table(spark, f"{root}/DIAGNOSTIC.csv", schema="subject_id BIGINT, date BIGINT, code STRING, sequence INT")
    csv_as_table(spark, f"{root}/MEDICATION.csv", schema="subject_id BIGINT, date BIGINT, med_name STRING")
    return (
        spark.table("PATIENT").select("subject_id", "sex", "dob", "dod"),
        spark.table("LAB").filter(present("value")).select("subject_id", "date", "lab_name", "value"),
        spark.table("DIAGNOSTIC").select("subject_id", "date", "code", "sequence"),
        spark.table("MEDICATION").select("subject_id", "date", "med_name"),
    )
