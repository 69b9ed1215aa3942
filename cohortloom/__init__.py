"""Cohort analytics written as Spark DataFrame programs."""
