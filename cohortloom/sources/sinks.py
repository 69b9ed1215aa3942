"""Writers. Each takes a target path that must not exist yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Chosen columns as CSV with a header in every part."""
    df.select(*(columns or df.columns)).write.csv(path, header=True)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Headerless delimited text."""
    df.write.csv(path, sep=sep, header=False)


def write_svmlight(lines: DataFrame, features_path: str, report_path: str, test_rows: bool = False) -> None:
    """Two text files from (patient_id, label, pairs): `label i:v ...` and `patient label i:v ...`.

    Both are in ascending patient order over their parts. Test rows carry label 0 and 3 decimals.
    """
    from cohortloom.functions.columns import sparse_text

    label = F.lit("0") if test_rows else F.col("label").cast("string")
    body = sparse_text("pairs", 3 if test_rows else 6)
    ordered = lines.select("patient_id", label.alias("label"), body.alias("body")).orderBy("patient_id").persist()
    ordered.select(F.concat_ws(" ", "label", "body")).write.text(features_path)
    ordered.select(F.concat_ws(" ", F.col("patient_id").cast("string"), "label", "body")).write.text(report_path)
    ordered.unpersist()


def write_submission(ids: DataFrame, predictions: DataFrame, path: str) -> None:
    """(patient_id, label) CSV; labels are matched by patient, not by row position."""
    ids.select("patient_id").join(predictions.select("patient_id", "label"), "patient_id").write.csv(path, header=True)


def write_single_file(df: DataFrame, path: str) -> None:
    """One text file, for reports. Only the finished lines meet in one task; what makes them stays parallel."""
    text = df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]))
    text.repartition(1).write.text(path)


def write_model(weights: DataFrame, path: str) -> None:
    """Model weights as a (model_id, idx, weight) table."""
    weights.select("model_id", "idx", "weight").write.parquet(path)
