"""Outcome models on Spark ML. Inputs have columns (id, features, label) and maybe `weight`."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import hash_unit_for
from cohortloom.session import cut

POSITIVE_WEIGHT = 0.91
NEGATIVE_WEIGHT = 0.09


def fold_of(key: str, folds: int) -> Column:
    """0 .. folds - 1 from a hash of the key that is independent of the test split's."""
    return F.floor(hash_unit_for(key, F.lit("fold")) * folds).cast("int")


def logistic(**params) -> LogisticRegression:
    return LogisticRegression(**params)


def svm(c: float = 1.0, n: int | None = None, **params) -> LinearSVC:
    """Linear SVM; `c` is the usual inverse penalty, 1 / (c n) in Spark's terms when n is given."""
    reg = 1.0 / (c * n) if n else 0.0
    return LinearSVC(regParam=reg, **params)


def tree(depth: int = 5) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, seed=545510477)


def forest(trees: int = 50, depth: int = 15, **params) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=545510477, **params)


def predict(model, rows: DataFrame) -> DataFrame:
    """(id, label, pred)"""
    return model.transform(rows).select("id", "label", F.col("prediction").cast("int").alias("pred"))


def probability_table(model, rows: DataFrame, name: str = "score") -> DataFrame:
    """(id, label, probability of class 1)"""
    return model.transform(rows).select("id", "label", vector_to_array("probability")[1].alias(name))


def select_by_coef(rows: DataFrame, c: float = 1.5, limit: float = 0.15) -> tuple[DataFrame, list[int]]:
    """Rows with only the features whose linear-SVM coefficient is at least `limit` in size, and their positions.

    If no coefficient reaches the limit there are no positions, and the rows keep their columns but for `features`.
    """
    model = svm(c, rows.count()).fit(rows)
    kept = [i for i, w in enumerate(model.coefficients) if abs(w) >= limit]
    return keep_features(rows, kept), kept


def keep_features(rows: DataFrame, kept: list[int]) -> DataFrame:
    """Rows with only the features at the given positions."""
    if not kept:
        return rows.drop("features")
    sliced = VectorSlicer(inputCol="features", outputCol="_kept", indices=kept).transform(rows)
    return sliced.drop("features").withColumnRenamed("_kept", "features")


def with_class_weight(rows: DataFrame, positive: float = POSITIVE_WEIGHT, negative: float = NEGATIVE_WEIGHT) -> DataFrame:
    """Add `weight` by class."""
    return rows.withColumn("weight", F.when(F.col("label") == 1, positive).otherwise(negative))


def grid_search(rows: DataFrame, grid: dict[str, list[float]], folds: int = 5, weighted: bool = False):
    """Cross-validated grid over a scale -> logistic pipeline, refit on all rows.

    Folds come from a hash of the id, drawn apart from other splits, so the same row is always in
    the same fold and folds of a training split are even.
    """
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    model = LogisticRegression(featuresCol="scaled")
    if weighted:
        model.setWeightCol("weight")
    builder = ParamGridBuilder()
    for name, options in grid.items():
        builder = builder.addGrid(model.getParam(name), options)
    search = CrossValidator(
        estimator=Pipeline(stages=[scaler, model]),
        estimatorParamMaps=builder.build(),
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC"),
        numFolds=folds,
        foldCol="fold",
        parallelism=4,
    )
    return search.fit(rows.withColumn("fold", fold_of("id", folds)))


def out_of_fold(rows: DataFrame, estimator, name: str, folds: int = 5) -> DataFrame:
    """(id, `name`): each row's probability from a model that has not seen it."""
    parted = rows.withColumn("_fold", fold_of("id", folds)).persist()
    try:
        out = None
        for fold in range(folds):
            model = estimator.fit(parted.filter(F.col("_fold") != fold))
            part = probability_table(model, parted.filter(F.col("_fold") == fold), name).select("id", name)
            out = part if out is None else out.unionByName(part)
        return cut(out)
    finally:
        parted.unpersist()


def join_predictions(first: DataFrame, others: list[DataFrame], on: str = "id") -> DataFrame:
    """Inner join of prediction tables on the row id."""
    out = first
    for other in others:
        out = out.join(other, on)
    return out


def stack(joined: DataFrame, score_columns: list[str], penalty: float = 0.001):
    """L1 logistic meta-model over joined base predictions with a `label`."""
    from pyspark.ml.feature import VectorAssembler

    assemble = VectorAssembler(inputCols=score_columns, outputCol="features")
    meta = LogisticRegression(elasticNetParam=1.0, regParam=penalty)
    return Pipeline(stages=[assemble, meta]).fit(joined)
