"""Model and clustering evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.ordered import running_totals


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def class_metrics(predictions: DataFrame, by: list[str] | None = None, y: str = "y", pred: str = "pred") -> DataFrame:
    """accuracy, auc_hard (area under the ROC of the hard labels), precision, recall, f1 per group."""
    hit = lambda a, b: F.sum(((F.col(y) == a) & (F.col(pred) == b)).cast("bigint"))
    table = predictions.groupBy(*(by or [])).agg(
        hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall, precision = _ratio(tp, tp + fn), _ratio(tp, tp + fp)
    return table.select(
        *(by or []),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ((recall + _ratio(tn, tn + fp)) / 2).alias("auc_hard"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def score_steps(scored: DataFrame, by: list[str] | None = None, y: str = "y", score: str = "score") -> DataFrame:
    """(by, score, pos, neg, tp, fp): label counts per distinct score and running counts from the top.

    Equal scores are combined before anything is ordered.
    """
    by = by or []
    label = F.col(y)
    ties = scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum((label == 1).cast("bigint")).alias("pos"), F.sum((label != 1).cast("bigint")).alias("neg")
    )
    return running_totals(ties, "score", {"pos": "tp", "neg": "fp"}, by)


def _class_totals(scored: DataFrame, by: list[str], y: str) -> DataFrame:
    label = F.col(y)
    return scored.groupBy(*by).agg(
        F.sum((label == 1).cast("bigint")).alias("n_pos"),
        F.sum((label != 1).cast("bigint")).alias("n_neg"),
        F.max("score").alias("top"),
    )


def roc_points(scored: DataFrame, by: list[str], y: str = "y") -> DataFrame:
    """(by, threshold, fpr, tpr): one point per distinct score, and (0, 0) above the largest one."""
    totals = _class_totals(scored, by, y)
    steps = score_steps(scored, by, y).join(totals, by)
    points = steps.select(
        *by,
        F.col("score").alias("threshold"),
        _ratio(F.col("fp"), F.col("n_neg")).alias("fpr"),
        _ratio(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    start = totals.select(*by, (F.col("top") + 1).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def roc_auc(scored: DataFrame, by: list[str], y: str = "y") -> DataFrame:
    """(by, auc): each step adds its negatives times the true positives at its middle."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)) / (F.sum("pos") * F.sum("neg"))
    return score_steps(scored, by, y).groupBy(*by).agg(area.alias("auc"))


def accuracy_table(predictions: DataFrame, by: list[str], y: str = "y", score: str = "score") -> DataFrame:
    """(by, accuracy) at a cut of 0.5."""
    right = (F.when(F.col(score) > 0.5, 1).otherwise(0) == F.col(y)).cast("int")
    return predictions.groupBy(*by).agg(F.avg(right).alias("accuracy"))


def cv_mean_scores(scored: DataFrame, model: str = "model", fold: str = "fold", y: str = "y") -> DataFrame:
    """(model, mean_accuracy, mean_auc) over folds; the AUC is taken on hard labels."""
    hard = scored.withColumn("pred", F.when(F.col("score") > 0.5, 1).otherwise(0))
    per_fold = class_metrics(hard, [model, fold], y)
    return per_fold.groupBy(model).agg(F.avg("accuracy").alias("mean_accuracy"), F.avg("auc_hard").alias("mean_auc"))


def weighted_log_loss(predictions: DataFrame, by: list[str], positive: float = 0.91, negative: float = 0.09) -> DataFrame:
    """(by, loss): mean of the class-weighted cross entropy, probabilities kept off 0 and 1."""
    p = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-7)), F.lit(1e-7))
    entropy = F.when(F.col("y") == 1, -F.log(p) * positive).otherwise(-F.log(1 - p) * negative)
    return predictions.groupBy(*by).agg(F.avg(entropy).alias("loss"))


def purity(assigned: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, purity): share of rows that belong to the largest class of their cluster."""
    by = by or []
    counts = assigned.groupBy(*by, "cluster", "class").agg(F.count("*").alias("n"))
    best = counts.groupBy(*by, "cluster").agg(F.max("n").alias("best"), F.sum("n").alias("total"))
    return best.groupBy(*by).agg((F.sum("best") / F.sum("total")).alias("purity"))
