"""Evaluation queries over the score view."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import evaluate
from cohortloom.operators.relational import contiguous_folds
from cohortloom.plans.registry import query
from cohortloom.plans.views import with_views
from cohortloom.sources import adapters as src

_LONG = """long AS (
    SELECT id, y, 's1' AS model, s1 AS score FROM scores UNION ALL SELECT id, y, 's2', s2 FROM scores
    UNION ALL SELECT id, y, 's3', s3 FROM scores)"""


def long_scores(spark, d):
    """(id, y, model, score)"""
    return src.scores(spark, d).select(
        "id",
        "y",
        F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in ("s1", "s2", "s3")])),
    )


@query("class_metrics", with_views("scores", """
    SELECT model, (tp + tn) / n AS accuracy, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc_hard, tp / (tp + fp) AS "precision",
           tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM (
      SELECT model, count(*)::DOUBLE AS n,
             count(*) FILTER (y = 1 AND score > 0.5)::DOUBLE AS tp, count(*) FILTER (y = 0 AND score > 0.5)::DOUBLE AS fp,
             count(*) FILTER (y = 1 AND score <= 0.5)::DOUBLE AS fn, count(*) FILTER (y = 0 AND score <= 0.5)::DOUBLE AS tn
      FROM long GROUP BY model)""", _LONG))
def class_metrics(spark, d):
    hard = long_scores(spark, d).withColumn("pred", F.when(F.col("score") > 0.5, 1).otherwise(0))
    return evaluate.class_metrics(hard, ["model"])


@query("roc_points", with_views("scores", """
    SELECT model, score AS threshold, sum(neg) OVER w / sum(neg) OVER (PARTITION BY model) AS fpr,
           sum(pos) OVER w / sum(pos) OVER (PARTITION BY model) AS tpr
    FROM (SELECT model, score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM long GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY model ORDER BY score DESC)
    UNION ALL SELECT model, max(score) + 1, 0.0, 0.0 FROM long GROUP BY model""", _LONG))
def roc_points(spark, d):
    return evaluate.roc_points(long_scores(spark, d), ["model"])


@query("roc_auc", with_views("scores", """
    SELECT model, round((sum(r) FILTER (y = 1) - p * (p + 1) / 2) / (p * n), 10) AS auc FROM (
      SELECT model, y, rank() OVER (PARTITION BY model ORDER BY score)
               + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r,
             sum(y) OVER (PARTITION BY model)::DOUBLE AS p, sum(1 - y) OVER (PARTITION BY model)::DOUBLE AS n
      FROM long) GROUP BY model, p, n""", _LONG))
def roc_auc(spark, d):
    return evaluate.roc_auc(long_scores(spark, d), ["model"]).withColumn("auc", F.round("auc", 10))


@query("accuracy_table", with_views("scores", """
    SELECT model, CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS part,
           avg(CASE WHEN (score > 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy
    FROM long GROUP BY 1, 2""", _LONG))
def accuracy_table(spark, d):
    parted = long_scores(spark, d).withColumn("part", F.when(F.col("id") % 5 == 0, "test").otherwise("train"))
    return evaluate.accuracy_table(parted, ["model", "part"])


@query("cv_mean_scores", with_views("scores", """
    SELECT model, round(avg((tp + tn) / n), 10) AS mean_accuracy,
           round(avg((tp / (tp + fn) + tn / (tn + fp)) / 2), 10) AS mean_auc FROM (
      SELECT l.model, f.fold, count(*)::DOUBLE AS n,
             count(*) FILTER (y = 1 AND score > 0.5)::DOUBLE AS tp, count(*) FILTER (y = 0 AND score > 0.5)::DOUBLE AS fp,
             count(*) FILTER (y = 1 AND score <= 0.5)::DOUBLE AS fn, count(*) FILTER (y = 0 AND score <= 0.5)::DOUBLE AS tn
      FROM long l JOIN (SELECT id, ntile(5) OVER (ORDER BY id) AS fold FROM scores) f ON f.id = l.id GROUP BY 1, 2)
    GROUP BY model""", _LONG))
def cv_mean_scores(spark, d):
    folds = contiguous_folds(src.scores(spark, d).select("id"), "id", 5)
    means = evaluate.cv_mean_scores(long_scores(spark, d).join(folds, "id"))
    return means.select(
        "model", F.round("mean_accuracy", 10).alias("mean_accuracy"), F.round("mean_auc", 10).alias("mean_auc")
    )


@query("weighted_log_loss", with_views("scores", """
    SELECT model, round(avg(CASE WHEN y = 1 THEN -0.91 * ln(p) ELSE -0.09 * ln(1 - p) END), 8) AS loss
    FROM (SELECT model, y, greatest(least(score, 1 - 1e-7), 1e-7) AS p FROM long) GROUP BY model""", _LONG))
def weighted_log_loss(spark, d):
    loss = evaluate.weighted_log_loss(long_scores(spark, d), ["model"])
    return loss.withColumn("loss", F.round("loss", 8))


@query("purity", """
    SELECT sum(best) / sum(total) AS purity FROM (
      SELECT cluster, max(n)::DOUBLE AS best, sum(n)::DOUBLE AS total FROM (
        SELECT vec_id % 7 AS cluster, label, count(*) AS n FROM embeddings GROUP BY 1, 2) GROUP BY cluster)""")
def purity(spark, d):
    assigned = src.vectors(spark, d).select((F.col("id") % 7).alias("cluster"), "class")
    return evaluate.purity(assigned)


@query("stack_join", with_views("scores", """
    SELECT a.id, a.y, a.s1, b.s2, c.s3 FROM scores a
    JOIN (SELECT * FROM scores WHERE id % 13 <> 0) b ON a.id = b.id
    JOIN (SELECT * FROM scores WHERE id % 17 <> 0) c ON a.id = c.id"""))
def stack_join(spark, d):
    from cohortloom.operators.models import join_predictions

    rows = src.scores(spark, d)
    return join_predictions(
        rows.select("id", "y", "s1"),
        [rows.filter(F.col("id") % 13 != 0).select("id", "s2"), rows.filter(F.col("id") % 17 != 0).select("id", "s3")],
    )
