"""Logistic regression by stochastic gradient descent, many models at once.

Training rows are long: (id, y, idx, value). A model is rows (model_id, idx, weight).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import hash_unit_for, sigmoid
from cohortloom.operators.relational import sample_per_model
from cohortloom.session import cut, drop_cut, keep_placed, tasks_for


def linear_scores(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """(model_id, id, probability): sigmoid of each model's weighted sum; unknown features weigh 0."""
    z = rows.join(weights, "idx").groupBy("model_id", "id").agg(F.sum(F.col("weight") * F.col("value")).alias("z"))
    return z.select("model_id", "id", sigmoid("z").alias("probability"))


def batch_step(sampled: DataFrame, weights: DataFrame, eta: float, mu: float) -> DataFrame:
    """(model_id, idx, weight) after w + eta * (mean of (y - p) x over the model's rows - 2 mu w).

    `sampled` is (model_id, id, y, idx, value). One join for the scores, one for the gradient.
    """
    known = sampled.join(weights, ["model_id", "idx"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    scored = known.groupBy("model_id", "id").agg(
        F.first("y").alias("y"), F.sum(F.col("weight") * F.col("value")).alias("z")
    )
    errors = scored.select("model_id", "id", (F.col("y") - sigmoid("z")).alias("error"))
    sizes = scored.groupBy("model_id").agg(F.count("*").alias("rows"))
    gradient = (
        sampled.join(errors, ["model_id", "id"]).groupBy("model_id", "idx")
        .agg(F.sum(F.col("error") * F.col("value")).alias("g"))
    )
    step = F.coalesce("g", F.lit(0.0)) / F.col("rows") - 2 * mu * F.col("weight")
    return (
        weights.join(sizes, "model_id").join(gradient, ["model_id", "idx"], "left")
        .select("model_id", "idx", (F.col("weight") + eta * step).alias("weight"))
    )


def zero_weights(sampled: DataFrame) -> DataFrame:
    return sampled.select("model_id", "idx").distinct().withColumn("weight", F.lit(0.0))


def train_batches(sampled: DataFrame, rounds: int, eta: float, mu: float) -> DataFrame:
    """`rounds` full-batch steps from zero; all models advance in the same jobs.

    The rows are placed by model and id once, so that a step shuffles sums only.
    """
    sampled = cut(sampled)
    sampled = keep_placed(sampled.repartition(tasks_for(sampled), "model_id", "id"))
    try:
        weights = cut(zero_weights(sampled))
        for _ in range(rounds):
            before, weights = weights, cut(batch_step(sampled, weights, eta, mu))
            drop_cut(before)
        return weights
    finally:
        sampled.unpersist()


def _train_rows(rows: pd.DataFrame, eta: float, mu: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights after one pass, row by row in id order: w <- (1 - 2 eta mu) w + eta (y - p) x."""
    indices = np.unique(np.concatenate(rows["idx"].to_list()))
    weight = np.zeros(len(indices))
    keep = 1.0 - 2.0 * eta * mu
    for row in rows.sort_values("id").itertuples(index=False):
        at = np.searchsorted(indices, row.idx)
        x = np.asarray(row.value, dtype=float)
        p = 1.0 / (1.0 + np.exp(-float(weight[at] @ x)))
        if mu:
            weight *= keep
        weight[at] += eta * (row.y - p) * x
    return indices, weight


def train_grouped(sampled: DataFrame, eta: float, mu: float, shards: int = 1) -> DataFrame:
    """(model_id, idx, weight) from one sequential pass over each of a model's `shards`, averaged by their size.

    The number of shards is the caller's and part of the definition: rows fall into them by a hash of
    the id, whatever their number, so the same rows give the same weights at every size and setting.
    One task holds one shard. For samples too large for that use `train_batches`, which gathers no rows.
    """
    packed = sampled.groupBy("model_id", "id").agg(
        F.first("y").cast("double").alias("y"), F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("pairs")
    )
    packed = cut(packed.select("model_id", "id", "y", F.col("pairs.idx").alias("idx"), F.col("pairs.value").alias("value")))
    totals = packed.groupBy("model_id").agg(F.count("*").alias("total"))
    # One row per model.
    placed = packed.join(F.broadcast(totals), "model_id").withColumn(
        "shard", F.floor(hash_unit_for("id", F.lit("shard")) * shards).cast("int")
    )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        indices, weight = _train_rows(group, eta, mu)
        share = len(group) / float(group["total"].iloc[0])
        return pd.DataFrame({"model_id": group["model_id"].iloc[0], "idx": indices, "part": weight * share})

    parts = placed.groupBy("model_id", "shard").applyInPandas(fit, "model_id INT, idx BIGINT, part DOUBLE")
    return parts.groupBy("model_id", "idx").agg(F.sum("part").alias("weight"))


def train_ensemble(
    rows: DataFrame, n_models: int, ratio: float, rounds: int = 10, eta: float = 0.5, mu: float = 0.0
) -> DataFrame:
    """`n_models` models, each on its own Bernoulli sample of the ids, by batch steps that gather no rows."""
    ids = sample_per_model(rows.select("id").distinct(), "id", n_models, ratio)
    return train_batches(rows.join(ids, "id").select("model_id", "id", "y", "idx", "value"), rounds, eta, mu)


def mean_probability(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, probability): mean over the models; a model that knows none of a row's features says 0.5."""
    models = weights.select("model_id").distinct()
    n_models = models.agg(F.count("*")).scalar()
    known = linear_scores(rows, weights).groupBy("id").agg(F.sum("probability").alias("s"), F.count("*").alias("n"))
    ids = rows.select("id").distinct()
    total = F.coalesce("s", F.lit(0.0)) + 0.5 * (n_models - F.coalesce("n", F.lit(0)))
    return ids.join(known, "id", "left").select("id", (total / n_models).alias("probability"))
