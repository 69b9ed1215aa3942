"""Outcome-model queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortloom.functions.columns import hash_unit
from cohortloom.operators import evaluate, models, sgd
from cohortloom.operators.relational import sample_per_model
from cohortloom.plans.etl import features
from cohortloom.plans.registry import query
from cohortloom.plans.views import unit, with_views
from cohortloom.session import cut
from cohortloom.sources import adapters as src

LANGS = ["en", "es", "fr", "de"]


def docs(spark, d):
    """(id, features, label, is_test): a numeric row per labelled document."""
    numbers = [F.log1p("n_chars"), F.log1p("n_words"), F.log1p("n_lines"), F.col("n_chars") / F.col("n_words")]
    flags = [(F.col("lang") == lang).cast("double") for lang in LANGS]
    rows = src.labelled_docs(spark, d).select(
        "id", array_to_vector(F.array(*numbers, *flags)).alias("features"), "label"
    )
    # Model fitting passes over the rows many times.
    return cut(rows.withColumn("is_test", (hash_unit("id") <= 0.2).cast("int")))


def _train_predict(spark, d, estimator):
    rows = docs(spark, d)
    model = estimator.fit(rows.filter("is_test = 0"))
    return models.predict(model, rows.filter("is_test = 1"))


@query("clf_logistic")
def clf_logistic(spark, d):
    return _train_predict(spark, d, models.logistic())


@query("clf_svm")
def clf_svm(spark, d):
    return _train_predict(spark, d, models.svm(maxIter=30))


@query("clf_tree")
def clf_tree(spark, d):
    return _train_predict(spark, d, models.tree(5))


@query("clf_forest")
def clf_forest(spark, d):
    return _train_predict(spark, d, models.forest(50, 15))


@query("select_by_coef")
def select_by_coef(spark, d):
    """(feature): the kept feature positions, from the training rows."""
    _, kept = models.select_by_coef(docs(spark, d).filter("is_test = 0"), limit=0.15)
    return spark.createDataFrame([(i,) for i in kept], "feature INT")


@query("select_then_forest")
def select_then_forest(spark, d):
    """Features selected on the training rows, a forest on those, predictions for the held-out rows."""
    rows = docs(spark, d)
    train, kept = models.select_by_coef(rows.filter("is_test = 0"), limit=0.15)
    if not kept:
        train, kept = rows.filter("is_test = 0"), list(range(4 + len(LANGS)))
    model = models.forest(50, 15).fit(train)
    return models.predict(model, models.keep_features(rows.filter("is_test = 1"), kept))


@query("clf_weighted")
def clf_weighted(spark, d):
    """Held-out metrics of the class-weighted model."""
    rows = models.with_class_weight(docs(spark, d))
    model = models.logistic(weightCol="weight").fit(rows.filter("is_test = 0"))
    scored = models.probability_table(model, rows.filter("is_test = 1")).withColumnRenamed("label", "y")
    return evaluate.weighted_log_loss(scored.withColumn("model", F.lit("logistic")), ["model"])


@query("grid_search_cv")
def grid_search_cv(spark, d):
    """(reg_param, mean_auc) per grid point."""
    grid = [0.001, 0.1]
    train = models.with_class_weight(docs(spark, d).filter("is_test = 0"))
    found = models.grid_search(train, {"regParam": grid}, folds=5, weighted=True)
    return spark.createDataFrame([(g, float(a)) for g, a in zip(grid, found.avgMetrics)], "reg_param DOUBLE, mean_auc DOUBLE")


@query("predict_proba_table")
def predict_proba_table(spark, d):
    rows = docs(spark, d)
    model = models.logistic().fit(rows.filter("is_test = 0"))
    return models.probability_table(model, rows.filter("is_test = 1")).select("id", "score")


@query("stack_models")
def stack_models(spark, d):
    """Meta-model on out-of-fold base predictions, scored on held-out rows."""
    rows = docs(spark, d)
    train, test = rows.filter("is_test = 0"), rows.filter("is_test = 1")
    bases = {"p_logistic": models.logistic(), "p_tree": models.tree(5), "p_forest": models.forest(10, 5)}
    folded = [models.out_of_fold(train, base, name, folds=3) for name, base in bases.items()]
    meta = models.stack(cut(models.join_predictions(train.select("id", "label"), folded)), list(bases))
    final = [models.probability_table(base.fit(train), test, name).select("id", name) for name, base in bases.items()]
    joined = models.join_predictions(test.select("id", "label"), final)
    return models.probability_table(meta, joined)


# --- SGD on the sparse patient features ---

ETA, MU = 0.5, 0.01


def rows_long(spark, d):
    """(id, y, idx, value): patient features with the mortality label."""
    dead = src.mortality(spark, d).select("patient_id").distinct().withColumn("y", F.lit(1))
    return features(spark, d).join(dead, "patient_id", "left").select(
        F.col("patient_id").alias("id"), F.coalesce("y", F.lit(0)).alias("y"), "idx", "value"
    )


_SAMPLED = f"""rows_long AS (
      SELECT n.patient_id AS id, CASE WHEN n.patient_id % 4 = 0 THEN 1 ELSE 0 END AS y, n.idx, n.value FROM normalized n),
    sampled AS (SELECT CAST(m AS INTEGER) AS model_id, r.* FROM rows_long r, range(1, 4) t(m)
                WHERE {unit("concat(r.id, '-', m)")} < 0.6)"""


def _sampled(spark, d):
    rows = rows_long(spark, d)
    return sample_per_model(rows, "id", 3, 0.6).select("model_id", "id", "y", "idx", "value")


@query("sgd_logistic", with_views("normalized", f"""
    SELECT w.model_id, w.idx, round(w.weight + {ETA} * (coalesce(g.g, 0) / s.n - 2 * {MU} * w.weight), 9) AS weight
    FROM w0 w JOIN sizes s ON s.model_id = w.model_id
    LEFT JOIN (SELECT t.model_id, t.idx, sum(e.error * t.value) AS g FROM sampled t
               JOIN errors e ON e.model_id = t.model_id AND e.id = t.id GROUP BY 1, 2) g
      ON g.model_id = w.model_id AND g.idx = w.idx""", _SAMPLED + """,
    w0 AS (SELECT DISTINCT model_id, idx, ((idx * 7 + model_id) % 11 - 5) / 10.0::DOUBLE AS weight FROM sampled),
    errors AS (SELECT s.model_id, s.id, any_value(s.y) - 1.0 / (1.0 + exp(-sum(w.weight * s.value))) AS error
               FROM sampled s JOIN w0 w ON w.model_id = s.model_id AND w.idx = s.idx GROUP BY 1, 2),
    sizes AS (SELECT model_id, count(*) AS n FROM errors GROUP BY 1)"""))
def sgd_logistic(spark, d):
    """One batch step of three models from given weights."""
    sampled = cut(_sampled(spark, d))
    weight = (((F.col("idx") * 7 + F.col("model_id")) % 11) - 5) / F.lit(10.0)
    start = sgd.zero_weights(sampled).withColumn("weight", weight)
    return sgd.batch_step(sampled, start, ETA, MU).withColumn("weight", F.round("weight", 9))


@query("sgd_batches")
def sgd_batches(spark, d):
    """Weights of three models after five batch steps."""
    return sgd.train_batches(_sampled(spark, d), 5, ETA, MU)


@query("udf_grouped_train")
def udf_grouped_train(spark, d):
    """One model per key by a grouped function, two shards each."""
    return sgd.train_grouped(_sampled(spark, d), 0.01, 0.0, shards=2)


def _ensemble_sql(rounds: int) -> str:
    """Batch steps from zero on the training rows, then probabilities of the held-out rows."""
    held = f"{unit('CAST(id AS VARCHAR)')} <= 0.2"
    steps = [
        f"train AS MATERIALIZED (SELECT * FROM sampled WHERE NOT ({held}))",
        "e0 AS MATERIALIZED (SELECT DISTINCT model_id, idx, 0.0::DOUBLE AS weight FROM train)",
        "n AS MATERIALIZED (SELECT model_id, count(DISTINCT id) AS n FROM train GROUP BY 1)",
    ]
    for i in range(1, rounds + 1):
        steps.append(f"""err{i} AS MATERIALIZED (SELECT s.model_id, s.id, any_value(s.y) - 1.0 / (1.0 + exp(-sum(w.weight * s.value))) AS error
          FROM train s JOIN e{i - 1} w ON w.model_id = s.model_id AND w.idx = s.idx GROUP BY 1, 2)""")
        steps.append(f"""e{i} AS MATERIALIZED (SELECT w.model_id, w.idx, w.weight + {ETA} * (coalesce(g.g, 0) / n.n) AS weight
          FROM e{i - 1} w JOIN n ON n.model_id = w.model_id
          LEFT JOIN (SELECT t.model_id, t.idx, sum(e.error * t.value) AS g FROM train t
                     JOIN err{i} e ON e.model_id = t.model_id AND e.id = t.id GROUP BY 1, 2) g
            ON g.model_id = w.model_id AND g.idx = w.idx)""")
    steps.append(f"""test AS MATERIALIZED (SELECT * FROM rows_long WHERE {held}),
      known AS (SELECT w.model_id, t.id, 1.0 / (1.0 + exp(-sum(w.weight * t.value))) AS p
                FROM test t JOIN e{rounds} w ON w.idx = t.idx GROUP BY 1, 2)""")
    return ", ".join(steps)


_ENSEMBLE_ROUNDS = 10


@query("sgd_train_ensemble", with_views("normalized", """
    SELECT i.id, i.y, round((coalesce(sum(k.p), 0) + 0.5 * (3 - count(k.p))) / 3, 9) AS probability
    FROM (SELECT DISTINCT id, y FROM test) i LEFT JOIN known k ON k.id = i.id GROUP BY 1, 2""",
    _SAMPLED + ", " + _ensemble_sql(_ENSEMBLE_ROUNDS)))
def sgd_train_ensemble(spark, d):
    """(id, y, probability) of held-out patients under the mean of three models trained on the others."""
    rows = cut(rows_long(spark, d).withColumn("is_test", hash_unit("id") <= 0.2))
    train, test = rows.filter("NOT is_test").drop("is_test"), rows.filter("is_test").drop("is_test")
    weights = sgd.train_ensemble(train, n_models=3, ratio=0.6, rounds=_ENSEMBLE_ROUNDS, eta=ETA)
    scored = sgd.mean_probability(test, weights).join(test.select("id", "y").distinct(), "id")
    return scored.select("id", "y", F.round("probability", 9).alias("probability"))


@query("sgd_ensemble_auc")
def sgd_ensemble_auc(spark, d):
    """(model, auc) of that ensemble on the held-out patients."""
    scored = sgd_train_ensemble(spark, d).select(F.lit("ensemble").alias("model"), "y", F.col("probability").alias("score"))
    return evaluate.roc_auc(scored, ["model"])


@query("ensemble_mean_prob", with_views("normalized", """
    SELECT id, round(avg(p), 9) AS probability FROM (
      SELECT m, patient_id AS id,
             1.0 / (1.0 + exp(-sum(((idx * 7 + m) % 11 - 5) / 10.0::DOUBLE * value))) AS p
      FROM normalized, range(1, 4) t(m) GROUP BY 1, 2) GROUP BY id"""))
def ensemble_mean_prob(spark, d):
    rows = cut(rows_long(spark, d))
    indices = rows.select("idx").distinct().withColumn("model_id", F.explode(F.sequence(F.lit(1), F.lit(3))))
    weights = indices.select(
        "model_id", "idx", (((F.col("idx") * 7 + F.col("model_id")) % 11 - 5) / F.lit(10.0)).alias("weight")
    )
    return sgd.mean_probability(rows, weights).withColumn("probability", F.round("probability", 9))


@query("udf_svmlight", with_views("sparse", "SELECT patient_id, concat(label, ' ', line) AS line FROM sparse"))
def udf_svmlight(spark, d):
    """Bag of pairs to text with array functions; no Python on rows."""
    from cohortloom.operators import etl

    vectors = etl.patient_vectors(features(spark, d), src.mortality(spark, d))
    return etl.svmlight_lines(vectors).select("patient_id", "line")
