"""What one task holds, and what is shuffled, on rows that pack well."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F


@contextlib.contextmanager
def _set(spark, **conf):
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_packed_keys_do_not_pile_up_in_one_task(spark):
    """A shuffle of few bytes and many rows is not put together into a few large tasks."""
    with _set(spark, **{"spark.sql.shuffle.partitions": "64"}):
        rows = spark.range(6_000_000).select((F.col("id") * 7919 % 2_000_000).alias("key"))
        counted = rows.repartition("key").select(F.spark_partition_id().alias("task")).groupBy("task").count()
        assert counted.agg(F.max("count")).first()[0] < 500_000


def test_rounds_over_a_small_table_have_few_tasks(spark, monkeypatch):
    """What a loop passes over is cut by its rows, not into as many tasks as the session's shuffles have."""
    from cohortloom.operators import nmf, propagate

    kept = []
    for module in (nmf, propagate):
        monkeypatch.setattr(module, "keep_placed", lambda df, f=module.keep_placed: kept.append(f(df)) or kept[-1])
    most = spark.sparkContext.defaultParallelism
    entries = spark.range(200).select((F.col("id") % 20).alias("row"), (F.col("id") % 10).cast("int").alias("col"), F.lit(1.5).alias("value"))
    edges = spark.range(200).select((F.col("id") % 20).alias("src"), (F.col("id") % 7).alias("dst"), F.lit(0.5).alias("weight"))
    with _set(spark, **{"spark.sql.shuffle.partitions": "64"}):
        nmf.factorize(entries, 2, max_rounds=1)
        slots, placed = propagate.place(edges, 3)
        arrived = propagate.push(slots.withColumn("x", F.col("vid").cast("double")), placed)
        sums = {r["vid"]: r["x"] for r in arrived.collect()}
    assert [k.rdd.getNumPartitions() <= most for k in kept] == [True, True]
    placed.unpersist()
    wanted = {}
    for i in range(200):
        wanted[i % 7] = wanted.get(i % 7, 0.0) + i % 20 * 0.5
    assert sums == wanted


def test_latest_events_take_one_shuffle(spark):
    from cohortloom.operators.graph import latest_events

    rows = [(1, "lab", "a", d, v) for d, v in [("2020-01-01", 9.0), ("2020-02-01", 1.0), ("2020-02-01", 3.0), (None, 50.0)]]
    rows += [(2, "lab", "a", None, 4.0), (2, "lab", "a", None, 5.0), (3, None, "b", "2020-01-01", None), (3, None, "b", "2020-01-01", 2.0)]
    events = spark.createDataFrame(rows, "patient_id BIGINT, kind STRING, item STRING, date STRING, value DOUBLE")
    found = latest_events(events.repartition(4))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == [
        (1, "lab", "a", "2020-02-01", 3.0), (2, "lab", "a", None, None), (3, None, "b", "2020-01-01", 2.0),
    ]
    plan = latest_events(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_batch_steps_leave_the_rows_in_place(spark, monkeypatch):
    """A step joins and sums rows that are placed by model and id: no exchange of them is left."""
    from cohortloom.operators import sgd

    plans, step = [], sgd.batch_step
    monkeypatch.setattr(sgd, "batch_step", lambda *a: plans.append((out := step(*a))._jdf.queryExecution().executedPlan().toString()) or out)
    rows = [(m, i, i % 2, j, 1.0 + j) for m in (1, 2) for i in range(40) for j in range(3)]
    sampled = spark.createDataFrame(rows, "model_id INT, id BIGINT, y INT, idx BIGINT, value DOUBLE")
    found = {(r["model_id"], r["idx"]): r["weight"] for r in sgd.train_batches(sampled, 1, 0.5, 0.0).collect()}
    assert found == {(m, j): 0.0 for m in (1, 2) for j in range(3)}
    assert not [line for line in plans[0].splitlines() if "hashpartitioning(model_id" in line and ", id#" in line and "ENSURE_REQUIREMENTS" in line]
