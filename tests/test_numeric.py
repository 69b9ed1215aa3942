"""Numbering, running totals, evaluation, factorisation, SGD and streaming."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.functions import ordered
from cohortloom.operators import cluster, evaluate, nmf, relational, sgd
from cohortloom.plans import QUERIES
from cohortloom.session import work_path
from cohortloom.sources import files
from cohortloom.streaming import kmeans as stream


def test_dense_index_over_many_partitions(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(13)
    got = ordered.dense_index(rows, ["x"]).collect()
    assert sorted((r.x, r.idx) for r in got) == [(i, i) for i in range(1000)]


def test_running_totals_match_a_plain_scan(spark):
    scores = [(i / 300.0, i % 3) for i in range(300)]
    df = spark.createDataFrame(scores, "k DOUBLE, n INT")
    got = {r.k: r.total for r in ordered.running_totals(df, "k", {"n": "total"}, rows_per_range=20).collect()}
    total, want = 0, {}
    for k, n in sorted(scores, reverse=True):
        total += n
        want[k] = total
    assert got == want


def test_groups_on_different_scales_are_cut_evenly(spark):
    """Three groups whose values lie orders of magnitude apart, one of them with most of the rows."""
    sizes = {"small": (1_000, 1e-6), "middle": (4_000, 1.0), "large": (16_000, 1e9)}
    rows = [(g, (k * 7919 % n) * scale, 1) for g, (n, scale) in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "g string, k double, n bigint")
    points = {r.g: r._cuts for r in ordered.cut_points(df, "k", ["g"], 500, 1024).collect()}
    assert {g: len(c) + 1 for g, c in points.items()} == {"small": 2, "middle": 8, "large": 32}
    for g, (n, scale) in sizes.items():
        edges = [-1, *[c / scale for c in points[g]], n]
        assert all(b - a < 3 * 500 for a, b in zip(edges, edges[1:]))
    got = ordered.running_totals(df, "k", {"n": "total"}, ["g"], rows_per_range=500)
    assert {(r.g, r.k): r.total for r in got.collect()} == {(g, k): sizes[g][0] - round(k / sizes[g][1]) for g, k, _ in rows}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_narrows_to_the_neighbours(spark, q):
    """Groups on other scales, one value in a third of the rows, ties, nulls, a null group; ranges of 20 values."""
    rows = [("a", (k * 7919 % 3000) * 0.37) for k in range(3000)] + [("a", 400.0)] * 1500 + [("b", -1e9 + k % 7) for k in range(500)]
    rows += [(None, float(k)) for k in range(10)] + [("c", None), ("d", 2.5), ("a", None)]
    df = spark.createDataFrame(rows, "g string, k double")
    got = {r.g: r.m for r in ordered.exact_quantile(df, "k", q, ["g"], "m", rows_per_range=20, most_ranges=16).collect()}
    values = {}
    for g, k in rows:
        if k is not None:
            values.setdefault(g, []).append(k)
    assert got == {g: pytest.approx(float(np.quantile(v, q)), rel=1e-12) for g, v in values.items()}
    whole = ordered.exact_quantile(df, "k", q, rows_per_range=20).collect()
    assert [r.quantile for r in whole] == [pytest.approx(float(np.quantile([k for _, k in rows if k is not None], q)), rel=1e-12)]


def test_exact_quantile_of_nothing(spark):
    assert ordered.exact_quantile(spark.createDataFrame([(None,)], "k double"), "k", 0.5).collect() == []


def test_svmlight_lines_are_numbered_in_file_order(spark, tmp_path):
    """Line k of a file is row k, over splits of 64 bytes and two files."""
    texts = [[f"{k % 2} {k}:0.5 {k + 1}:{k}.25" if k % 5 else f"{k % 2}" for k in range(n)] for n in (300, 40)]
    for name, lines in zip(("a.txt", "b.txt"), texts, strict=True):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        rows = files.read_svmlight(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for line, k in enumerate([*range(300), *range(40)]):
        want += [(line, k % 2, k, 0.5), (line, k % 2, k + 1, k + 0.25)] if k % 5 else [(line, k % 2, None, None)]
    assert sorted((r.line, r.label, r.idx, r.value) for r in rows if r.idx is not None) == sorted(w for w in want if w[2] is not None)
    assert sorted(r.line for r in rows if r.idx is None) == [w[0] for w in want if w[2] is None]


def test_cut_points_are_bounded_and_one_range_needs_none(spark):
    df = spark.createDataFrame([("a", float(k)) for k in range(5000)] + [("b", 1.0)], "g string, k double")
    points = {r.g: r._cuts for r in ordered.cut_points(df, "k", ["g"], 10, 16).collect()}
    assert len(points["a"]) == 15 and points["b"] == []


def test_running_count_of_a_hot_group(spark):
    df = spark.range(500).select(F.lit(1).alias("g"), "id", (F.col("id") % 50).alias("t"))
    got = ordered.running_count(df, "g", ["t", "id"], F.floor(F.col("t") / 10), "n").orderBy("t", "id").collect()
    assert [r.n for r in got] == list(range(1, 501))


@pytest.mark.parametrize("n,k", [(10, 5), (13, 5), (3, 3), (11, 4)])
def test_folds_are_contiguous_and_even(spark, n, k):
    got = relational.contiguous_folds(spark.range(n), "id", k).orderBy("id").collect()
    assert [r.fold for r in got] == [f for f, part in enumerate(np.array_split(range(n), k)) for _ in part]


def test_full_outer_with_hot_and_unmatched_keys(spark):
    left = spark.createDataFrame([(1, "a")] * 5 + [(2, "b"), (None, "n")], "k INT, l STRING")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k INT, r STRING")
    got = sorted(map(str, relational.full_outer(left, right, ["k"]).collect()))
    assert got == sorted(map(str, left.join(right, "k", "full_outer").collect()))


@pytest.mark.parametrize("scores,auc", [([0.5] * 4, 0.5), ([0.1, 0.2, 0.8, 0.9], 1.0), ([0.9, 0.8, 0.2, 0.1], 0.0)])
def test_auc_extremes(spark, scores, auc):
    rows = [("m", y, s) for y, s in zip([0, 0, 1, 1], scores)]
    df = spark.createDataFrame(rows, "model STRING, y INT, score DOUBLE")
    assert evaluate.roc_auc(df, ["model"]).first()["auc"] == auc
    points = sorted((r.fpr, r.tpr) for r in evaluate.roc_points(df, ["model"]).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)


def test_purity(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 2)]
    df = spark.createDataFrame(rows, "cluster INT, class INT")
    assert evaluate.purity(df).first()[0] == 3 / 5
    own = df.withColumn("cluster", F.monotonically_increasing_id())
    assert evaluate.purity(own).first()[0] == 1.0


def test_nmf_error_falls_and_factors_stay_positive(spark):
    rng = np.random.default_rng(3)
    v = rng.random((12, 2)) @ rng.random((2, 9))
    v[3, 4] = v[5, 1] = 0.0
    entries = spark.createDataFrame(
        [(i, j, float(v[i, j])) for i in range(12) for j in range(9) if v[i, j] > 0], "row BIGINT, col BIGINT, value DOUBLE"
    )
    f = nmf.factorize(entries, 3, max_rounds=6)
    assert all(b <= a + 1e-9 for a, b in zip(f.errors, f.errors[1:]))
    w = np.array([[r.w0, r.w1, r.w2] for r in f.w.orderBy("row").collect()])
    h = np.array([[r.w0, r.w1, r.w2] for r in f.h.orderBy("col").collect()])
    assert (w >= 0).all() and (h >= 0).all()
    assert f.errors[-1] == pytest.approx(0.5 * ((v - w @ h.T) ** 2).sum())


def test_pca_axes_are_ordered_by_variance(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(80, 4)) * [5, 3, 1, 0.5]
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], "id INT, features ARRAY<DOUBLE>")
    projected = cluster.component_rows(cluster.pca_project(cluster.as_vectors(df), 3))
    spread = [r.v for r in projected.groupBy("component").agg(F.var_samp("value").alias("v")).orderBy("component").collect()]
    assert spread == sorted(spread, reverse=True)


def sgd_rows(spark, n=40):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        y = i % 2
        rows += [(1, i, y, j, float(rng.random() + (y if j == 0 else 0))) for j in range(4) if (i + j) % 3]
    return rows, spark.createDataFrame(rows, "model_id INT, id BIGINT, y INT, idx BIGINT, value DOUBLE")


def plain_sgd(rows, eta, mu, width=4):
    w = np.zeros(width)
    for i in sorted({r[1] for r in rows}):
        mine = [r for r in rows if r[1] == i]
        at, x, y = [r[3] for r in mine], np.array([r[4] for r in mine]), mine[0][2]
        p = 1 / (1 + np.exp(-w[at] @ x))
        w *= 1 - 2 * eta * mu
        w[at] += eta * (y - p) * x
    return w


@pytest.mark.parametrize("mu", [0.0, 0.02])
def test_one_shard_is_the_sequential_pass(spark, mu):
    rows, df = sgd_rows(spark)
    got = {r.idx: r.weight for r in sgd.train_grouped(df, 0.1, mu).collect()}
    assert [got[j] for j in range(4)] == pytest.approx(list(plain_sgd(rows, 0.1, mu)))


def test_shards_bound_the_group_and_still_learn(spark):
    rows, df = sgd_rows(spark, 200)
    weights = sgd.train_grouped(df, 0.1, 0.0, shards=8)
    long = df.select("id", "y", "idx", "value")
    scored = sgd.mean_probability(long, weights).join(long.select("id", "y").distinct(), "id").select(
        F.lit("m").alias("model"), "y", F.col("probability").alias("score")
    )
    assert evaluate.roc_auc(scored, ["model"]).first()["auc"] > 0.7


def test_batch_step_matches_numpy(spark):
    rows, df = sgd_rows(spark)
    start = spark.createDataFrame([(1, j, 0.1 * j) for j in range(4)], "model_id INT, idx BIGINT, weight DOUBLE")
    got = {r.idx: r.weight for r in sgd.batch_step(df, start, 0.5, 0.01).collect()}
    x, y, w = np.zeros((40, 4)), np.zeros(40), 0.1 * np.arange(4)
    for _, i, label, j, v in rows:
        x[i, j], y[i] = v, label
    want = w + 0.5 * (x.T @ (y - 1 / (1 + np.exp(-x @ w))) / 40 - 2 * 0.01 * w)
    assert [got[j] for j in range(4)] == pytest.approx(list(want))


def test_streamed_centres_follow_the_update_rule(spark):
    """Files one by one give the same centres as the rule applied to the batches in turn."""
    rng = np.random.default_rng(2)
    path = work_path(spark, "points")
    batches = [rng.normal(size=(20, 3)) for _ in range(3)]
    for b, data in enumerate(batches):
        rows = [(b * 100 + i, [float(v) for v in row]) for i, row in enumerate(data)]
        spark.createDataFrame(rows, "id BIGINT, features ARRAY<DOUBLE>").coalesce(1).write.mode("append").parquet(path)
    points = spark.readStream.schema("id BIGINT, features ARRAY<DOUBLE>").option("maxFilesPerTrigger", 1).parquet(path)
    last = stream.run(points, stream.start_centers(2, 3), decay=0.5)
    got = [(list(r.center), r.weight) for r in stream.centers_table(spark, last).orderBy("cluster").collect()]
    centers = [(np.array(c), n) for c, n in stream.start_centers(2, 3)]
    for data in batches:
        nearest = np.argmin([((data - c) ** 2).sum(axis=1) for c, _ in centers], axis=0)
        moved = []
        for k, (c, n) in enumerate(centers):
            mine = data[nearest == k]
            n = n * 0.5
            total = n + len(mine)
            moved.append(((c * n + mine.sum(axis=0)) / total if len(mine) else c, total))
        centers = moved
    for (c, n), (want_c, want_n) in zip(got, centers):
        assert n == pytest.approx(want_n) and c == pytest.approx(list(want_c))


def test_spread_lookup_is_a_plain_join(spark):
    rows = spark.createDataFrame([(1, i % 3) for i in range(50)] + [(2, 0), (3, 1)], "k INT, v INT")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, name STRING")
    for how in ("inner", "left"):
        got = relational.spread_lookup(rows, dim, "k", how)
        assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(dim, "k", how).collect()))


def test_hot_lookup_key_gets_its_own_shuffle(spark):
    """Without broadcasting, both join inputs are fresh exchanges the runtime can split."""
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = relational.with_group_max(rows, "k", "id", "top")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(k") >= 2 and "_slot" in plan
        assert joined.filter("k = 0").select("top").distinct().collect()[0].top == 1998
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["nmf", "phenotype_clustering"])
def test_registered_factorisations_run_to_the_end(spark, monkeypatch, name):
    """With the operator's own rounds and tolerance."""
    seen = []

    class Reached(Exception):
        pass

    def factorize(entries, k, *args, **kwargs):
        seen.append((k, args, kwargs))
        raise Reached

    monkeypatch.setattr(nmf, "factorize", factorize)
    with pytest.raises(Reached):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen == [(3, (), {})]


def test_plan_of_a_stream_step_does_not_grow_with_the_centers(spark, tmp_path):
    lengths = []
    for k, width in ((2, 3), (40, 300)):
        path = str(tmp_path / f"{k}")
        stream._table(spark, stream.start_centers(k, width)).write.parquet(path)
        points = spark.createDataFrame([(1, [0.5] * width)], "id BIGINT, features ARRAY<DOUBLE>")
        step = stream.updated(points, spark.read.parquet(path), 1.0)
        lengths.append(len(step._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(lengths[1] - lengths[0]) < 200


def test_rounds_of_a_factorisation_share_jobs(spark):
    """The updates of dense arrays, whether a job's rounds end before the tolerance or behind it; a cell without a value, a negative number."""
    from cohortloom.session import noted_paths

    rng = np.random.default_rng(8)
    v = np.round(rng.random((11, 7)), 3) * (rng.random((11, 7)) < 0.7)
    v[:, 0] = 0.5
    cells = [(i - 3, j, float(v[i, j])) for i in range(11) for j in range(7) if v[i, j]] + [(9, 2, None)]
    entries = spark.createDataFrame(cells, "row BIGINT, col INT, value DOUBLE")
    v = np.vstack((v, np.zeros((2, 7))))
    rows = np.array([*range(-3, 8), 9])
    v = v[:12]
    start = lambda keys: np.array([[(np.fmod(x * 7 + i * 13, 17) + 1) / 17 for i in range(2)] for x in keys])
    w, h = start(rows), start(range(7))
    errors = [0.5 * ((v - w @ h.T) ** 2).sum()]
    while len(errors) < 100:
        w = w * (v @ h / (w @ (h.T @ h) + 2e-15))
        h = h * (v.T @ w / (h @ (w.T @ w) + 1e-10))
        errors.append(0.5 * ((v - w @ h.T) ** 2).sum())
        if abs(errors[-1] - errors[-2]) <= 1e-2:
            break
    assert 3 < len(errors) < 30
    for per_job in (2, 40):
        with noted_paths() as paths:
            f = nmf.factorize(entries, 2, tolerance=1e-2, rounds_per_job=per_job)
        assert f.errors == pytest.approx(errors)
        assert [tuple(r) for r in f.w.select("row", "w0", "w1").orderBy("row").collect()] == [pytest.approx((r, *x)) for r, x in zip(rows, w)]
        assert [tuple(r) for r in f.h.select("col", "w0", "w1").orderBy("col").collect()] == [pytest.approx((r, *x)) for r, x in enumerate(h)]
    assert len(paths) < 8
    assert f.h.schema["col"].dataType.simpleString() == "int"
