"""Matrix, factorisation, clustering and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import cluster, matrix, nmf, pic, projection, similarity
from cohortloom.operators.evaluate import purity
from cohortloom.plans.clinical import _LABELS_SQL, clinical_tuples, phenotype_labels
from cohortloom.plans.graph import _STAY_SETS, THRESHOLD, items, stay_items
from cohortloom.plans.registry import query
from cohortloom.plans.views import unit, with_views
from cohortloom.session import cut, work_path
from cohortloom.sources import adapters as src
from cohortloom.streaming import kmeans as stream

K = 3


def _w_sql(key: str, source: str, name: str) -> str:
    cols = ", ".join(f"(({key} * 7 + {i * 13}) % 17 + 1) / 17.0::DOUBLE AS w{i}" for i in range(K))
    return f"{name} AS (SELECT {key}, {cols} FROM (SELECT DISTINCT {key} FROM {source}))"


_W0 = _w_sql("row", "matrix_entries", "w0t")
_H0 = _w_sql("col", "matrix_entries", "h0t")


def _gram_sql(factor: str, name: str) -> str:
    sums = ", ".join(f"sum(w{i} * w{j}) AS g{i}{j}" for i in range(K) for j in range(K))
    return f"{name} AS (SELECT {sums} FROM {factor})"


def _update_sql(name: str, key: str, other_key: str, factor: str, other: str, guard: float) -> str:
    tops = ", ".join(f"sum(v.value * o.w{i}) AS n{i}" for i in range(K))
    cols = ", ".join(
        f"f.w{i} * (t.n{i} / (" + " + ".join(f"f.w{j} * g.g{j}{i}" for j in range(K)) + f" + {guard})) AS w{i}"
        for i in range(K)
    )
    return f"""{_gram_sql(other, name + '_g')},
        {name} AS (SELECT f.{key}, {cols} FROM {factor} f JOIN (
          SELECT v.{key}, {tops} FROM matrix_entries v JOIN {other} o ON o.{other_key} = v.{other_key} GROUP BY v.{key}) t
          ON t.{key} = f.{key}, {name}_g g)"""


_W1 = _update_sql("w1t", "row", "col", "w0t", "h0t", 2e-15)
_H1 = _update_sql("h1t", "col", "row", "h0t", "w1t", 1e-10)
_ROUNDED = ", ".join(f"round(w{i}, 9) AS w{i}" for i in range(K))


def _entries(spark, d):
    return src.matrix_entries(spark, d)


def _rounded(df, key):
    return df.select(key, *[F.round(c, 9).alias(c) for c in matrix.factor_columns(K)])


def _start(entries):
    return (
        matrix.start_factor(entries.select("row").distinct(), "row", K),
        matrix.start_factor(entries.select("col").distinct(), "col", K),
    )


def _long(factor, key):
    """(row, col, value) of a factor."""
    cells = F.array(*matrix.factor_columns(K))
    return factor.select(F.col(key).alias("row"), F.posexplode(cells).alias("col", "value"))


_LONG_W = "lw AS (" + " UNION ALL ".join(f"SELECT row, {i} AS col, w{i} AS value FROM w0t" for i in range(K)) + ")"
_LONG_H = "lh AS (" + " UNION ALL ".join(f"SELECT col, {i} AS j, w{i} AS b FROM h0t" for i in range(K)) + ")"


@query("mat_mul_small", with_views("matrix_entries", """
    SELECT v.row, h.j, round(sum(v.value * h.b), 9) AS value FROM matrix_entries v JOIN lh h ON h.col = v.col GROUP BY 1, 2""",
    f"{_H0}, {_LONG_H}"))
def mat_mul_small(spark, d):
    entries = _entries(spark, d)
    small = _long(_start(entries)[1], "col").select(F.col("row").alias("col"), F.col("col").alias("j"), F.col("value").alias("b"))
    return matrix.times_small(entries, small).withColumn("value", F.round("value", 9))


@query("mat_gram", with_views("matrix_entries", """
    SELECT w.col AS i, v.col AS j, round(sum(w.value * v.value), 7) AS value
    FROM lw w JOIN matrix_entries v ON v.row = w.row GROUP BY 1, 2""", f"{_W0}, {_LONG_W}"))
def mat_gram(spark, d):
    entries = _entries(spark, d)
    return matrix.gram(_long(_start(entries)[0], "row"), entries).withColumn("value", F.round("value", 7))


@query("mat_elementwise", with_views("matrix_entries", """
    SELECT v.row, v.col, round(v.value * (v.row % 5) , 9) AS product, round(v.value / ((v.row % 5) + 2e-15), 3) AS quotient
    FROM matrix_entries v"""))
def mat_elementwise(spark, d):
    entries = _entries(spark, d)
    other = entries.select("row", "col", (F.col("row") % 5).cast("double").alias("value"))
    product = matrix.elementwise(entries, other, "product").withColumnRenamed("value", "product")
    quotient = matrix.elementwise(entries, other, "quotient").withColumnRenamed("value", "quotient")
    return product.join(quotient, ["row", "col"]).select(
        "row", "col", F.round("product", 9).alias("product"), F.round("quotient", 3).alias("quotient")
    )


@query("nmf_update_w", with_views("matrix_entries", f"SELECT row, {_ROUNDED} FROM w1t", f"{_W0}, {_H0}, {_W1}"))
def nmf_update_w(spark, d):
    entries = _entries(spark, d)
    w, h = _start(entries)
    return _rounded(nmf.update_factor(entries, w, h, "row", "col", matrix.factor_gram(h, K), matrix.GUARD), "row")


@query("nmf_update_h", with_views("matrix_entries", f"SELECT col, {_ROUNDED} FROM h1t", f"{_W0}, {_H0}, {_W1}, {_H1}"))
def nmf_update_h(spark, d):
    """H from the new W."""
    entries = _entries(spark, d)
    w, h = _start(entries)
    w = cut(nmf.update_factor(entries, w, h, "row", "col", matrix.factor_gram(h, K), matrix.GUARD))
    return _rounded(nmf.update_factor(entries, h, w, "col", "row", matrix.factor_gram(w, K), 1e-10), "col")


_WH = " + ".join(f"w.w{i} * h.w{i}" for i in range(K))


@query("nmf_error", with_views("matrix_entries", f"""
    SELECT round(0.5 * sum((v.value - ({_WH})) * (v.value - ({_WH}))), 6) AS error
    FROM matrix_entries v JOIN w1t w ON w.row = v.row JOIN h1t h ON h.col = v.col""", f"{_W0}, {_H0}, {_W1}, {_H1}"))
def nmf_error(spark, d):
    entries = _entries(spark, d)
    factors = nmf.factorize(entries, K, max_rounds=1)
    return spark.range(1).select(F.round(F.lit(factors.errors[-1]), 6).alias("error"))


@query("nmf_assign", with_views("matrix_entries", """
    SELECT row, CASE WHEN w0 >= w1 AND w0 >= w2 THEN 0 WHEN w1 >= w2 THEN 1 ELSE 2 END AS cluster FROM w1t""",
                                f"{_W0}, {_H0}, {_W1}"))
def nmf_assign(spark, d):
    return nmf.assign(nmf.factorize(_entries(spark, d), K, max_rounds=1).w, K)


@query("nmf")
def nmf_rounds(spark, d):
    """(round, error) of a factorisation."""
    factors = nmf.factorize(_entries(spark, d), K)
    return spark.createDataFrame(list(enumerate(factors.errors)), "round INT, error DOUBLE")


@query("standard_scale", with_views("signed_entries", """
    SELECT row, col, round((value - avg(value) OVER (PARTITION BY col)) / stddev_samp(value) OVER (PARTITION BY col), 5)
      + 0.0 AS value FROM signed_entries"""))
def standard_scale(spark, d):
    entries = src.vectors(spark, d).select(F.col("id").alias("row"), F.posexplode("features").alias("col", "value"))
    return matrix.standard_scale(entries).withColumn("value", F.round("value", 5) + 0.0)


#: Columns of the projection's block. Data no wider than this are projected exactly after one round.
BLOCK = 64


def _vector_entries(spark, d):
    return src.vectors(spark, d).select(F.col("id").alias("row"), F.posexplode("features").alias("col", "value"))


def _projected(spark, d):
    """The narrow, dense embeddings on Spark ML's components, with their class."""
    rows = cluster.as_vectors(src.vectors(spark, d))
    return cluster.pca_project(cluster.scale(rows), 10)


@query("pca_project")
def pca_project(spark, d):
    scores = projection.project(_vector_entries(spark, d), 10, BLOCK).scores
    return scores.select(F.col("row").alias("id"), F.posexplode("score").alias("component", "value"))


@query("pca_row_norms", with_views("signed_entries", """
    SELECT row, round(sum(z * z), 6) AS norm FROM (
      SELECT row, (value - avg(value) OVER (PARTITION BY col)) / stddev_samp(value) OVER (PARTITION BY col) AS z FROM signed_entries)
    GROUP BY row"""))
def pca_row_norms(spark, d):
    """On all components together the rows keep their lengths, and so the total variance."""
    scores = projection.project(_vector_entries(spark, d), BLOCK, BLOCK).scores
    return scores.select("row", F.round(F.aggregate("score", F.lit(0.0), lambda n, x: n + x * x), 6).alias("norm"))


@query("pca_orthonormality", """
    SELECT i::INTEGER AS i, j::INTEGER AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS product,
           CASE WHEN i = j THEN NULL ELSE 0.0::DOUBLE END AS covariance
    FROM range(10) a(i), range(10) b(j) WHERE i <= j AND (SELECT count(*) FROM embeddings) > 0""")
def pca_orthonormality(spark, d):
    """Products of the ten leading components with each other, and the covariance of different components' scores."""
    found = projection.project(_vector_entries(spark, d), 10, BLOCK)
    pair = [F.col(c).alias(c) for c in ("i", "j")]

    def products(rows, column, name):
        cells = F.flatten(F.transform(column, lambda x, i: F.transform(F.slice(column, i + 1, F.lit(10)), lambda y, j: F.struct(i.alias("i"), (i + j).alias("j"), (x * y).alias("p")))))
        return rows.select(F.inline(cells)).groupBy("i", "j").agg((F.round(F.sum("p"), 6) + 0.0).alias(name))

    parts = products(found.components, F.col("part"), "product")
    scores = products(found.scores, F.col("score"), "covariance").withColumn("covariance", F.when(F.col("i") != F.col("j"), F.col("covariance")))
    return parts.join(scores, ["i", "j"]).select(*pair, "product", "covariance")


@query("kmeans")
def kmeans(spark, d):
    return cluster.kmeans(_projected(spark, d)).select("id", "class", "cluster")


@query("gmm")
def gmm(spark, d):
    return cluster.gmm(_projected(spark, d)).select("id", "class", "cluster")


def _centers_sql() -> str:
    rows = ", ".join(f"({c}, {i}, {v})" for c, (center, _) in enumerate(stream.start_centers(K, 64)) for i, v in enumerate(center))
    return f"""centers AS (SELECT cluster, col, c::DOUBLE AS c FROM (VALUES {rows}) v(cluster, col, c)),
    dist AS (SELECT e.row, c.cluster, sum((e.value - c.c) * (e.value - c.c)) AS dist FROM signed_entries e
             JOIN centers c ON c.col = e.col GROUP BY 1, 2),
    assigned AS (SELECT row, cluster FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY dist, cluster) AS k
                 FROM dist) WHERE k = 1),
    moved AS (SELECT a.cluster, e.col, avg(e.value) AS c, count(*) AS weight FROM assigned a
              JOIN signed_entries e ON e.row = a.row GROUP BY 1, 2)"""


@query("kmeans_step", with_views("signed_entries", """
    SELECT CAST(cluster AS INTEGER) AS cluster, CAST(col AS INTEGER) AS col, round(c, 8) + 0.0 AS center FROM moved""",
                                 _centers_sql()))
def kmeans_step(spark, d):
    """One assignment and centre update from fixed starting centres."""
    points = src.vectors(spark, d)
    assigned = cluster.nearest_center(points, [c for c, _ in stream.start_centers(K, 64)])
    moved = cluster.cluster_sums(assigned, 64)
    return moved.select("cluster", "m", F.posexplode("sums").alias("col", "total")).select(
        "cluster", "col", (F.round(F.col("total") / F.col("m"), 8) + 0.0).alias("center")
    )


@query("stream_kmeans", with_views("signed_entries", """
    SELECT CAST(c.cluster AS INTEGER) AS cluster, CAST(c.col AS INTEGER) AS col,
           coalesce(m.weight, 0)::DOUBLE AS weight, round(coalesce(m.c, c.c), 8) + 0.0 AS center
    FROM centers c LEFT JOIN moved m ON m.cluster = c.cluster AND m.col = c.col""", _centers_sql()))
def stream_kmeans(spark, d):
    """The embeddings as one micro-batch of a file stream."""
    schema = src.table(spark, d, "embeddings").schema
    points = spark.readStream.schema(schema).option("pathGlobFilter", "embeddings.parquet").parquet(d).select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features")
    )
    path = stream.run(points, stream.start_centers(K, 64))
    return stream.centers_table(spark, path).select(
        "cluster", "weight", F.posexplode("center").alias("col", "c")
    ).select("cluster", "col", "weight", (F.round("c", 8) + 0.0).alias("center"))


@query("stream_kmeans_batches", """
    SELECT CAST(k - 1 AS INTEGER) AS col, count(*) AS n_points, round(sum(CAST(embedding[k] AS DOUBLE)), 5) + 0.0 AS total
    FROM embeddings, range(1, 65) t(k) GROUP BY k""")
def stream_kmeans_batches(spark, d):
    """Eight files, one per micro-batch. Without decay the centres times their weights add up to the points, position by position."""
    path = work_path(spark, "batches")
    src.vectors(spark, d).select("id", "features").repartition(8, "id").write.parquet(path)
    points = (
        spark.readStream.schema("id BIGINT, features ARRAY<DOUBLE>").option("maxFilesPerTrigger", 1).parquet(path)
    )
    last = stream.run(points, stream.start_centers(K, 64))
    entries = stream.centers_table(spark, last).select("weight", F.posexplode("center").alias("col", "c"))
    total = F.round(F.sum(F.col("weight") * F.col("c")), 5) + 0.0
    return entries.groupBy("col").agg(F.sum("weight").cast("bigint").alias("n_points"), total.alias("total"))


@query("cluster_label_join", "WITH labels_q AS (" + _LABELS_SQL + """)
    SELECT o.o_custkey % 3 AS cluster, l.label AS class, count(*) AS n FROM
      (SELECT DISTINCT o_custkey FROM orders) o JOIN labels_q l ON l.patient_id = o.o_custkey GROUP BY 1, 2""")
def cluster_label_join(spark, d):
    assigned = src.table(spark, d, "orders").select(F.col("o_custkey").alias("patient_id")).distinct().withColumn(
        "cluster", F.col("patient_id") % 3
    )
    labelled = assigned.join(phenotype_labels(spark, d), "patient_id").withColumnRenamed("label", "class")
    return labelled.groupBy("cluster", "class").agg(F.count("*").alias("n"))


@query("phenotype_clustering")
def phenotype_clustering(spark, d):
    """(method, purity): clinical features -> scale -> PCA -> k-means, mixture, factorisation; against the phenotype."""
    from cohortloom.operators import features as feat

    tuples = cut(feat.construct(clinical_tuples(spark, d)))
    labels = phenotype_labels(spark, d).withColumnRenamed("label", "class")
    entries = tuples.select(F.col("patient_id").alias("row"), F.col("idx").alias("col"), "value")
    scores = projection.project(entries, 10, BLOCK).scores
    projected = cut(cluster.as_vectors(scores.select(F.col("row").alias("id"), F.col("score").alias("features"))))
    parts = [
        cluster.kmeans(projected).select(F.lit("kmeans").alias("method"), F.col("id").alias("patient_id"), "cluster"),
        cluster.gmm(projected).select(F.lit("gmm").alias("method"), F.col("id").alias("patient_id"), "cluster"),
    ]
    factors = nmf.factorize(entries, K)
    parts.append(
        nmf.assign(factors.w, K).select(F.lit("nmf").alias("method"), F.col("row").alias("patient_id"), "cluster")
    )
    assigned = parts[0].unionByName(parts[1]).unionByName(parts[2]).join(labels, "patient_id")
    return purity(assigned, ["method"])


def _similarity_graph(items, threshold):
    """(pairs of distinct sets, members): the whole graph, copies as multiplicities."""
    sets, members = similarity.distinct_sets(items)
    sets, members = cut(sets), cut(members)
    pairs = similarity.similar_sets(sets, threshold)
    weighted = cut(pairs.select(F.col("s1").alias("src"), F.col("s2").alias("dst"), F.col("similarity").alias("weight")))
    return weighted, members.select(F.col("patient_id").alias("id"), "set_id")


@query("pic")
def pic_clusters(spark, d):
    """(id, cluster) of stays by power iteration over their similarities."""
    weighted, members = _similarity_graph(cut(stay_items(spark, d)), THRESHOLD)
    return pic.assign_clusters(weighted, k=3, rounds=100, members=members)


@query("pic_patients")
def pic_patients(spark, d):
    """(id, cluster) of the graph's patients by the diagnoses, medications and labs they share."""
    sets, members = similarity.distinct_sets(cut(items(spark, d)))
    sets, members = cut(sets), cut(members).select(F.col("patient_id").alias("id"), "set_id")
    # Nearly all pairs reach this threshold: they are compared in each round, not kept.
    return pic.assign_set_clusters(sets, members, 0.05, k=3, rounds=100)


def _pic_rounds_sql(rounds: int) -> str:
    u = unit("CAST(vid AS VARCHAR)")
    steps = [f"v0 AS (SELECT vid, {u} AS x FROM (SELECT DISTINCT src AS vid FROM both_ways))"]
    for i in range(1, rounds + 1):
        steps.append(f"""v{i} AS (SELECT b.src AS vid, sum(b.weight / t.total * v.x) AS x FROM both_ways b
            JOIN totals t ON t.src = b.src JOIN v{i - 1} v ON v.vid = b.dst GROUP BY b.src)""")
    return ", ".join(steps)


@query("pic_embedding", _STAY_SETS + f""",
    both_ways AS (SELECT m.patient_id AS src, n.patient_id AS dst, similarity AS weight FROM (
        SELECT a.patient_id AS p1, b.patient_id AS p2, count(*) / (min(a.n) + min(b.n) - count(*))::DOUBLE AS similarity
        FROM sets a JOIN sets b ON a.item = b.item GROUP BY 1, 2) s
      JOIN reps m ON m.rep = p1 JOIN reps n ON n.rep = p2 WHERE similarity >= {THRESHOLD} AND m.patient_id <> n.patient_id),
    totals AS (SELECT src, sum(weight) AS total FROM both_ways GROUP BY src), {_pic_rounds_sql(3)}
    SELECT vid AS id, round(x / (SELECT sum(x) FROM v3), 12) AS x FROM v3""")
def pic_embedding(spark, d):
    """Three rounds of the power iteration, against all pairs of stays, copies included."""
    weighted, members = _similarity_graph(cut(stay_items(spark, d)), THRESHOLD)
    return pic.embed(weighted, rounds=3, members=members).withColumn("x", F.round("x", 12))
