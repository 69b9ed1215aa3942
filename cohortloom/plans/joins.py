"""Join, aggregate, window, sort, set and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import codes
from cohortloom.functions.ordered import dense_index, exact_quantile, running_count
from cohortloom.operators import cohort, etl
from cohortloom.operators import relational as R
from cohortloom.plans.registry import query
from cohortloom.plans.views import in_list, unit, with_views
from cohortloom.session import cut
from cohortloom.sources import adapters as src


def _events(spark, d):
    return src.clinical_events(spark, d)


def _deaths(spark, d):
    return src.mortality(spark, d)


# --- joins ---


@query("join_inner", with_views("clinical_events mortality", """
    SELECT e.patient_id, e.event_id, e.event_time, m.death_time FROM clinical_events e
    JOIN mortality m ON e.patient_id = m.patient_id"""))
def join_inner(spark, d):
    return _events(spark, d).join(_deaths(spark, d), "patient_id").select(
        "patient_id", "event_id", "event_time", "death_time"
    )


_NOT_DEAD = """SELECT e.patient_id, e.event_id FROM clinical_events e
    LEFT OUTER JOIN mortality m ON e.patient_id = m.patient_id WHERE m.patient_id IS NULL"""


@query("join_anti_outer", with_views("clinical_events mortality", _NOT_DEAD))
def join_anti_outer(spark, d):
    alive, _ = cohort.split_cohort(_events(spark, d), _deaths(spark, d))
    return alive.select("patient_id", "event_id")


@query("join_semi", with_views("clinical_events mortality", """
    SELECT patient_id, event_id, value FROM clinical_events WHERE patient_id IN (SELECT patient_id FROM mortality)"""))
def join_semi(spark, d):
    rows = _events(spark, d).select("patient_id", "event_id", "value")
    return rows.join(_deaths(spark, d), "patient_id", "left_semi")


@query("join_anti", with_views("clinical_events mortality", """
    SELECT patient_id, event_id, value FROM clinical_events
    WHERE patient_id NOT IN (SELECT patient_id FROM mortality)"""))
def join_anti(spark, d):
    rows = _events(spark, d).select("patient_id", "event_id", "value")
    return rows.join(_deaths(spark, d), "patient_id", "left_anti")


@query("join_semi_collected", with_views("diagnostic medication", f"""
    SELECT DISTINCT patient_id, CASE WHEN patient_id IN (SELECT patient_id FROM medication
             WHERE lower(medicine) IN ({in_list(codes.T1DM_MED)})) THEN 1 ELSE 0 END AS on_t1_med
    FROM diagnostic WHERE code IN ({in_list(codes.T2DM_DX)})"""))
def join_semi_collected(spark, d):
    """Membership in an id set, both ways, without bringing the set to the driver."""
    patients = src.diagnostic(spark, d).filter(F.col("code").isin(codes.T2DM_DX)).select("patient_id").distinct()
    treated = src.medication(spark, d).filter(F.lower("medicine").isin(codes.T1DM_MED)).select("patient_id").distinct()
    inside = patients.join(treated, "patient_id", "left_semi").withColumn("on_t1_med", F.lit(1))
    outside = patients.join(treated, "patient_id", "left_anti").withColumn("on_t1_med", F.lit(0))
    return inside.unionByName(outside)


_SHIFTED = "SELECT patient_id + 400 AS patient_id, death_time FROM mortality"


@query("join_full_outer", with_views("clinical_events mortality", f"""
    SELECT coalesce(e.patient_id, m.patient_id) AS patient_id, e.event_id, e.event_time, m.death_time
    FROM clinical_events e FULL OUTER JOIN ({_SHIFTED}) m ON e.patient_id = m.patient_id"""))
def join_full_outer(spark, d):
    # Shifted ids leave unmatched rows on both sides.
    deaths = _deaths(spark, d).select((F.col("patient_id") + 400).alias("patient_id"), "death_time")
    events = _events(spark, d).select("patient_id", "event_id", "event_time")
    return R.full_outer(events, deaths, ["patient_id"])


@query("join_outer_pandas", """
    SELECT coalesce(a.stay, b.stay) AS stay, a.icustay_id, b.prediction FROM
      (SELECT concat(o_orderkey, '_ts') AS stay, o_orderkey AS icustay_id FROM orders WHERE o_orderstatus <> 'P') a
      FULL OUTER JOIN
      (SELECT concat(o_orderkey, '_ts') AS stay, o_totalprice / 1000000.0 AS prediction FROM orders
       WHERE o_orderstatus <> 'F') b ON a.stay = b.stay""")
def join_outer_pandas(spark, d):
    orders = src.table(spark, d, "orders")
    stay = F.concat(F.col("o_orderkey").cast("string"), F.lit("_ts")).alias("stay")
    left = orders.filter(F.col("o_orderstatus") != "P").select(stay, F.col("o_orderkey").alias("icustay_id"))
    right = orders.filter(F.col("o_orderstatus") != "F").select(
        stay, (F.col("o_totalprice") / 1000000.0).alias("prediction")
    )
    return R.full_outer(left, right, ["stay"])


@query("join_self_agg", with_views("clinical_events", """
    SELECT patient_id, event_id, event_time, max(event_time) OVER (PARTITION BY patient_id) AS last_event
    FROM clinical_events"""))
def join_self_agg(spark, d):
    rows = _events(spark, d).select("patient_id", "event_id", "event_time")
    return R.with_group_max(rows, "patient_id", "event_time", "last_event")


@query("join_pair_rdd", with_views("medication", f"""
    SELECT a.patient_id, a.d AS first_t1, b.d AS first_t2 FROM
      (SELECT patient_id, min(date) AS d FROM medication
       WHERE lower(medicine) IN ({in_list(codes.T1DM_MED)}) GROUP BY 1) a
    JOIN (SELECT patient_id, min(date) AS d FROM medication
       WHERE lower(medicine) IN ({in_list(codes.T2DM_MED)}) GROUP BY 1) b ON a.patient_id = b.patient_id"""))
def join_pair_rdd(spark, d):
    def first(listed, name):
        rows = src.medication(spark, d).filter(F.lower("medicine").isin(listed))
        return rows.groupBy("patient_id").agg(F.min("date").alias(name))

    return first(codes.T1DM_MED, "first_t1").join(first(codes.T2DM_MED, "first_t2"), "patient_id")


@query("join_zip_position", """
    SELECT e.vec_id AS id, e.label AS class, round(list_sum(list_transform(e.embedding, lambda x: x::DOUBLE)), 6) AS total
    FROM embeddings e""")
def join_zip_position(spark, d):
    """Two row-aligned frames are paired by the key each row keeps, never by position."""
    rows = src.vectors(spark, d)
    totals = rows.select("id", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))
    return rows.select("id", "class").join(totals, "id")


@query("join_broadcast_map", with_views("clinical_events", """
    SELECT e.patient_id, m.idx FROM clinical_events e JOIN
      (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx
       FROM (SELECT DISTINCT event_id FROM clinical_events)) m ON e.event_id = m.event_id"""))
def join_broadcast_map(spark, d):
    """Name -> index lookup. The planner broadcasts the map when its measured size allows."""
    events = _events(spark, d).select("patient_id", "event_id")
    return events.join(etl.feature_index(events), "event_id").select("patient_id", "idx")


@query("join_outer_vertices", """
    SELECT c.c_custkey AS vertex, coalesce(o.n, 0) AS out_degree FROM customer c LEFT JOIN
      (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) o
      ON o.o_custkey = c.c_custkey""")
def join_outer_vertices(spark, d):
    degree = (
        src.table(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
        .groupBy(F.col("o_custkey").alias("vertex")).agg(F.count("*").alias("n"))
    )
    vertices = src.table(spark, d, "customer").select(F.col("c_custkey").alias("vertex"))
    return vertices.join(degree, "vertex", "left").select("vertex", F.coalesce("n", F.lit(0)).alias("out_degree"))


# --- aggregates ---


@query("agg_group_count", with_views("clinical_events", """
    SELECT patient_id, event_id, count(*) AS n_events FROM clinical_events GROUP BY 1, 2"""))
def agg_group_count(spark, d):
    return _events(spark, d).groupBy("patient_id", "event_id").agg(F.count("*").alias("n_events"))


@query("agg_sum_count", with_views("clinical_events", """
    SELECT patient_id, event_id, sum(value) AS value_sum, count(value) AS value_count
    FROM clinical_events GROUP BY 1, 2"""))
def agg_sum_count(spark, d):
    return _events(spark, d).groupBy("patient_id", "event_id").agg(
        F.sum("value").alias("value_sum"), F.count("value").alias("value_count")
    )


@query("agg_count_distinct", with_views("clinical_events", """
    SELECT patient_id, count(DISTINCT event_time) AS n_encounters FROM clinical_events GROUP BY 1"""))
def agg_count_distinct(spark, d):
    return _events(spark, d).groupBy("patient_id").agg(F.count_distinct("event_time").alias("n_encounters"))


@query("agg_min_max_avg", with_views("clinical_events", """
    SELECT min(n) AS min_events, max(n) AS max_events, avg(n) AS avg_events
    FROM (SELECT patient_id, count(*) AS n FROM clinical_events GROUP BY 1)"""))
def agg_min_max_avg(spark, d):
    per_patient = _events(spark, d).groupBy("patient_id").agg(F.count("*").alias("n"))
    return per_patient.agg(
        F.min("n").alias("min_events"), F.max("n").alias("max_events"), F.avg("n").alias("avg_events")
    )


@query("agg_percentile_exact", with_views("clinical_events", """
    SELECT quantile_cont(n, 0.5) AS median_days FROM
      (SELECT date_diff('day', min(event_time), max(event_time)) AS n FROM clinical_events GROUP BY patient_id)"""))
def agg_percentile_exact(spark, d):
    days = F.date_diff(F.max("event_time"), F.min("event_time")).alias("days")
    lengths = _events(spark, d).groupBy("patient_id").agg(days).groupBy("days").agg(F.count("*").alias("n"))
    return lengths.agg(F.percentile("days", F.lit(0.5), F.col("n")).alias("median_days"))


@query("agg_percentile_exact_values", """
    SELECT CASE WHEN o.o_custkey % 4 = 0 THEN 'dead' ELSE 'alive' END AS cohort, l.l_returnflag AS flag,
           round(quantile_cont(CAST(l.l_extendedprice AS DOUBLE), 0.5), 4) AS median_price
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2""")
def agg_percentile_exact_values(spark, d):
    """The median of a continuous value by cohort and flag; no group is sorted or held whole."""
    dead = F.when(F.col("o_custkey") % 4 == 0, "dead").otherwise("alive").alias("cohort")
    orders = src.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), dead)
    prices = src.table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").cast("double").alias("price"))
    values = cut(prices.join(orders, "l_orderkey").select("cohort", "flag", "price"))  # read by every step of the first round
    found = exact_quantile(values, "price", 0.5, ["cohort", "flag"], "median_price")
    return found.select("cohort", "flag", F.round("median_price", 4).alias("median_price"))


@query("agg_multi_flatten", with_views("clinical_events", """
    SELECT event_id, min(value) AS value_min, max(value) AS value_max, min(event_time) AS event_time_min,
           max(event_time) AS event_time_max FROM clinical_events GROUP BY 1"""))
def agg_multi_flatten(spark, d):
    flat = [fn(c).alias(f"{c}_{fn.__name__}") for c in ("value", "event_time") for fn in (F.min, F.max)]
    return _events(spark, d).groupBy("event_id").agg(*flat)


@query("agg_avg_group", with_views("lab_result", """
    SELECT patient_id, lower(test_name) AS test_name, round(avg(value), 8) AS mean_value
    FROM lab_result GROUP BY 1, 2"""))
def agg_avg_group(spark, d):
    return src.lab_result(spark, d).groupBy("patient_id", F.lower("test_name").alias("test_name")).agg(
        F.round(F.avg("value"), 8).alias("mean_value")
    )


@query("agg_argmin_date", with_views("medication", """
    SELECT patient_id, date, medicine FROM (
      SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY date, medicine) AS k FROM medication)
    WHERE k = 1"""))
def agg_argmin_date(spark, d):
    first = F.min(F.struct("date", "medicine")).alias("first")
    return src.medication(spark, d).groupBy("patient_id").agg(first).select("patient_id", "first.date", "first.medicine")


@query("agg_argmax_latest", with_views("graph_events", """
    SELECT patient_id, kind, item, date, value FROM (
      SELECT *, row_number() OVER (PARTITION BY patient_id, kind, item ORDER BY date DESC, value DESC) AS k
      FROM graph_events) WHERE k = 1"""))
def agg_argmax_latest(spark, d):
    from cohortloom.operators.graph import latest_events

    return latest_events(src.graph_events(spark, d))


@query("agg_collect_list", with_views("feature_counts", """
    SELECT patient_id, string_agg(concat(event_id, '=', feature_value), ' ' ORDER BY event_id) AS pairs
    FROM feature_counts GROUP BY 1"""))
def agg_collect_list(spark, d):
    events = _events(spark, d)
    counts = etl.window_counts(events, etl.index_dates(events, _deaths(spark, d)))
    pairs = F.array_sort(F.collect_list(F.struct("event_id", "feature_value")))
    text = F.transform(pairs, lambda p: F.concat(p["event_id"], F.lit("="), p["feature_value"].cast("string")))
    return counts.groupBy("patient_id").agg(F.array_join(text, " ").alias("pairs"))


@query("agg_distinct", with_views("clinical_events", "SELECT DISTINCT patient_id, event_id FROM clinical_events"))
def agg_distinct(spark, d):
    return _events(spark, d).select("patient_id", "event_id").distinct()


@query("agg_sum_by_stay", with_views("stay_diagnosis", """
    SELECT stay_id, sum(flag)::BIGINT AS phenotype_score FROM stay_diagnosis GROUP BY 1"""))
def agg_sum_by_stay(spark, d):
    from cohortloom.operators.icu import phenotype_score

    return phenotype_score(src.stay_diagnosis(spark, d))


@query("agg_global_mean", with_views("clinical_events", """
    SELECT avg(date_diff('day', lo, hi)) AS mean_days FROM
      (SELECT min(event_time) AS lo, max(event_time) AS hi FROM clinical_events GROUP BY patient_id)"""))
def agg_global_mean(spark, d):
    spans = _events(spark, d).groupBy("patient_id").agg(
        F.min("event_time").alias("lo"), F.max("event_time").alias("hi")
    )
    return spans.agg(F.avg(F.date_diff("hi", "lo")).alias("mean_days"))


# --- windows and ordering ---


@query("win_cumulative_count", with_views("icu_stay", """
    SELECT stay_id, subject_id, count(*) OVER (PARTITION BY subject_id ORDER BY intime, stay_id
      ROWS UNBOUNDED PRECEDING) AS icu_cum FROM icu_stay"""))
def win_cumulative_count(spark, d):
    month = F.trunc("intime", "month")
    return running_count(src.icu_stay(spark, d), "subject_id", ["intime", "stay_id"], month, "icu_cum").select(
        "stay_id", "subject_id", "icu_cum"
    )


@query("win_rank_index", with_views("clinical_events", """
    SELECT event_id, rank() OVER (ORDER BY event_id) - 1 AS idx FROM (SELECT DISTINCT event_id FROM clinical_events)"""))
def win_rank_index(spark, d):
    return dense_index(_events(spark, d).select("event_id").distinct(), ["event_id"])


@query("win_zip_with_index", with_views("graph_events", """
    SELECT kind, item, row_number() OVER (PARTITION BY kind ORDER BY item) - 1
           + (SELECT count(DISTINCT item) FROM graph_events g WHERE g.kind < t.kind) AS idx
    FROM (SELECT DISTINCT kind, item FROM graph_events) t"""))
def win_zip_with_index(spark, d):
    """One numbering in (kind, item) order: each kind is contiguous and starts after the one before."""
    names = src.graph_events(spark, d).select("kind", "item").distinct()
    return dense_index(names, ["kind", "item"])


@query("win_group_max", with_views("features", """
    SELECT patient_id, idx, feature_value / CAST(max(feature_value) OVER (PARTITION BY idx) AS DOUBLE) AS value
    FROM features"""))
def win_group_max(spark, d):
    from cohortloom.plans.etl import features

    return features(spark, d)


@query("win_argmax_index", """
    SELECT vec_id AS id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS largest
    FROM embeddings""")
def win_argmax_index(spark, d):
    from cohortloom.functions.columns import argmax_index

    return src.vectors(spark, d).select("id", argmax_index("features").alias("largest"))


@query("sort_multi_key", with_views("clinical_events", """
    SELECT patient_id, event_id, event_time FROM clinical_events ORDER BY patient_id, event_id, event_time"""))
def sort_multi_key(spark, d):
    return _events(spark, d).select("patient_id", "event_id", "event_time").orderBy(
        "patient_id", "event_id", "event_time"
    )


@query("sort_nested", with_views("clinical_events", """
    SELECT patient_id, event_time, string_agg(event_id, ' ' ORDER BY event_id) AS events
    FROM (SELECT DISTINCT patient_id, event_time, event_id FROM clinical_events) GROUP BY 1, 2"""))
def sort_nested(spark, d):
    kinds = _events(spark, d).select("patient_id", "event_time", "event_id").distinct()
    return kinds.groupBy("patient_id", "event_time").agg(
        F.array_join(F.sort_array(F.collect_list("event_id")), " ").alias("events")
    )


@query("topk_taken_ordered", """
    SELECT o_orderkey AS id, o_totalprice AS score FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def topk_taken_ordered(spark, d):
    rows = src.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"))
    return rows.orderBy(F.desc("score"), "id").limit(10)


# --- set operations, samples, splits ---


@query("set_union_all", with_views("diagnostic medication", """
    SELECT patient_id, date, code AS name FROM diagnostic
    UNION ALL SELECT patient_id, date, medicine FROM medication"""))
def set_union_all(spark, d):
    dx = src.diagnostic(spark, d).withColumnRenamed("code", "name")
    return dx.unionByName(src.medication(spark, d).withColumnRenamed("medicine", "name"))


@query("set_subtract", with_views("diagnostic", f"""
    SELECT patient_id, code FROM diagnostic WHERE patient_id NOT IN
      (SELECT patient_id FROM diagnostic WHERE lower(code) IN ({in_list(codes.DM_RELATED_DX)}))"""))
def set_subtract(spark, d):
    dx = src.diagnostic(spark, d).select("patient_id", "code")
    related = dx.filter(F.lower("code").isin(codes.DM_RELATED_DX))
    return R.subtract(dx, related, "patient_id")


@query("set_overlap", """
    SELECT a.o_orderkey AS id,
           len(list_intersect(a.s, b.s)) AS n_common, len(list_distinct(list_concat(a.s, b.s))) AS n_union
    FROM (SELECT l_orderkey AS o_orderkey, list(DISTINCT l_partkey % 20) AS s FROM lineitem GROUP BY 1) a
    JOIN (SELECT l_orderkey AS o_orderkey, list(DISTINCT l_partkey % 20) AS s FROM lineitem GROUP BY 1) b
      ON b.o_orderkey = a.o_orderkey + 1""")
def set_overlap(spark, d):
    """Overlap of each order's item set with the next order's."""
    sets = src.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.collect_set(F.col("l_partkey") % 20).alias("s")
    )
    following = sets.select((F.col("id") - 1).alias("id"), F.col("s").alias("t"))
    return sets.join(following, "id").select(
        "id",
        F.size(F.array_intersect("s", "t")).cast("bigint").alias("n_common"),
        F.size(F.array_union("s", "t")).cast("bigint").alias("n_union"),
    )


_PATIENTS = "SELECT c_custkey AS patient_id FROM customer"


def _patients(spark, d):
    return src.graph_patient(spark, d)


@query("split_random", f"""
    SELECT patient_id, CASE WHEN {unit('CAST(patient_id AS VARCHAR)')} <= 0.20 THEN 'testing' ELSE 'training' END
      AS part FROM ({_PATIENTS})""")
def split_random(spark, d):
    return R.split_random(_patients(spark, d), "patient_id")


@query("sample_per_model", f"""
    SELECT patient_id, CAST(m AS INTEGER) AS model_id FROM ({_PATIENTS}), range(1, 6) r(m)
    WHERE {unit("concat(patient_id, '-', m)")} < 0.4""")
def sample_per_model(spark, d):
    return R.sample_per_model(_patients(spark, d), "patient_id", 5, 0.4)


@query("split_by_id_list", with_views("icu_stay", f"""
    SELECT i.stay_id, i.subject_id, i.care_unit, p.part FROM icu_stay i
    JOIN (SELECT patient_id, CASE WHEN {unit('CAST(patient_id AS VARCHAR)')} <= 0.20 THEN 'testing'
          ELSE 'training' END AS part FROM ({_PATIENTS})) p ON p.patient_id = i.subject_id"""))
def split_by_id_list(spark, d):
    ids = R.split_random(_patients(spark, d), "patient_id").withColumnRenamed("patient_id", "subject_id")
    stays = src.icu_stay(spark, d).select("stay_id", "subject_id", "care_unit")
    train = R.split_by_ids(stays, ids.filter(F.col("part") == "training"), "subject_id")
    test = R.split_by_ids(stays, ids.filter(F.col("part") == "testing"), "subject_id")
    return train.withColumn("part", F.lit("training")).unionByName(test.withColumn("part", F.lit("testing")))


@query("split_kfold", f"""
    SELECT patient_id, CAST(ntile(5) OVER (ORDER BY patient_id) - 1 AS INTEGER) AS fold FROM ({_PATIENTS})""")
def split_kfold(spark, d):
    return R.contiguous_folds(_patients(spark, d), "patient_id", 5)


@query("split_shuffle", f"""
    SELECT patient_id, CAST(i AS INTEGER) AS iteration,
           CASE WHEN {unit("concat(patient_id, '-', i)")} < 0.2 THEN 1 ELSE 0 END AS is_test
    FROM ({_PATIENTS}), range(1, 6) r(i)""")
def split_shuffle(spark, d):
    return R.shuffle_splits(_patients(spark, d), "patient_id", 5)
