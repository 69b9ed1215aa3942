"""Source and sink queries: write a view under the shared folder, read it back with the reader under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions.columns import table_name
from cohortloom.operators import etl
from cohortloom.plans.etl import features
from cohortloom.plans.registry import query
from cohortloom.plans.rows import _RAW, _raw_lab_text
from cohortloom.plans.views import with_views
from cohortloom.session import work_path
from cohortloom.sources import adapters as src
from cohortloom.sources import files, sinks

_EVENTS = with_views("clinical_events", "SELECT patient_id, event_id, event_time, value FROM clinical_events")


def _events(spark, d):
    return src.clinical_events(spark, d)


@query("src_csv_header", _EVENTS)
def src_csv_header(spark, d):
    path = work_path(spark, "events.csv")
    _events(spark, d).write.csv(path, header=True)
    return files.read_csv(spark, path, "patient_id BIGINT, event_id STRING, event_time DATE, value DOUBLE")


@query("src_csv_ddl", with_views("clinical_events", """
    SELECT CAST(patient_id AS VARCHAR) AS patient_id, event_id, 'desc ' || event_id AS event_description,
           event_time, value FROM clinical_events"""))
def src_csv_ddl(spark, d):
    path = work_path(spark, "events")
    rows = _events(spark, d)
    rows.select("patient_id", "event_id", F.concat(F.lit("desc "), "event_id"), "event_time", "value").write.csv(path)
    return files.create_csv_table(spark, "ext_events", path, files.EVENTS_DDL)


@query("src_csv_permissive", f"WITH {_RAW}" + """
    SELECT patient_id, CASE WHEN raw ~ '^[0-9]+$' OR raw = 'NaN' THEN CAST(raw AS DOUBLE) END AS value,
           CASE WHEN raw = 'pending' THEN NULL ELSE DATE '2001-02-03' END AS day FROM raw_lab""")
def src_csv_permissive(spark, d):
    path = work_path(spark, "labs.csv")
    day = F.when(F.col("raw") == "pending", "soon").otherwise("2001-02-03")
    _raw_lab_text(spark, d).select("patient_id", "raw", day).write.csv(path)
    return files.read_csv_permissive(spark, path, "patient_id BIGINT, value DOUBLE, day STRING", dates=["day"])


@query("src_csv_as_table", with_views("clinical_events", """
    SELECT event_id, count(*) AS n_events, sum(value) AS total FROM clinical_events GROUP BY event_id"""))
def src_csv_as_table(spark, d):
    path = work_path(spark, "as_table") + "/events_by_code.csv"
    _events(spark, d).write.csv(path, header=True)
    files.csv_as_table(spark, path, schema="patient_id BIGINT, event_id STRING, event_time DATE, value DOUBLE")
    return spark.sql("SELECT event_id, count(*) AS n_events, sum(value) AS total FROM events_by_code GROUP BY event_id")


@query("src_table_name", """
    SELECT page_id, regexp_extract(url, '(\\w+)(\\.csv)?$', 1) AS found,
           CASE WHEN regexp_extract(url, '(\\w+)(\\.csv)?$', 1) <> '' THEN regexp_extract(url, '(\\w+)(\\.csv)?$', 1)
                ELSE url END AS name FROM pages""")
def src_table_name(spark, d):
    found = F.regexp_extract("url", r"(\w+)(\.csv)?$", 1).alias("found")
    return src.table(spark, d, "pages").select("page_id", found, table_name("url").alias("name"))


def _svmlight_file(spark, d):
    path = work_path(spark, "features_svmlight")
    vectors = etl.patient_vectors(features(spark, d), src.mortality(spark, d))
    etl.svmlight_lines(vectors).select("line").write.text(path)
    return path


_SVMLIGHT_ROWS = """
    SELECT CAST(CASE WHEN patient_id % 4 = 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label, count(*) AS n_pairs,
           string_agg(CAST(idx AS VARCHAR), ' ' ORDER BY idx) AS indices, CAST(sum(CAST(round(CAST(printf('%.6f', value) AS DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) AS total
    FROM normalized GROUP BY patient_id"""


@query("src_svmlight", with_views("normalized", _SVMLIGHT_ROWS))
def src_svmlight(spark, d):
    """The file's rows again, put together by their line: label, pairs, indices in order, sum of values in millionths."""
    pairs = files.read_svmlight(spark, _svmlight_file(spark, d)).filter("idx IS NOT NULL")
    ordered = F.transform(F.array_sort(F.collect_list("idx")), lambda i: i.cast("string"))
    return pairs.groupBy("line").agg(
        F.first("label").alias("label"), F.count("*").alias("n_pairs"), F.array_join(ordered, " ").alias("indices"), F.sum(F.round(F.col("value") * 1000000).cast("bigint")).alias("total")
    ).drop("line")


@query("src_wordlist", "SELECT DISTINCT lower(p_name) AS code FROM part")
def src_wordlist(spark, d):
    path = work_path(spark, "words.txt")
    src.table(spark, d, "part").select(F.upper("p_name")).write.text(path)
    return files.read_wordlist(spark, path)


@query("src_folder_tree", """
    SELECT CAST(c.c_nationkey AS VARCHAR) AS patient_id, o.o_orderkey AS stay_id, o.o_totalprice AS value
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")
def src_folder_tree(spark, d):
    path = work_path(spark, "tree")
    people = src.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("patient"))
    stays = src.table(spark, d, "orders").join(people, "o_custkey")
    stays.select("patient", F.col("o_orderkey").alias("stay_id"), F.col("o_totalprice").alias("value")).write.partitionBy(
        "patient"
    ).csv(path, header=True)
    return files.read_folder_tree(spark, path, "stay_id BIGINT, value DOUBLE")


@query("src_episode_lookup", """
    SELECT concat(patient, '_', episode, '_timeseries.csv') AS stay, min(o_orderkey) AS icustay_id
    FROM (SELECT c.c_nationkey AS patient, concat('episode', substr(o.o_orderpriority, 1, 1)) AS episode, o.o_orderkey
          FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)
    WHERE episode <> 'episode5' GROUP BY 1""")
def src_episode_lookup(spark, d):
    path = work_path(spark, "episodes")
    people = src.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("patient"))
    episode = F.concat(F.lit("episode"), F.substring("o_orderpriority", 1, 1)).alias("episode")
    rows = src.table(spark, d, "orders").join(people, "o_custkey").select(
        "patient", episode, F.col("o_orderkey").alias("icustay_id"), "o_totalprice"
    )
    (
        rows.repartition("patient", "episode").sortWithinPartitions("patient", "episode", "icustay_id")
        .write.partitionBy("patient", "episode").csv(path, header=True)
    )
    stay = F.concat(F.col("patient").cast("string"), F.lit("_"), "episode", F.lit("_timeseries.csv")).alias("stay")
    predicted = rows.filter(F.col("episode") != "episode5").select(stay).distinct()
    return files.episode_lookup(spark, predicted, path)


_LABEL_AT = 50


@query("src_positional_wide", """
    SELECT vec_id AS id, label::DOUBLE AS label, 64 AS n_features, CAST(embedding[1] AS DOUBLE) AS first_value,
           CAST(embedding[64] AS DOUBLE) AS last_value,
           round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total
    FROM embeddings WHERE vec_id % 11 <> 0""")
def src_positional_wide(spark, d):
    path = work_path(spark, "wide.txt")
    rows = src.vectors(spark, d)
    text = F.transform("features", lambda x: x.cast("string"))
    cells = F.concat(
        F.array(F.when(F.col("id") % 11 == 0, "").otherwise(F.col("id").cast("string"))),
        F.slice(text, 1, _LABEL_AT - 1),
        F.array(F.when(F.col("class") == 0, "").otherwise(F.col("class").cast("string"))),
        F.slice(text, _LABEL_AT, 64),
    )
    rows.select(F.array_join(cells, ",")).write.text(path)
    wide = files.read_positional(spark, path, _LABEL_AT)
    return wide.select(
        "id",
        "label",
        F.size("features").alias("n_features"),
        F.element_at("features", 1).alias("first_value"),
        F.element_at("features", -1).alias("last_value"),
        F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


# --- sinks ---


@query("sink_csv", with_views("index_date", "SELECT patient_id, index_date FROM index_date"))
def sink_csv(spark, d):
    path = work_path(spark, "index_dates")
    sinks.write_csv(etl.index_dates(_events(spark, d), src.mortality(spark, d)), path, ["patient_id", "index_date"])
    return files.read_csv(spark, path, "patient_id BIGINT, index_date DATE")


@query("sink_delimited_store", with_views("feature_map", "SELECT idx, event_id FROM feature_map"))
def sink_delimited_store(spark, d):
    path = work_path(spark, "features")
    events = _events(spark, d)
    counts = etl.window_counts(events, etl.index_dates(events, src.mortality(spark, d)))
    sinks.write_delimited(etl.feature_index(counts), path, sep=" ")
    return spark.read.schema("idx BIGINT, event_id STRING").csv(path, sep=" ")


@query("sink_svmlight", with_views("sparse", """
    SELECT 'features' AS file, concat(label, ' ', line) AS value FROM sparse
    UNION ALL SELECT 'report', concat(patient_id, ' ', label, ' ', line) FROM sparse"""))
def sink_svmlight(spark, d):
    first, second = work_path(spark, "features_svmlight"), work_path(spark, "features")
    sinks.write_svmlight(etl.patient_vectors(features(spark, d), src.mortality(spark, d)), first, second)
    return spark.read.text(first).withColumn("file", F.lit("features")).unionByName(
        spark.read.text(second).withColumn("file", F.lit("report"))
    )


@query("sink_svmlight_test_rows", with_views("normalized", """
    SELECT concat(patient_id, ' 0 ', string_agg(printf('%d:%.3f', idx, value), ' ' ORDER BY idx)) AS value
    FROM normalized GROUP BY patient_id"""))
def sink_svmlight_test_rows(spark, d):
    first, second = work_path(spark, "test_svmlight"), work_path(spark, "test")
    sinks.write_svmlight(etl.patient_vectors(features(spark, d), src.mortality(spark, d)), first, second, test_rows=True)
    return spark.read.text(second)


@query("sink_submission", with_views("scores", """
    SELECT id AS patient_id, CASE WHEN s1 > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM scores"""))
def sink_submission(spark, d):
    path = work_path(spark, "predictions")
    scored = src.scores(spark, d).select(
        F.col("id").alias("patient_id"), F.when(F.col("s1") > 0.5, 1.0).otherwise(0.0).alias("label")
    )
    sinks.write_submission(src.graph_patient(spark, d), scored, path)
    return files.read_csv(spark, path, "patient_id BIGINT, label DOUBLE")


@query("sink_single_file", with_views("clinical_events", """
    SELECT 1 AS n_files, concat(event_id, ',', count(*)) AS value FROM clinical_events GROUP BY event_id"""))
def sink_single_file(spark, d):
    path = work_path(spark, "report")
    sinks.write_single_file(_events(spark, d).groupBy("event_id").agg(F.count("*").alias("n")), path)
    lines = spark.read.text(path)
    n_files = lines.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f").cast("int")).scalar()
    return lines.select(n_files.alias("n_files"), "value")


@query("sink_model", with_views("features", """
    SELECT CAST(m AS INTEGER) AS model_id, idx, ((idx * 7 + m) % 11 - 5) / 10.0::DOUBLE AS weight
    FROM (SELECT DISTINCT idx FROM features), range(1, 4) r(m)"""))
def sink_model(spark, d):
    path = work_path(spark, "weights")
    indices = features(spark, d).select("idx").distinct()
    weights = indices.withColumn("model_id", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumn(
        "weight", ((F.col("idx") * 7 + F.col("model_id")) % 11 - 5) / F.lit(10.0)
    )
    sinks.write_model(weights, path)
    return spark.read.parquet(path)


# --- table loading ---


@query("load_clinical", with_views("medication lab_result diagnostic", """
    SELECT 'medication' AS source, patient_id, date, medicine AS name, NULL::DOUBLE AS value FROM medication
    UNION ALL SELECT 'lab', patient_id, date, test_name, value FROM lab_result WHERE value <> 2.75
    UNION ALL SELECT 'diagnostic', d.o_custkey, CAST(d.o_orderdate AS DATE), concat('dx', l.l_partkey % 97), NULL
    FROM orders d JOIN lineitem l ON l.l_orderkey = d.o_orderkey WHERE l.l_linenumber <> 1"""))
def load_clinical(spark, d):
    """Medication, numeric labs and encounter-joined diagnoses from CSV, null rows dropped."""
    from cohortloom.sources.clinical import load_clinical as load

    meds, labs, enc, enc_dx = (work_path(spark, n) for n in ("med.csv", "lab.csv", "encounter.csv", "encounter_dx.csv"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    src.medication(spark, d).select(
        F.col("patient_id").alias("Member_ID"), stamp("date").alias("Order_Date"), F.col("medicine").alias("Drug_Name")
    ).write.csv(meds, header=True, ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False)
    src.lab_result(spark, d).select(
        F.col("patient_id").alias("Member_ID"),
        stamp("date").alias("Date_Resulted"),
        F.col("test_name").alias("Result_Name"),
        F.when(F.col("value") == 2.75, "n/a").otherwise(F.col("value").cast("string")).alias("Numeric_Result"),
    ).write.csv(labs, header=True)
    orders = src.table(spark, d, "orders")
    orders.select(
        F.col("o_orderkey").alias("Encounter_ID"),
        F.col("o_custkey").alias("Member_ID"),
        stamp(F.col("o_orderdate").cast("date")).alias("Encounter_DateTime"),
    ).write.csv(enc, header=True)
    code = F.when(F.col("l_linenumber") != 1, F.concat(F.lit("dx"), (F.col("l_partkey") % 97).cast("string")))
    src.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("Encounter_ID"), code.alias("code")
    ).write.csv(enc_dx, header=True)
    medication, lab, diagnostic = load(spark, meds, labs, enc, enc_dx)
    day = F.col("date").cast("date").alias("date")
    none = F.lit(None).cast("double").alias("value")
    return (
        medication.select(F.lit("medication").alias("source"), "patient_id", day, F.col("medicine").alias("name"), none)
        .unionByName(lab.select(F.lit("lab").alias("source"), "patient_id", day, F.col("test_name").alias("name"), "value"))
        .unionByName(
            diagnostic.select(F.lit("diagnostic").alias("source"), "patient_id", day, F.col("code").alias("name"), none)
        )
    )


@query("load_graph_tables", with_views("graph_events", """
    SELECT 'patient' AS source, c_custkey AS patient_id, NULL::BIGINT AS date, NULL AS name FROM customer
    UNION ALL SELECT 'lab', patient_id, date_diff('day', DATE '1970-01-01', date), item FROM graph_events
      WHERE kind = 'lab' AND value <> 1
    UNION ALL SELECT kind, patient_id, date_diff('day', DATE '1970-01-01', date), item FROM graph_events
      WHERE kind <> 'lab'"""))
def load_graph_tables(spark, d):
    """Patients, labs with a value, diagnoses and medications selected from registered CSV tables."""
    from cohortloom.sources.clinical import load_graph_tables as load

    root = work_path(spark, "graph")
    events = src.graph_events(spark, d).select(
        F.col("patient_id").alias("subject_id"), F.unix_date("date").cast("bigint").alias("date"), "kind", "item", "value"
    )
    value = F.when(F.col("value") == 1, "").otherwise(F.col("value").cast("string")).alias("value")
    none = F.lit(None).cast("string")
    src.graph_patient(spark, d).select(
        F.col("patient_id").alias("subject_id"), F.lit("F").alias("sex"), none.alias("dob"), none.alias("dod")
    ).write.csv(f"{root}/PATIENT.csv", header=True)
    events.filter("kind = 'lab'").select("subject_id", "date", F.col("item").alias("lab_name"), value).write.csv(
        f"{root}/LAB.csv", header=True
    )
    events.filter("kind = 'diag'").select(
        "subject_id", "date", F.col("item").alias("code"), F.lit(1).alias("sequence")
    ).write.csv(f"{root}/DIAGNOSTIC.csv", header=True)
    events.filter("kind = 'med'").select("subject_id", "date", F.col("item").alias("med_name")).write.csv(
        f"{root}/MEDICATION.csv", header=True
    )
    patient, lab, diag, med = load(spark, root)
    row = lambda df, source, date, name: df.select(
        F.lit(source).alias("source"), F.col("subject_id").alias("patient_id"), date, name.alias("name")
    )
    day = F.col("date")
    return (
        row(patient, "patient", F.lit(None).cast("bigint").alias("date"), none)
        .unionByName(row(lab, "lab", day, F.col("lab_name")))
        .unionByName(row(diag, "diag", day, F.col("code")))
        .unionByName(row(med, "med", day, F.col("med_name")))
    )
