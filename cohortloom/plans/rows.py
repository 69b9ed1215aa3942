"""Projections, filters, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import codes
from cohortloom.functions import columns as C
from cohortloom.operators import relational as R
from cohortloom.plans.registry import query
from cohortloom.plans.views import with_views
from cohortloom.session import cut
from cohortloom.sources import adapters as src


def _events(spark, d):
    return src.clinical_events(spark, d)


@query("proj_select_rename", with_views("clinical_events", """
    SELECT patient_id AS subject, event_id AS code, year(event_time) AS event_year, value * 2 AS doubled
    FROM clinical_events"""))
def proj_select_rename(spark, d):
    return _events(spark, d).select(
        F.col("patient_id").alias("subject"),
        F.col("event_id").alias("code"),
        F.year("event_time").cast("bigint").alias("event_year"),
        (F.col("value") * 2).alias("doubled"),
    )


@query("proj_drop_dup_cols", with_views("icu_stay stay_diagnosis", """
    SELECT i.stay_id, i.subject_id, s.flags FROM icu_stay i
    JOIN (SELECT stay_id, sum(flag)::BIGINT AS flags FROM stay_diagnosis GROUP BY stay_id) s ON i.stay_id = s.stay_id"""))
def proj_drop_dup_cols(spark, d):
    stays = src.icu_stay(spark, d).withColumn("flags", F.lit(-1))
    flags = src.stay_diagnosis(spark, d).groupBy("stay_id").agg(F.sum("flag").alias("flags"))
    # The right-hand copy of the shared column wins: drop the left one before the join.
    return stays.drop("flags").join(flags, "stay_id").select("stay_id", "subject_id", "flags")


@query("filter_not_null", with_views("clinical_events", "SELECT * FROM clinical_events WHERE value IS NOT NULL"))
def filter_not_null(spark, d):
    return _events(spark, d).filter(F.col("value").isNotNull())


@query("filter_na_drop", with_views("clinical_events mortality", """
    SELECT e.patient_id, e.event_id, e.value, m.death_time FROM clinical_events e
    LEFT JOIN mortality m ON e.patient_id = m.patient_id
    WHERE e.value IS NOT NULL AND m.death_time IS NOT NULL"""))
def filter_na_drop(spark, d):
    deaths = src.mortality(spark, d).select("patient_id", "death_time")
    joined = _events(spark, d).select("patient_id", "event_id", "value").join(deaths, "patient_id", "left")
    return joined.na.drop()


def _raw_lab_text(spark, d):
    """(patient_id, raw): lab values as text with blanks, words and NaN among them."""
    raw = (
        F.when(F.col("l_linenumber") == 2, "")
        .when(F.col("l_linenumber") == 3, "pending")
        .when(F.col("l_linenumber") == 4, "NaN")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    return src._order_lines(spark, d).select("patient_id", raw.alias("raw"))


_RAW = """raw_lab AS (SELECT o.o_custkey AS patient_id,
    CASE l.l_linenumber WHEN 2 THEN '' WHEN 3 THEN 'pending' WHEN 4 THEN 'NaN'
         ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS raw
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


@query("filter_numeric_castable", f"WITH {_RAW}" + """
    SELECT patient_id, TRY_CAST(raw AS DOUBLE) AS value FROM raw_lab
    WHERE TRY_CAST(raw AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(raw AS DOUBLE))""")
def filter_numeric_castable(spark, d):
    rows = _raw_lab_text(spark, d).select("patient_id", C.number_or_null("raw").alias("value"))
    return rows.filter(F.col("value").isNotNull())


@query("filter_nonempty", f"WITH {_RAW} SELECT patient_id, raw FROM raw_lab WHERE raw IS NOT NULL AND raw <> ''")
def filter_nonempty(spark, d):
    return _raw_lab_text(spark, d).filter(C.present("raw"))


@query("filter_prefix", with_views("clinical_events", """
    SELECT patient_id, event_id FROM clinical_events WHERE event_id LIKE 'DIAG%'"""))
def filter_prefix(spark, d):
    return _events(spark, d).filter(F.col("event_id").startswith("DIAG")).select("patient_id", "event_id")


@query("filter_code_set", with_views("medication code_sets", """
    SELECT patient_id, medicine FROM medication
    WHERE lower(medicine) IN (SELECT lower(code) FROM code_sets WHERE set_name = 't2dm_med')"""))
def filter_code_set(spark, d):
    listed = _code_sets(spark).filter(F.col("set_name") == "t2dm_med").select("code")
    return R.keep_codes(src.medication(spark, d).select("patient_id", "medicine"), "medicine", listed)


def _code_sets(spark):
    rows = [F.struct(F.lit(name).alias("set_name"), F.lit(code).alias("code"))
            for name, items in codes.CODE_SETS.items() for code in items]
    return spark.range(1).select(F.inline(F.array(*rows)))


@query("filter_range_window", with_views("clinical_events", """
    SELECT patient_id, event_id, event_time FROM clinical_events
    WHERE event_time BETWEEN DATE '1996-02-29' AND DATE '1997-03-01'"""))
def filter_range_window(spark, d):
    return (
        _events(spark, d)
        .filter(F.col("event_time").between(F.lit("1996-02-29").cast("date"), F.lit("1997-03-01").cast("date")))
        .select("patient_id", "event_id", "event_time")
    )


@query("filter_case_insensitive", with_views("medication", """
    SELECT patient_id, date, medicine FROM medication WHERE lower(medicine) = 'insulin nph'"""))
def filter_case_insensitive(spark, d):
    return src.medication(spark, d).filter(F.lower("medicine") == "insulin nph")


@query("fill_missing_sentinel", f"WITH {_RAW}" + """
    SELECT patient_id, coalesce(CASE WHEN isnan(x) THEN NULL ELSE x END, -10.0::DOUBLE) AS masked,
           coalesce(CASE WHEN isnan(x) THEN NULL ELSE x END, 0.0::DOUBLE) AS zeroed
    FROM (SELECT patient_id, TRY_CAST(raw AS DOUBLE) AS x FROM raw_lab)""")
def fill_missing_sentinel(spark, d):
    rows = _raw_lab_text(spark, d).withColumn("x", F.col("raw").try_cast("double"))
    return rows.select("patient_id", C.fill("x", -10.0).alias("masked"), C.fill("x", 0.0).alias("zeroed"))


@query("missing_mask", f"WITH {_RAW}" + """
    SELECT patient_id, CASE WHEN x IS NULL OR isnan(x) THEN 1 ELSE 0 END AS is_missing
    FROM (SELECT patient_id, TRY_CAST(raw AS DOUBLE) AS x FROM raw_lab)""")
def missing_mask(spark, d):
    return _raw_lab_text(spark, d).select("patient_id", C.number_or_null("raw").isNull().cast("int").alias("is_missing"))


# --- scalar functions ---


@query("fn_date_parse", with_views("clinical_events", """
    SELECT patient_id, event_time AS parsed, year(event_time) AS y
    FROM clinical_events"""))
def fn_date_parse(spark, d):
    text = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stamped = _events(spark, d).select("patient_id", text.alias("text"))
    parsed = F.to_timestamp("text", "yyyy-MM-dd'T'HH:mm:ssX").cast("date")
    day = F.to_date(F.substring("text", 1, 10), "yyyy-MM-dd")
    return stamped.select("patient_id", parsed.alias("parsed"), F.year(day).cast("bigint").alias("y"))


@query("fn_date_offset", with_views("clinical_events", """
    SELECT patient_id, event_id, CAST(event_time - INTERVAL 30 DAY AS DATE) AS earlier,
           CAST(event_time + INTERVAL 2000 DAY AS DATE) AS later FROM clinical_events"""))
def fn_date_offset(spark, d):
    return _events(spark, d).select(
        "patient_id",
        "event_id",
        F.date_sub("event_time", 30).alias("earlier"),
        F.date_add("event_time", 2000).alias("later"),
    )


@query("fn_days_between", with_views("clinical_events mortality", """
    SELECT e.patient_id, e.event_id, CAST(date_diff('day', e.event_time, m.death_time) AS INTEGER) AS before_death,
           CAST(date_diff('day', m.death_time, e.event_time) AS INTEGER) AS after_death
    FROM clinical_events e JOIN mortality m ON e.patient_id = m.patient_id"""))
def fn_days_between(spark, d):
    both = _events(spark, d).join(src.mortality(spark, d), "patient_id")
    return both.select(
        "patient_id",
        "event_id",
        F.date_diff("death_time", "event_time").alias("before_death"),
        F.date_diff("event_time", "death_time").alias("after_death"),
    )


@query("fn_regex_extract", with_views("clinical_events", """
    SELECT patient_id, event_id, regexp_extract(event_id, '([a-zA-Z]+)', 1) AS code_class FROM clinical_events"""))
def fn_regex_extract(spark, d):
    return _events(spark, d).select("patient_id", "event_id", C.code_class("event_id").alias("code_class"))


@query("fn_lower", with_views("medication", "SELECT patient_id, lower(medicine) AS medicine FROM medication"))
def fn_lower(spark, d):
    return src.medication(spark, d).select("patient_id", F.lower("medicine").alias("medicine"))


@query("fn_cast", f"WITH {_RAW}" + """
    SELECT patient_id, CAST(patient_id AS VARCHAR) AS id_text,
           CASE WHEN raw ~ '^[0-9]+$' THEN CAST(raw AS BIGINT) END AS as_long,
           CASE WHEN raw ~ '^[0-9]+$' THEN CAST(raw AS DOUBLE) END AS as_double FROM raw_lab""")
def fn_cast(spark, d):
    return _raw_lab_text(spark, d).select(
        "patient_id",
        F.col("patient_id").cast("string").alias("id_text"),
        F.col("raw").try_cast("bigint").alias("as_long"),
        C.number_or_null("raw").alias("as_double"),
    )


@query("fn_format_pair", with_views("features", """
    SELECT patient_id, printf('%d:%.6f', idx, feature_value / 7.0::DOUBLE) AS pair FROM features"""))
def fn_format_pair(spark, d):
    from cohortloom.operators import etl

    events = src.clinical_events(spark, d)
    counts = cut(etl.window_counts(events, etl.index_dates(events, src.mortality(spark, d))))
    rows = etl.feature_map_join(counts, etl.feature_index(counts))
    return rows.select("patient_id", F.format_string("%d:%.6f", "idx", F.col("feature_value") / 7.0).alias("pair"))


@query("fn_conditional", with_views("clinical_events", """
    SELECT patient_id, event_id, CASE WHEN event_id LIKE 'LAB%' THEN value ELSE 1.0::DOUBLE END AS weight
    FROM clinical_events"""))
def fn_conditional(spark, d):
    weight = F.when(C.code_class("event_id") == "LAB", F.col("value")).otherwise(1.0)
    return _events(spark, d).select("patient_id", "event_id", weight.alias("weight"))


_UNITS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("fn_one_hot", with_views("icu_stay", "SELECT stay_id, "
       + ", ".join(f"CASE WHEN care_unit = '{u}' THEN 1 ELSE 0 END AS \"{u}\"" for u in _UNITS) + " FROM icu_stay"))
def fn_one_hot(spark, d):
    return R.one_hot(src.icu_stay(spark, d), "stay_id", "care_unit", _UNITS)


@query("fn_one_hot_long", with_views("icu_stay", """
    SELECT stay_id, unnest(list_distinct(string_split(concat(care_unit, ',', year(intime)), ','))) AS category
    FROM icu_stay"""))
def fn_one_hot_long(spark, d):
    tags = F.concat_ws(",", "care_unit", F.year("intime").cast("string"))
    return R.one_hot_long(src.icu_stay(spark, d).withColumn("tags", tags), "stay_id", "tags")


@query("fn_abs", """
    SELECT vec_id AS id, CAST(i AS INTEGER) AS pos, abs(CAST(embedding[i + 1] AS DOUBLE)) AS value FROM embeddings, range(64) r(i)""")
def fn_abs(spark, d):
    return src.vectors(spark, d).select("id", F.posexplode(F.transform("features", F.abs)).alias("pos", "value"))


@query("fn_sigmoid", with_views("normalized", """
    SELECT patient_id, round(1.0 / (1.0 + exp(-sum(((idx * 7 % 11) - 5) / 10.0::DOUBLE * value))), 8) AS probability
    FROM normalized GROUP BY patient_id"""))
def fn_sigmoid(spark, d):
    from cohortloom.plans.etl import features

    weight = (F.col("idx") * 7 % 11 - 5) / F.lit(10.0)
    scored = features(spark, d).groupBy("patient_id").agg(F.sum(weight * F.col("value")).alias("z"))
    return scored.select("patient_id", F.round(C.sigmoid("z"), 8).alias("probability"))


@query("fn_split_csv_line", with_views("clinical_events", """
    SELECT patient_id, event_id, event_time, value FROM clinical_events"""))
def fn_split_csv_line(spark, d):
    line = F.concat_ws(",", F.col("patient_id").cast("string"), "event_id", F.col("event_time").cast("string"),
                       F.coalesce(F.col("value").cast("string"), F.lit("")))
    parts = F.split(line, ",")
    return _events(spark, d).select(parts.alias("p")).select(
        F.col("p")[0].cast("bigint").alias("patient_id"),
        F.col("p")[1].alias("event_id"),
        F.to_date(F.col("p")[2]).alias("event_time"),
        C.number_or_null(F.col("p")[3]).alias("value"),
    )


@query("fn_path_parts", """
    SELECT o_orderkey AS id, concat(o_custkey, '_episode', o_orderkey % 9, '_timeseries.csv') AS stay,
           CAST(o_custkey AS VARCHAR) AS patient, concat('episode', o_orderkey % 9) AS episode FROM orders""")
def fn_path_parts(spark, d):
    stay = F.concat(F.col("o_custkey").cast("string"), F.lit("_episode"),
                    (F.col("o_orderkey") % 9).cast("string"), F.lit("_timeseries.csv"))
    rows = src.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), stay.alias("stay"))
    parts = F.split("stay", "_")
    return rows.select("id", "stay", parts[0].alias("patient"), parts[1].alias("episode"))


@query("code_sets", with_views("code_sets diagnostic medication", """
    SELECT c.set_name, c.code, count(*) AS n_rows FROM code_sets c
    JOIN (SELECT lower(code) AS name FROM diagnostic UNION ALL SELECT lower(medicine) FROM medication) r
      ON r.name = c.code GROUP BY c.set_name, c.code"""))
def code_sets(spark, d):
    """How often each listed code occurs in the diagnosis and medication tables."""
    names = src.diagnostic(spark, d).select(F.lower("code").alias("code")).unionByName(
        src.medication(spark, d).select(F.lower("medicine").alias("code"))
    )
    counted = names.groupBy("code").agg(F.count("*").alias("n_rows"))
    # The code lists are fixed in this package, a few hundred short strings.
    return F.broadcast(_code_sets(spark)).join(counted, "code").select("set_name", "code", "n_rows")
