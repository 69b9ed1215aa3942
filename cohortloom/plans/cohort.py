"""Cohort statistics queries."""

from __future__ import annotations

from cohortloom.operators import cohort
from cohortloom.plans.registry import query
from cohortloom.plans.views import with_views
from cohortloom.sources import adapters as src


def _inputs(spark, d):
    return src.clinical_events(spark, d), src.mortality(spark, d)


@query("cohort_split", with_views("cohort_events", """
    SELECT cohort, patient_id, event_id, event_time FROM cohort_events"""))
def cohort_split(spark, d):
    alive, dead = cohort.split_cohort(*_inputs(spark, d))
    cols = ["patient_id", "event_id", "event_time"]
    return alive.selectExpr("'alive' AS cohort", *cols).unionByName(dead.selectExpr("'dead' AS cohort", *cols))


@query("event_count_metrics", with_views("cohort_events", """
    SELECT cohort, avg(n) AS avg_events, min(n) AS min_events, max(n) AS max_events
    FROM (SELECT cohort, patient_id, count(event_id) AS n FROM cohort_events GROUP BY 1, 2) GROUP BY cohort"""))
def event_count_metrics(spark, d):
    return cohort.event_count_metrics(*_inputs(spark, d))


@query("encounter_count_metrics", with_views("cohort_events", """
    SELECT cohort, avg(n) AS avg_encounters, min(n) AS min_encounters, max(n) AS max_encounters
    FROM (SELECT cohort, patient_id, count(DISTINCT event_time) AS n FROM cohort_events GROUP BY 1, 2)
    GROUP BY cohort"""))
def encounter_count_metrics(spark, d):
    return cohort.encounter_count_metrics(*_inputs(spark, d))


@query("record_length_metrics", with_views("cohort_events", """
    SELECT cohort, avg(n) AS avg_days, median(n) AS median_days,
           CAST(min(n) AS INTEGER) AS min_days, CAST(max(n) AS INTEGER) AS max_days
    FROM (SELECT cohort, patient_id, date_diff('day', min(event_time), max(event_time)) AS n
          FROM cohort_events GROUP BY 1, 2) GROUP BY cohort"""))
def record_length_metrics(spark, d):
    return cohort.record_length_metrics(*_inputs(spark, d))


_TOP = """
    SELECT cohort, code_class, event_id, n_events, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY cohort, code_class ORDER BY n_events DESC, event_id) AS rank
      FROM (SELECT cohort, regexp_extract(event_id, '([a-zA-Z]+)', 1) AS code_class, event_id, count(*) AS n_events
            FROM cohort_events GROUP BY 1, 2, 3)) WHERE rank <= {k}"""


@query("common_codes", with_views("cohort_events", _TOP.format(k=5)))
def common_codes(spark, d):
    return cohort.common_codes(*_inputs(spark, d))


@query("topk_by_count", with_views("cohort_events", _TOP.format(k=3)))
def topk_by_count(spark, d):
    return cohort.common_codes(*_inputs(spark, d), k=3)


@query("metrics_table", with_views("cohort_events", """
    SELECT measure, cohort, avg(x) AS avg_value, min(x) AS min_value, max(x) AS max_value FROM (
      SELECT cohort, patient_id, 'n_events' AS measure, count(event_id) AS x FROM cohort_events GROUP BY 1, 2
      UNION ALL
      SELECT cohort, patient_id, 'n_encounters', count(DISTINCT event_time) FROM cohort_events GROUP BY 1, 2
      UNION ALL
      SELECT cohort, patient_id, 'record_length', date_diff('day', min(event_time), max(event_time))
      FROM cohort_events GROUP BY 1, 2) GROUP BY measure, cohort"""))
def metrics_table(spark, d):
    return cohort.metrics_table(*_inputs(spark, d))
