"""Feature ETL queries, one per stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import etl
from cohortloom.plans.registry import query
from cohortloom.plans.views import with_views
from cohortloom.session import cut
from cohortloom.sources import adapters as src


def _timed(spark, d):
    events = src.clinical_events(spark, d)
    return etl.time_difference(events, etl.index_dates(events, src.mortality(spark, d)))


def _counts(spark, d, **kw):
    events = src.clinical_events(spark, d)
    return etl.window_counts(events, etl.index_dates(events, src.mortality(spark, d)), **kw)


def features(spark, d):
    return etl.feature_pipeline(src.clinical_events(spark, d), src.mortality(spark, d))


@query("index_date", with_views("index_date", "SELECT * FROM index_date"))
def index_date(spark, d):
    return etl.index_dates(src.clinical_events(spark, d), src.mortality(spark, d))


@query("time_difference", with_views("timed", "SELECT * FROM timed"))
def time_difference(spark, d):
    return _timed(spark, d)


@query("observation_window", with_views("windowed", "SELECT * FROM windowed"))
def observation_window(spark, d):
    return etl.observation_window(_timed(spark, d))


@query("feature_counts", with_views("feature_counts", "SELECT patient_id, event_id, feature_value FROM feature_counts"))
def feature_counts(spark, d):
    return etl.feature_counts(etl.observation_window(_timed(spark, d)))


# A given map that lacks some codes: the inner join must drop their events.
_GIVEN_MAP = """given_map AS (
    SELECT row_number() OVER (ORDER BY event_id) - 1 AS idx, event_id
    FROM (SELECT DISTINCT event_id FROM clinical_events WHERE event_id NOT LIKE '%7'))"""

_AGG = """
    SELECT f.patient_id, m.idx AS feature_id,
           {v} / CAST(max({v}) OVER (PARTITION BY m.idx) AS DOUBLE) AS feature_value
    FROM feature_counts f JOIN given_map m ON f.event_id = m.event_id"""


def _given_map(spark, d):
    codes = src.clinical_events(spark, d).select("event_id").filter(~F.col("event_id").endswith("7"))
    return etl.feature_index(codes)


@query("aggregate_events", with_views("feature_counts", _AGG.format(v="f.feature_value"), _GIVEN_MAP))
def aggregate_events(spark, d):
    events = src.clinical_events(spark, d)
    index = etl.index_dates(events, src.mortality(spark, d))
    return etl.aggregate_events(events, index, _given_map(spark, d))


@query("aggregate_events_sum_for_lab", with_views("feature_counts", """
    SELECT patient_id, idx AS feature_id, v / CAST(max(v) OVER (PARTITION BY idx) AS DOUBLE) AS feature_value
    FROM (SELECT f.patient_id, m.idx, CASE WHEN f.event_id LIKE 'LAB%' THEN f.value_sum ELSE f.feature_value END AS v
          FROM feature_counts f JOIN given_map m ON f.event_id = m.event_id)""", _GIVEN_MAP))
def aggregate_events_sum_for_lab(spark, d):
    events = src.clinical_events(spark, d)
    index = etl.index_dates(events, src.mortality(spark, d))
    return etl.aggregate_events(events, index, _given_map(spark, d), value_mode="sum_for_lab")


@query("feature_index", with_views("feature_map", "SELECT idx, event_id FROM feature_map"))
def feature_index(spark, d):
    return etl.feature_index(_counts(spark, d))


@query("feature_map_join", with_views("features", "SELECT patient_id, idx, feature_value FROM features"))
def feature_map_join(spark, d):
    counts = cut(_counts(spark, d))  # read for the codes and for the features
    return etl.feature_map_join(counts, etl.feature_index(counts))


@query("normalize_minmax", with_views("normalized", "SELECT patient_id, idx, value FROM normalized"))
def normalize_minmax(spark, d):
    return features(spark, d)


@query("patient_vectors", with_views("normalized", """
    SELECT n.patient_id, coalesce(max(m.label), 0) AS label, count(*) AS n_features,
           string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices, round(sum(value), 6) AS total
    FROM normalized n LEFT JOIN mortality m ON n.patient_id = m.patient_id GROUP BY n.patient_id"""))
def patient_vectors(spark, d):
    rows = etl.patient_vectors(features(spark, d), src.mortality(spark, d))
    return rows.select(
        "patient_id",
        "label",
        F.size("pairs").cast("bigint").alias("n_features"),
        F.array_join(F.col("pairs.idx").cast("array<string>"), ",").alias("indices"),
        F.round(F.aggregate("pairs", F.lit(0.0), lambda acc, p: acc + p["value"]), 6).alias("total"),
    )


@query("samples", with_views("sparse", "SELECT patient_id, label, line AS sparse FROM sparse"))
def samples(spark, d):
    events = src.clinical_events(spark, d)
    return etl.samples(features(spark, d), etl.index_dates(events, src.mortality(spark, d)))
