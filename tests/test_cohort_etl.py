"""Hand-made tables for the cohort and feature rules."""

from datetime import date, timedelta

import pytest

from cohortloom.operators import cohort, etl

EVENTS = "patient_id BIGINT, event_id STRING, event_time DATE, value DOUBLE"
DEATHS = "patient_id BIGINT, death_time DATE, label INT"
DAY = date(2010, 6, 1)


def at(offset):
    return DAY + timedelta(days=offset)


@pytest.fixture
def deaths(spark):
    # Patient 2 has two death records, patient 9 no events.
    return spark.createDataFrame([(2, at(30), 1), (2, at(30), 1), (9, at(0), 1)], DEATHS)


@pytest.fixture
def events(spark):
    rows = [
        (1, "LAB1", at(0), 1.0),
        (1, "LAB1", at(-2000), 1.0),
        (1, "LAB1", at(-2001), 1.0),
        (1, "DIAG1", at(-1), None),
        (2, "LAB1", at(0), 3.0),
        (2, "LAB1", at(1), 5.0),
        (2, "LAB1", at(-5), 2.0),
        (2, "DRUG1", at(-2000), 4.0),
        (3, "LAB1", at(4), 7.0),
    ]
    return spark.createDataFrame(rows, EVENTS)


def test_split_is_a_partition_of_the_events(events, deaths):
    alive, dead = cohort.split_cohort(events, deaths)
    assert alive.count() == 5 and dead.count() == 4
    assert {r.patient_id for r in dead.collect()} == {2}


def test_index_dates(events, deaths):
    got = {r.patient_id: (r.index_date, r.label) for r in etl.index_dates(events, deaths).collect()}
    assert got == {1: (at(0), 0), 3: (at(4), 0), 2: (at(0), 1), 9: (at(-30), 1)}


def test_window_keeps_both_ends_and_drops_missing_values(events, deaths):
    timed = etl.time_difference(events, etl.index_dates(events, deaths))
    kept = sorted((r.patient_id, r.event_id, r.time_difference) for r in etl.observation_window(timed).collect())
    # The event between the index date and death is out, and so is the one at 2001 days.
    assert kept == [(1, "LAB1", 0), (1, "LAB1", 2000), (2, "DRUG1", 2000), (2, "LAB1", 0), (2, "LAB1", 5), (3, "LAB1", 0)]


@pytest.mark.parametrize("mode", ["count", "sum_for_lab"])
def test_counting_by_day_first_changes_nothing(events, deaths, mode):
    index = etl.index_dates(events, deaths)
    one = etl.feature_counts(etl.observation_window(etl.time_difference(events, index)), mode)
    two = etl.window_counts(events, index, value_mode=mode)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_normalised_values_and_lines(events, deaths):
    features = etl.feature_pipeline(events, deaths)
    got = sorted(map(tuple, features.collect()))
    # DRUG1 -> 0, LAB1 -> 1; the largest LAB1 count is 2.
    assert got == [(1, 1, 1.0), (2, 0, 1.0), (2, 1, 1.0), (3, 1, 0.5)]
    lines = etl.svmlight_lines(etl.patient_vectors(features, deaths))
    assert {r.patient_id: r.line for r in lines.collect()} == {
        1: "0 1:1.000000",
        2: "1 0:1.000000 1:1.000000",
        3: "0 1:0.500000",
    }


def test_record_length_median_is_exact(spark, deaths):
    rows = [(p, "LAB1", at(x), 1.0) for p, n in ((1, 10), (3, 20), (4, 21), (5, 40)) for x in (0, n)]
    got = cohort.record_length_metrics(spark.createDataFrame(rows, EVENTS), deaths).collect()
    assert [tuple(r) for r in got] == [("alive", 22.75, 20.5, 10, 40)]


def test_hot_patient_counts(spark, deaths):
    """One patient with most of the rows, many of them copies."""
    rows = [(7, "LAB1", at(-(i % 40)), 1.0) for i in range(4000)] + [(8, "LAB2", at(0), 1.0)]
    got = cohort.event_count_metrics(spark.createDataFrame(rows, EVENTS), deaths).collect()
    assert [tuple(r) for r in got] == [("alive", 2000.5, 1, 4000)]
