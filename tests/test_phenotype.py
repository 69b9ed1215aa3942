"""Hand-made patients for the phenotype rules."""

from datetime import date

from cohortloom.operators import phenotype as ph

D1, D2 = date(2010, 1, 1), date(2010, 2, 1)


def frames(spark, dx, meds, labs=()):
    return (
        spark.createDataFrame(list(dx) or [(-1, D1, "x")], "patient_id BIGINT, date DATE, code STRING"),
        spark.createDataFrame(list(meds) or [(-1, D1, "x")], "patient_id BIGINT, date DATE, medicine STRING"),
        spark.createDataFrame(
            list(labs) or [(-1, D1, "x", 0.0)], "patient_id BIGINT, date DATE, test_name STRING, value DOUBLE"
        ),
    )


def ids(df):
    return sorted(r.patient_id for r in df.collect())


def test_cases(spark):
    dx, meds, _ = frames(
        spark,
        [(1, D1, "250.00"), (2, D1, "250.00"), (3, D1, "250.00"), (4, D1, "250.00"), (6, D1, "401.9"), (7, D1, "250.02"),
         (7, D1, "250.01")],
        [(2, D1, "Lantus"),                              # T1 only
         (3, D1, "METFORMIN"), (3, D2, "lantus"),        # T2 first
         (4, D1, "lantus"), (4, D1, "metformin"),        # same day: neither first
         (5, D1, "metformin"), (5, D2, "lantus"),        # T2 first without a diagnosis
         (6, D1, "lantus")],
    )
    assert ids(ph.case_patients(dx, meds)) == [1, 2, 3, 5, 7]
    assert ids(ph.case_patients(dx, meds, require_dx=True)) == [1, 2, 3, 7]
    assert ids(ph.case_patients(dx, meds, exclude_t1="patient", require_dx=True)) == [1, 2, 3]


def test_lab_limits(spark):
    rows = [(1, D1, "HbA1c", 6.0), (2, D1, "HbA1c", 5.99), (3, D1, "Fasting Glucose", 110.0), (4, D1, "Glucose", 110.0),
            (5, D1, "glucose, serum", 110.5), (6, D1, "glucose 3hr", 900.0)]
    _, _, labs = frames(spark, [], [], rows)
    assert ids(ph.abnormal_labs(labs)) == [1, 3, 5]


def test_controls_and_labels(spark):
    dx, meds, labs = frames(
        spark,
        [(1, D1, "401.9"), (2, D1, "790.21"), (3, D1, "401.9"), (4, D1, "250.3"), (5, D1, "401.9")],
        [],
        [(1, D1, "Glucose", 90.0), (2, D1, "Glucose", 90.0), (3, D1, "Glucose", 90.0), (3, D2, "HbA1c", 7.0),
         (4, D1, "Glucose", 90.0), (8, D1, "Glucose", 90.0)],
    )
    assert ids(ph.control_patients(dx, labs)) == [1, 4, 8]
    labels = {r.patient_id: r.label for r in ph.phenotype_labels(dx, meds, labs).collect()}
    # 4 is both: case wins. 8 has labs only and is a control all the same.
    assert labels == {1: 2, 2: 3, 3: 3, 4: 1, 5: 3, 8: 2}
    both = ph.phenotype_labels(dx, meds, labs, allow_overlap=True)
    assert sorted(r.label for r in both.collect() if r.patient_id == 4) == [1, 2]
