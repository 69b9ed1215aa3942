"""Clinical feature, phenotype and ICU queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import codes
from cohortloom.operators import features as feat
from cohortloom.operators import icu
from cohortloom.operators import phenotype as ph
from cohortloom.plans.registry import query
from cohortloom.plans.rows import _UNITS, _code_sets
from cohortloom.plans.views import in_list, with_views
from cohortloom.sources import adapters as src


def _listed(spark, set_name):
    return _code_sets(spark).filter(F.col("set_name") == set_name).select("code")


_DX = "SELECT patient_id, 'diag' AS source, lower(code) AS name, count(*)::DOUBLE AS value FROM diagnostic {w} GROUP BY 1, 3"
_MED = "SELECT patient_id, 'med' AS source, lower(medicine) AS name, count(*)::DOUBLE AS value FROM medication {w} GROUP BY 1, 3"
_LAB = "SELECT patient_id, 'lab' AS source, lower(test_name) AS name, round(avg(value), 8) AS value FROM lab_result {w} GROUP BY 1, 3"


def _rounded(df):
    return df.withColumn("value", F.round("value", 8))


@query("feat_diagnostic_count", with_views("diagnostic", _DX.format(w="")))
def feat_diagnostic_count(spark, d):
    return feat.diagnostic_counts(src.diagnostic(spark, d))


@query("feat_medication_count", with_views("medication", _MED.format(w="")))
def feat_medication_count(spark, d):
    return feat.medication_counts(src.medication(spark, d))


@query("feat_lab_avg", with_views("lab_result", _LAB.format(w="")))
def feat_lab_avg(spark, d):
    return _rounded(feat.lab_averages(src.lab_result(spark, d)))


@query("feat_diagnostic_filtered", with_views("diagnostic", _DX.format(
    w=f"WHERE lower(code) IN ({in_list([c.lower() for c in codes.DM_RELATED_DX])})")))
def feat_diagnostic_filtered(spark, d):
    return feat.diagnostic_counts(src.diagnostic(spark, d), only=_listed(spark, "dm_related_dx"))


@query("feat_medication_filtered", with_views("medication", _MED.format(
    w=f"WHERE lower(medicine) IN ({in_list(codes.T2DM_MED)})")))
def feat_medication_filtered(spark, d):
    return feat.medication_counts(src.medication(spark, d), only=_listed(spark, "t2dm_med"))


@query("feat_lab_filtered", with_views("lab_result", _LAB.format(
    w=f"WHERE lower(test_name) IN ({in_list(codes.GLUCOSE_LABS)})")))
def feat_lab_filtered(spark, d):
    return _rounded(feat.lab_averages(src.lab_result(spark, d), only=_listed(spark, "glucose_lab")))


def clinical_tuples(spark, d):
    dx = feat.diagnostic_counts(src.diagnostic(spark, d))
    med = feat.medication_counts(src.medication(spark, d))
    return dx.unionByName(med).unionByName(feat.lab_averages(src.lab_result(spark, d)))


_TUPLES = f"tuples AS ({_DX.format(w='')} UNION ALL {_MED.format(w='')} UNION ALL {_LAB.format(w='')})"


@query("feat_construct", with_views("diagnostic medication lab_result", """
    SELECT t.patient_id, n.idx, t.value FROM tuples t
    JOIN (SELECT source, name, row_number() OVER (ORDER BY source, name) - 1 AS idx
          FROM (SELECT DISTINCT source, name FROM tuples)) n ON n.source = t.source AND n.name = t.name""", _TUPLES))
def feat_construct(spark, d):
    return _rounded(feat.construct(clinical_tuples(spark, d)))


_T2DX, _T1MED, _T2MED = in_list(codes.T2DM_DX), in_list(codes.T1DM_MED), in_list(codes.T2DM_MED)
_CASES = f"""
    t2_dx AS (SELECT DISTINCT patient_id FROM diagnostic WHERE code IN ({_T2DX})),
    t1_med AS (SELECT patient_id, min(date) AS d FROM medication WHERE lower(medicine) IN ({_T1MED}) GROUP BY 1),
    t2_med AS (SELECT patient_id, min(date) AS d FROM medication WHERE lower(medicine) IN ({_T2MED}) GROUP BY 1),
    cases AS (
      SELECT patient_id FROM t2_dx WHERE patient_id NOT IN (SELECT patient_id FROM t1_med)
      UNION SELECT patient_id FROM t2_dx WHERE patient_id IN (SELECT patient_id FROM t1_med)
        AND patient_id NOT IN (SELECT patient_id FROM t2_med)
      UNION SELECT a.patient_id FROM t1_med a JOIN t2_med b ON a.patient_id = b.patient_id WHERE b.d < a.d)"""
_ABNORMAL = """abnormal AS (
      SELECT l.patient_id, l.test_name, l.value FROM lab_result l JOIN lab_rules r ON lower(l.test_name) = r.test
      WHERE (r.op = '>=' AND l.value >= r.threshold) OR (r.op = '>' AND l.value > r.threshold))"""
_CONTROLS = f"""controls AS (
      SELECT DISTINCT patient_id FROM lab_result WHERE lower(test_name) IN ({in_list(codes.GLUCOSE_LABS)})
        AND patient_id NOT IN (SELECT patient_id FROM abnormal)
        AND patient_id NOT IN (SELECT patient_id FROM diagnostic
                               WHERE lower(code) IN ({in_list(codes.DM_RELATED_DX)})))"""


@query("phenotype_case", with_views("diagnostic medication", "SELECT patient_id FROM cases", _CASES))
def phenotype_case(spark, d):
    return ph.case_patients(src.diagnostic(spark, d), src.medication(spark, d))


@query("phenotype_case_strict", with_views("diagnostic medication", f"""
    SELECT patient_id FROM cases
    WHERE patient_id IN (SELECT patient_id FROM t2_dx)
      AND patient_id NOT IN (SELECT patient_id FROM diagnostic WHERE code IN ({in_list(codes.T1DM_DX)}))""", _CASES))
def phenotype_case_strict(spark, d):
    """Cases with a T2 diagnosis, leaving out every patient with a T1 diagnosis."""
    return ph.case_patients(src.diagnostic(spark, d), src.medication(spark, d), exclude_t1="patient", require_dx=True)


@query("lab_abnormal", with_views("lab_result lab_rules", "SELECT patient_id, test_name, value FROM abnormal", _ABNORMAL))
def lab_abnormal(spark, d):
    return ph.abnormal_labs(src.lab_result(spark, d)).select("patient_id", "test_name", "value")


@query("phenotype_control", with_views("diagnostic lab_result lab_rules", "SELECT patient_id FROM controls",
                                       _ABNORMAL + ", " + _CONTROLS))
def phenotype_control(spark, d):
    return ph.control_patients(src.diagnostic(spark, d), src.lab_result(spark, d))


_LABELS_SQL = with_views("diagnostic medication lab_result lab_rules", """
    SELECT patient_id, min(label) AS label FROM (
      SELECT patient_id, 1 AS label FROM cases UNION ALL SELECT patient_id, 2 FROM controls
      UNION ALL SELECT patient_id, 3 FROM diagnostic) GROUP BY patient_id""",
    ", ".join([_CASES, _ABNORMAL, _CONTROLS]))


def phenotype_labels(spark, d):
    return ph.phenotype_labels(src.diagnostic(spark, d), src.medication(spark, d), src.lab_result(spark, d))


query("phenotype_label", _LABELS_SQL)(phenotype_labels)


@query("icu_stay_features", with_views("icu_stay stay_diagnosis", "SELECT i.stay_id, i.icu_cum, "
       + ", ".join(f"CASE WHEN care_unit = '{u}' THEN 1 ELSE 0 END AS \"{u}\"" for u in _UNITS) + """,
           s.phenotype_score
    FROM (SELECT *, count(*) OVER (PARTITION BY subject_id ORDER BY intime, stay_id ROWS UNBOUNDED PRECEDING) AS icu_cum
          FROM icu_stay) i
    JOIN (SELECT stay_id, sum(flag)::BIGINT AS phenotype_score FROM stay_diagnosis GROUP BY 1) s
      ON s.stay_id = i.stay_id"""))
def icu_stay_features(spark, d):
    return icu.stay_features(src.icu_stay(spark, d), src.stay_diagnosis(spark, d), _UNITS)


@query("predictions_join", """
    SELECT o_orderkey AS icustay_id, o_totalprice / 1000000.0::DOUBLE AS prediction,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y_true FROM orders WHERE o_orderkey % 7 <> 0""")
def predictions_join(spark, d):
    orders = src.table(spark, d, "orders")
    stay = F.concat(F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"),
                    F.lit("_timeseries.csv")).alias("stay")
    predictions = orders.select(
        stay,
        (F.col("o_totalprice") / 1000000.0).alias("prediction"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y_true"),
    )
    # Some stays have no id on file; their predictions drop out.
    stays = orders.filter(F.col("o_orderkey") % 7 != 0).select(stay, F.col("o_orderkey").alias("icustay_id"))
    return icu.rekey_predictions(predictions, stays)
