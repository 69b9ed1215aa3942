"""Code lists and thresholds of the type 2 diabetes phenotype."""

from __future__ import annotations

# The published phenotype's code lists. Spelling and spacing are part of the rule.
T1DM_DX = [
    "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33", "250.41", "250.43",
    "250.51", "250.53", "250.61", "250.63", "250.71", "250.73", "250.81", "250.83", "250.91", "250.93",
]
T2DM_DX = [
    "250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7", "250.72", "250.6",
    "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02",
]
T1DM_MED = [
    "lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente", "insulin nph",
    "insulin reg", "insulin,ultralente",
]
T2DM_MED = [
    "chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol", "glucotrol xl",
    "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide", "diabeta", "glimepiride", "amaryl",
    "repaglinide", "prandin", "nateglinide", "metformin", "rosiglitazone", "pioglitazone", "acarbose",
    "miglitol", "sitagliptin", "exenatide", "tolazamide", "acetohexamide", "troglitazone", "tolbutamide",
    "avandia", "actos",
]
DM_RELATED_DX = [
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "684", "648.0", "648.00",
    "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "v77.1", "256.4", "250.*", "250",
    "250.0", "250.00", "250.01",
]
GLUCOSE_LABS = [
    "fasting glucose", "fasting blood glucose", "fasting plasma glucose", "glucose", "glucose, serum",
    "glucose 2hr post dose", "glucose 3hr",
]
# Fixed values: (test, comparison, limit) beyond which a result counts as abnormal.
ABNORMAL_LABS = [
    ("hba1c", ">=", 6.0),
    ("hemoglobin a1c", ">=", 6.0),
    ("fasting glucose", ">=", 110.0),
    ("fasting blood glucose", ">=", 110.0),
    ("fasting plasma glucose", ">=", 110.0),
    ("glucose", ">", 110.0),
    ("glucose, serum", ">", 110.0),
]

CODE_SETS = {
    "t1dm_dx": T1DM_DX,
    "t2dm_dx": T2DM_DX,
    "t1dm_med": T1DM_MED,
    "t2dm_med": T2DM_MED,
    "dm_related_dx": DM_RELATED_DX,
    "glucose_lab": GLUCOSE_LABS,
}
