"""The adapter views as SQL, for the oracle."""

from __future__ import annotations

from cohortloom.functions import codes
from cohortloom.sources.adapters import DX_NAMES, LAB_NAMES, MED_NAMES


def values(rows: list[tuple]) -> str:
    """A SQL VALUES list."""
    cell = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def in_list(names: list[str]) -> str:
    return ", ".join("'" + n + "'" for n in names)


def _pick(key: str, size: int, names: list[str], other: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE ({key}) % {size} {arms} ELSE concat('{other}', CAST(({key}) % {size} AS VARCHAR)) END"


def unit(key: str) -> str:
    """SQL form of `functions.columns.hash_unit`."""
    return f"(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) / 4294967296.0)"


_LINES = "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"

VIEWS: dict[str, tuple[list[str], str]] = {
    "clinical_events": ([], f"""
        SELECT o.o_custkey AS patient_id,
               concat(CASE l.l_partkey % 3 WHEN 0 THEN 'DIAG' WHEN 1 THEN 'LAB' ELSE 'DRUG' END,
                      CAST(l.l_partkey % 60 AS VARCHAR)) AS event_id,
               CAST(o.o_orderdate AS DATE) AS event_time,
               CASE WHEN l.l_returnflag = 'N' AND l.l_linenumber = 1 THEN NULL ELSE l.l_quantity END AS value
        FROM {_LINES}"""),
    "mortality": ([], """
        SELECT o_custkey AS patient_id, max(CAST(o_orderdate AS DATE)) AS death_time, 1 AS label
        FROM orders WHERE o_custkey % 4 = 0 GROUP BY o_custkey"""),
    "cohort_events": (["clinical_events", "mortality"], """
        SELECT e.*, CASE WHEN m.patient_id IS NULL THEN 'alive' ELSE 'dead' END AS cohort
        FROM clinical_events e LEFT JOIN mortality m ON e.patient_id = m.patient_id"""),
    "index_date": (["cohort_events", "mortality"], """
        SELECT patient_id, max(event_time) AS index_date, 0 AS label
        FROM cohort_events WHERE cohort = 'alive' GROUP BY patient_id
        UNION ALL SELECT patient_id, CAST(death_time - INTERVAL 30 DAY AS DATE), 1 FROM mortality"""),
    "timed": (["clinical_events", "index_date"], """
        SELECT e.patient_id, e.event_id, e.value, i.label,
               CAST(date_diff('day', e.event_time, i.index_date) AS INTEGER) AS time_difference
        FROM clinical_events e JOIN index_date i ON e.patient_id = i.patient_id"""),
    "windowed": (["timed"], """
        SELECT * FROM timed WHERE time_difference BETWEEN 0 AND 2000 AND value IS NOT NULL"""),
    "feature_counts": (["windowed"], """
        SELECT patient_id, event_id, count(*) AS feature_value, sum(value) AS value_sum
        FROM windowed GROUP BY patient_id, event_id"""),
    "feature_map": (["feature_counts"], """
        SELECT row_number() OVER (ORDER BY event_id) - 1 AS idx, event_id
        FROM (SELECT DISTINCT event_id FROM feature_counts)"""),
    "features": (["feature_counts", "feature_map"], """
        SELECT f.patient_id, m.idx, f.feature_value
        FROM feature_counts f JOIN feature_map m ON f.event_id = m.event_id"""),
    "normalized": (["features"], """
        SELECT patient_id, idx, feature_value / CAST(max(feature_value) OVER (PARTITION BY idx) AS DOUBLE) AS value
        FROM features"""),
    "sparse": (["normalized", "index_date"], """
        SELECT n.patient_id, any_value(i.label) AS label,
               string_agg(printf('%d:%.6f', n.idx, n.value), ' ' ORDER BY n.idx) AS line
        FROM normalized n JOIN index_date i ON n.patient_id = i.patient_id GROUP BY n.patient_id"""),
    "diagnostic": ([], f"""
        SELECT o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) AS date,
               {_pick('l.l_partkey', 97, DX_NAMES, '4.')} AS code FROM {_LINES}"""),
    "medication": ([], f"""
        SELECT o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) + l.l_linenumber AS date,
               {_pick('l.l_partkey * 7 + l.l_linenumber', 83, MED_NAMES, 'Drug')} AS medicine FROM {_LINES}"""),
    "lab_result": ([], f"""
        SELECT o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) AS date,
               {_pick('l.l_partkey + l.l_linenumber', 41, LAB_NAMES, 'Lab')} AS test_name,
               l.l_quantity * CASE WHEN (l.l_partkey + l.l_linenumber) % 41 = 2 THEN 0.25::DOUBLE
                                   ELSE 2.75::DOUBLE END AS value
        FROM {_LINES}"""),
    "graph_events": ([], f"""
        SELECT patient_id, kind, item, date, value FROM (
          SELECT o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) AS date, l.l_quantity AS value,
                 p.p_type, p.p_name, concat(p.p_brand, '.', CAST(p.p_partkey AS VARCHAR)) AS code
          FROM {_LINES} JOIN part p ON p.p_partkey = l.l_partkey) t,
        LATERAL (VALUES ('lab', t.p_type), ('med', t.p_name), ('diag', t.code)) v(kind, item)"""),
    "patient_items": (["graph_events"], "SELECT DISTINCT patient_id, concat(kind, ':', item) AS item FROM graph_events"),
    "icu_stay": ([], """
        SELECT o_orderkey AS stay_id, o_custkey AS subject_id, CAST(o_orderdate AS DATE) AS intime,
               o_orderpriority AS care_unit FROM orders"""),
    "stay_diagnosis": ([], """
        SELECT l_orderkey AS stay_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag FROM lineitem"""),
    "matrix_entries": ([], """
        SELECT vec_id AS row, CAST(i AS INTEGER) AS col, abs(CAST(embedding[i + 1] AS DOUBLE)) AS value
        FROM embeddings, range(64) r(i)"""),
    "signed_entries": ([], """
        SELECT vec_id AS row, CAST(i AS INTEGER) AS col, CAST(embedding[i + 1] AS DOUBLE) AS value
        FROM embeddings, range(64) r(i)"""),
    "scores": ([], """
        SELECT id, y, (id * 37 % 50 + y * 20) / 70.0::DOUBLE AS s1, (id * 53 % 40 + y * 5) / 45.0::DOUBLE AS s2,
               (id * 71 % 97) / 97.0::DOUBLE AS s3
        FROM (SELECT c_custkey AS id, CASE WHEN (c_custkey * 7919) % 100 < 30 THEN 1 ELSE 0 END AS y FROM customer)"""),
    "code_sets": ([], f"""
        SELECT * FROM (VALUES {values([(name, code) for name, items in codes.CODE_SETS.items() for code in items])})
        v(set_name, code)"""),
    "lab_rules": ([], f"SELECT * FROM (VALUES {values(codes.ABNORMAL_LABS)}) v(test, op, threshold)"),
}


def with_views(names: str, body: str, extra: str = "") -> str:
    """`body` after a WITH clause that defines the named views and what they are built from."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in VIEWS[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    ctes = [f"{name} AS ({VIEWS[name][1].strip()})" for name in ordered]
    if extra:
        ctes.append(extra.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
