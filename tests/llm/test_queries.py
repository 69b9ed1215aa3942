"""The registered queries on edge cases, empty tables and the smallest tables, against their SQL where there is one."""

import pytest

from cohortloom.llm.plans import ORACLES, QUERIES
from tests.compare import differences, duck
from tests.llm import edges


def agree(spark, folder, name):
    got = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in got.collect()]
    assert differences(got.columns, rows, duck(folder), ORACLES[name]) is None
    return rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_edges_against_sql(spark, tmp_path, name):
    assert agree(spark, edges.write(tmp_path), name)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_smallest_tables_against_sql(spark, name):
    assert agree(spark, "/root/testdata/sf0.001", name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    folder = edges.write(tmp_path, rows=[], items=[], pages=[], labels=[], vectors=[])
    assert QUERIES[name](spark, folder).collect() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_whitening"}))
def test_edges_run(spark, tmp_path, name):
    """A row for every input row, whatever it holds."""
    folder = edges.write(tmp_path, rows=edges.documents(longest=150_000))
    got = QUERIES[name](spark, folder)
    table, key = ("pages", "page_id") if "page_id" in got.columns else ("documents", "doc_id")
    want = sorted(r[0] is not None and r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect())
    assert sorted(r[0] is not None and r[0] for r in got.select(key).collect()) == want
