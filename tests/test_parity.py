"""Registered queries vs their DuckDB oracle SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.parity import duck, rows_of

@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", [k for k in entry.oracle_sql() if not k.startswith("op")])
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(entry.oracle_sql()[name])
    want, want_cols = rows_of(rel.columns, rel.fetchall())
    assert got_cols == want_cols
    assert got == want


def test_every_query_has_an_oracle():
    own = {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"}  # the others are tested in tests/llm
    assert own <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_table_queries_leave_nothing_behind(spark):
    before = {d.name for d in spark.catalog.listDatabases()}
    assert entry.queries()["quarantine_table"](spark, SF_SMALL).count() > 0
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["site_id", "event_date", "sessions", "avg_duration_seconds", "bounce_sessions", "bounce_rate"]
    assert df.count() > 0
