"""Tier 2: every registered query against its DuckDB twin (row count,
column names, order-insensitive value hash), on the small test tables."""

import os

import pytest

import __spark_entry__ as E
from signalyard.plans.jobs import QUERIES
from tools.oracle_check import digest, duck
from tools.oracle_jobs import ORACLE

from .conftest import SF_SMALL

SF = os.environ.get("ORACLE_SF_DIR", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    # zoned timestamps would be rendered in the Python process's zone
    assert not any(f.dataType.typeName() == "timestamp" for f in df.schema.fields), df.schema
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows) == digest(d_cols, d_rows)
    kinds = lambda cols, rows: {c: {type(r[i]).__name__ for r in rows if r[i] is not None}
                                for i, c in enumerate(cols)}
    assert kinds(s_cols, s_rows) == kinds(d_cols, d_rows)


@pytest.mark.parametrize("name,by", [("logs_union", ["source", "start_date"]), ("pred_vs_real", ["record_date"]),
                                     ("weather_series", ["record_date"]), ("news_series", ["record_date", "source"]),
                                     ("distinct_dates", ["day"])])
def test_ordered_results_are_in_order(spark, name, by):
    keys = [tuple(r[c] for c in by) for r in QUERIES[name](spark, SF).collect()]
    assert keys == sorted(keys)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["record_date", "source", "count"]
