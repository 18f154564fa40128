"""The registered corpus queries on the small tables."""

import pytest

import __spark_entry__ as E
from signalyard.llm.queries import ORACLE, QUERIES
from tools.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_on_whole_tables(spark, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    table = {"op4": "pages", "op11": "embeddings", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert len(rows) == n or name.startswith("op1_") and len(rows) >= n
    if name in ORACLE:
        res = duck(SF).execute(ORACLE[name])
        cols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(cols)
        assert digest(df.columns, rows) == digest(cols, res.fetchall())
