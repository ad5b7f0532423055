"""Queries that SQL can express, against DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from matchspan.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_registered():
    q = E.queries()
    assert set(QUERIES) | {"pipeline"} <= set(q)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    norm = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    assert sorted((norm(r) for r in df.select(*cols).collect()), key=repr) == sorted(map(norm, res.fetchall()), key=repr)
