"""The driver contract: entry(), queries() and oracle_sql() against DuckDB on sf0.001."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from matchspan.plans.registry import ORACLE, QUERIES
from matchspan.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def test_keys_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) == set(ORACLE) and len(ORACLE) >= 60
    assert set(QUERIES) <= set(q) and set(ORACLE) <= set(o)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["a", "b", "status", "t", "o1", "o2", "v", "start_time", "final_end_time", "final_end_reason"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    got = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    idx = {c: i for i, c in enumerate(ocols)}
    exp = sorted((tuple(_norm(r[idx[c]]) for c in sorted(cols)) for r in res.fetchall()), key=repr)
    assert got == exp


@pytest.mark.parametrize("name", ["filter_null_a", "timestamp_difference", "match_ranges_assume_start"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
