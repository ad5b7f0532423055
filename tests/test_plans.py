"""Physical-plan checks: pruning and pushdown reach the scan, shuffles are
the intended ones, no query pairs rows by cross product."""

import os

import pytest

import __spark_entry__ as E
from matchspan.operators.ranges import chosen_ranges
from matchspan.plans.explain import report
from matchspan.plans.match_queries import IGNORE_CFG
from matchspan.plans.registry import QUERIES
from matchspan.sources.tables import match_events

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_scan_prunes_and_pushes(spark):
    r = report(E.queries()["scan_parquet"](spark, SF))
    assert len(r.scans) == 1
    scan = r.scans[0]
    assert "LessThan(l_quantity,5.0)" in scan["PushedFilters"] and "EqualTo(l_returnflag,R)" in scan["PushedFilters"]
    assert scan["ReadSchema"].count(":") == 4  # 4 of lineitem's 11 columns
    assert not r.exchanges


def test_match_events_reads_only_needed_columns(spark):
    r = report(match_events(spark, SF))
    assert r.scans and all("event_id" not in s["ReadSchema"] and "value" not in s["ReadSchema"] for s in r.scans)


def test_match_pipeline_shuffles(spark):
    r = report(chosen_ranges(match_events(spark, SF), IGNORE_CFG))
    # (a, bucket), (b, bucket, spread), (a, bucket) chosen by us; the rest are
    # Spark's (the distinct of the first pass, and the small per-bucket summaries).
    assert r.exchanges["REPARTITION_BY_COL"] == 3
    assert not r.nested_loop_or_cartesian
    # the prepared rows (main path + two pruned, partially aggregated summaries); the
    # source itself was scanned once, to write them
    assert len(r.scans) == 3 and all("props" not in s["ReadSchema"] for s in r.scans)


def main_path_exchanges(df):
    """Every exchange, of whatever origin, on the path of the rows themselves
    (the left child of each join)."""
    node, n = df._jdf.queryExecution().executedPlan(), 0
    while True:
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            node = node.initialPlan()
            continue
        n += kind == "ShuffleExchangeExec"
        if node.children().isEmpty():
            return n
        node = node.children().apply(0)


def test_written_rows_are_exchanged_three_times_without_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert main_path_exchanges(chosen_ranges(match_events(spark, SF), IGNORE_CFG)) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_group_count_aggregates_before_the_shuffle(spark):
    text = report(E.queries()["group_count"](spark, SF)).text
    assert "partial_count" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products(spark, name):
    assert not report(E.queries()[name](spark, SF)).nested_loop_or_cartesian
