"""Match-range queries over ``match_events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EndReason, MatchConfig, UpdatePolicy
from ..operators import prepare, ranges
from ..operators.validate import reduce_and_validate, start_flag
from ..session import ensure_checkpoint_dir
from ..sources.tables import hot_user, match_events, tied_events
from .match_sql import HOT_MATCH_EVENTS_SQL, MATCH_EVENTS_SQL, TIED_MATCH_EVENTS_SQL, match_sql, payload_sql

# The two configurations exercised by the original tests: the module-level
# one (IGNORE policy plus both optional filters) and the end-to-end one
# (ASSUME_START, no optional filters).
STATUS_NAMES = {"start": 1, "update": 2, "end": 3}
IGNORE_CFG = (MatchConfig("a", "b", "t", "status", STATUS_NAMES, ["o1", "o2"], "v")
              .filter_null_a().filter_null_b_on_start())
ASSUME_CFG = MatchConfig("a", "b", "t", "status", STATUS_NAMES, ["o1", "o2"], "v",
                         update_policy=UpdatePolicy.ASSUME_START)
END_ONLY_CFG = MatchConfig("a", "b", "t", "status", STATUS_NAMES, ["o1", "o2"], "v",
                           end_reasons=[EndReason.NEXT_END_FOR_SAME_MATCH])


def q_match_ranges_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.match_ranges(match_events(spark, sf), IGNORE_CFG)


def q_match_ranges_assume_start(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.match_ranges(match_events(spark, sf), ASSUME_CFG)


def q_match_ranges_end_only(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.match_ranges(match_events(spark, sf), END_ONLY_CFG)


def q_match_ranges_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """Skew scenario: a third of all events under one key, which gets its own
    finer bucket width (any key above 1,000 rows counts as hot here)."""
    return ranges.match_ranges(match_events(spark, sf, user=hot_user()), ASSUME_CFG.with_hot_keys(1000))


def q_match_ranges_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges with the value and id of the event that started them."""
    return ranges.match_ranges(match_events(spark, sf, payload=("value", "event_id")), ASSUME_CFG, payload=["value", "event_id"])


def q_match_ranges_tied(spark: SparkSession, sf: str) -> DataFrame:
    """Skew scenario: a third of all events tie on one key and time (buckets of 500 rows)."""
    return ranges.match_ranges(tied_events(spark, sf), ASSUME_CFG.with_hot_keys(500))


def q_match_initialized(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.initialize(match_events(spark, sf), IGNORE_CFG)


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.initialize(match_events(spark, sf), ASSUME_CFG).withColumn("v", start_flag(ASSUME_CFG))


def q_match_reduce_by_a(spark: SparkSession, sf: str) -> DataFrame:
    x = _flagged(spark, sf)
    return reduce_and_validate(x, ASSUME_CFG, ["a", "t"], ["o1", "o2", "b"])


def q_match_valid_starts(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.mark_valid_starts(prepare.initialize(match_events(spark, sf), ASSUME_CFG), ASSUME_CFG)


def _stage(df: DataFrame) -> DataFrame:
    """Stage outputs are read by several branches of the next stage; write
    them to the checkpoint folder so the work before them runs once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def q_match_end_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.end_candidates(_stage(q_match_valid_starts(spark, sf)), ASSUME_CFG)


def q_match_final_end(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.choose_final_end(q_match_end_candidates(spark, sf), ASSUME_CFG)


def q_match_connected(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.connect_ranges(_stage(q_match_final_end(spark, sf)), ASSUME_CFG)


def q_status_enumerated(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.recode_status(match_events(spark, sf), IGNORE_CFG)


def q_filter_null_time(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.filter_null_time(match_events(spark, sf), IGNORE_CFG)


def q_filter_both_null(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.filter_both_null(match_events(spark, sf), IGNORE_CFG)


def q_filter_ignore_updates(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.filter_ignore_updates(prepare.recode_status(match_events(spark, sf), IGNORE_CFG), IGNORE_CFG)


def q_filter_null_a(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.filter_null_a(match_events(spark, sf), IGNORE_CFG)


def q_filter_start_null_b(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.filter_null_b_on_start(prepare.recode_status(match_events(spark, sf), IGNORE_CFG), IGNORE_CFG)


def q_next_event(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.next_event(prepare.initialize(match_events(spark, sf), IGNORE_CFG), IGNORE_CFG)


_ME = f"(\n{MATCH_EVENTS_SQL}) me"
_RECODE = ("CAST(CASE status WHEN 'start' THEN 1 WHEN 'update' THEN 2 WHEN 'end' THEN 3 END AS INTEGER)")
_FILTERS = ["null_a", "null_b_on_start"]

QUERIES = {
    "match_ranges_ignore": q_match_ranges_ignore,
    "match_ranges_assume_start": q_match_ranges_assume_start,
    "match_ranges_end_only": q_match_ranges_end_only,
    "match_ranges_hot_key": q_match_ranges_hot_key,
    "match_ranges_payload": q_match_ranges_payload,
    "match_ranges_tied": q_match_ranges_tied,
    "match_initialized": q_match_initialized,
    "match_reduce_by_a": q_match_reduce_by_a,
    "match_valid_starts": q_match_valid_starts,
    "match_end_candidates": q_match_end_candidates,
    "match_final_end": q_match_final_end,
    "match_connected": q_match_connected,
    "status_enumerated": q_status_enumerated,
    "filter_null_time": q_filter_null_time,
    "filter_both_null": q_filter_both_null,
    "filter_ignore_updates": q_filter_ignore_updates,
    "filter_null_a": q_filter_null_a,
    "filter_start_null_b": q_filter_start_null_b,
    "next_event": q_next_event,
}

ORACLE = {
    "match_ranges_ignore": match_sql("ignore", _FILTERS),
    "match_ranges_assume_start": match_sql("assume_start", []),
    "match_ranges_end_only": match_sql("ignore", [], reasons=[1]),
    "match_ranges_hot_key": match_sql("assume_start", [], events_sql=HOT_MATCH_EVENTS_SQL),
    "match_ranges_payload": payload_sql("assume_start", [], ["value", "event_id"]),
    "match_ranges_tied": match_sql("assume_start", [], events_sql=TIED_MATCH_EVENTS_SQL),
    "match_initialized": match_sql("ignore", _FILTERS, upto="init"),
    "match_reduce_by_a": match_sql("assume_start", [], upto="p1"),
    "match_valid_starts": match_sql("assume_start", [], upto="valid"),
    "match_end_candidates": match_sql("assume_start", [], upto="cands"),
    "match_final_end": match_sql("assume_start", [], upto="final"),
    "match_connected": match_sql("assume_start", []),
    "status_enumerated": f"SELECT a, b, {_RECODE} AS status, t, o1, o2 FROM {_ME}",
    "filter_null_time": f"SELECT * FROM {_ME} WHERE a IS NOT NULL AND t IS NOT NULL",
    "filter_both_null": f"SELECT * FROM {_ME} WHERE a IS NOT NULL OR b IS NOT NULL",
    "filter_ignore_updates": f"SELECT * FROM (SELECT a, b, {_RECODE} AS status, t, o1, o2 FROM {_ME}) x "
                             "WHERE status IN (1, 3)",
    "filter_null_a": f"SELECT * FROM {_ME} WHERE a IS NOT NULL",
    "filter_start_null_b": f"SELECT * FROM (SELECT a, b, {_RECODE} AS status, t, o1, o2 FROM {_ME}) x "
                           "WHERE b IS NOT NULL OR status <> 1",
    "next_event": f"""
SELECT a, b, status, t, o1, o2,
       lead(t) OVER w AS next_t, lead(status) OVER w AS next_status, lead(b) OVER w AS next_b
FROM ({match_sql("ignore", _FILTERS, upto="init")}) i
WINDOW w AS (PARTITION BY a ORDER BY t, status DESC NULLS LAST, b ASC NULLS LAST,
             o1 ASC NULLS LAST, o2 ASC NULLS LAST)""",
}
