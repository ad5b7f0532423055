"""Queries for the DataFrame operations around the match-range core
(columns, maps, explode family, aggregates, windows, null handling, quality,
sources and sinks, partitioning, streaming), each over the driver tables,
with its DuckDB oracle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import collections as C
from ..functions import nulls as N
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import partitioning as P
from ..operators import quality as Q
from ..operators import row_checks as RC
from ..operators.windows import range_frame_sum
from ..session import scratch_path
from ..sources import catalog, sinks
from ..sources.random_table import random_rows
from ..sources.tables import hot_user, props_k, read_table, table_path
from ..streaming import watermark


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


# -- projections, scalars ----------------------------------------------------

def q_add_columns(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return S.add_columns(li, "l_partkey", "l_suppkey", "sum")


def q_modulo_projection(spark, sf):
    return S.modulo_projection(_t(spark, sf, "events"), "event_id", 5, "ts")


def q_project_subset(spark, sf):
    o = _t(spark, sf, "orders")
    o = o.select("*", (F.col("o_totalprice") > F.lit(100000.0)).alias("big"))
    return o.drop("o_totalprice", "o_orderpriority", "o_orderdate").select("o_orderkey", "o_custkey", "o_orderstatus", "big")


def q_struct_fields(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", F.struct("p_size", "p_brand", "p_type").alias("s"))
    return C.struct_fields(p, "s", ["p_size", "p_brand"], keep=["p_partkey"])


def q_timestamp_difference(spark, sf):
    e = _t(spark, sf, "events")
    return e.select(
        "event_id",
        S.timestamp_diff_micros(F.col("ts"), F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("micros_into_day"),
        S.timestamp_diff_micros(F.date_trunc("month", "ts").cast("timestamp_ntz"), F.col("ts"))
        .alias("micros_from_month_start"),
    )


# -- nulls --------------------------------------------------------------------

def _events_with_nulls(spark, sf):
    e = _t(spark, sf, "events")
    k = F.col("event_id")
    return e.select(
        "event_id",
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("col1"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("value")).alias("col2"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("col3"),
    )


_EVENTS_NULLS_SQL = """(SELECT event_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS col1,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS col2,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS col3 FROM events) en"""


def q_na_drop(spark, sf):
    return N.drop_null_rows(_events_with_nulls(spark, sf))


def q_na_fill(spark, sf):
    return N.fill_nulls(_events_with_nulls(spark, sf), {"col1": 0, "col2": 1.0, "col3": "unknown"})


def q_na_replace(spark, sf):
    return N.replace_values(_events_with_nulls(spark, sf), 1, 100)


# -- maps, arrays, explode ----------------------------------------------------

def _priority_arrays(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    arr = (F.when(k % 7 == 0, F.lit(None).cast("array<string>"))
           .when(k % 7 == 1, F.array().cast("array<string>"))
           .otherwise(F.split(F.col("o_orderpriority"), "-")))
    return o.select("o_orderkey", arr.alias("arr"))


_ARR_SQL = """(SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            WHEN o_orderkey % 7 = 1 THEN CAST([] AS VARCHAR[])
            ELSE string_split(o_orderpriority, '-') END AS arr FROM orders) pa"""


def q_explode_array(spark, sf):
    return C.explode_array(_priority_arrays(spark, sf), ["o_orderkey"], "arr")


def q_explode_outer_array(spark, sf):
    return C.explode_array(_priority_arrays(spark, sf), ["o_orderkey"], "arr", outer=True)


def q_posexplode_array(spark, sf):
    return C.explode_array(_priority_arrays(spark, sf), ["o_orderkey"], "arr", outer=True, with_pos=True)


def _part_maps(spark, sf):
    p = _t(spark, sf, "part")
    s = F.col("p_size")
    m = (F.when(s % 10 == 0, F.lit(None).cast("map<string,string>"))
         .when(s % 10 == 1, F.create_map().cast("map<string,string>"))
         .otherwise(C.map_with_literal_keys([("brand", "p_brand"), ("type", "p_type")])))
    return p.select("p_partkey", m.alias("m"))


_MAP_ROWS_SQL = """
SELECT p_partkey, 0 AS pos, 'brand' AS key, p_brand AS value FROM part WHERE p_size % 10 NOT IN (0, 1)
UNION ALL SELECT p_partkey, 1, 'type', p_type FROM part WHERE p_size % 10 NOT IN (0, 1)
UNION ALL SELECT p_partkey, NULL, NULL, NULL FROM part WHERE p_size % 10 IN (0, 1)"""


def q_explode_outer_map(spark, sf):
    return C.explode_map(_part_maps(spark, sf), ["p_partkey"], "m", outer=True)


def q_posexplode_map(spark, sf):
    return C.explode_map(_part_maps(spark, sf), ["p_partkey"], "m", outer=True, with_pos=True)


def q_map_build(spark, sf):
    p = _t(spark, sf, "part")
    m = C.map_with_literal_keys([("name", "p_name"), ("brand", "p_brand")])
    by_value = C.map_with_column_keys([("p_brand", F.lit("x"))])
    return p.select(
        "p_partkey",
        C.lookup(m, "name").alias("name"),
        C.lookup(m, "brand").alias("brand"),
        F.size(m).alias("n"),
        F.map_keys(by_value).getItem(0).alias("value_key"),
    )


def q_map_lookup(spark, sf):
    e = _t(spark, sf, "events")
    m = F.from_json(F.col("props"), "map<string,int>")
    codes = F.create_map(F.lit("click"), F.lit(1), F.lit("view"), F.lit(2))
    return e.select(
        "event_id",
        C.lookup(m, "k").alias("k"),
        C.lookup(m, "missing").alias("missing"),
        C.lookup(F.array("user_id", "event_id"), 2).alias("second"),
        C.lookup(codes, F.col("event_type")).alias("code"),
    )


def q_array_append(spark, sf):
    e = _t(spark, sf, "events")
    first = F.array(F.struct(F.col("event_id").alias("id"), F.lit("first").alias("tag")))
    arr = C.append_struct(first, F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("tag")))
    return e.select("event_id", F.size(arr).alias("n"),
                    arr.getItem(1).getField("id").alias("last_id"),
                    arr.getItem(1).getField("tag").alias("last_tag"))


def q_argmin_per_group(spark, sf):
    p = _t(spark, sf, "part")
    m = C.map_with_literal_keys([
        ("size", F.col("p_size").cast("long")),
        ("price", F.col("p_retailprice").cast("long")),
        ("key_mod", F.col("p_partkey") % 97),
    ])
    return C.argmin_over_map(p.select(F.col("p_brand").alias("store"), m.alias("sales")), "store", "sales")


# -- aggregates, windows ------------------------------------------------------

def q_group_count(spark, sf):
    return A.group_count(_t(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


def q_distinct_rows(spark, sf):
    return A.distinct_rows(_t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


def q_dedup_subset(spark, sf):
    return A.dedup_keep_first(_t(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], ["o_orderkey"])


def q_dedup_single(spark, sf):
    return A.distinct_values(_t(spark, sf, "orders"), "o_orderpriority")


def q_windowed_value_set(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return A.value_set_size(li, ["l_orderkey"], "l_returnflag", "n_flags").drop("l_returnflag")


def q_value_set(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    sets = A.value_set(li, ["l_orderkey"], "l_returnflag", "flags")
    return sets.select("l_orderkey", "l_linenumber", F.array_join("flags", ",").alias("flags"), F.get("flags", F.lit(0)).alias("first_flag"))


def q_range_frame_sum(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return range_frame_sum(p, ["p_brand"], "p_size", "p_size", following=1, out="sum")


def q_range_frame_sum_wide(spark, sf):
    """The next day's sum of k for each event of a user; a third of them are one user's."""
    ev = _t(spark, sf, "events").select("event_id", hot_user().alias("user_id"), "ts", props_k().alias("k"))
    return range_frame_sum(ev, ["user_id"], "ts", "k", following=86_400, out="next_day")


# -- set operations and quality -----------------------------------------------

def _diff_inputs(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    k = F.col("o_orderkey")
    actual = (o.where(k % 10 != 3)
              .unionByName(o.where(k % 10 == 5))
              .unionByName(o.where(k % 10 == 7).withColumn("o_orderstatus", F.lit("X"))))
    return o, actual


_DIFF_SQL = """
WITH e AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders),
     a AS (SELECT * FROM e WHERE o_orderkey % 10 <> 3
           UNION ALL SELECT * FROM e WHERE o_orderkey % 10 = 5
           UNION ALL SELECT o_orderkey, o_custkey, 'X' FROM e WHERE o_orderkey % 10 = 7)
SELECT 'expected_only' AS side, * FROM (SELECT * FROM e EXCEPT{all} SELECT * FROM a)
UNION ALL
SELECT 'actual_only' AS side, * FROM (SELECT * FROM a EXCEPT{all} SELECT * FROM e)"""


def q_frame_diff(spark, sf):
    e, a = _diff_inputs(spark, sf)
    return Q.frame_diff(e, a)


def q_frames_equal(spark, sf):
    """Surplus rows of unequal frames, and of a frame and itself in another order."""
    e, a = _diff_inputs(spark, sf)
    pairs = {"changed": (e, a), "reordered": (e, e.select(*reversed(e.columns)))}
    out = []
    for name, (x, y) in pairs.items():
        same, n = Q.frames_equal(x, y)
        out.append((name, same, n["expected_only"], n["actual_only"]))
    return spark.createDataFrame(out, "pair string, same boolean, expected_only long, actual_only long")


def q_frame_diff_multiset(spark, sf):
    e, a = _diff_inputs(spark, sf)
    return Q.frame_diff(e, a, multiset=True)


def q_frame_diff_by_digest(spark, sf):
    """As the multiset difference; only rows in buckets with unequal digests are shuffled."""
    e, a = _diff_inputs(spark, sf)
    return Q.frame_diff(e, a, multiset=True, digest_buckets=4096)


def q_frame_changes(spark, sf):
    e, a = _diff_inputs(spark, sf)
    changes = Q.frame_changes(e, a.distinct(), ["o_orderkey"])
    return changes.select("o_orderkey", "change", F.array_join("columns", ",").alias("columns"))


_ROW_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("rec", T.StructType([T.StructField("amount", T.DoubleType()), T.StructField("at", T.TimestampNTZType())])),
    T.StructField("tags", T.ArrayType(T.IntegerType())),
    T.StructField("extra", T.MapType(T.StringType(), T.IntegerType())),
])


def _text_rows(spark, sf):
    """Events as nested text, some of which does not convert."""
    k = F.col("event_id")
    text = lambda c: F.col(c).cast("string")
    return _t(spark, sf, "events").select(
        "event_id",
        F.struct(F.when(k % 5 == 0, F.concat(F.lit("x"), text("value"))).otherwise(text("value")).alias("amount"),
                 F.when(k % 7 == 0, F.lit("never")).otherwise(text("ts")).alias("at")).alias("rec"),
        F.array(F.lit("12"), F.when(k % 3 == 0, F.col("event_type")), F.lit("")).alias("tags"),
        F.create_map(F.lit("a"), F.when(k % 6 == 0, F.lit("1.5x")).otherwise(F.lit("3")), F.lit("b"), F.lit(None).cast("string")).alias("extra"))


def q_rows_checked(spark, sf):
    checked = RC.check_rows(_text_rows(spark, sf), _ROW_SCHEMA)
    return checked.select("event_id", F.size("violations").cast("long").alias("n"), F.array_join(F.transform("violations", lambda v: v["path"]), ",").alias("paths"))


def q_rows_split(spark, sf):
    """Converted rows and rejected ones with the first reason."""
    good, rejected = RC.split_rows(_text_rows(spark, sf), _ROW_SCHEMA)
    first = F.get("violations", F.lit(0))
    return good.select("event_id", F.lit(True).alias("good"), F.col("rec.at").alias("at"), F.get("tags", F.lit(0)).alias("tag"), F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("event_id", F.lit(False).alias("good"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(None).cast("int").alias("tag"), F.concat(first["path"], F.lit(" "), first["wanted"]).alias("reason")))


_LABEL_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
    T.StructField("toxic", T.IntegerType()), T.StructField("note", T.StringType()),
])


def q_conform_to_schema(spark, sf):
    return Q.conform_to_schema(_t(spark, sf, "labels").select("doc_id", "quality"), _LABEL_SCHEMA)


def q_conform_with_defaults(spark, sf):
    lab = _t(spark, sf, "labels")
    lab = lab.select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.lit(None)).otherwise(F.col("quality")).alias("quality"))
    return Q.conform_to_schema(lab, _LABEL_SCHEMA, defaults={"toxic": 0, "note": "n/a"})


def q_validate_schema(spark, sf):
    e = _t(spark, sf, "events")
    k = F.col("event_id")
    d = e.select(
        F.when(k % 9 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("s_int"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.col("value").cast("string")).alias("s_double"),
        F.when(k % 6 == 0, F.lit("not a time")).otherwise(F.col("ts").cast("string")).alias("s_ts"),
    )
    Q.validate_schema(d, T.StructType([T.StructField(c, T.StringType()) for c in ("s_int", "s_double", "s_ts")]))
    return Q.type_violations(d, {"s_int": "bigint", "s_double": "double", "s_ts": "timestamp"})


# -- partitioning, per-partition work ----------------------------------------

def q_repartition_by_key(spark, sf):
    c = P.repartition_by_key(_t(spark, sf, "customer"), 10, ["c_nationkey", "c_mktsegment"])
    return P.key_placement(c, ["c_nationkey", "c_mktsegment"])


def q_partition_stats(spark, sf):
    stats = P.partition_stats(_t(spark, sf, "events"), "value")
    return stats.agg(F.sum("rows").alias("rows"), F.round(F.sum("total"), 2).alias("total"))


def q_partition_files(spark, sf):
    """Files that the tasks wrote themselves, read back by the list of those that count."""
    ev, folder = _t(spark, sf, "events").select("event_id", "user_id", "event_type"), scratch_path(spark, "arrow-files")
    listed = P.write_arrow_files(ev.repartition("user_id"), folder)
    return P.read_arrow_files(listed, folder, ev.schema)


# -- sources and sinks --------------------------------------------------------

def q_scan_parquet(spark, sf):
    li = _t(spark, sf, "lineitem")
    return (li.where((F.col("l_quantity") < 5) & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_quantity"))


def q_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "customer_by_segment")
    sinks.write_partitioned(_t(spark, sf, "customer"), path, ["c_mktsegment", "c_nationkey"])
    back = sinks.read_parquet(spark, path, _t(spark, sf, "customer").schema)
    return A.group_count(back, ["c_mktsegment", "c_nationkey"])


def q_partition_overwrite(spark, sf):
    """One segment's partition is rewritten; the others stay as they were."""
    path, c = scratch_path(spark, "customer_rewritten"), _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    sinks.write_partitioned(c, path, ["c_mktsegment"])
    sinks.overwrite_partitions(c.where("c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0").withColumn("c_nationkey", F.col("c_nationkey") + 100), path, ["c_mktsegment"])
    return sinks.read_parquet(spark, path, c.schema)


def q_sql_over_partitions(spark, sf):
    """SQL over a catalog table that knows its partitions."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    path, name = scratch_path(spark, "customer_parts"), f"customer_parts_{uuid.uuid4().hex}"
    sinks.write_partitioned(c, path, ["c_mktsegment"])
    catalog.register_partitioned_table(spark, name, path, c.schema, ["c_mktsegment"])
    return spark.sql(f"SELECT c_nationkey, count(*) AS n FROM {name} WHERE c_mktsegment = 'MACHINERY' GROUP BY c_nationkey")


def q_sql_over_table(spark, sf):
    name = f"customer_ext_{uuid.uuid4().hex}"
    catalog.register_parquet_table(spark, name, table_path(sf, "customer"))
    return spark.sql(f"""
        SELECT c_mktsegment, count(*) AS n, min(c_acctbal) AS min_bal, max(c_acctbal) AS max_bal
        FROM {name} GROUP BY c_mktsegment""")


def q_binary_roundtrip(spark, sf):
    path = scratch_path(spark, "documents_binary")
    d = _t(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("binaryData"))
    sinks.write_binary(d, path)
    back = spark.read.load(path)
    return back.select("doc_id", F.length("binaryData").alias("n_bytes"), F.md5("binaryData").alias("md5"))


def q_sequence_roundtrip(spark, sf):
    path = scratch_path(spark, "conversations_seq")
    c = _t(spark, sf, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"),
        F.col("text").cast("binary").alias("payload"))
    sinks.write_sequence(c, "key", "payload", path)
    back = sinks.read_sequence(spark, path)
    return back.select("key", F.length("payload").alias("n_bytes"), F.md5("payload").alias("md5"))


def q_text_roundtrip(spark, sf):
    path = scratch_path(spark, "orders_text")
    o = _t(spark, sf, "orders").select(
        F.concat_ws(" ", F.col("o_orderpriority"), F.col("o_orderkey").cast("string")).alias("line"))
    sinks.write_text(o, "line", path)
    return sinks.read_text(spark, path)


def _draw_sql(key: str, seed: int, n: int) -> str:
    m = 2_147_483_647
    return f"((({key} * 48271 + {seed}) % {m}) * 69621 + {seed}) % {m} % {n}"


_RANDOM_SQL = f"""
WITH d AS (SELECT {_draw_sql('c_custkey', 7 + 7919, 1000)} AS a, {_draw_sql('c_custkey', 7 + 2 * 7919, 5)} AS b,
    {_draw_sql('c_custkey', 7 + 3 * 7919, 101)} AS c FROM customer),
names AS (SELECT r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS i FROM region)
SELECT 'some_' || lpad(CAST(a AS VARCHAR), 3, '0') AS country, r_name AS username, CAST(c AS INTEGER) AS id
FROM d JOIN names ON i = b"""


def q_random_table(spark, sf):
    schema = T.StructType([T.StructField("country", T.StringType()), T.StructField("username", T.StringType()),
                           T.StructField("id", T.IntegerType())])
    # the drawn names are those of the region table, which has five rows at any scale
    value_sets = {"username": [r["r_name"] for r in _t(spark, sf, "region").orderBy("r_regionkey").collect()]}
    driver = _t(spark, sf, "customer").select("c_custkey")
    return random_rows(driver, schema, value_sets, seed=7)


# -- streaming ----------------------------------------------------------------

def q_stream_watermark_events(spark, sf):
    base = scratch_path(spark, "events_stream")
    schema = _t(spark, sf, "events").schema
    stream = watermark.events_with_watermark(spark, table_path(sf, "events"), schema)
    watermark.run_available_now(stream, base + "/out", base + "/ckpt")
    back = spark.read.parquet(base + "/out")
    return back.select("event_id", "value", "ts", F.unix_micros("time").alias("time_us"))


def q_stream_window_totals(spark, sf):
    """Daily totals of a stream without repeated events, each put out once its day is
    behind the watermark."""
    base = scratch_path(spark, "events_totals")
    stream = watermark.events_with_watermark(spark, table_path(sf, "events"), _t(spark, sf, "events").schema)
    totals = watermark.window_totals(watermark.first_within_watermark(stream, ["event_id"]), "1 day", ["value"], "event_id")
    watermark.run_available_now(totals, base + "/out", base + "/ckpt")
    back = spark.read.schema(totals.schema).parquet(base + "/out")
    return back.select(F.unix_micros("start").alias("start_us"), "value", "n", "total")


_REJECTED_SQL = """
WITH d AS (SELECT event_id, ts, list_filter([
    CASE WHEN event_id % 5 = 0 AND value IS NOT NULL THEN {'path': 'rec.amount', 'wanted': 'double'} END,
    CASE WHEN event_id % 7 = 0 THEN {'path': 'rec.at', 'wanted': 'timestamp_ntz'} END,
    CASE WHEN event_id % 3 = 0 AND event_type IS NOT NULL THEN {'path': 'tags[1]', 'wanted': 'int'} END,
    CASE WHEN event_id % 6 = 0 THEN {'path': 'extra{a}', 'wanted': 'int'} END], lambda x: x IS NOT NULL) AS v FROM events)
"""


QUERIES = {
    "add_columns": q_add_columns,
    "modulo_projection": q_modulo_projection,
    "project_subset": q_project_subset,
    "struct_fields": q_struct_fields,
    "timestamp_difference": q_timestamp_difference,
    "na_drop": q_na_drop,
    "na_fill": q_na_fill,
    "na_replace": q_na_replace,
    "explode_array": q_explode_array,
    "explode_outer_array": q_explode_outer_array,
    "posexplode_array": q_posexplode_array,
    "explode_outer_map": q_explode_outer_map,
    "posexplode_map": q_posexplode_map,
    "map_build": q_map_build,
    "map_lookup": q_map_lookup,
    "array_append": q_array_append,
    "argmin_per_group": q_argmin_per_group,
    "group_count": q_group_count,
    "distinct_rows": q_distinct_rows,
    "dedup_subset": q_dedup_subset,
    "dedup_single": q_dedup_single,
    "windowed_value_set": q_windowed_value_set,
    "value_set": q_value_set,
    "range_frame_sum": q_range_frame_sum,
    "range_frame_sum_wide": q_range_frame_sum_wide,
    "frames_equal": q_frames_equal,
    "frame_diff": q_frame_diff,
    "frame_diff_multiset": q_frame_diff_multiset,
    "conform_to_schema": q_conform_to_schema,
    "conform_with_defaults": q_conform_with_defaults,
    "validate_schema": q_validate_schema,
    "repartition_by_key": q_repartition_by_key,
    "partition_stats": q_partition_stats,
    "scan_parquet": q_scan_parquet,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "sql_over_table": q_sql_over_table,
    "binary_roundtrip": q_binary_roundtrip,
    "sequence_roundtrip": q_sequence_roundtrip,
    "text_roundtrip": q_text_roundtrip,
    "random_table": q_random_table,
    "stream_watermark_events": q_stream_watermark_events,
    "stream_window_totals": q_stream_window_totals,
    "frame_diff_by_digest": q_frame_diff_by_digest,
    "frame_changes": q_frame_changes,
    "rows_checked": q_rows_checked,
    "rows_split": q_rows_split,
    "partition_overwrite": q_partition_overwrite,
    "partition_files": q_partition_files,
    "sql_over_partitions": q_sql_over_partitions,
}

ORACLE = {
    "add_columns": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey + l_suppkey AS sum FROM lineitem",
    "modulo_projection": "SELECT event_id % 5 AS value, ts AS time FROM events",
    "project_subset": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice > 100000.0 AS big FROM orders",
    "struct_fields": "SELECT p_partkey, p_size, p_brand FROM part",
    "timestamp_difference": """
SELECT event_id, date_diff('microsecond', date_trunc('day', ts), ts) AS micros_into_day,
       date_diff('microsecond', ts, date_trunc('month', ts)) AS micros_from_month_start FROM events""",
    "na_drop": f"SELECT * FROM {_EVENTS_NULLS_SQL} WHERE col1 IS NOT NULL AND col2 IS NOT NULL AND col3 IS NOT NULL",
    "na_fill": f"""SELECT event_id, coalesce(col1, 0) AS col1, coalesce(col2, 1.0) AS col2,
                   coalesce(col3, 'unknown') AS col3 FROM {_EVENTS_NULLS_SQL}""",
    "na_replace": f"""SELECT CASE WHEN event_id = 1 THEN 100 ELSE event_id END AS event_id,
                      CASE WHEN col1 = 1 THEN 100 ELSE col1 END AS col1,
                      CASE WHEN col2 = 1 THEN 100.0 ELSE col2 END AS col2, col3 FROM {_EVENTS_NULLS_SQL}""",
    "explode_array": f"SELECT o_orderkey, unnest(arr) AS col FROM {_ARR_SQL}",
    "explode_outer_array": f"""SELECT o_orderkey, unnest(arr) AS col FROM {_ARR_SQL} WHERE len(arr) > 0
UNION ALL SELECT o_orderkey, NULL FROM {_ARR_SQL} WHERE arr IS NULL OR len(arr) = 0""",
    "posexplode_array": f"""SELECT o_orderkey, unnest(range(len(arr))) AS pos, unnest(arr) AS col FROM {_ARR_SQL}
WHERE len(arr) > 0
UNION ALL SELECT o_orderkey, NULL, NULL FROM {_ARR_SQL} WHERE arr IS NULL OR len(arr) = 0""",
    "explode_outer_map": f"SELECT p_partkey, key, value FROM ({_MAP_ROWS_SQL}) m",
    "posexplode_map": f"SELECT p_partkey, pos, key, value FROM ({_MAP_ROWS_SQL}) m",
    "map_build": "SELECT p_partkey, p_name AS name, p_brand AS brand, 2 AS n, p_brand AS value_key FROM part",
    "map_lookup": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS missing,
       event_id AS second,
       CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS code FROM events""",
    "array_append": "SELECT event_id, 2 AS n, user_id AS last_id, event_type AS last_tag FROM events",
    "argmin_per_group": """
WITH e AS (
  SELECT p_brand AS store, 'size' AS key, CAST(p_size AS BIGINT) AS value FROM part
  UNION ALL SELECT p_brand, 'price', CAST(p_retailprice AS BIGINT) FROM part
  UNION ALL SELECT p_brand, 'key_mod', p_partkey % 97 FROM part)
SELECT store, value AS min_value, key AS min_key FROM (
  SELECT *, row_number() OVER (PARTITION BY store ORDER BY value, key) AS rn FROM e) WHERE rn = 1""",
    "group_count": "SELECT c_nationkey, c_mktsegment, count(*) AS count FROM customer GROUP BY 1, 2",
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "dedup_subset": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn
  FROM orders) WHERE rn = 1""",
    "dedup_single": "SELECT DISTINCT o_orderpriority FROM orders",
    "windowed_value_set": """
SELECT l_orderkey, l_linenumber, count(DISTINCT l_returnflag) OVER (PARTITION BY l_orderkey) AS n_flags
FROM lineitem""",
    "range_frame_sum": """
SELECT p_partkey, p_brand, p_size,
       sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN CURRENT ROW AND 1 FOLLOWING) AS sum
FROM part""",
    "range_frame_sum_wide": """
SELECT event_id, user_id, ts, k,
       CAST(sum(k) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL 86400 SECOND FOLLOWING) AS BIGINT) AS next_day
FROM (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts,
             CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e""",
    "value_set": """
SELECT l.l_orderkey, l.l_linenumber, s.flags, s.first_flag FROM lineitem l JOIN (
    SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, min(l_returnflag) AS first_flag
    FROM lineitem GROUP BY l_orderkey) s USING (l_orderkey)""",
    "frames_equal": f"""
SELECT 'changed' AS pair, count(*) = 0 AS same, count(*) FILTER (WHERE side = 'expected_only') AS expected_only,
    count(*) FILTER (WHERE side = 'actual_only') AS actual_only FROM ({_DIFF_SQL.format(all=" ALL")}) d
UNION ALL SELECT 'reordered', true, 0, 0""",
    "random_table": _RANDOM_SQL,
    "frame_diff": _DIFF_SQL.format(all=""),
    "frame_diff_multiset": _DIFF_SQL.format(all=" ALL"),
    "frame_diff_by_digest": _DIFF_SQL.format(all=" ALL"),
    "frame_changes": """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'removed' ELSE 'changed' END AS change,
       CASE WHEN o_orderkey % 10 = 3 THEN '' ELSE 'o_orderstatus' END AS columns
FROM orders WHERE o_orderkey % 10 IN (3, 7)""",
    "rows_checked": _REJECTED_SQL + "SELECT event_id, len(v) AS n, coalesce(list_aggregate(list_transform(v, lambda x: x.path), 'string_agg', ','), '') AS paths FROM d",
    "rows_split": _REJECTED_SQL + """SELECT event_id, len(v) = 0 AS good, CASE WHEN len(v) = 0 THEN ts END AS at,
CAST(CASE WHEN len(v) = 0 THEN 12 END AS INTEGER) AS tag, v[1].path || ' ' || v[1].wanted AS reason FROM d""",
    "partition_overwrite": """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey, c_mktsegment
FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_custkey % 2 = 0""",
    "partition_files": "SELECT event_id, user_id, event_type FROM events",
    "sql_over_partitions": "SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment = 'MACHINERY' GROUP BY c_nationkey",
    "stream_window_totals": """
SELECT epoch_us(date_trunc('day', ts)) AS start_us, event_id % 5 AS value, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total
FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 10 MINUTE FROM events)
GROUP BY ALL""",
    "conform_to_schema": """SELECT doc_id, quality, CAST(NULL AS INTEGER) AS toxic, CAST(NULL AS VARCHAR) AS note
FROM labels""",
    "conform_with_defaults": """
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE quality END AS quality, 0 AS toxic, 'n/a' AS note
FROM labels""",
    "validate_schema": """
WITH d AS (
  SELECT CASE WHEN event_id % 9 = 0 THEN 'x' || CAST(event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS s_int,
         CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS s_double,
         CASE WHEN event_id % 6 = 0 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END AS s_ts
  FROM events)
SELECT 's_int' AS "column", 'bigint' AS target_type, count(*) FILTER (WHERE s_int <> '') AS n_checked,
       count(*) FILTER (WHERE s_int <> '' AND TRY_CAST(s_int AS BIGINT) IS NULL) AS n_bad FROM d
UNION ALL
SELECT 's_double', 'double', count(*) FILTER (WHERE s_double <> ''),
       count(*) FILTER (WHERE s_double <> '' AND TRY_CAST(s_double AS DOUBLE) IS NULL) FROM d
UNION ALL
SELECT 's_ts', 'timestamp', count(*) FILTER (WHERE s_ts <> ''),
       count(*) FILTER (WHERE s_ts <> '' AND TRY_CAST(s_ts AS TIMESTAMP) IS NULL) FROM d""",
    "repartition_by_key": """SELECT c_nationkey, c_mktsegment, count(*) AS n_rows, 1 AS n_partitions
FROM customer GROUP BY 1, 2""",
    "partition_stats": "SELECT count(*) AS rows, round(sum(value), 2) AS total FROM events",
    "scan_parquet": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 AND l_returnflag = 'R'",
    "partitioned_roundtrip": "SELECT c_mktsegment, c_nationkey, count(*) AS count FROM customer GROUP BY 1, 2",
    "sql_over_table": """SELECT c_mktsegment, count(*) AS n, min(c_acctbal) AS min_bal, max(c_acctbal) AS max_bal
FROM customer GROUP BY c_mktsegment""",
    "binary_roundtrip": "SELECT doc_id, strlen(text) AS n_bytes, md5(text) AS md5 FROM documents",
    "sequence_roundtrip": """SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS key,
       strlen(text) AS n_bytes, md5(text) AS md5 FROM conversations""",
    "text_roundtrip": "SELECT o_orderpriority || ' ' || CAST(o_orderkey AS VARCHAR) AS value FROM orders",
    "stream_watermark_events": "SELECT event_id, event_id % 5 AS value, ts, epoch_us(ts) AS time_us FROM events",
}
