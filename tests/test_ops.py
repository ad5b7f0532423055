"""Operations around the core: columns, maps, explode family, aggregates,
windows, nulls, quality, partitioning, sinks, catalog, random rows, streaming."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import assert_same_rows, make_df
from matchspan.functions import collections as C
from matchspan.functions import nulls as N
from matchspan.functions import scalar as S
from matchspan.operators import aggregates as A
from matchspan.operators import partitioning as P
from matchspan.operators import quality as Q
from matchspan.operators.windows import range_frame_sum
from matchspan.session import scratch_path
from matchspan.sources import catalog, sinks
from matchspan.sources.random_table import random_rows
from matchspan.streaming import watermark

def test_distinct_and_dedup(spark):
    rows = [(-1, None, 0.5), (-1, None, 0.5), (-1, "", 0.5), (3, "", -2.0), (3, "long" * 50, -2.0), (None, None, None), (None, None, None)]
    df = make_df(spark, rows, "n long, s string, x double")
    assert_same_rows(A.distinct_rows(df), set(rows))
    kept = A.dedup_keep_first(df, ["n", "x"], ["s"])  # nulls first
    assert_same_rows(kept, [(-1, None, 0.5), (3, "", -2.0), (None, None, None)], ["n", "s", "x"])
    assert_same_rows(A.distinct_values(df, "x"), [(0.5,), (-2.0,), (None,)])
    assert A.distinct_rows(df.where("false")).count() == 0


def test_explode_family(spark):
    """Against list comprehensions: empty and long arrays, nulls inside and outside."""
    arrays = [list(range(40)), [], None, [None], [-1, None, -1], [0]]
    maps = [{}, {"k": None}, None, {chr(97 + i): i for i in range(20)}, {"": 1, "é": -1}, {"z": 0}]
    df = make_df(spark, [(i, x, m) for i, (x, m) in enumerate(zip(arrays, maps))], "id int, xs array<int>, m map<string,int>")
    inner = [(i, p, x) for i, xs in enumerate(arrays) for p, x in enumerate(xs or [])]
    left = [(i, None, None) for i, xs in enumerate(arrays) if not xs]
    assert_same_rows(C.explode_array(df, ["id"], "xs"), [(i, x) for i, _, x in inner])
    assert_same_rows(C.explode_array(df, ["id"], "xs", outer=True), [(i, x) for i, _, x in inner + left])
    assert_same_rows(C.explode_array(df, ["id"], "xs", outer=True, with_pos=True), inner + left)
    inner = [(i, k, v) for i, m in enumerate(maps) for k, v in (m or {}).items()]
    left = [(i, None, None) for i, m in enumerate(maps) if not m]
    assert_same_rows(C.explode_map(df, ["id"], "m"), inner)
    assert_same_rows(C.explode_map(df, ["id"], "m", outer=True), inner + left)
    placed = C.explode_map(df, ["id"], "m", outer=True, with_pos=True)
    assert placed.columns == ["id", "pos", "key", "value"] and placed.count() == len(inner + left)


def test_argmin_over_map_ties_to_smaller_key(spark):
    data = [("s1", {"size": 41, "width": 17}), ("s2", {"depth": 3, "size": 8}),
            ("s3", {"width": 66, "depth": 65}), ("s4", {"size": 9, "depth": 9})]
    df = spark.createDataFrame(data, "supplier string, sizes map<string,long>")
    assert_same_rows(C.argmin_over_map(df, "supplier", "sizes"),
                     [("s1", 17, "width"), ("s2", 3, "depth"), ("s3", 65, "depth"), ("s4", 9, "depth")])


def test_maps_and_lookup(spark):
    df = spark.createDataFrame([("c1", "MACHINERY", 51), ("c2", "FURNITURE", 87)], "cust string, segment string, balance long")
    lit_keys = C.map_with_literal_keys([("segment", "segment"), ("balance", F.col("balance").cast("string"))])
    by_value = C.map_with_column_keys([("segment", F.lit("segment"))])
    out = df.select("cust", C.lookup(lit_keys, "segment").alias("d"), C.lookup(lit_keys, "nope").alias("x"),
                    C.lookup(by_value, "MACHINERY").alias("hr"))
    assert_same_rows(out, [("c1", "MACHINERY", None, "segment"), ("c2", "FURNITURE", None, None)])


def test_array_append_and_struct_fields(spark):
    df = spark.createDataFrame([(1, "x")], "id int, tag string")
    arr = C.append_struct(F.array(F.struct(F.lit(0).alias("id"), F.lit("a").alias("tag"))), F.struct("id", "tag"))
    out = df.select(arr.alias("arr")).select(F.size("arr").alias("n"), F.col("arr").getItem(1).alias("s"))
    assert_same_rows(C.struct_fields(out, "s", ["id", "tag"], keep=["n"]), [(2, 1, "x")])


def test_add_columns_and_modulo(spark):
    df = spark.createDataFrame([(11, 7), (-2, 9), (40, 0)], "col1 long, col2 long")
    assert_same_rows(S.add_columns(df, "col1", "col2"), [(11, 7, 18), (-2, 9, 7), (40, 0, 40)])
    ts = datetime.datetime(2024, 1, 1)
    m = spark.createDataFrame([(7, ts)], "value long, timestamp timestamp_ntz")
    out = S.modulo_projection(m, "value", 5, "timestamp")
    assert out.columns == ["value", "time"] and out.first()["value"] == 2


@pytest.mark.parametrize("a,b,expected", [
    (datetime.datetime(2024, 3, 1, 6), datetime.datetime(2024, 2, 28), datetime.timedelta(2, 6 * 3600)),
    (datetime.datetime(1969, 5, 4), datetime.datetime(1969, 5, 9), datetime.timedelta(-5)),
    (datetime.datetime(2999, 1, 1), datetime.datetime(3000, 1, 1), datetime.timedelta(-365)),
])
def test_timestamp_difference(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(S.timestamp_diff_interval(F.col("a"), F.col("b")).alias("d"),
                    S.timestamp_diff_micros(F.col("a"), F.col("b")).alias("us")).first()
    assert row["d"] == expected
    assert row["us"] == expected // datetime.timedelta(microseconds=1)


def test_null_handling(spark):
    rows = [(x, y, z) for x in (None, -5, 0) for y in (None, -5) for z in (None, "", "w")]
    df = make_df(spark, rows, "x long, y long, z string")
    assert_same_rows(N.drop_null_rows(df), [r for r in rows if None not in r])
    fill = {"x": 9, "z": "-"}
    assert_same_rows(N.fill_nulls(df, fill), [(9 if x is None else x, y, "-" if z is None else z) for x, y, z in rows])
    assert_same_rows(N.replace_values(df, -5, 70), [tuple(70 if v == -5 else v for v in r) for r in rows])


def test_value_set_size_null_keys(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, None), (None, "x"), (None, "x"), (2, None)], "k int, v string")
    assert_same_rows(A.value_set_size(df, ["k"], "v", "n"),
                     [(1, "x", 2), (1, "y", 2), (1, None, 2), (None, "x", 1), (None, "x", 1), (2, None, 0)])


def test_group_count_order(spark):
    df = spark.createDataFrame([("c", "u"), ("a", "u"), ("a", "u")], "country string, username string")
    assert [tuple(r) for r in A.group_count(df, ["country", "username"]).collect()] == [("a", "u", 2), ("c", "u", 1)]


def test_quality(spark):
    e = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, s string")
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, s string")
    assert_same_rows(Q.frame_diff(e, a), [("actual_only", 3, "c")])
    assert_same_rows(Q.frame_diff(e, a, multiset=True), [("actual_only", 3, "c"), ("expected_only", 2, "b")])
    with pytest.raises(Q.SchemaMismatch):
        Q.compare_schemas(e, a.withColumn("id", F.col("id").cast("long")))
    with pytest.raises(Q.SchemaMismatch):
        Q.compare_schemas(e, a.drop("s"))
    Q.compare_schemas(e, a.select("s", "id"))  # order ignored


def test_conform_and_validate(spark):
    schema = T.StructType([T.StructField("price", T.DoubleType()), T.StructField("key", T.IntegerType()),
                           T.StructField("lines", T.IntegerType()), T.StructField("clerk", T.StringType()),
                           T.StructField("shipped", T.TimestampNTZType()), T.StructField("priority", T.IntegerType())])
    df = spark.createDataFrame([(81.5, 6, None)], "price double, key int, clerk string")
    out = Q.conform_to_schema(df, schema, defaults={"shipped": datetime.datetime(1995, 6, 3), "clerk": "x"})
    assert out.columns == ["price", "key", "lines", "clerk", "shipped", "priority"]
    assert tuple(out.first()) == (81.5, 6, None, None, datetime.datetime(1995, 6, 3), None)
    with pytest.raises(ValueError):
        Q.conform_to_schema(df.withColumn("extra", F.lit(1)), schema)
    Q.validate_schema(df, schema)
    with pytest.raises(ValueError):
        Q.validate_schema(df.withColumn("key", F.lit("x")), schema)
    v = spark.createDataFrame([("1",), ("x",), ("",), (None,)], "s string")
    assert [tuple(r) for r in Q.type_violations(v, {"s": "int"}).collect()] == [("s", "int", 2, 1)]


def test_partitioning_and_stats(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("x"))
    placed = P.key_placement(P.repartition_by_key(df, 10, ["k"]), ["k"])
    assert placed.agg(F.max("n_partitions")).first()[0] == 1
    assert P.num_partitions(P.repartition_by_key(df, 10, ["k"])) == 10
    tot = P.partition_stats(df.repartition(4), "x").agg(F.sum("rows"), F.sum("total")).first()
    assert tuple(tot) == (1000, float(sum(range(1000))))


def test_sinks_roundtrip(spark):
    df = spark.createDataFrame([("01", "n1", 1), ("01", "n2", 2), ("1", "n1", 3)], "country string, username string, id int")
    p = scratch_path(spark, "t-part")
    sinks.write_partitioned(df, p, ["country", "username"])
    back = sinks.read_parquet(spark, p, df.schema)
    assert_same_rows(A.group_count(back, ["country", "username"]), [("01", "n1", 1), ("01", "n2", 1), ("1", "n1", 1)])
    assert back.where("country = '1'").count() == 1
    b = spark.createDataFrame([(bytearray([0, 255, 10, 9]),)], "payload binary")
    pb = scratch_path(spark, "t-bin")
    sinks.write_binary(b, pb)
    assert bytes(spark.read.load(pb).first()[0]) == bytes([0, 255, 10, 9])
    ps = scratch_path(spark, "t-seq")
    sinks.write_sequence(spark.createDataFrame([("r/7 é", bytearray(range(256)))], "k string, p binary"), "k", "p", ps)
    assert [(r[0], bytes(r[1])) for r in sinks.read_sequence(spark, ps).collect()] == [("r/7 é", bytes(range(256)))]
    pt = scratch_path(spark, "t-text")
    sinks.write_text(spark.createDataFrame([("1-URGENT 42",)], "s string"), "s", pt)
    assert [r[0] for r in sinks.read_text(spark, pt).collect()] == ["1-URGENT 42"]


def test_catalog_table(spark):
    p = scratch_path(spark, "t-cat")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.parquet(p)
    catalog.register_parquet_table(spark, "t_cat_test", p)
    assert spark.sql("SELECT sum(id) FROM t_cat_test").first()[0] == 3


def test_random_rows(spark):
    schema = T.StructType([T.StructField("country", T.StringType()), T.StructField("username", T.StringType()),
                           T.StructField("id", T.IntegerType()), T.StructField("when", T.TimestampType())])
    out = random_rows(spark.range(500), schema, {"country": ["ASIA", "EUROPE"]}, seed=3)
    rows = out.collect()
    assert len(rows) == 500
    assert {r["country"] for r in rows} <= {"ASIA", "EUROPE"}
    assert all(0 <= r["id"] <= 100 for r in rows)
    assert all(r["username"].startswith("some_") for r in rows)
    assert all(r["when"] is None for r in rows)
    assert [tuple(r) for r in random_rows(spark.range(500), schema, {"country": ["ASIA", "EUROPE"]}, seed=3).collect()] == \
        [tuple(r) for r in rows]


def test_rate_stream_has_watermark(spark):
    s = watermark.rate_with_watermark(spark)
    assert s.isStreaming
    assert "EventTimeWatermark" in s._jdf.queryExecution().analyzed().toString()
    assert s.columns == ["value", "time"]


def test_partition_pruning_on_read_back(spark):
    from matchspan.plans.explain import _collect_scans
    df = spark.range(200).select((F.col("id") % 4).alias("part"), F.col("id"))
    p = scratch_path(spark, "t-prune")
    sinks.write_partitioned(df, p, ["part"])
    q = sinks.read_parquet(spark, p).where("part = 2")
    assert q.count() == 50
    scans = _collect_scans(q._jdf.queryExecution().executedPlan())
    meta = scans[0].metadata()
    assert "part" in meta.get("PartitionFilters").get() and "2" in meta.get("PartitionFilters").get()


def test_checkpoint_folder_is_set_once(spark):
    from matchspan.session import ensure_checkpoint_dir
    first = ensure_checkpoint_dir(spark)
    assert {ensure_checkpoint_dir(spark) for _ in range(300)} == {first}


def test_sequence_file_rejects_nulls(spark):
    with pytest.raises(Exception, match="no nulls"):
        sinks.write_sequence(spark.createDataFrame([("k", None)], "k string, p binary"), "k", "p", scratch_path(spark, "t-null"))


def test_partitioned_write_makes_few_files(spark):
    import glob
    p = scratch_path(spark, "t-files")
    sinks.write_partitioned(spark.range(1000).repartition(16).select((F.col("id") % 20).alias("part"), "id"), p, ["part"])
    assert len(glob.glob(p.removeprefix("file:") + "/part=*/*.parquet")) <= 25


def test_register_never_drops(spark):
    p = scratch_path(spark, "t-cat2")
    spark.createDataFrame([(1,)], "id int").write.parquet(p)
    catalog.register_parquet_table(spark, "t_cat_kept", p)
    with pytest.raises(Exception):
        catalog.register_parquet_table(spark, "t_cat_kept", p)
    assert spark.table("t_cat_kept").count() == 1


def test_dedup_with_map_column_and_odd_names(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 5), (1, {"a": 0}, 4)], "`k.x` int, m map<string,int>, o int")
    assert [tuple(r) for r in A.dedup_keep_first(df, ["k.x"], ["o"]).collect()] == [(1, {"a": 0}, 4)]


def test_range_frame_sum_at_the_types_minimum(spark):
    low = -(1 << 63)
    df = spark.createDataFrame([(low, 1), (low + 1, 2)], "o long, v long")
    out = range_frame_sum(df.withColumn("p", F.lit(1)), ["p"], "o", "v", following=1, out="s")
    assert_same_rows(out.select("o", "s"), [(low, 3), (low + 1, 2)])


def test_frames_equal(spark):
    e = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, s string")
    assert Q.frames_equal(e, e.select("s", "id")) == (True, {"expected_only": 0, "actual_only": 0})
    assert Q.frames_equal(e, e.distinct()) == (False, {"expected_only": 1, "actual_only": 0})


def test_stream_reads_a_folder_of_part_files(spark):
    p, out = scratch_path(spark, "t-events.parquet"), scratch_path(spark, "t-stream")
    spark.range(100).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts").repartition(3).write.parquet(p)
    watermark.run_available_now(watermark.events_with_watermark(spark, p, spark.read.parquet(p).schema), out + "/o", out + "/c")
    assert spark.read.parquet(out + "/o").count() == 100


def test_map_partitions(spark):
    def doubled(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"x": [2 * v for v in b.column(0).to_pylist()]})
    assert P.map_partitions(spark.range(10), doubled, "x long").agg(F.sum("x")).first()[0] == 90
