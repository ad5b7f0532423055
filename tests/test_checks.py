"""Row checks, frame comparison by digests and by key, stream state, partitions."""

import datetime
import glob
import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspan.operators import quality as Q
from matchspan.operators import row_checks as RC
from matchspan.session import scratch_path
from matchspan.sources import catalog, sinks
from matchspan.streaming import watermark

TEXT = "id long, `a.b` string, s struct<x:string,y:array<string>,extra:string>, m map<string,struct<v:string>>, odd array<string>"
TARGET_DDL = "id int, `a.b` double, s struct<x:int,y:array<date>,z:int>, m map<int,struct<v:boolean>>, odd int, absent string"


def plain_reasons(row):
    """Paths of the values of a row of TEXT that do not convert to TARGET."""
    def fails(v, f):
        if v in (None, ""):
            return False
        try:
            f(v)
        except ValueError:
            return True
        return False

    truth = lambda v: {"true": 1, "false": 0}[v] if v in ("true", "false") else int("no")
    out = []
    if row[0] is not None and not -2**31 <= row[0] < 2**31:
        out.append("id")
    if fails(row[1], float):
        out.append("a.b")
    if row[2] is not None:
        x, y, extra = row[2]
        if fails(x, int):
            out.append("s.x")
        out += [f"s.y[{i}]" for i, v in enumerate(y or []) if fails(v, datetime.date.fromisoformat)]
        if extra is not None:
            out.append("s.extra")
    for k, v in (row[3] or {}).items():
        if fails(k, int):
            out.append(f"m{{{k}}} key")
        if v is not None and fails(v[0], truth):
            out.append(f"m{{{k}}}.v")
    if row[4] is not None:
        out.append("odd")
    return out


def test_row_checks_at_any_depth(spark):
    TARGET = T.StructType.fromDDL(TARGET_DDL)
    draw = random.Random(2)
    number = lambda: draw.choice([None, "", "7", "-3", "seven", "1e"])
    rows = []
    for i in range(300):
        s = draw.choice([None, (number(), draw.choice([None, [], ["2024-02-29", None, "2024-02-30", ""]]), draw.choice([None, None, "e"]))])
        m = draw.choice([None, {}, {"1": ("true",), "x": None}, {"2": ("maybe",), "3": (None,)}])
        rows.append((draw.choice([i, None, 2**40]), draw.choice([None, "1.5", "NaN", "one"]), s, m, draw.choice([None, None, ["q"]])))
    df = spark.createDataFrame(rows, TEXT)
    got = [(tuple(r)[:5], [v["path"] for v in r["violations"]]) for r in RC.check_rows(df, TARGET).collect()]
    assert [p for _, p in got] == [plain_reasons(r) for r in rows]
    good, rejected = RC.split_rows(df, TARGET)
    assert good.schema.simpleString() == TARGET.simpleString()
    assert good.count() == sum(not plain_reasons(r) for r in rows) and rejected.count() == sum(bool(plain_reasons(r)) for r in rows)
    assert all(r["absent"] is None for r in good.collect())
    assert RC.check_rows(df.where("false"), TARGET).count() == 0
    with pytest.raises(ValueError):
        RC.check_rows(df.withColumn("more", F.lit(1)), TARGET)


def test_digests_find_what_the_whole_comparison_finds(spark):
    draw = random.Random(5)
    schema = "k int, `v.w` double, m map<string,int>, n array<map<string,int>>"
    one = lambda: (draw.choice([None, 1, 2, 3, 4]), draw.choice([None, 0.0, -0.0, float("nan"), 2.5]), draw.choice([None, {}, {"a": 1, "b": 2}, {"b": 2, "a": 1}]), draw.choice([None, [{"z": 1}]]))
    rows = [one() for _ in range(200)]
    e = spark.createDataFrame(rows, schema).select("k", F.col("`v.w`"), F.to_json("m").alias("m"))
    for other in (rows[::-1], rows[:-1], rows + rows[:3], [*rows[5:], *[one() for _ in range(4)]]):
        a = spark.createDataFrame(other, schema).select("k", F.col("`v.w`"), F.to_json("m").alias("m")).repartition(5)
        for multiset in (False, True):
            want = Counter(map(repr, Q.frame_diff(e, a, multiset).collect()))
            assert Counter(map(repr, Q.frame_diff(e, a, multiset, digest_buckets=16).collect())) == want
        assert Q.frames_equal(e, a, digest_buckets=16) == Q.frames_equal(e, a)
    whole = spark.createDataFrame(rows, schema)
    assert len({tuple(r) for r in Q.bucket_digests(whole, 4).collect()} ^ {tuple(r) for r in Q.bucket_digests(whole.repartition(7), 4).collect()}) == 0


def test_rows_of_equal_frames_are_not_shuffled(spark):
    df = spark.range(5000).select("id", (F.col("id") * 3).alias("x"))
    out = Q.frame_diff(df, df.orderBy(F.col("id").desc()), digest_buckets=64)
    assert out.collect() == []
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    # what is left of the plan in its final form holds no exchange of rows
    assert "Exchange" not in final.split("== Initial Plan ==")[0].split("Final Plan ==")[-1]


def test_changes_by_key(spark):
    schema = "k string, `n.o` int, v int, w array<int>"
    e = spark.createDataFrame([("a", 1, 1, [1]), ("b", None, 1, None), (None, 2, 5, []), ("gone", 0, 0, None), ("same", 0, None, [None])], schema)
    a = spark.createDataFrame([("a", 1, 2, [1]), ("b", None, 1, [3]), (None, 2, None, [1]), ("new", 0, 0, None), ("same", 0, None, [None])], schema)
    got = {(r[0], r[1]): (r[2], r[3]) for r in Q.frame_changes(e, a, ["k", "n.o"]).collect()}
    assert got == {("a", 1): ("changed", ["v"]), ("b", None): ("changed", ["w"]), (None, 2): ("changed", ["v", "w"]), ("gone", 0): ("removed", []), ("new", 0): ("added", [])}
    assert Q.frame_changes(e, e, ["k", "n.o"]).count() == 0


def test_late_rows_are_dropped_and_state_is_bounded(spark):
    """Files in order of arrival, one a batch: repeats pass once, rows behind the
    watermark count nowhere, and what is remembered does not grow with the stream."""
    base, day = scratch_path(spark, "late"), datetime.datetime(2024, 5, 1)
    schema = "event_id long, ts timestamp_ntz"
    minute = lambda m: day + datetime.timedelta(minutes=m)
    files = [[(k * 100 + j, minute(60 * k + j)) for j in range(50)] for k in range(12)]
    files[3] += [(300, minute(180)), (301, minute(181))]  # repeats in time
    files[8] += [(9_000_001, minute(5)), (9_000_002, minute(65))]  # behind the watermark
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/in/f{k:02d}")
        os.utime(glob.glob(f"{base.removeprefix('file:')}/in/f{k:02d}/*.parquet")[0], (1e9 + k, 1e9 + k))
    folder = base.removeprefix("file:")
    os.makedirs(f"{folder}/flat")
    for k in range(len(files)):
        os.link(glob.glob(f"{folder}/in/f{k:02d}/*.parquet")[0], f"{folder}/flat/f{k:02d}.parquet")
    stream = watermark.events_with_watermark(spark, f"{folder}/flat", spark.read.parquet(f"{folder}/flat").schema, "10 minutes", files_per_trigger=1)
    totals = watermark.window_totals(watermark.first_within_watermark(stream, ["event_id"]), "1 hour", [], "event_id")
    q = (totals.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r["start"].hour, r["n"], r["total"]) for r in spark.read.parquet(f"{base}/out").withColumn("start", F.to_utc_timestamp("start", "UTC")).collect()}
    want = set()
    for k in range(11):  # the last hour is not behind the watermark
        ids = {i for i, t in files[k] if t >= minute(60 * k)}
        want.add((k, len(ids), sum(ids)))
    assert {(n, t) for _, n, t in got} == {(n, t) for _, n, t in want}
    rows = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert max(rows[4:]) <= max(rows[:4]) + 5 and dropped >= 2


def test_only_given_partitions_are_replaced_and_read(spark):
    path, name = scratch_path(spark, "parts"), "parts_of_test"
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y"), (None, 4, "y")], "k string, n int, t string")
    sinks.write_partitioned(df, path, ["k"])
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/k=*/*.parquet")}
    before = files()
    sinks.overwrite_partitions(spark.createDataFrame([("b", 20, "z"), ("d", 5, "z")], df.schema), path, ["k"])
    after = files()
    assert {f: t for f, t in after.items() if "k=b" not in f and "k=d" not in f} == {f: t for f, t in before.items() if "k=b" not in f}
    assert sorted(map(tuple, sinks.read_parquet(spark, path, df.schema).select("k", "n", "t").collect()), key=repr) == sorted([("a", 1, "x"), ("b", 20, "z"), ("c", 3, "y"), ("d", 5, "z"), (None, 4, "y")], key=repr)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    catalog.register_partitioned_table(spark, name, path, df.schema, ["k"])
    try:
        q = spark.sql(f"SELECT n FROM {name} WHERE k = 'b'")
        assert [r["n"] for r in q.collect()] == [20]
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(k" in plan and "DataFilters: []" in plan
        assert spark.table(name).count() == 5
    finally:
        spark.sql(f"DROP TABLE {name}")


LOST_TRIES = """
import os, sys
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark import TaskContext
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3")
         .config("spark.checkpoint.dir", {shared!r}).config("spark.executorEnv.PYTHONPATH", {repo!r}).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from matchspan.operators import partitioning as P
folder = {shared!r} + "/effects"
os.makedirs(folder)

def work(attempt, batches):
    rows = sum(b.num_rows for b in batches)
    with open(folder + "/" + attempt, "w") as f:
        f.write(str(rows))
    task = TaskContext.get()
    if task.attemptNumber() == 0 and task.partitionId() % 2:
        raise RuntimeError("lost after its side effect")
    yield attempt, rows

listed = P.for_each_partition(spark.range(0, 100, 1, 4), work).collect()
left = os.listdir(folder)
print(len(left), len(listed), sum(r["rows"] for r in listed), sorted(r["partition"] for r in listed), {{r["name"] for r in listed}} <= set(left))
spark.stop()
"""


def test_lost_tries_count_nowhere(tmp_path):
    """Partitions whose first try fails after its side effect are counted once."""
    repo, tests = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))
    code = LOST_TRIES.format(repo=repo, tests=tests, shared=str(tmp_path))
    env = {**os.environ, "PYTHONPATH": repo}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200, env=env)
    assert out.stdout.split("\n")[-2] == "6 4 100 [0, 1, 2, 3] True", out.stderr[-2000:]
