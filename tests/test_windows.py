"""Range frames against brute force: types, widths, hot partitions, odd values."""

import datetime
import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from matchspan.operators.windows import PIECES, SHORT, range_frame_sum

DAY = datetime.datetime(2024, 3, 1)


def plain(rows, width):
    """rows: (part, order, value) -> sorted (part, order, value, sum)."""
    out = []
    special = lambda x: x is None or (isinstance(x, float) and not math.isfinite(x))
    for p, o, v in rows:
        if special(o):
            frame = [w for q, r, w in rows if q == p and repr(r) == repr(o)]
        else:
            frame = [w for q, r, w in rows if q == p and not special(r) and o <= r <= o + width]
        frame = [w for w in frame if w is not None]
        out.append((p, o, v, sum(frame) if frame else None))
    return sorted(out, key=repr)


def check(spark, rows, schema, following, width):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = sorted((tuple(r) for r in range_frame_sum(df, ["p"], "o", "v", following, "s").collect()), key=repr)
    want = plain(rows, width)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert repr(g[:3]) == repr(w[:3])
        assert g[3] == w[3] or math.isclose(g[3], w[3], rel_tol=1e-12), (g, w)


def rows_of(draw, order, n=300, value=lambda d: d.choice([None, -3, 0, 5, 11])):
    # a hot partition and a null one
    return [(draw.choice(["hot", "hot", "hot", "b", None]), order(draw), value(draw)) for _ in range(n)]


@pytest.mark.parametrize("following", [0, 1, 5, SHORT, SHORT + 1, PIECES, 1000, 86_400])
def test_whole_numbers(spark, following):
    draw = random.Random(following)
    span = 3 * following + 5
    rows = rows_of(draw, lambda d: d.choice([None, d.randrange(-span, span)]))
    check(spark, rows, "p string, o long, v int", following, following)


def test_ends_of_the_type(spark):
    big = (1 << 63) - 1
    rows = [("a", x, 1) for x in (big, big - 1, big - 70, -big - 1, -big, 0)]
    check(spark, rows, "p string, o long, v int", 100, 100)
    check(spark, [("a", x, 1) for x in (127, 126, -128, 0)], "p string, o byte, v int", 3, 3)


@pytest.mark.parametrize("following", [0.5, 3.25, 86_400.0])
def test_doubles(spark, following):
    draw = random.Random(7)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0]
    rows = rows_of(draw, lambda d: d.choice([*odd, *[d.uniform(-4 * following, 4 * following) for _ in range(8)]]), value=lambda d: d.choice([None, 1e16, -1e16, 0.1, 2.5]))
    rows += [("hot", k * following / PIECES, 1.0) for k in range(-130, 130)]  # on the buckets' edges
    df = spark.createDataFrame(rows, "p string, o double, v double").repartition(3)
    got = {}
    for p, o, v, s in range_frame_sum(df, ["p"], "o", "v", following, "s").collect():
        got[p, repr(o)] = s
    for p, o, _, s in plain([(p, o, decimal.Decimal(v) if v is not None else None) for p, o, v in rows], following):
        g = got[p, repr(o)]
        assert (g is None) == (s is None)
        if s is not None:  # sums of large and small values in any order
            assert abs(g - float(s)) <= 1e3


def test_decimals_and_dates(spark):
    draw = random.Random(8)
    rows = rows_of(draw, lambda d: d.choice([None, decimal.Decimal(d.randrange(-900, 900)).scaleb(-2)]))
    check(spark, rows, "p string, o decimal(12,2), v int", 2, 2)
    first = DAY.date()
    rows = rows_of(draw, lambda d: first + datetime.timedelta(days=d.randrange(700)))
    check(spark, rows, "p string, o date, v long", 90, datetime.timedelta(days=90))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_day_of_timestamps(spark, kind):
    draw = random.Random(9)
    rows = rows_of(draw, lambda d: d.choice([None, DAY + datetime.timedelta(seconds=d.randrange(400_000), microseconds=d.randrange(3))]), n=400)
    check(spark, rows, f"p string, o {kind}, v long", 86_400, datetime.timedelta(days=1))


def test_names_and_no_rows(spark):
    df = spark.createDataFrame([("x", 1, 2), ("x", 2, 3)], "`p.q` string, `o``d` int, _s int")
    out = range_frame_sum(df, ["p.q"], "o`d", "_s", 1, "a.b")
    assert out.columns == ["p.q", "o`d", "_s", "a.b"] and sorted(map(tuple, out.collect())) == [("x", 1, 2, 5), ("x", 2, 3, 3)]
    assert range_frame_sum(df.where(F.lit(False)), ["p.q"], "o`d", "_s", 9).count() == 0
    with pytest.raises(ValueError):
        range_frame_sum(df, ["p.q"], "o`d", "_s", -1)


def test_hot_partition_is_spread(spark):
    """No shuffle by the partition key alone but that of one row a bucket."""
    df = spark.range(20_000).select(F.lit("hot").alias("p"), "id", F.lit(1).alias("v"))
    out = range_frame_sum(df, ["p"], "id", "v", 5_000, "s")
    assert out.where("s <> least(5001, 20000 - id)").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    placed = [ln.split("hashpartitioning(")[1] for ln in plan.splitlines() if "Exchange hashpartitioning(" in ln]
    assert len([p for p in placed if "_k1#" not in p and " g#" not in p]) == 1
