"""Ordered-window helpers that survive hot keys.

A plain ``Window.partitionBy(key).orderBy(time)`` puts every row of a key in
one task; with a key that holds a third of the data that task is the whole
job.  Here each key's timeline is cut into buckets (a monotone function of
time), windows run per (key, bucket), and the few rows that sit on a bucket
edge are fixed up from a small per-bucket summary.  Results are exactly those
of the unsplit window whatever the bucket width.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_once


def time_units(col: Column, dtype: T.DataType) -> Column | None:
    """Time on a natural numeric scale: hours for timestamps, days for dates,
    the value itself for numbers; ``None`` for other types (never cut)."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col) / F.lit(3.6e9)
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, col) / F.lit(3.6e9)
    if isinstance(dtype, T.DateType):
        return F.datediff(col, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(dtype, T.NumericType):
        return col.cast("double")
    return None


def default_width(dtype: T.DataType, width: float | None) -> float | None:
    """Bucket width for keys that are not hot: ``width`` if given, else 24
    hours for timestamps, 30 days for dates and no cut for numbers."""
    if width is not None:
        return float(width)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return 24.0
    if isinstance(dtype, T.DateType):
        return 30.0
    return None


def cold_bucket(units: Column, default: float | None) -> Column:
    """Bucket number of a key that is not hot: time cut at ``default`` units (or not
    at all).  Monotone in time, which is all exactness needs."""
    number = F.floor(units / F.lit(default)).cast("long") if default else F.lit(0).cast("long")
    # NaN sorts after every number, so it belongs to the last bucket
    return F.when(F.isnan(units), F.lit(1 << 62)).otherwise(number)


#: Edges of all hot keys of one side together; what is sent to every task stays below it.
MAX_EDGES = 16_384
#: Drawn rows of a hot key for each of its buckets.
DRAWN = 64


@dataclass(frozen=True)
class Edges:
    """Where the timelines of hot keys are cut: ``table`` has ``key`` and ``_edges``,
    a sorted array of order tuples (struct k0, k1, ...; k0 is the time).  A bucket's
    number is the count of edges at or before a row's tuple, so ties on time are cut
    too where they are large.  An edge that only cuts by time has nulls behind k0,
    which sort before every tuple of that time; ``ties``: some edge cuts inside a time."""

    key: str
    table: DataFrame
    ties: bool

    def on(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_edges`` (null for keys that are not hot).  At most MAX_EDGES
        tuples are broadcast; the join keeps the frame's partitioning."""
        return df.join(F.broadcast(self.table), self.key, "left")


def order_tuple(order: Sequence[Column]) -> Column:
    """The order columns as one value that compares with edges."""
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.lit(True).alias("whole"))


def _edges_before(holds: Callable[[Column], Column]) -> Column:
    """How many of the sorted ``_edges`` satisfy ``holds``, a prefix of them, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MAX_EDGES.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(holds(F.get(F.col("_edges"), at + step - 1)), at + step).otherwise(at)).cast("long")


def bucket_by_rows(order: Sequence[Column], cold: Column) -> Column:
    """Bucket of a row (a frame with ``_edges``) by its order columns; ``cold`` for other keys."""
    return F.when(F.col("_edges").isNotNull(), _edges_before(lambda e: e <= order_tuple(order))).otherwise(cold)


def bucket_by_time(time: Column, cold: Column) -> Column:
    """A coarser bucket that depends on the time alone."""
    return F.when(F.col("_edges").isNotNull(), _edges_before(lambda e: e["k0"] <= time)).otherwise(cold)


def first_bucket_of_time(time: Column) -> Column:
    """The first bucket that holds rows of a time (null for keys that are not hot); the
    last one is :func:`bucket_by_time`.  They differ where a tie is cut."""
    return F.when(F.col("_edges").isNotNull(), _edges_before(lambda e: (e["k0"] < time) | ((e["k0"] == time) & e["whole"])))


def hot_edges(x: DataFrame, sides: Sequence[tuple[str, Sequence[Column]]], rows_per_bucket: int | None, max_keys: int) -> list[Edges | None]:
    """Edges for the keys that hold more than ``rows_per_bucket`` rows, one entry a
    side (key, order columns: the time first, none of them null in a tuple's k0).

    One job of partial aggregates counts rows a key and returns at most ``max_keys`` + 1
    of them; more raise the bound, as do more than MAX_EDGES buckets, so no key
    above the bound is left whole.  A second job, only where keys are hot, draws rows
    of each by a hash of the tuple, DRAWN for each bucket, sorts them and takes every
    so manieth as an edge: buckets are even in rows whatever the type or spread of the
    times.  Draws merge by union.  Results do not depend on the choice."""
    if rows_per_bucket is None:
        return [None] * len(sides)
    bound, hot = rows_per_bucket, None
    while hot is None:
        counts = None
        for i, (key, _) in enumerate(sides):
            # a null key never joins back; without a filter all sides share the input
            n = x.groupBy(F.col(key).alias(f"k{i}")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).orderBy(F.col("n").desc(), F.col(f"k{i}")).limit(max_keys + 1)
            n = n.select(F.lit(i).alias("side"), "n", f"k{i}")
            counts = n if counts is None else counts.unionByName(n, allowMissingColumns=True)
        rows = counts.collect()
        hot = [[(r[f"k{i}"], r["n"], -(-r["n"] // bound)) for r in rows if r["side"] == i and r[f"k{i}"] is not None] for i in range(len(sides))]
        if any(sum(r["side"] == i for r in rows) > max_keys or sum(k[2] for k in hot[i]) > MAX_EDGES for i in range(len(sides))):
            bound, hot = 4 * bound, None
    return [_edges_of(x, key, order, keys) if keys else None for (key, order), keys in zip(sides, hot)]


def _edges_of(x: DataFrame, key: str, order: Sequence[Column], keys: list[tuple]) -> Edges:
    spark, kind = x.sparkSession, x.schema[key].dataType
    table = spark.createDataFrame(keys, T.StructType([T.StructField(key, kind), T.StructField("_n", T.LongType()), T.StructField("_parts", T.LongType())]))
    tuples = order_tuple(order)
    drawn = F.pmod(F.xxhash64(key, *order), F.lit(1 << 40)) < F.lit(DRAWN << 40) / F.col("_n") * F.col("_parts")
    # edges are rows until the end: windows sort them once, where a function of the whole
    # array for each of its elements would take the square of their number
    rows = x.join(F.broadcast(table), key).where(drawn).select(key, "_parts", tuples.alias("_e")).distinct()
    w = Window.partitionBy(key).orderBy("_e")
    rows = rows.select(key, "_parts", "_e", (F.row_number().over(w) - 1).cast("long").alias("_r"), F.count(F.lit(1)).over(Window.partitionBy(key)).alias("_n"))
    # row r is the j-th edge where r = j * n div parts for a j from 1 to parts - 1
    j = F.greatest(F.expr("(_r * _parts + _n - 1) div _n"), F.lit(1).cast("long"))
    picked = rows.withColumn("_j", j).where((F.col("_j") < F.col("_parts")) & (F.expr("(_j * _n) div _parts") == F.col("_r")))
    # an edge alone at its time cuts before the time; only larger ties are cut inside
    time = F.col("_e.k0")
    alone = ~(F.coalesce(F.lag(time).over(w) == time, F.lit(False)) | F.coalesce(F.lead(time).over(w) == time, F.lit(False)))
    names = [f"k{i}" for i in range(1, len(order))]
    picked = picked.select(key, "_r", "_e", alone.alias("_a"))
    cut = F.struct(time.alias("k0"), *[F.when(~F.col("_a"), F.col(f"_e.{n}")).alias(n) for n in names], (F.col("_a") if names else F.lit(True)).alias("whole"))
    found = picked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_r", cut.alias("e")))).alias("_s")).select(key, F.col("_s.e").alias("_edges"))
    table = write_once(found, "edges")
    seen = table.agg(F.count(F.lit(1)).alias("keys"), F.max(F.exists("_edges", lambda e: ~e["whole"])).alias("ties")).first()
    return Edges(key, table, seen["ties"]) if seen["keys"] else None


def asc_nulls_last_key(c: Column) -> list[Column]:
    """Fields that make struct ordering equal ``c ASC NULLS LAST``."""
    return [c.isNull(), c]


def desc_nulls_last_key(c: Column) -> list[Column]:
    """Fields that make struct ordering equal ``c DESC NULLS LAST`` (numeric c)."""
    return [c.isNull(), -c]


def next_bucket_first(firsts: DataFrame, keys: Sequence[str], bucket: str, first_col: str) -> DataFrame:
    """For each (keys, bucket), the first row of the next non-empty bucket.

    ``firsts`` holds one row per (keys, bucket); its size is the number of
    buckets, not the number of rows, so a hot key costs only its bucket count.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(bucket).asc())
    return firsts.select(*keys, bucket, F.lead(first_col).over(w).alias("_bucket_next"))


def lead_across_buckets(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    values: Sequence[str],
    next_first: DataFrame,
    prefix: str,
) -> DataFrame:
    """Exact ``lead(v, 1)`` over ``partitionBy(keys).orderBy(bucket, *order)``.

    The window runs per (keys, bucket); the last row of each bucket takes the
    values of ``next_first`` (see :func:`next_bucket_first`), whose struct has
    one field per name in ``values``.  The left join is on the partitioning
    keys of ``df``, so only the small side moves.
    """
    w = Window.partitionBy(*keys, bucket).orderBy(*order)
    base = df.columns
    df = df.select(
        "*",
        *[F.lead(v, 1).over(w).alias(f"{prefix}{v}") for v in values],
        F.lead(F.lit(1), 1).over(w).isNull().alias("_last_in_bucket"),
    )
    joined = df.join(next_first, on=[*keys, bucket], how="left")
    fixed = [
        F.when(F.col("_last_in_bucket"), F.col("_bucket_next").getField(v))
        .otherwise(F.col(f"{prefix}{v}"))
        .alias(f"{prefix}{v}")
        for v in values
    ]
    return joined.select(*base, *fixed)
