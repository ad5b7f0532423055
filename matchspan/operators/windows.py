"""Value-range frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import null_safe_keys, quoted

#: Buckets that a frame is cut into.
PIECES = 64
#: Frames of at most so many further whole numbers need no buckets.
SHORT = 16
MICROS = 1_000_000


def _position(order: Column, dtype: T.DataType, following: float) -> tuple[Column, int | float]:
    """The order value on a scale that ``following`` can be added to, and its length there:
    microseconds for timestamps (``following`` in seconds), days for dates, else the value."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(order), round(following * MICROS)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), order), round(following * MICROS)
    if isinstance(dtype, T.DateType):
        return F.datediff(order, F.lit("1970-01-01").cast("date")).cast("long"), int(following)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return order.cast("long"), int(following)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return order.cast("double"), float(following)
    if isinstance(dtype, T.DecimalType):
        return order, following
    raise ValueError(f"no frame of values over {dtype.simpleString()}")


def range_frame_sum(df: DataFrame, part: Sequence[str], order: str, value: str,
                    following: float = 1, out: str = "sum") -> DataFrame:
    """``sum(value) OVER (PARTITION BY part ORDER BY order RANGE BETWEEN
    CURRENT ROW AND following FOLLOWING)`` for every row.  ``order`` is a number, a date
    (``following`` in days) or a timestamp (in seconds).

    Values are first summed by (part, order).  The order axis is cut into buckets, some
    64 of them a frame, so a frame is the rest of its first bucket, whole buckets, and
    the beginning of its last one.  Rests and beginnings are running sums within a
    bucket, in which each frame's end takes its place as a row without a value; whole
    buckets are summed over their totals, one row a bucket.  Nothing is subtracted, so
    sums of doubles lose nothing, and a hot partition spreads over its buckets.

    For a short frame of whole numbers it is cheaper to copy each sum to the few values
    whose frames hold it, which one more aggregate then adds up.

    A null, NaN or infinite order value only meets its own peers.  Doubles that are so
    large that buckets of the frame cannot be told apart are an error."""
    if following < 0:
        raise ValueError("a frame ends at its row or after it")
    x, f = _position(F.col("_o"), df.schema[order].dataType, following)
    rows, at = null_safe_keys(df.select("*", quoted(order).alias("_o"), quoted(value).alias("_v")), [*part, order])
    groups, own = at[:-2] if f"_n{len(part)}" in at else at[:-1], at
    sums = rows.groupBy(*own).agg(F.first("_o").alias("_o"), F.sum("_v").alias("_s"))
    kind = sums.schema["_s"].dataType
    sums = sums.select(*own, "_s", x.alias("_x"))
    real = not isinstance(sums.schema["_x"].dataType, T.LongType)
    usual = F.col("_x").isNotNull()
    if isinstance(sums.schema["_x"].dataType, T.DoubleType):
        usual = usual & ~F.isnan("_x") & (F.abs("_x") != F.lit(float("inf")))
    frames = sums.select(*own, F.col("_s").alias("_out"))
    if f and f <= SHORT and isinstance(df.schema[order].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        frames = _short_frames(sums, groups, own, f, rows.schema[own[-1]].dataType)
    elif f:
        inside = _frames(sums.where(usual), groups, own, f, real, kind)
        frames = inside.unionByName(sums.where(F.coalesce(~usual, F.lit(True))).select(*own, F.col("_s").alias("_out")))
    return rows.join(frames, own, "left").select(*map(quoted, df.columns), F.col("_out").alias(out))


def _frames(sums: DataFrame, groups: list[str], own: list[str], f, real: bool, kind: T.DataType) -> DataFrame:
    """``own`` and ``_out`` for every (part, order value) with its sum ``_s`` at ``_x``."""
    width = float(f) / PIECES if real else max(1, f // PIECES)
    usual = int(float(f) / width) if real else f // width
    if real:
        end = F.col("_x") + F.lit(f)

        def bucket(x: Column) -> Column:
            g = x.cast("double") / F.lit(width)
            return F.when(F.abs(g) < F.lit(float(1 << 52)), F.floor(g)).otherwise(F.raise_error(F.lit("order values too large for the frame")).cast("long"))
    else:
        end = F.try_add(F.col("_x"), F.lit(f).cast("long"))  # null: the frame ends past the largest long

        def bucket(x: Column) -> Column:
            return _floor_div(x, F.lit(width).cast("long"))
    rows = sums.select(*own, "_s", "_x", end.alias("_end"), bucket(F.col("_x")).alias("_g"), bucket(end).alias("_ge"))
    far = F.coalesce(F.col("_ge") - F.col("_g"), F.lit(-1).cast("long"))
    value = F.struct(F.col("_g").alias("g"), F.col("_x").alias("pos"), F.lit(0).alias("kind"), F.col("_s").alias("s"), far.alias("far"))
    stop = F.struct(F.col("_ge").alias("g"), F.col("_end").alias("pos"), F.lit(1).alias("kind"), F.lit(None).cast(kind).alias("s"), far.alias("far"))
    records = rows.select(*own, F.inline(F.when(F.col("_end").isNull(), F.array(value)).otherwise(F.array(value, stop))))
    before = Window.partitionBy(*groups, "g").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*groups, "g").orderBy(F.col("pos").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = records.select("*", F.when(F.col("kind") == 1, F.sum("s").over(before)).alias("head"), F.when(F.col("kind") == 0, F.sum("s").over(after)).alias("rest"))
    # one row a bucket that holds values; the sums of those strictly between
    totals = records.where("kind = 0").groupBy(*groups, "g").agg(F.sum("s").alias("t"))
    axis = F.col("g").cast("decimal(20,0)")  # frames past the largest long stay numbers
    between = {d: F.sum("t").over(Window.partitionBy(*groups).orderBy(axis).rangeBetween(1, d - 1)) for d in (usual - 1, usual, usual + 1) if d > 1}
    if not real:  # the frame runs to the last value
        between[-1] = F.sum("t").over(Window.partitionBy(*groups).orderBy(F.col("g").desc()).rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*groups, "g", *[w.alias(f"m{d}") for d, w in between.items()])
    whole = F.lit(None).cast(kind)
    for d in between:
        whole = F.when(F.col("far") == d, F.col(f"m{d}")).otherwise(whole)
    parts = run.join(totals, [*groups, "g"], "left").select(*own, "head", "rest", F.when(F.col("kind") == 0, whole).alias("whole"))
    sums3 = parts.groupBy(*own).agg(*[F.max(c).alias(c) for c in ("head", "rest", "whole")])
    zero = F.lit(0).cast(kind)
    total = sum((F.coalesce(F.col(c), zero) for c in ("rest", "whole")), F.coalesce(F.col("head"), zero))
    some = F.coalesce("head", "rest", "whole").isNotNull()
    return sums3.select(*own, F.when(some, total).cast(kind).alias("_out"))


def _short_frames(sums: DataFrame, groups: list[str], own: list[str], f: int, kind: T.DataType) -> DataFrame:
    """As :func:`_frames`: the sum at x goes to x, x - 1, ... x - f."""
    none, at = own[-2:]
    shift = F.explode(F.when(F.col(none), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(f))))
    to = F.try_subtract(F.col("_x"), F.col("_shift").cast("long")).try_cast(kind)
    spread = sums.select(*own, "_x", "_s", shift.alias("_shift")).select(*groups, none, F.when(F.col(none), F.col(at)).otherwise(to).alias(at), "_s")
    # below the type's least value there is no row
    return spread.where(F.col(at).isNotNull()).groupBy(*own).agg(F.sum("_s").alias("_out"))


def _floor_div(x: Column, w: Column) -> Column:
    """Whole quotient towards minus infinity, without leaving the type."""
    return F.call_function("div", x, w) - F.when(x % w < 0, 1).otherwise(0)
