"""Array, map and struct functions (F1-F13, P16) and arg-min over a map (A2)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_with_literal_keys(pairs: Sequence[tuple[str, Column | str]]) -> Column:
    """a map whose keys are the given names (literals) and whose values
    are columns.  Passing a bare column name as a *key* to ``create_map``
    would use that column's values as keys instead; see
    :func:`map_with_column_keys`."""
    args: list[Column] = []
    for name, value in pairs:
        args += [F.lit(name), F.col(value) if isinstance(value, str) else value]
    return F.create_map(*args)


def map_with_column_keys(pairs: Sequence[tuple[str, Column]]) -> Column:
    """F1 (column-keyed form): keys are the *values* of the named columns."""
    args: list[Column] = []
    for key_col, value in pairs:
        args += [F.col(key_col), value]
    return F.create_map(*args)


def lookup(container: Column, key: Column | str | int) -> Column:
    """element access that yields null for a missing key/index (ANSI-safe)."""
    k = key if isinstance(key, Column) else F.lit(key)
    return F.try_element_at(container, k)


def append_struct(arr: Column, item: Column) -> Column:
    """``arr`` with one more element, by concatenation."""
    return F.concat(arr, F.array(item))


def explode_array(df: DataFrame, keep: Sequence[str], arr: str, outer: bool = False,
                  with_pos: bool = False) -> DataFrame:
    """One row per element.  Inner form drops null and empty
    arrays; outer form keeps such rows with null element (and position)."""
    fn = {(False, False): F.explode, (True, False): F.explode_outer,
          (False, True): F.posexplode, (True, True): F.posexplode_outer}[(outer, with_pos)]
    names = ("pos", "col") if with_pos else ("col",)
    return df.select(*keep, fn(F.col(arr)).alias(*names))


def explode_map(df: DataFrame, keep: Sequence[str], m: str, outer: bool = False,
                with_pos: bool = False) -> DataFrame:
    """one row per map entry as (key, value), optionally with position."""
    fn = {(False, False): F.explode, (True, False): F.explode_outer,
          (False, True): F.posexplode, (True, True): F.posexplode_outer}[(outer, with_pos)]
    names = ("pos", "key", "value") if with_pos else ("key", "value")
    return df.select(*keep, fn(F.col(m)).alias(*names))


def struct_fields(df: DataFrame, struct_col: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Struct fields as top-level columns."""
    return df.select(*keep, *[F.col(f"{struct_col}.{f}").alias(f) for f in fields])


def argmin_over_map(df: DataFrame, group: str, m: str) -> DataFrame:
    """A2: per group, the smallest map value and its key; ties go to the
    smaller key (struct order), unlike ``min_by``.  Partial aggregation runs
    before the shuffle, so a hot group costs one row per task."""
    entries = explode_map(df, [group], m)
    best = F.min(F.struct(F.col("value"), F.col("key"))).alias("_m")
    return (entries.groupBy(group).agg(best)
            .select(group, F.col("_m.value").alias("min_value"), F.col("_m.key").alias("min_key")))
