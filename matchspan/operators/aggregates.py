"""Grouping and deduplication."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(c: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col(f"`{c.replace('`', '``')}`")


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A1/O1: rows per group, ordered by the keys (partial count before the shuffle)."""
    return df.groupBy(*keys).count().orderBy(*keys)


def distinct_rows(df: DataFrame) -> DataFrame:
    """A3: distinct rows."""
    return df.distinct()


def dedup_keep_first(df: DataFrame, subset: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """A4: one row per ``subset`` value -- the one that sorts first by
    ``order_by`` (then by the remaining columns), so the kept row is defined.
    A min over a struct aggregates partially before the shuffle: a hot key
    costs one row per task, unlike a row_number window."""
    q = {c: quoted(c) for c in df.columns}
    kept = [c for c in df.columns if c not in subset]
    # what cannot be ordered (maps and what holds them) is ordered by its text
    rest = [F.to_json(F.struct(q[c])) if "map<" in df.schema[c].dataType.simpleString() else q[c] for c in kept if c not in order_by]
    best = F.min_by(F.struct(*[q[c].alias(f"f{i}") for i, c in enumerate(kept)]), F.struct(*[q[c] for c in order_by], *rest)).alias("_keep")
    out = df.groupBy(*[q[c].alias(f"_s{i}") for i, c in enumerate(subset)]).agg(best)
    at = {c: F.col(f"_s{i}") for i, c in enumerate(subset)} | {c: F.col(f"_keep.f{i}") for i, c in enumerate(kept)}
    return out.select(*[at[c].alias(c) for c in df.columns])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A5: the distinct values of one column."""
    return df.select(col).distinct()


def value_set_size(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """For every row, the number of distinct non-null ``value`` in
    its key group -- what ``size(collect_set(value) OVER (PARTITION BY keys))``
    gives, computed as a partial aggregate joined back (null-safe on keys) so
    that a hot key is reduced before its shuffle and AQE can split the join."""
    return _joined_back(df, keys, F.count_distinct(quoted(value)), out)


def value_set(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """For every row, the sorted distinct non-null ``value`` of its key group
    (``collect_set(value) OVER (PARTITION BY keys)`` with a defined order).  The
    set of a key is one value of the result, so it must fit into memory."""
    return _joined_back(df, keys, F.array_sort(F.collect_set(quoted(value))), out)


def null_safe_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that stand for ``keys`` and hold no nulls, and their names: a
    flag and the value where a null can be replaced, else a struct.  Grouping and
    joining by them is null-safe and keeps one partitioning for both."""
    at, named = [], []
    for i, k in enumerate(keys):
        kind = df.schema[k].dataType
        if isinstance(kind, (T.NumericType, T.StringType)):
            empty = F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)
            named += [quoted(k).isNull().alias(f"_n{i}"), F.coalesce(quoted(k), empty).alias(f"_k{i}")]
            at += [f"_n{i}", f"_k{i}"]
        else:
            named += [F.struct(quoted(k).alias("v")).alias(f"_k{i}")]  # a struct is never null
            at += [f"_k{i}"]
    return df.select("*", *named), at


def _joined_back(df: DataFrame, keys: Sequence[str], agg, out: str) -> DataFrame:
    """A group's aggregate on each of its rows, joined back null-safely; the aggregate
    is not shuffled again for the join."""
    rows, at = null_safe_keys(df, keys)
    sets = rows.groupBy(*at).agg(agg.alias("_out"))
    return rows.join(sets, at, "left").select(*map(quoted, df.columns), F.col("_out").alias(out))
