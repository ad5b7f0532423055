"""Data-quality operators (D1-D5, X1): schema comparison and conformance,
type validation, and frame differences returned as DataFrames."""

from __future__ import annotations

from functools import reduce
from typing import Any, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import null_safe_keys
from .aggregates import quoted as _name


class SchemaMismatch(ValueError):
    """Raised when two frames do not have the same columns and types."""


def compare_schemas(expected: DataFrame | T.StructType, actual: DataFrame | T.StructType) -> None:
    """Same set of names and the same type per name; column order and
    nullability are ignored.  Metadata only -- no job runs."""
    e = expected.schema if isinstance(expected, DataFrame) else expected
    a = actual.schema if isinstance(actual, DataFrame) else actual
    en, an = set(e.fieldNames()), set(a.fieldNames())
    if en != an:
        raise SchemaMismatch(f"columns missing from the actual frame: {sorted(en - an)}; unknown there: {sorted(an - en)}")
    et = {f.name: f.dataType for f in e.fields}
    at = {f.name: f.dataType for f in a.fields}
    diff = [f"column {n} has type {at[n].simpleString()}, not {et[n].simpleString()}"
            for n in sorted(en) if et[n] != at[n]]
    if diff:
        raise SchemaMismatch("; ".join(diff))


def bucket_digests(df: DataFrame, buckets: int) -> DataFrame:
    """``_b``, rows and four 64-bit sums a bucket of rows (dealt by hash): sums do not
    depend on order, so equal frames have equal digests, and unequal ones differ but for
    a chance of about 2 ** -100.  Only one row a bucket and task is shuffled."""
    cols = [_hashed(f) for f in df.schema.fields]
    h = [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]
    rows = df.select(F.pmod(h[0], F.lit(buckets)).alias("_b"), *[x.alias(f"_h{i}") for i, x in enumerate(h)])
    halves = [F.sum(half).alias(f"_s{i}{k}") for i in range(2) for k, half in enumerate((F.col(f"_h{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"_h{i}", 32)))]
    return rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_rows"), *halves)


def _hashed(f: T.StructField):
    """What can be hashed: a map by its sorted entries, deeper maps by their JSON text."""
    c, kind = _name(f.name), f.dataType
    if isinstance(kind, T.MapType) and "map<" not in kind.valueType.simpleString() + kind.keyType.simpleString():
        return F.array_sort(F.map_entries(c))
    return F.to_json(F.struct(c.alias("v"))) if "map<" in kind.simpleString() else c


def _differing(expected: DataFrame, actual: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The rows of both frames in buckets whose digests differ.  At most ``buckets``
    bucket numbers are broadcast."""
    e, a = bucket_digests(expected, buckets), bucket_digests(actual, buckets)
    same = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in e.columns if c != "_b"]
    both = e.alias("_l").join(a.alias("_r"), "_b", "full")
    wanted = F.broadcast(both.where(~reduce(lambda x, y: x & y, same)).select("_b"))

    def those(df: DataFrame) -> DataFrame:
        rows = df.select("*", F.pmod(F.xxhash64(*[_hashed(f) for f in df.schema.fields]), F.lit(buckets)).alias("_b"))
        return rows.join(wanted, "_b", "left_semi").drop("_b")

    return those(expected), those(actual)


def frame_diff(expected: DataFrame, actual: DataFrame, multiset: bool = False, digest_buckets: int | None = None) -> DataFrame:
    """Rows present on one side only, tagged with ``side``.

    ``multiset=False`` compares distinct rows (EXCEPT DISTINCT, as
    ``subtract``); ``multiset=True`` also reports surplus copies (EXCEPT ALL).
    The result is a DataFrame -- nothing is collected; an empty result means
    equal.  With ``digest_buckets`` (for large frames that are mostly equal, and cheap
    to read twice) only rows in buckets whose digests differ are shuffled.
    """
    compare_schemas(expected, actual)
    cols = expected.columns
    actual = actual.select(*[_name(c) for c in cols])
    if digest_buckets:
        expected, actual = _differing(expected, actual, digest_buckets)
    counts = _side_counts(expected, actual)
    n = F.col("_e") - F.col("_a")
    if multiset:
        side = F.when(n > 0, F.lit("expected_only")).otherwise(F.lit("actual_only"))
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.abs(n))).alias("_copy")
        return counts.where(n != 0).select(side.alias("side"), *[_name(c) for c in cols], copies).drop("_copy")
    side = F.when(F.col("_a") == 0, F.lit("expected_only")).when(F.col("_e") == 0, F.lit("actual_only"))
    return counts.select(side.alias("side"), *[_name(c) for c in cols]).where(F.col("side").isNotNull())


def _side_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """The distinct rows with their copies on either side, ``_e`` and ``_a``: one
    tagged union and one aggregate, partial before its only exchange."""
    cols = [_name(c) for c in expected.columns]
    both = expected.select(*cols, F.lit(1).alias("_e"), F.lit(0).alias("_a")).unionAll(
        actual.select(*cols, F.lit(0).alias("_e"), F.lit(1).alias("_a")))
    return both.groupBy(*cols).agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))


def frame_changes(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """D2 by key: ``keys``, change ("removed", "added" or "changed") and the names of the
    columns that differ, for every key whose rows are not the same.  Keys compare
    null-safely and identify a row: of rows that share a key each pair is compared."""
    compare_schemas(expected, actual)
    values = [c for c in expected.columns if c not in keys]
    sides = []
    for df, side in ((expected, "_e"), (actual, "_a")):
        rows, at = null_safe_keys(df, keys)
        sides.append(rows.select(*at, F.struct(*[_name(c).alias(f"k{i}") for i, c in enumerate(keys)], *[_name(c).alias(f"v{i}") for i, c in enumerate(values)]).alias(side)))
    both = sides[0].join(sides[1], at, "full")
    e, a = F.col("_e"), F.col("_a")
    change = F.when(a.isNull(), "removed").when(e.isNull(), "added")
    names = F.array_compact(F.array(*[F.when(~e[f"v{i}"].eqNullSafe(a[f"v{i}"]), F.lit(c)) for i, c in enumerate(values)]).cast("array<string>"))
    columns = F.when(change.isNull(), names).otherwise(F.array().cast("array<string>"))
    key = [F.coalesce(e[f"k{i}"], a[f"k{i}"]).alias(c) for i, c in enumerate(keys)]
    return both.select(*key, F.coalesce(change, F.lit("changed")).alias("change"), columns.alias("columns")).where((F.col("change") != "changed") | (F.size("columns") > 0))


def frames_equal(expected: DataFrame, actual: DataFrame, digest_buckets: int | None = None) -> tuple[bool, dict[str, int]]:
    """D2 as pass or fail: whether both frames hold the same rows as often, and
    the number of surplus rows of each side.  One aggregate; no row is collected.
    ``digest_buckets`` as in :func:`frame_diff`."""
    compare_schemas(expected, actual)
    n = F.col("_e") - F.col("_a")
    actual = actual.select(*[_name(c) for c in expected.columns])
    if digest_buckets:
        expected, actual = _differing(expected, actual, digest_buckets)
    r = _side_counts(expected, actual).agg(
        F.sum(F.when(n > 0, n)).alias("e"), F.sum(F.when(n < 0, -n)).alias("a")).first()
    counts = {"expected_only": r["e"] or 0, "actual_only": r["a"] or 0}
    return not any(counts.values()), counts


def conform_to_schema(df: DataFrame, schema: T.StructType, defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Reshape ``df`` to ``schema``: columns follow the schema order,
    present columns are cast to the schema type, absent ones become the
    default literal for that column (or null).  A present null stays null.
    Columns not in the schema are an error."""
    defaults = dict(defaults or {})
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"the target schema has no columns {unknown}")
    bad_defaults = [c for c in defaults if c not in schema.fieldNames()]
    if bad_defaults:
        raise ValueError(f"defaults for unknown columns {bad_defaults}")
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in have:
            out.append(_name(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*out)


_FAMILIES = [
    (T.StringType,),
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.FloatType, T.DoubleType),
    (T.TimestampType, T.TimestampNTZType),
]


def _family(dt: T.DataType):
    for fam in _FAMILIES:
        if isinstance(dt, fam):
            return fam
    return None


def validate_schema(df: DataFrame, schema: T.StructType) -> None:
    """D5 (metadata): every column must be in ``schema`` and of the same type
    family (string; int/long; float/double; timestamp)."""
    for f in df.schema.fields:
        if f.name not in schema.fieldNames():
            raise ValueError(f"the target schema has no column {f.name}")
        want = schema[f.name].dataType
        fam = _family(want)
        if fam is not None and not isinstance(f.dataType, fam):
            raise ValueError(f"column {f.name} of type {f.dataType.simpleString()} cannot hold {want.simpleString()}")


def type_violations(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """D5 (data): per column, how many values were checked and how many do
    not convert to the target type.  Null and empty values are not checked.
    One aggregate pass, partial per task."""
    aggs = []
    for c, typ in targets.items():
        v = _name(c)
        checked = v.isNotNull() & (v.cast("string") != F.lit(""))
        bad = checked & v.try_cast(typ).isNull()
        aggs += [F.sum(checked.cast("long")).alias(f"checked{len(aggs)}"), F.sum(bad.cast("long")).alias(f"bad{len(aggs)}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("target_type"),
                     F.coalesce(F.col(f"checked{2 * i}"), F.lit(0)).alias("n_checked"),
                     F.coalesce(F.col(f"bad{2 * i}"), F.lit(0)).alias("n_bad"))
            for i, (c, t) in enumerate(targets.items())]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
