"""Row checks against a schema (D5): every value that does not convert, with its path,
and the split into converted and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_once
from .aggregates import quoted

REASONS = "array<struct<path:string,value:string,wanted:string>>"
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _text(c: Column, kind: T.DataType) -> Column:
    return F.to_json(F.struct(c.alias("v"))) if isinstance(kind, _NESTED) else c.cast("string")


def _one(path: Column, c: Column, kind: T.DataType, wanted: str) -> Column:
    return F.array(F.struct(path.alias("path"), _text(c, kind).alias("value"), F.lit(wanted).alias("wanted"))).cast(REASONS)


def _reasons(c: Column, kind: T.DataType, target: T.DataType, path: Column) -> Column:
    """Why the value at ``path`` does not convert: an array, empty if it does."""
    none = F.array().cast(REASONS)
    if isinstance(kind, T.StructType) and isinstance(target, T.StructType):
        wanted = {f.name: f.dataType for f in target.fields}
        parts = []
        for f in kind.fields:
            at, v = F.concat(path, F.lit("." + f.name)), c.getField(f.name)
            if f.name not in wanted:
                parts.append(F.when(v.isNotNull(), _one(at, v, f.dataType, "no such field")).otherwise(none))
            else:
                parts.append(_reasons(v, f.dataType, wanted[f.name], at))
        return F.when(c.isNull(), none).otherwise(F.concat(none, *parts))
    if isinstance(kind, T.ArrayType) and isinstance(target, T.ArrayType):
        each = F.transform(c, lambda x, i: _reasons(x, kind.elementType, target.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.coalesce(F.flatten(each), none)
    if isinstance(kind, T.MapType) and isinstance(target, T.MapType):
        def entry(e: Column) -> Column:
            k = e.getField("key")
            at = F.concat(path, F.lit("{"), _text(k, kind.keyType), F.lit("}"))
            return F.concat(_reasons(k, kind.keyType, target.keyType, F.concat(at, F.lit(" key"))), _reasons(e.getField("value"), kind.valueType, target.valueType, at))

        return F.coalesce(F.flatten(F.transform(F.map_entries(c), entry)), none)
    if isinstance(kind, _NESTED) or isinstance(target, _NESTED):
        return F.when(c.isNotNull(), _one(path, c, kind, target.simpleString())).otherwise(none)
    given = c.isNotNull() & (c.cast("string") != F.lit(""))
    return F.when(given & c.try_cast(target).isNull(), _one(path, c, kind, target.simpleString())).otherwise(none)


def _converted(c: Column, kind: T.DataType, target: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and isinstance(target, T.StructType):
        have = {f.name: f.dataType for f in kind.fields}
        fields = [(_converted(c.getField(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(c, lambda x: _converted(x, kind.elementType, target.elementType))
    if isinstance(kind, T.MapType) and isinstance(target, T.MapType):
        return F.map_from_entries(F.transform(F.map_entries(c), lambda e: F.struct(_converted(e["key"], kind.keyType, target.keyType), _converted(e["value"], kind.valueType, target.valueType))))
    if isinstance(kind, _NESTED) or isinstance(target, _NESTED):
        return F.lit(None).cast(target)  # only null gets here
    return c.try_cast(target)


def check_rows(df: DataFrame, schema: T.StructType, out: str = "violations") -> DataFrame:
    """``df`` and an array of (path, value, wanted) of the values, at any depth of
    structs, arrays and maps, that do not convert to the schema's types, in order of
    place.  Null and empty values convert (to null); a field that the schema does not
    have is a violation where it is not null; a field that the row does not have is
    null.  Columns that the schema does not have are an error, as is a column that is
    called ``out``.  One pass, no shuffle."""
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown or out in df.columns:
        raise ValueError(f"columns {unknown or [out]} are not in the schema, or clash with the result")
    parts = [_reasons(quoted(f.name), f.dataType, schema[f.name].dataType, F.lit(f.name)) for f in df.schema.fields]
    return df.select("*", F.concat(F.array().cast(REASONS), *parts).alias(out))


def split_rows(df: DataFrame, schema: T.StructType, out: str = "violations") -> tuple[DataFrame, DataFrame]:
    """The rows without violations, converted to ``schema``, and the rejected rows as
    they came with their violations.  ``df`` is computed once: the checked rows are
    written to the shared folder and read by both."""
    checked = write_once(check_rows(df, schema, out), "checked")
    have = {f.name: f.dataType for f in df.schema.fields}
    good = checked.where(F.size(quoted(out)) == 0)
    good = good.select(*[(_converted(quoted(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    return good, checked.where(F.size(quoted(out)) > 0)
