"""Seeded random rows driven by a table."""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def draw(key: Column, seed: int, n: int) -> Column:
    """A number from 0 to ``n`` - 1 for an integer key: two linear congruential
    steps modulo 2**31 - 1, which SQL engines can repeat."""
    m = 2_147_483_647
    x = F.pmod(key.cast("long") * 48_271 + seed, F.lit(m))
    x = F.pmod(x * 69_621 + seed, F.lit(m))
    return F.pmod(x, F.lit(n))


def random_rows(driver: DataFrame, schema: T.StructType, value_sets: Mapping[str, Sequence[Any]],
                seed: int = 42, key: str | None = None, base: str = "some_", digits: int = 3) -> DataFrame:
    """One drawn row per row of ``driver``, generated on the executors from
    its integer column ``key`` (by default its first column; values below 1e14).

    Columns listed in ``value_sets`` draw from their set; integer columns draw
    from 0..100; string columns are ``base`` and a number of ``digits`` digits;
    other types are null.  A row depends on its key and the seed alone.  A null
    key draws nulls.
    """
    k = F.col(key or driver.columns[0])
    cols = []
    for i, f in enumerate(schema.fields):
        s = seed + 7919 * (i + 1)
        if f.name in value_sets:
            values = list(value_sets[f.name])
            c = F.get(F.array(*[F.lit(v) for v in values]), draw(k, s, len(values)).cast("int"))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
            c = draw(k, s, 101)
        elif isinstance(f.dataType, T.StringType):
            c = F.concat(F.lit(base), F.lpad(draw(k, s, 10 ** digits).cast("string"), digits, "0"))
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return driver.select(*cols)
