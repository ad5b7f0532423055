"""External tables over Parquet paths, queried with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def register_parquet_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An external (unmanaged) table in the session catalog over ``path``.
    An error if a table of that name exists; nothing is dropped."""
    return spark.catalog.createTable(name, path=path, source="parquet")


def register_partitioned_table(spark: SparkSession, name: str, path: str, schema: T.StructType, by: list[str]) -> DataFrame:
    """An external table over a folder of ``key=value`` partitions, with its partitions
    and its size in the catalog: SQL over it reads only the partitions that its
    filters leave, and joins know how large it is."""
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema) if not by else spark.sql(
        f"CREATE TABLE {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema.fields)}) USING parquet "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)}) LOCATION '{path}'")
    if by:
        spark.catalog.recoverPartitions(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    return spark.table(name)
