"""Sinks and their round trips.

Every writer keeps the frame's own parallelism: no ``coalesce(1)`` or
small fixed ``repartition(n)`` that would push all rows through a few tasks.
Paths should live under the cluster's shared folder (see
``session.scratch_path``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], max_records_per_file: int = 5_000_000) -> None:
    """Hive-style ``key=value`` directories, overwrite.  Rows are rebalanced
    by the partition keys first, so that a small partition is one file and a hot
    one several; files are capped in size."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*by).parquet(path))


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], max_records_per_file: int = 5_000_000) -> None:
    """Replaces only those partitions of a table at ``path`` that ``df`` has rows of;
    all others stay.  Replaced partitions are swapped in when the job commits, so a
    failed job leaves the table as it was.  ``df`` must not read what it replaces:
    write it first."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file).partitionBy(*by).parquet(path))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with partition discovery.  With the written ``schema`` the
    partition keys keep their types ("01" and "1" stay two strings)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_binary(df: DataFrame, path: str) -> None:
    """A binary payload column written with the default data source."""
    df.write.mode("overwrite").save(path)


def write_sequence(df: DataFrame, key: str, payload: str, path: str) -> None:
    """(text key, bytes) pairs as a Hadoop sequence file.  Only the RDD
    API writes this format, row by row through Python on the executors, so it
    costs more than the other sinks.  The format has no null: a null key or
    payload is an error.  An existing path is an error, as Hadoop has it."""
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(payload).cast("binary").alias("p"))
    none = F.raise_error(F.lit("a sequence file holds no nulls"))
    whole = rows.select(F.coalesce("k", none.cast("string")).alias("k"), F.coalesce("p", none.cast("binary")).alias("p"))
    whole.rdd.map(lambda r: (r[0], bytearray(r[1]))).saveAsSequenceFile(path)


def read_sequence(spark: SparkSession, path: str, key: str = "key", payload: str = "payload") -> DataFrame:
    """S8 read-back as a DataFrame (key string, payload binary)."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(payload, T.BinaryType())])
    rdd = spark.sparkContext.sequenceFile(path, "org.apache.hadoop.io.Text", "org.apache.hadoop.io.BytesWritable")
    return spark.createDataFrame(rdd.map(lambda kv: (kv[0], bytes(kv[1]))), schema)


def write_text(df: DataFrame, column: str, path: str) -> None:
    """One line per row of a string column, one file per task."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """S9 read-back (``value`` column)."""
    return spark.read.option("wholetext", whole_file).text(path)
