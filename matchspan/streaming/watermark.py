"""Event-time watermarks on streams (M1, M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rate_with_watermark(spark: SparkSession, rows_per_second: int = 10, delay: str = "10 minutes") -> DataFrame:
    """M1: rate source -> ``value % 5`` -> event time ``time`` with a watermark."""
    src = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
           .selectExpr("value % 5 AS value", "timestamp"))
    return src.select("value", F.col("timestamp").alias("time")).withWatermark("time", delay)


def events_with_watermark(spark: SparkSession, path: str, schema, delay: str = "10 minutes", files_per_trigger: int = 100) -> DataFrame:
    """M2: a file stream of ``events`` with an event-time watermark.  The
    watermark needs TIMESTAMP, so ``ts`` (TIMESTAMP_NTZ) is read as UTC.  ``path``
    is the table: a folder of part files, or one file."""
    # a file stream takes one file only through a pattern; this one matches the path alone
    pattern = f"{path[:-1]}[{path[-1]}]"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(pattern)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    event_time = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("ts")))
    return (src.select("event_id", (F.col("event_id") % 5).alias("value"), "ts", event_time.alias("time"))
            .withWatermark("time", delay))


def first_within_watermark(stream: DataFrame, keys: list[str]) -> DataFrame:
    """M2 with state: of rows with equal ``keys`` the first one passes.  A key is
    remembered until the watermark passes its row's event time by the delay, so state
    is bounded by the delay; rows behind the watermark are dropped."""
    return stream.dropDuplicatesWithinWatermark(keys)


def window_totals(stream: DataFrame, width: str, keys: list[str], value: str) -> DataFrame:
    """M2 with state: rows and sum of ``value`` a (tumbling window of ``time``, keys).  In
    append mode a window is put out once, when the watermark passes its end, and its
    state goes; later rows of it are dropped."""
    totals = stream.groupBy(F.window("time", width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return totals.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n", "total")


def run_available_now(stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """Drain everything available into Parquet (exactly once through the
    checkpoint), then stop."""
    q = (stream.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
