"""Table access (S1) and the ``match_events`` projection of ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; column pruning and filters reach the reader."""
    return spark.read.parquet(table_path(sf_dir, name))


def props_k() -> F.Column:
    """The integer ``$.k`` of ``events.props``."""
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def hot_user() -> F.Column:
    """``user_id`` with every third user folded into key 0: one key then holds
    about a third of all events (every row is kept)."""
    uid = F.col("user_id")
    return F.when(uid % 3 == 0, F.lit(0).cast("long")).otherwise(uid)


def match_events(spark: SparkSession, sf_dir: str, truncate: str = "hour", user: F.Column | None = None, payload: tuple[str, ...] = ()) -> DataFrame:
    """Event log shaped for the match-range operator (roles a, b, t, status;
    other matches o1, o2), derived from ``events``:

    * a = user_id; b = null when k % 10 = 0, user_id + 1 when k % 10 is 1 or 2, else user_id
    * t = ts truncated to the hour (raw ts never ties)
    * status: signup, purchase -> start; view, click -> update; error -> end
    * o1 = null when k % 7 = 0, else user_id % 3; o2 = k when k % 11 = 0, else null

    ``user`` replaces ``user_id`` in all of the above (see :func:`hot_user`);
    ``payload`` adds columns of ``events`` as they are.
    """
    ev = read_table(spark, sf_dir, "events")
    k = props_k()
    uid = F.col("user_id") if user is None else user
    b = (F.when(k % 10 == 0, F.lit(None).cast("long"))
         .when((k % 10).isin(1, 2), uid + 1)
         .otherwise(uid))
    status = (F.when(F.col("event_type").isin("signup", "purchase"), F.lit("start"))
              .when(F.col("event_type").isin("view", "click"), F.lit("update"))
              .when(F.col("event_type") == "error", F.lit("end")))
    return ev.select(
        uid.alias("a"),
        b.alias("b"),
        status.alias("status"),
        # date_trunc yields a session-zone TIMESTAMP; keep the wall clock.
        F.date_trunc(truncate, F.col("ts")).cast("timestamp_ntz").alias("t"),
        F.when(k % 7 == 0, F.lit(None).cast("long")).otherwise(uid % 3).alias("o1"),
        F.when(k % 11 == 0, k).alias("o2"),
        *payload,
    )


def tied_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``match_events`` with every third user's events under one key and at one time
    (the first hour of their year), b as it was: a third of the rows tie on (a, t)."""
    tied = F.col("a") % 3 == 0
    year = F.date_trunc("year", F.col("t")).cast("timestamp_ntz")
    return match_events(spark, sf_dir).select(
        F.when(tied, F.lit(0).cast("long")).otherwise(F.col("a")).alias("a"), "b", "status",
        F.when(tied, year).otherwise(F.col("t")).alias("t"), "o1", "o2")
