"""Partitioning operations (R1-R3) and per-partition work."""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pa_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_once


def repartition_by_key(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """Hash-partition into ``n`` partitions by ``keys``."""
    return df.repartition(n, *keys)


def key_placement(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """R1 check: rows and the number of distinct partitions per key (1 when
    the frame is hash-partitioned by the keys)."""
    return (df.select(*keys, F.spark_partition_id().alias("_pid"))
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_pid").alias("n_partitions")))


def num_partitions(df: DataFrame) -> int:
    """The partition count of the planned frame, read from its plan.  A plan that
    does not state one (a scan) is asked for its tasks, which runs no shuffle there."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()
    return plan.outputPartitioning().numPartitions() or df.rdd.getNumPartitions()


def rebalance(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """R2: even partitions of a good size for writing; rows of a key stay close
    together, and adaptive execution splits hot keys and merges small ones."""
    return df.hint("rebalance", *keys)


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """The caller's function over the Arrow batches of every partition."""
    return df.mapInArrow(fn, schema)


def for_each_partition(df: DataFrame, work: Callable[[str, Iterator[pa.RecordBatch]], Iterator[tuple[str, int]]]) -> DataFrame:
    """U2 with side effects: ``work(attempt, batches)`` of every partition may write
    what it likes under names that hold ``attempt`` (unique to each try of a task), and
    yields (name, rows) of what it has finished.  Returns partition, attempt, name and
    rows of the tries that counted: the list is written by Spark, which commits one
    try a partition, so what lost, failed or repeated tries left behind is in no list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt = f"{task.partitionId()}-{task.taskAttemptId()}"
        done = list(work(attempt, batches))
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()] * len(done), pa.int32()), pa.array([attempt] * len(done), pa.string()),
                                          pa.array([n for n, _ in done], pa.string()), pa.array([r for _, r in done], pa.int64())], names=["partition", "attempt", "name", "rows"])

    return write_once(map_partitions(df, run, "partition int, attempt string, name string, rows long"), "committed")


def _store(folder: str) -> tuple[pa_fs.FileSystem, str]:
    """The file system of a folder (a URI or a path) and the path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return pa_fs.FileSystem.from_uri(folder) if "://" in folder else (pa_fs.LocalFileSystem(), folder)


def write_arrow_files(df: DataFrame, folder: str) -> DataFrame:
    """One Arrow IPC file a partition that has rows, written by the task itself below
    ``folder`` (a URI or a shared path); the list of the files that count."""
    def work(attempt: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
        store, top = _store(folder)
        name, out, rows = f"{attempt}.arrow", None, 0
        for b in batches:
            if out is None:
                store.create_dir(top, recursive=True)
                sink = store.open_output_stream(f"{top}/{name}")
                out = pa.ipc.new_file(sink, b.schema)
            out.write_batch(b)
            rows += b.num_rows
        if out is not None:
            out.close()
            sink.close()
            yield name, rows

    return for_each_partition(df, work)


def read_arrow_files(listed: DataFrame, folder: str, schema) -> DataFrame:
    """The rows of the listed files, one task or more a file."""
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_file(f"{top}/{name}") as f:
                    file = pa.ipc.open_file(f)
                    for i in range(file.num_record_batches):
                        yield file.get_batch(i)

    parts = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.select("name").repartition(parts, "name").mapInArrow(load, schema)


def partition_stats(df: DataFrame, value: str) -> DataFrame:
    """Per-partition work in Python over Arrow batches (one summary row
    per partition: rows and the sum of ``value``), the vectorised form of a
    per-partition function."""
    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, 0.0
        for b in batches:
            rows += b.num_rows
            col = b.column(0)
            s = pc.sum(col).as_py() if b.num_rows else None
            total += s or 0.0
        yield pa.RecordBatch.from_pydict({"rows": [rows], "total": [float(total)]},
                                         schema=pa.schema([("rows", pa.int64()), ("total", pa.float64())]))

    return map_partitions(df.select(F.col(value).cast("double")), summarize, "rows long, total double")
