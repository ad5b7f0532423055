"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import tempfile
import time
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: LOWER, and every ASCII byte that is not [0-9a-z] becomes a blank: split() then
#: gives the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, as all bytes of a
#: non-ASCII character are above 0x7F.
WORDS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in LOWER)
UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def known_to_workers(spark: SparkSession) -> SparkSession:
    """Lets the workers' Python find this package also where the driver runs in another folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return known_to_workers(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that the session names in
    ``spark.checkpoint.dir``.  Only a local master may go without that setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="matchspan-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the
    lineage, so that a lost executor costs one task and no whole recomputation,
    and later steps read only the columns that they need."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small pieces of Arrow batches, so that few texts are Python objects at a time."""
    _give_back()  # what the task before left: its objects live until its function ends
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    _give_back()


def _give_back() -> None:
    """Freed memory of a Python worker goes back to the system, and what it kept for an
    operator that has not asked for it since IDLE_S: workers are reused by later stages,
    and would keep the peak of all stages before."""
    if time.monotonic() - _asked > IDLE_S:
        _CACHE.clear()
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):  # glibc only
        _LIBC.malloc_trim(0)


def text_or_empty(col: str = "text") -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def held_out(folds: int, fold: int, col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % folds == fold, F.lit(False))


def file_of(uri: str) -> tuple[object, str]:
    """The Arrow file system and the path in it of a URI or a local path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def worker_cache() -> dict:
    """Objects that a Python worker keeps between tasks (vocabularies, automata)."""
    global _asked
    _asked = time.monotonic()
    return _CACHE


#: Seconds that kept objects outlast their last use.
IDLE_S = 20
_asked = 0.0
_CACHE: dict = {}
_LIBC = ctypes.CDLL(None)
