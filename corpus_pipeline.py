"""A corpus pipeline over ``documents``: toxicity, exact dedup, near dedup,
benchmark decontamination, byte-level BPE.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and is written as Parquet before the next one reads it.  All but the last
return the columns of ``documents``.  Null texts count as empty.  The dedup
stages decide by id and text: of rows that are copies (or near copies) one stays,
that with the smallest id; rows without an id stay only where no row with an id
does, and equal ids are ordered by text.  Rows that repeat an id with different
texts are different documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspan.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from matchspan.llm.common import held_out, known_to_workers, read, text_or_empty, written
from matchspan.operators.aggregates import quoted

#: Rows of an Arrow batch.
BATCH_ROWS = 500
#: Distinct words and tokens of a block of the encoder: a third of its own, as the executors come from four other stages.
BLOCK = {"block_words": 100_000, "block_tokens": 1_000_000}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more are rejected; the model learns from the labelled documents of the table."""
    _small_batches(spark)
    model = toxicity.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "toxic", held_out(4, 2))
    return toxicity.keep_ordinary(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    _small_batches(spark)
    found = exact_dedup.dedup(docs, F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return _those(docs, found.where("kept").select(*_id(), F.col("digest").alias("name")), F.unhex(F.sha2(exact_dedup.normalised(), 256)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard 0.8 or more join, the one with the smallest id stays."""
    _small_batches(spark)
    name = F.unhex(F.sha2(text_or_empty(), 256))
    # ordered by all of it, so that one row of a component is the smallest whatever its ids
    rows = docs.select(F.struct(*_id(), name.alias("name")).alias("row"), "text")
    found = jaccard_join.link_components(rows, width=5, least=0.8, id_col="row")
    return _those(docs, found.where("row <=> component_id").select("row.*"), name)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    _small_batches(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and the digest of the bytes that they decode to.
    The ids are written before they are decoded: in one stage encoder and decoder
    would hold two Python workers a core."""
    _small_batches(spark)
    ranks = bpe.public_ranks()
    whole = bpe.decode(written(bpe.encode(docs, ranks, **BLOCK)), ranks)
    return whole.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def _small_batches(spark: SparkSession) -> None:
    """Rows go to the Python workers at most ``BATCH_ROWS`` at a time, as a batch of whole
    texts is held in the JVM and in the worker at once.  Stages are lazy, so the
    session keeps the setting; a smaller one of its own stays."""
    known_to_workers(spark)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(setting))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def _id() -> list[Column]:
    """The id as columns without nulls; rows without an id come last."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id")]


def _those(docs: DataFrame, kept: DataFrame, name: Column) -> DataFrame:
    """Of the rows of ``docs`` with each (no_id, id, name) of ``kept`` the smallest one.
    Copies fold in each task before the texts are shuffled, which is once: the
    aggregate and the semi join share its partitioning."""
    fields = F.struct(*[quoted(c).alias(f"f{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(*_id(), name.alias("name"), fields.alias("row"))
    # maps have no order; a row that holds one is ordered by its JSON text
    smallest = F.min_by("row", F.to_json("row")) if "map<" in docs.schema.simpleString() else F.min("row")
    one = rows.groupBy("no_id", "id", "name").agg(smallest.alias("row"))
    kept = one.join(kept.hint("merge"), ["no_id", "id", "name"], "left_semi")
    return kept.select(*[F.col(f"row.f{i}").alias(c) for i, c in enumerate(docs.columns)])



STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE", encode),
]

#: No stage but exact dedup has an SQL form of its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
