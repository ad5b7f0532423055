"""Registered queries of this package, over whole tables, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchspan.llm import alignment, bpe, chat_format, decontaminate, exact_dedup, jaccard_join, license_scan, one_permutation, quality, spelling, token_count, toxicity, warc
from matchspan.llm.common import held_out, read, written


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read(spark, sf_dir, "documents"), token_count.public_vocabulary(), 512)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read(spark, sf_dir, "documents"), held_out(4, 2)
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels"), "toxic", held), held)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read(spark, sf_dir, "documents"), held_out(5, 0)
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels"), "quality", held), held)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.public_ranks()
    whole = bpe.decode(bpe.encode(read(spark, sf_dir, "documents"), ranks), ranks)
    return whole.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot holds the rows with an even crc32 of the id, the batch all others."""
    docs = read(spark, sf_dir, "documents")
    rows = exact_dedup.dedup(docs, F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(read(spark, sf_dir, "documents"), width=5, least=0.8)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"), min_bytes=0)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.ordered_turns(read(spark, sf_dir, "conversations"))
    chosen, rejected = chat_format.mismatched_answers(turns)
    return chat_format.format_pairs(chosen, rejected, "conv_id")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_permutation.near_documents(read(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(read(spark, sf_dir, "documents")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(read(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model")
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return alignment.link_figures(written(aligned.withColumn("groups_sha256", digest).drop("groups")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_warc": op9_warc,
    "op10_chat_format": op10_chat_format,
    "op11_fingerprints": op11_fingerprints,
    "op12_spelling": op12_spelling,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = {
    "op2_license_scan": license_scan.oracle_sql(),
    "op7_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)""",
    "op10_chat_format": chat_format.oracle_sql(),
}
