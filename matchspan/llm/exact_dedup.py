"""Exact deduplication with static binary-fuse filters over an immutable snapshot.

The table comes as a snapshot (rows taken in earlier) and a batch (incoming
rows).  Texts count as equal when identical after each run of ASCII white space
has become one blank.

1. Every row gets the SHA-256 of its normalised text; (id, digest) is written
   once, the texts stay where they are.
2. The snapshot's distinct digests are dealt to buckets by digest, and each
   bucket gets a 3-wise binary-fuse filter of 16-bit fingerprints, built once.
3. The batch's digests are grouped among themselves (new-batch duplicates) and
   screened by the filter of their bucket.  A negative is certainly new.
4. Positives join the snapshot's exact bucket by digest.  Groups of more than
   one row then have their texts compared byte for byte: the smallest and the
   largest text of a digest must be the same.  Should two texts share a digest,
   the rows of that digest are grouped by the texts themselves.

Copies fold into one row per digest in each task before a shuffle, and the text
is read with (id, digest) as key, so that a group that holds a third of all rows
fills no task.

Results: null counts as empty; all empty texts are one group.  Of equal texts
the row with the smallest id stays; a null id stays only if its group has no
other.  Repeated rows (same id and text) are each returned, count each in
``group_size`` and have the same ``kept``.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspan.llm.common import text_or_empty, written

#: Snapshot digests that one filter holds on average.
BUCKET_KEYS = 4_000
M = np.uint64(0xFF51AFD7ED558CCD)


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]+", " ")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(33))) * M
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class FuseFilter:
    """A static 3-wise binary-fuse filter of unsigned 64-bit keys: the
    fingerprint of a key is the exclusive or of the three slots that it has in
    three neighbouring segments."""

    def __init__(self, seed: int, segment: int, segments: int, slots: np.ndarray):
        self.seed, self.segment, self.segments, self.slots = seed, segment, segments, slots

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = _mix(keys, seed)
        first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        low = np.uint64(segment - 1)
        at = [(first + np.uint64(k)) * np.uint64(segment) + ((h >> np.uint64(18 * k)) & low if k else (h ^ (h >> np.uint64(40))) & low) for k in range(3)]
        return np.stack(at).astype(np.int64), (_mix(h, 7) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peels the keys round by round: a slot with one key left fixes that key."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        segment = min(segment, 1 << 18)
        for seed in range(1, 200):
            room = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))) * (1 + 0.02 * (seed - 1))) + 8
            segments = max(1, -(-room // segment) - 2)
            at, mark = cls.places(keys, seed, segment, segments)
            size = segment * (segments + 2)
            count = np.bincount(at.reshape(-1), minlength=size)
            names = np.zeros(size, np.int64)
            for row in at:
                np.bitwise_xor.at(names, row, np.arange(n))
            rounds, left = [], n
            while True:
                slots = np.flatnonzero(count == 1)
                if not len(slots):
                    break
                peeled, where = np.unique(names[slots], return_index=True)
                rounds.append((peeled, slots[where]))
                for row in at:
                    np.subtract.at(count, row[peeled], 1)
                    np.bitwise_xor.at(names, row[peeled], peeled)
                left -= len(peeled)
            if left:
                continue
            table = np.zeros(size, np.uint16)
            for peeled, slots in reversed(rounds):
                table[slots] = 0
                table[slots] = mark[peeled] ^ table[at[0][peeled]] ^ table[at[1][peeled]] ^ table[at[2][peeled]]
            return cls(seed, segment, segments, table)
        raise ValueError("no seed peels these keys")

    def has(self, keys: np.ndarray) -> np.ndarray:
        at, mark = self.places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return (self.slots[at[0]] ^ self.slots[at[1]] ^ self.slots[at[2]]) == mark


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8].ljust(8, b"\0") for d in digests), "<u8").astype(np.uint64)


def build_filters(digests: DataFrame) -> DataFrame:
    """One row per bucket of the distinct (bucket, digest): seed, segment, segments, slots."""

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        f = FuseFilter.build(_keys(keys["digest"]))
        return pd.DataFrame([{"bucket": keys["bucket"].iloc[0], "seed": f.seed, "segment": f.segment, "segments": f.segments, "slots": f.slots.tobytes()}])

    return digests.groupBy("bucket").applyInPandas(build, "bucket int, seed int, segment int, segments int, slots binary")


def screen(digests: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows (bucket, digest, ...) with ``maybe``: the filter of their bucket lets them pass."""
    schema = digests.schema
    names = schema.names

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, now = None, None
        for b in batches:
            n = b.num_rows
            maybe, row, buckets = np.zeros(n, bool), np.ones(n, bool), np.asarray(b.column(b.schema.get_field_index("bucket")))
            cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1), n] if n else [0]
            for lo, hi in zip(cuts, cuts[1:]):
                if buckets[lo] != bucket:
                    bucket, now = buckets[lo], None
                at = lo
                slots = b.column(b.schema.get_field_index("slots"))
                if slots[lo].is_valid:  # the filter's row stands first in its bucket
                    seed, segment, segments = (b.column(b.schema.get_field_index(c))[lo].as_py() for c in ("seed", "segment", "segments"))
                    now, at, row[lo] = FuseFilter(seed, segment, segments, np.frombuffer(slots[lo].as_py(), np.uint16)), lo + 1, False
                if now is not None and at < hi:
                    maybe[at:hi] = now.has(_keys(b.column(b.schema.get_field_index("digest")).slice(at, hi - at).to_pylist()))
            out = b.select(names)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(maybe)], names=[*names, "maybe"]).filter(pa.array(row))

    extra = "seed int, segment int, segments int, slots binary"
    rows = digests.withColumns({c.split()[0]: F.lit(None).cast(c.split()[1]) for c in extra.split(", ")})
    heads = filters.select(*[F.col(c) if c in filters.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in rows.columns])
    parts = int(digests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = rows.unionByName(heads).repartition(parts, "bucket").sortWithinPartitions("bucket", F.col("slots").isNull())
    return both.mapInArrow(test, T.StructType([*schema.fields, T.StructField("maybe", T.BooleanType())]))


def dedup(docs: DataFrame, in_snapshot: Column, id_col: str = "doc_id", text_col: str = "text", digest: Column | None = None, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``id_col``, keep_id, group_size, kept, digest of every row.

    ``in_snapshot`` tells the snapshot's rows from the batch's.  ``digest``
    replaces the SHA-256 of the normalised text (tests use a short one)."""
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("text"), F.coalesce(in_snapshot, F.lit(False)).alias("old"))
    source = source.withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)) if digest is None else digest)
    rows = written(source.select("id", "old", "digest"))

    old = written(rows.where("old").groupBy("digest").agg(F.min("id").alias("old_id"), F.count(F.lit(1)).alias("old_n")))
    buckets = max(1, -(-old.count() // bucket_keys))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")
    filters = build_filters(old.select(bucket, "digest"))
    new = rows.where("NOT old").groupBy("digest").agg(F.min("id").alias("new_id"), F.count(F.lit(1)).alias("new_n"))
    screened = written(screen(new.select(bucket, "digest", "new_id", "new_n"), filters).drop("bucket"))
    positives = screened.where("maybe")
    met = old.join(positives, "digest", "left").select("digest", F.least("old_id", "new_id").alias("keep_id"), (F.col("old_n") + F.coalesce("new_n", F.lit(0))).alias("group_size"))
    false = positives.join(old.select("digest"), "digest", "left_anti")
    fresh = screened.where("NOT maybe").unionByName(false).select("digest", F.col("new_id").alias("keep_id"), F.col("new_n").alias("group_size"))
    groups = written(met.unionByName(fresh))

    members = rows.join(groups.where("group_size > 1").select("digest"), "digest", "left_semi").select(F.col("id").alias("mid"), F.col("digest").alias("md"))
    texts = source.join(members, F.col("id").eqNullSafe(F.col("mid")) & (F.col("digest") == F.col("md")), "left_semi")
    shared = texts.groupBy("digest").agg(F.min("text").alias("lo"), F.max("text").alias("hi")).where("lo != hi").select("digest")
    shared = written(shared)

    sized = rows.join(groups, "digest").select("id", "digest", "keep_id", "group_size")
    if shared.isEmpty():
        whole = sized
    else:
        apart = source.join(shared, "digest", "left_semi").select("id", "digest", "text")
        by_text = apart.groupBy("digest", "text").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        whole = sized.join(shared, "digest", "left_anti").unionByName(apart.join(by_text, ["digest", "text"]).select("id", "digest", "keep_id", "group_size"))
    return whole.select(F.col("id").alias(id_col), F.col("keep_id").cast(kind).alias("keep_id"), "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
