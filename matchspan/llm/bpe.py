"""Byte-level BPE encoding and decoding through one global shuffle of distinct words.

Encoding:

1. Every task cuts its rows into blocks, splits the texts into pre-tokens and
   numbers the distinct words of each block; a text becomes its word numbers by
   position.  This is the exploded (word, document, position) relation with the
   copies of a word within a block folded before any shuffle.
2. Words go to the partition of their hash, packed as one row per block and
   partition, and each distinct word is encoded once for the whole table.
3. The ids join back by (block, number): the rows of a block, its words and its
   documents, meet in one partition and every document is put together by
   position.

Decoding joins ids with the table of token bytes (one row per rank, bounded by
the vocabulary).

A word has one row a block at most, so no word is hot, and a block has at most
``BLOCK_WORDS`` distinct words plus those of one text.  Steps 1 and 3 read the
table twice; a block's name is a digest of its
rows, so that a source which gives other rows, or another order, the
second time raises an error.

Results: a null or empty text has no tokens; repeated rows are each returned.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from matchspan.llm.common import slices, text_or_empty, worker_cache
from matchspan.llm.pretokens import splitter

#: A block ends with the text that brings it to this many distinct words.
BLOCK_WORDS = 250_000
#: Or to this many tokens, a row counting as 16 more.
BLOCK_TOKENS = 3_000_000
#: Words whose ids the encoding of one partition remembers.
WORDS_KNOWN = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _encoding(path: str) -> tiktoken.Encoding:
    kept = worker_cache()
    if ("ranks", path) not in kept:
        kept["ranks", path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    return kept["ranks", path]


class TokenBytes:
    """The token-byte table: the bytes of every id, ready to be gathered."""

    def __init__(self, path: str):
        ranks = load_ranks(path)
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _token_bytes(path: str) -> TokenBytes:
    kept = worker_cache()
    if ("token bytes", path) not in kept:
        kept["token bytes", path] = TokenBytes(path)
    return kept["token bytes", path]


def _blocks(batches: Iterator[pa.RecordBatch], most: int, most_tokens: int) -> Iterator[tuple[int, list[str], list]]:
    """The blocks of this task's rows (id, text): a name, the distinct words
    (frequent ones first), and the rows as (id, word numbers).  The name is a
    digest of the words and numbers; blocks of equal content may share it, as
    their words have equal ids."""
    split = splitter()
    words: dict[str, int] = {}
    rows: list = []
    tokens = 0

    def block():
        flat = np.concatenate([n for _, n in rows])
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        known = list(words)
        known = [known[i] for i in order.tolist()]
        name = hashlib.blake2b("\0".join(known).encode("utf-8"), digest_size=8)
        ranked = [(k, rank[n]) for k, n in rows]
        for _, numbers in ranked:
            name.update(len(numbers).to_bytes(8, "little") + numbers.tobytes())
        words.clear()
        rows.clear()
        return int.from_bytes(name.digest(), "little", signed=True), known, ranked

    for b in slices(batches):
        for key, text in zip(b.column(0), b.column(1).to_pylist()):
            numbers = np.array([words.setdefault(w, len(words)) for w in split(text)], np.uint32)
            rows.append((key.as_py(), numbers))
            tokens += len(numbers) + 16
            if len(words) >= most or tokens >= most_tokens:
                yield block()
                tokens = 0
    if rows:
        yield block()


#: Numbers below ONE take a byte, those below TWO two bytes, all others three or five.
_ONE, _TWO = 192, 192 + 48 * 256
_THREE = _TWO + 15 * 65536


def _pack(v: np.ndarray) -> bytes:
    """Numbers as lead bytes, then the second, third and further bytes of those that have them."""
    v = v.astype(np.int64)
    two, three, five = (v >= _ONE) & (v < _TWO), (v >= _TWO) & (v < _THREE), v >= _THREE
    lead = np.where(two, _ONE + ((v - _ONE) >> 8), np.where(three, 240 + ((v - _TWO) >> 16), np.where(five, 255, v)))
    return len(v).to_bytes(4, "little") + lead.astype(np.uint8).tobytes() + ((v[two] - _ONE) & 255).astype(np.uint8).tobytes() + ((v[three] - _TWO) & 65535).astype("<u2").tobytes() + v[five].astype("<u4").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    lead = np.frombuffer(data, np.uint8, n, 4).astype(np.int64)
    two, three, five = (lead >= _ONE) & (lead < 240), (lead >= 240) & (lead < 255), lead == 255
    at, v = 4 + n, lead.copy()
    k = int(two.sum())
    v[two] = _ONE + ((lead[two] - _ONE) << 8) + np.frombuffer(data, np.uint8, k, at)
    at += k
    k = int(three.sum())
    v[three] = _TWO + ((lead[three] - 240) << 16) + np.frombuffer(data, "<u2", k, at)
    v[five] = np.frombuffer(data, "<u4", int(five.sum()), at + 2 * k)
    return v


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``id_col``, ids (binary: little-endian unsigned 32-bit) of every row."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind, id_type = source.schema["id"].dataType.simpleString(), to_arrow_type(source.schema["id"].dataType)
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def words_of(batches):
        for name, words, rows in _blocks(batches, block_words, block_tokens):
            del rows
            raw = [w.encode("utf-8") for w in words]
            part = np.array([zlib.crc32(w) % parts for w in raw], np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.append(0, np.cumsum(np.bincount(part, minlength=parts)))
            full = [(p, order[cuts[p]: cuts[p + 1]]) for p in range(parts) if cuts[p + 1] > cuts[p]]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in full], pa.int32()),
                pa.array([name] * len(full), pa.int64()),
                # a word's number is the sum of the steps up to it
                pa.array([_pack(np.diff(at, prepend=0)) for _, at in full], pa.binary()),
                pa.array([_pack(np.array([len(raw[i]) for i in at], np.int64)) + b"".join([raw[i] for i in at]) for _, at in full], pa.binary()),
            ], names=["part", "block", "numbers", "words"])

    def encode_words(batches):
        encoding, known = _encoding(ranks), {}
        kind = "<u2" if encoding.max_token_value < 1 << 16 else "<u4"
        for b in slices(batches, 16):
            out = []
            for blob in b.column(3).to_pylist():
                ids = []
                for w in _cut(blob):
                    found = known.get(w)
                    if found is None:
                        if len(known) > WORDS_KNOWN:
                            known.clear()
                        found = known[w] = np.array(encoding.encode_ordinary(w.decode("utf-8")), kind).tobytes()
                    ids.append(found)
                out.append(_pack(np.array([len(x) for x in ids], np.int64) // int(kind[-1])) + b"".join(ids))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.binary())], names=["block", "numbers", "ids"])

    def documents_of(batches):
        for name, words, rows in _blocks(batches, block_words, block_tokens):
            del words
            for at in range(0, len(rows), 1000):
                some = rows[at: at + 1000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(some), pa.int64()),
                    pa.array([k for k, _ in some], id_type),
                    pa.array([_pack(n) for _, n in some], pa.binary()),
                ], names=["block", "id", "numbers"])

    def assemble(batches):
        wide = "<u2" if len(_token_bytes(ranks).tokens) <= 1 << 16 else "<u4"
        now, parts_of, starts, lengths, flat = None, {}, None, None, None
        for b in slices(batches, 1000):
            blocks, numbers, ids, keys = b.columns
            ids, numbers, rows = ids.to_pylist(), numbers.to_pylist(), []
            for i, block in enumerate(blocks.to_pylist()):
                if block != now:
                    now, parts_of, starts = block, {}, None
                if ids[i] is not None:
                    parts_of[numbers[i]] = ids[i]  # equal blocks bring equal parts
                    continue
                if starts is None:  # the words of a block come before its documents
                    order, lengths, flat = _table(parts_of, wide)
                    starts = np.cumsum(lengths) - lengths
                    starts, lengths = starts[order], lengths[order]
                    parts_of = {}
                places = _unpack(numbers[i])
                if len(places) and places.max() >= len(starts):
                    raise ValueError("the source gave other rows, or another order, the second time")
                rows.append((keys[i].as_py(), _gather(flat, starts, lengths, places).astype("<u4").tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], keys.type), pa.array([x for _, x in rows], pa.binary())], names=["id", "ids"])

    words = source.mapInArrow(words_of, "part int, block long, numbers binary, words binary")
    encoded = words.repartition(parts, "part").mapInArrow(encode_words, "block long, numbers binary, ids binary")
    documents = source.mapInArrow(documents_of, f"block long, id {kind}, numbers binary")
    both = encoded.selectExpr("block", "numbers", "ids", f"CAST(NULL AS {kind}) AS id").unionByName(
        documents.selectExpr("block", "numbers", "CAST(NULL AS binary) AS ids", "id"))
    whole = both.repartition(parts, "block").sortWithinPartitions("block", F.col("ids").isNull())
    return whole.mapInArrow(assemble, f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def _cut(blob: bytes) -> list[bytes]:
    """The words of a blob: packed lengths, then the words."""
    n = _unpack(blob)
    ends = np.cumsum(n) + len(blob) - int(n.sum())
    return [blob[lo:hi] for lo, hi in zip((ends - n).tolist(), ends.tolist())]


def _table(parts: dict[bytes, bytes], wide: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (numbers, ids) parts: the place of each word number, the words' lengths and all ids."""
    numbers, lengths, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for steps, blob in parts.items():
        n = _unpack(blob)
        numbers.append(np.cumsum(_unpack(steps)))
        lengths.append(n)
        flat.append(blob[len(blob) - int(n.sum()) * int(wide[-1]):])
    numbers = np.concatenate(numbers)
    order = np.argsort(numbers, kind="stable")
    return order, np.concatenate(lengths), np.frombuffer(b"".join(flat), wide)


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The ids of the words ``numbers``, one after another."""
    if not len(numbers):
        return np.zeros(0, np.int64)
    n = lengths[numbers]
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1]) + np.repeat(starts[numbers] - ends + n, n)]


def decode(encoded: DataFrame, ranks: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for."""
    schema = encoded.drop(out_col).schema.add(out_col, "binary")

    def join(batches):
        table = _token_bytes(ranks)
        for b in slices(batches):
            ids = b.column(b.schema.get_field_index(ids_col)).to_pylist()
            kept = [(n, b.column(i)) for i, n in enumerate(b.schema.names) if n != out_col]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array([None if x is None else table.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary())], names=[n for n, _ in kept] + [out_col])

    return encoded.mapInArrow(join, schema)


def public_ranks(name: str = "byte_bpe_50k.tiktoken") -> str:
    return public_tokenizers.path(name)
