"""Alignment of two tokenizers' tokens by diagonal run skipping.

Text A is the tokens of " " + text by a byte-level BPE file, text B those of the
text by a sentencepiece model, which adds the space itself.  Both cut the same
bytes, so their alignment lies in the two sorted arrays of token ends.  At the
current shift between the indexes the arrays are compared in steps that double
while they agree and then halve, so a stretch of one-to-one tokens is jumped over
in a few comparisons; where they differ the smaller end advances until both meet,
which closes an irregular group and sets a new shift.

A link is a pair of tokens that end together; the count of an (A id, B id) pair is
the number of its links in the whole corpus.  Links are kept by block: a block of
documents lists its distinct pairs once, and its links point into that list.  Only
the lists are counted and joined with the corpus counts, so no row of a pair is as
frequent as the pair itself; then every block's documents meet its list.

Results: texts that are null or empty, or whose tokens' bytes differ from the
text's (a normalising B, say), have no tokens: all figures 0, no groups.  Strings
of special tokens are plain text.  Repeated rows count each; null ids stay; other
columns are ignored; no rows, no result.
"""

from __future__ import annotations

import gc
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspan.llm.common import slices, worker_cache, written
from matchspan.llm.token_count import byte_letters

#: Links of a block; a longer document is a block of its own.
BLOCK_LINKS = 1_000_000
#: Texts and characters that go to a library in one call.
CALL_TEXTS, CALL_CHARS = 64, 400_000
#: Tokens compared first at a new shift.
FIRST_STEP = 8


class Tokenizers:
    """Both vocabularies with the bytes of each id."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(_file(a_file))
        self.a.encode_special_tokens = True
        letters = byte_letters()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode("utf-8")
        self.b = sentencepiece.SentencePieceProcessor(model_file=_file(b_file))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]
        self.a_size, self.b_size = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        small = np.uint8 if max(*self.a_size, *self.b_size) < 256 else np.uint32
        self.a_sizes, self.b_sizes = np.array(self.a_size, small), np.array(self.b_size, small)
        # every id with each sign that may follow it
        most = max(len(self.a_size), len(self.b_size))
        self.comma, self.bar, self.semicolon, self.nothing = range(0, 4 * most, most)
        self.told = pa.array([f"{i}{sign}" for sign in (",", "|", ";", "") for i in range(most)], pa.string())

        self.fast = self._by_rank(_file(a_file))

    def _by_rank(self, path: str):
        """A faster encoder of the same vocabulary where its merges stand in the order of
        the ids they make, so that the lowest id is the next merge; else None."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        singles = sorted(i for c, i in vocab.items() if c in letters)
        if made != sorted(made) or len(singles) != 256 or singles[-1] > made[0] or spec.get("normalizer"):
            return None
        # each entry's last merge is the listed one: the order of merges within it decides
        ranks = {self.a_bytes[i]: i for i in [*singles, *made]}
        return tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, text: str) -> list[int]:
        if self.fast is not None:
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both sides; none on either where they do not give the text's bytes."""
        for t, y in zip(texts, self.b.encode(texts, num_threads=1)):
            want = b" " + t.encode("utf-8")
            if not t or b"".join(map(self.b_bytes.__getitem__, y)) != want:
                yield [], []
                continue
            x = self.a_ids(" " + t)
            # the ranks hold every byte and the pattern every character, so by rank no byte is lost
            yield (x, y) if self.fast is not None or b"".join(map(self.a_bytes.__getitem__, x)) == want else ([], [])


def _file(name: str) -> str:
    """A public tokenizer's file by its name, found where the task runs; other paths as they are."""
    return name if "/" in name else public_tokenizers.path(name)


def _tokenizers(a_file: str, b_file: str) -> Tokenizers:
    kept = worker_cache()
    if ("aligned", a_file, b_file) not in kept:
        kept["aligned", a_file, b_file] = Tokenizers(a_file, b_file)
    return kept["aligned", a_file, b_file]


def irregular(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """i, i_end, j, j_end of the irregular groups, told by a first end that differs;
    between them lie stretches of tokens that end together one by one.  ``a`` and ``b`` are
    the tokens' sizes, none 0, of equal sums: where ends meet, equal sizes go on meeting."""
    width, n = a.itemsize, len(a)
    a_raw, b_raw = a.tobytes(), b.tobytes()
    a_size, b_size = memoryview(a_raw).cast(a.dtype.char), memoryview(b_raw).cast(a.dtype.char)
    number, found = int.from_bytes, ([], [], [], [])
    add_i, add_x, add_j, add_y = (f.append for f in found)
    i = j = 0
    while i < n:
        step = FIRST_STEP
        while True:  # the stretch: steps double while they agree
            p, q = a_raw[i * width:(i + step) * width], b_raw[j * width:(j + step) * width]
            if p != q:
                break
            i, j, step = i + len(p) // width, j + len(p) // width, 2 * step
            if i >= n:
                return found
        apart = number(p, "little") ^ number(q, "little")
        same = ((apart & -apart).bit_length() - 1) // (8 * width)  # tokens before the first that differs
        i, j = i + same, j + same
        add_i(i)
        add_j(j)
        x, y = a_size[i], b_size[j]
        i, j = i + 1, j + 1
        while x != y:
            if x < y:
                x += a_size[i]
                i += 1
            else:
                y += b_size[j]
                j += 1
        add_x(i)
        add_y(j)
    return found


def runs(a_ends: list[int], b_ends: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(i, i_end, j, j_end): one-to-one stretches (i_end - i == j_end - j tokens that end
    together one by one) and irregular groups (one group of tokens i..i_end, j..j_end,
    told by a first end that differs).  Both lists rise and end alike."""
    i = j = 0
    for g, g_end, h, h_end in zip(*irregular(*(np.diff(np.array(e, np.int64), prepend=0).astype(np.uint32) for e in (a_ends, b_ends)))):
        if g > i:
            yield i, g, j, h
        yield g, g_end, h, h_end
        i, j = g_end, h_end
    if i < len(a_ends):
        yield i, len(a_ends), j, len(b_ends)


def _ends_group(starts: list[int], ends: list[int], n: int) -> np.ndarray:
    """Whether each of n tokens ends a group, by the irregular groups; all others are groups of one."""
    edge = np.zeros(n + 1, np.int8)
    edge[starts] += 1
    edge[np.array(ends, np.int64) - 1] -= 1
    return np.cumsum(edge[:n], dtype=np.int8) == 0


def align_tokens(a: list[list[int]], b: list[list[int]], t: Tokenizers) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of texts' ids: the groups of each as ``a1,a2|b1;a3|b2,b3``, the links (a << 32 | b)
    of all in order, and how many each text has.  The texts are aligned in one pass, as
    both sides of each end alike."""
    a_at, b_at = (np.cumsum([0, *map(len, x)]) for x in (a, b))
    a, b = (np.fromiter(chain.from_iterable(x), np.int64, at[-1]) for x, at in ((a, a_at), (b, b_at)))
    i, x, j, y = irregular(t.a_sizes[a], t.b_sizes[b])
    a_last, b_last = _ends_group(i, x, len(a)), _ends_group(j, y, len(b))
    a_links, b_links = np.flatnonzero(a_last), np.flatnonzero(b_last)
    keys = a[a_links] << 32 | b[b_links]

    # a token of A stands behind the groups before its own, a token of B behind its group's part of A, too
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    said = np.empty(len(a) + len(b), np.int64)
    said[np.arange(len(a)) + np.append(0, b_links + 1)[a_group]] = a + np.where(a_last, t.bar, t.comma)
    end = np.where(b_last, t.semicolon, t.comma)
    end[b_at[1:][b_at[1:] > b_at[:-1]] - 1] = t.nothing
    said[np.arange(len(b)) + (a_links + 1)[b_group]] = b + end
    told = t.told.take(pa.array(said))
    places = np.frombuffer(told.buffers()[1], np.int32, len(said) + 1)[a_at + b_at] if len(said) else np.zeros(len(a_at), np.int32)
    groups = pa.StringArray.from_buffers(len(a_at) - 1, pa.py_buffer(places.tobytes()), told.buffers()[2] or pa.py_buffer(b""))
    return groups, keys, np.diff(np.searchsorted(a_links, a_at))


def _calls(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for b in slices(batches, CALL_TEXTS):
        texts, at, size = b.column(1).to_pylist(), 0, 0
        for k, t in enumerate(texts):
            if size and size + len(t) > CALL_CHARS:
                yield b.column(0).slice(at, k - at), texts[at:k]
                at, size = k, 0
            size += len(t)
        yield b.column(0).slice(at), texts[at:]


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """Rows of documents: ``id_col``, n_a, n_b, n_groups, groups, block, links (places in
    the block's list of pairs, 32 bits each).  Rows of blocks: block, pairs (a << 32 | b,
    rising) and times, the rest null.  Write it before it is read twice: block numbers
    hold for one run."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"{id_col} {kind}, n_a long, n_b long, n_groups long, groups string, block long, links binary, pairs array<bigint>, times array<bigint>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizers(a_file, b_file)
        block = TaskContext.get().partitionId() << 32
        ids, figures, groups, keys, held = [], [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal block, held
            if not ids:
                return
            place, pairs = pd.factorize(np.concatenate(keys))  # by hash; the few distinct ones are sorted then
            order = np.argsort(pairs)
            rank = np.empty(len(order), "<u4")
            rank[order] = np.arange(len(order))
            place, pairs = rank[place], pairs[order]
            times, at, links = np.bincount(place, minlength=len(pairs)), 0, []
            for _, _, k in figures:
                links.append(place[at:at + k].tobytes())
                at += k
            whole = pa.concat_arrays(ids)
            n = len(whole)
            none = pa.nulls(n, pa.list_(pa.int64()))
            columns = [whole, *(pa.array(c, pa.int64()) for c in zip(*figures)), pa.concat_arrays(groups), pa.array([block] * n, pa.int64()), pa.array(links, pa.binary()), none, none]
            out = pa.RecordBatch.from_arrays(columns, names=names)
            yield out
            empty = [pa.nulls(1, f.type) for f in out.schema]
            empty[5] = pa.array([block], pa.int64())
            empty[7], empty[8] = pa.array([pairs.tolist()], pa.list_(pa.int64())), pa.array([times.tolist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(empty, names=names)
            block, held = block + 1, 0
            ids.clear(), figures.clear(), groups.clear(), keys.clear()

        gc.disable()  # many small lists, no cycles
        try:
            for some, texts in _calls(batches):
                a, b = zip(*t.encode(texts))
                told, links, n = align_tokens(a, b, t)
                figures += zip(map(len, a), map(len, b), n.tolist())
                keys.append(links)
                groups.append(told)
                held += len(links)
                ids.append(some)
                if held >= block_links or len(figures) >= block_links:
                    yield from close()
            yield from close()
        finally:
            gc.enable()

    names = [id_col, "n_a", "n_b", "n_groups", "groups", "block", "links", "pairs", "times"]
    return source.mapInArrow(work, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n (links of the pair in the corpus) and best: no other pair of that b has more."""
    lists = aligned.where("pairs IS NOT NULL").select(F.inline(F.arrays_zip("pairs", "times")))
    n = lists.groupBy("pairs").agg(F.sum("times").alias("n")).select("pairs", F.shiftright("pairs", 32).alias("a"), F.col("pairs").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n")
    most = n.groupBy("b").agg(F.max("n").alias("most"))
    return n.join(most, "b").select("pairs", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def link_figures(aligned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of documents of ``aligned`` (written) with n_links, n_best and count_sum
    in place of block and links."""
    kept = [f for f in aligned.schema.fields if f.name not in ("block", "links", "pairs", "times")]
    counts = written(pair_counts(aligned).select("pairs", (F.col("n") * 2 + F.col("best").cast("long")).alias("code")))
    lists = aligned.where("pairs IS NOT NULL").select("block", F.explode("pairs").alias("pairs"))
    # a pair stands in a block's list once, so no key of this join is hot
    codes = lists.join(counts, "pairs").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pairs", "code"))).alias("l"))
    codes = codes.select("block", F.lit(0).alias("turn"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in kept], F.lit(None).cast("binary").alias("links"), F.col("l.code").alias("codes"))
    rows = aligned.where("pairs IS NULL").select("block", F.lit(1).alias("turn"), *[f.name for f in kept], "links", F.lit(None).cast("array<bigint>").alias("codes"))
    names = [f.name for f in kept] + ["n_links", "n_best", "count_sum"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = np.zeros(0, np.int64)
        for b in slices(batches):
            turns, links, codes, rows, out = b.column(1).to_pylist(), b.column(b.num_columns - 2), b.column(b.num_columns - 1), [], []
            for k, turn in enumerate(turns):
                if turn == 0:
                    code = np.asarray(codes[k].values, np.int64)
                else:
                    c = code[np.frombuffer(links[k].as_py(), "<u4")]
                    rows.append(k)
                    out.append((len(c), int((c & 1).sum()), int((c >> 1).sum())))
            if rows:
                taken = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*taken.columns[2:2 + len(kept)], *(pa.array(c, pa.int64()) for c in zip(*out))], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_links long, n_best long, count_sum long"
    return codes.unionByName(rows).repartition("block").sortWithinPartitions("block", "turn").mapInArrow(add, schema)
