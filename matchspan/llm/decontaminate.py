"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the normalised word sequences of the benchmark items.  A
document's words are streamed through it; after each word it knows the longest
run ending there that occurs in an item.  A window (``window`` consecutive item
words, or a whole shorter item) occurs where that run is at least as long as
the window and the automaton's state leads to it.  Document words inside any
occurrence are hit.  ``clean`` removes these spans, and documents whose hit
share exceeds ``max_coverage``.

Only items travel to the tasks, in blocks of at most ``BLOCK_WORDS`` words (plus
one item), so what is sent has a fixed size; documents are streamed once a
block and the findings of blocks are put together by row.

Results: A-Z count as a-z; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A null
or empty text, or one without words, has no words and no hits.  Items without
words match nothing; items with equal texts are all named; a null item_id with
words marks words but is not named.  Repeated document rows are each returned.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchspan.llm.common import LOWER_AZ, UPPER_AZ, WORD_PATTERN, WORDS, slices, text_or_empty, worker_cache, written
from matchspan.operators.aggregates import quoted

#: Benchmark words in one automaton (about 100 MB in a task).
BLOCK_WORDS = 200_000
_LOW = str.maketrans(UPPER_AZ, LOWER_AZ)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(WORDS).split()


class SuffixAutomaton:
    """The generalised suffix automaton of word sequences."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(key, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for key, words in items if words]
        for _, sequence in sequences:
            last = 0
            for c in sequence:
                last = self._extend(last, c)
        self.width, self.items = self._windows(sequences)

    def _extend(self, last: int, c: int) -> int:
        follow, link, length = self.next, self.link, self.length
        q = follow[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = cur
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        follow, link, length = self.next, self.link, self.length
        copy = len(follow)
        follow.append(dict(follow[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and follow[p].get(c) == q:
            follow[p][c] = copy
            p = link[p]
        return copy

    def step(self, state: int, run: int, c: int) -> tuple[int, int]:
        """The state and the longest matching run after word ``c``."""
        while c not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            run = self.length[state]
        return self.next[state][c], run + 1

    def _windows(self, sequences):
        """For each state the windows that end in its runs: (length, items), longest first."""
        ends: dict[int, dict[int, set]] = {}
        for key, sequence in sequences:
            size = min(self.window, len(sequence))
            state = run = 0
            for i, c in enumerate(sequence):
                state, run = self.step(state, run, c)
                if i + 1 >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    ends.setdefault(at, {}).setdefault(size, set()).add(key)
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        width: list[tuple[int, ...]] = [()] * len(self.length)
        items: list[tuple] = [()] * len(self.length)
        for v in order:
            own = sorted(((n, tuple(k)) for n, k in ends.get(v, {}).items()), reverse=True)
            up = self.link[v]
            items[v] = (*own, *items[up]) if own else items[up]
            width[v] = tuple(n for n, _ in items[v])
        return width, items

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """Which words are hit (None: none), and the items whose windows occur."""
        ids = list(map(self.vocabulary.get, words))
        follow, link, length, width, items = self.next, self.link, self.length, self.width, self.items
        state = run = 0
        spans: list[tuple[int, int]] = []
        found: set = set()
        for i, c in enumerate(ids):
            if c is None:
                state = run = 0
                continue
            to = follow[state].get(c)
            while to is None:
                state = link[state]
                if state < 0:
                    break
                run = length[state]
                to = follow[state].get(c)
            if to is None:
                state = run = 0
                continue
            state, run = to, run + 1
            if width[state]:
                for size, keys in items[state]:
                    if run >= size:
                        spans.append((i + 1 - size, i + 1))
                        found.update(keys)
        if not spans:
            return None, found
        edge = np.zeros(len(words) + 1, np.int64)
        for lo, hi in spans:
            edge[lo] += 1
            edge[hi] -= 1
        return np.cumsum(edge[:-1]) > 0, found


def _automaton(name: str, blob, window: int) -> SuffixAutomaton:
    kept = worker_cache()
    if kept.get("automaton name") != name:
        kept.pop("automaton", None)
        kept["automaton"], kept["automaton name"] = SuffixAutomaton([(k, words_of(t)) for k, t in blob.value], window), name
    return kept["automaton"]


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, str]]]:
    """The distinct items in blocks of at most ``block_words`` words, or of one item."""
    block: list[tuple[str | None, str]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("k"), text_or_empty("text").alias("t")).distinct()
    for r in rows.toLocalIterator():
        n = len(words_of(r["t"]))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        if n:
            block.append((r["k"], r["t"]))
            size += n
    yield block


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``id_col`` (and the columns ``keep``), n_words, n_hit, hits (binary: a bit a
    word, null without hits), items (sorted names) of every row."""
    columns = [id_col, *(c for c in keep or [] if c != id_col)]
    source = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(columns)], text_or_empty(text_col).alias("_text"))
    keys = source.columns[:-1]
    blocks = item_blocks(benchmark, block_words)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        found = _scan(source, first, window)
    else:
        row = F.sha2(F.to_json(F.struct(*source.columns), {"ignoreNullFields": "false"}), 256).alias("_row")
        keyed, parts = source.select(row, "_text"), None
        for block in itertools.chain([first, second], blocks):
            part = _scan(keyed, block, window).where("hits IS NOT NULL").select("_row", "hits", "items").distinct()
            parts = part if parts is None else parts.unionByName(part)
        parts = written(parts)

        def merge(rows):
            bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in rows["hits"]])
            rows = rows.iloc[:1].copy()
            rows["hits"], rows["n_hit"] = [bits.tobytes()], int(np.unpackbits(bits).sum())
            return rows[["_row", "hits", "n_hit"]]

        bits = parts.select("_row", "hits").groupBy("_row").applyInPandas(merge, "_row string, hits binary, n_hit long")
        items = parts.select("_row", F.explode("items").alias("i")).distinct().groupBy("_row").agg(F.array_sort(F.collect_list("i")).alias("items"))
        plain = _scan(source.select(*keys, row, "_text"), [], window).drop("hits", "items", "n_hit")
        found = plain.join(bits, "_row", "left").join(items, "_row", "left").withColumns({"items": F.coalesce("items", F.array().cast("array<string>")), "n_hit": F.coalesce("n_hit", F.lit(0))})
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, columns)], "n_words", "n_hit", "hits", "items")


def _scan(source: DataFrame, block: list, window: int) -> DataFrame:
    """The columns of ``source`` but the last, the text, and what one block's automaton finds."""
    name = hashlib.sha256(repr((window, block)).encode()).hexdigest()
    blob = source.sparkSession.sparkContext.broadcast(block)
    names = [*source.columns[:-1], "n_words", "n_hit", "hits", "items"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, blob, window)
        for b in slices(batches):
            counts, n_hit, hits, items = [], [], [], []
            for text in b.column(b.num_columns - 1).to_pylist():
                words = words_of(text)
                hit, found = automaton.scan(words)
                counts.append(len(words))
                n_hit.append(0 if hit is None else int(hit.sum()))
                hits.append(None if hit is None else np.packbits(hit).tobytes())
                items.append(sorted(k for k in found if k is not None))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))], names=names)

    schema = source.drop(source.columns[-1]).schema.add("n_words", "long").add("n_hit", "long").add("hits", "binary").add("items", T.ArrayType(T.StringType()))
    return source.mapInArrow(scan, schema)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the runs of hit words (each at least ``window`` words, or a
    whole shorter item, long), and without the rows in which more than
    ``max_coverage`` of the words are hit.  Rows without hits are
    returned as they are; a column n_chars is kept in step with a text that
    was cut."""
    columns = docs.columns
    plain = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(columns)])
    at = columns.index(text_col)
    found = find(plain, benchmark, window, id_col="c0", text_col=f"c{at}", keep=plain.columns[1:])
    names = plain.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, hits = b.column(at).to_pylist(), b.column(len(names)).to_pylist()
            changed = [t if h is None else _without(t, h) for t, h in zip(texts, hits)]
            out = [b.column(i) for i in range(len(names))]
            out[at] = pa.array(changed, pa.string())
            yield pa.RecordBatch.from_arrays(out, names=names)

    # written, so that rows are scanned once and no core holds a worker that scans beside one that cuts
    kept = written(found.where(F.col("n_hit") <= F.col("n_words") * max_coverage).select(*names, "hits"))
    whole = kept.where("hits IS NULL").select(*names)
    if "n_chars" in columns:
        n = names[columns.index("n_chars")]
        after = kept.where("hits IS NOT NULL").mapInArrow(cut, plain.schema).withColumn(n, F.length(names[at]).cast(plain.schema[n].dataType))
    else:
        after = kept.where("hits IS NOT NULL").mapInArrow(cut, plain.schema)
    return whole.unionByName(after).select(*[F.col(k).alias(c) for k, c in zip(names, columns)])


def _without(text: str, hits: bytes) -> str:
    """``text`` without its runs of hit words."""
    places = [m.span() for m in re.finditer(WORD_PATTERN, text.translate(_LOW))]
    bits = np.unpackbits(np.frombuffer(hits, np.uint8))[: len(places)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], bits, [0]))))
    out, last = [], 0
    for lo, hi in zip(edges[::2], edges[1::2]):
        out.append(text[last: places[lo][0]])
        last = places[hi - 1][1]
    return "".join(out) + text[last:]
