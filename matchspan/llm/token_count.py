"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a pre-token are a doubly linked list and its adjacent pairs lie
in a heap by (merge rank, place).  The lowest pair is popped again and again;
a stale entry (one of its symbols was merged meanwhile) is skipped.  The count
is the number of initial symbols less the number of merges; no identifiers are
built.  Strings of special tokens in a text count as one token each, as the
vocabulary file says.

Results: a null or empty text has 0 bytes and 0 tokens; repeated rows are each
returned; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspan.llm.common import slices, text_or_empty, worker_cache
from matchspan.llm.pretokens import splitter

#: Words whose count a Python worker remembers; beyond it the memory starts anew.
REMEMBERED = 700_000


def byte_letters() -> dict[str, int]:
    """The printable character by which vocabulary files write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


class MergeCounter:
    """Counts tokens of words by the merges of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges, letters = spec["model"]["vocab"], spec["model"]["merges"], byte_letters()
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        #: (left id, right id) in one int -> (rank, id of the merged symbol)
        self.merges = {vocab[a] << 20 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.memory: dict[str, int] = {}
        self.split = splitter()

    def word(self, data: bytes) -> int:
        n = len(data)
        if n < 2:
            return n
        find, first = self.merges.get, self.first
        symbol = [first[b] for b in data]
        heap = []
        for i in range(n - 1):
            if found := find(symbol[i] << 20 | symbol[i + 1]):
                heap.append((found[0], i, found[1], symbol[i], symbol[i + 1]))
        if not heap:
            return n
        heapify(heap)
        after, before, merged = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            _, i, new, left, right = heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue
            merged += 1
            symbol[i], symbol[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := find(new << 20 | symbol[k]):
                    heappush(heap, (found[0], i, found[1], new, symbol[k]))
            if (h := before[i]) >= 0 and (found := find(symbol[h] << 20 | new)):
                heappush(heap, (found[0], h, found[1], symbol[h], new))
        return n - merged

    def _plain(self, text: str) -> int:
        words, memory = self.split(text), self.memory
        counts = list(map(memory.get, words))
        if None in counts:
            if len(memory) > REMEMBERED:
                memory.clear()
            for i, n in enumerate(counts):
                if n is None:
                    w = words[i]
                    counts[i] = memory[w] = self.word(w.encode("utf-8"))
                    if len(w) > 64:
                        del memory[w]
        return sum(counts)

    def text(self, text: str) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, filter(None, parts))) + len(parts) - 1


def _counter(path: str) -> MergeCounter:
    kept = worker_cache()
    if ("merges", path) not in kept:
        kept["merges", path] = MergeCounter(path)
    return kept["merges", path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = f"{id_col} {source.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            tokens = [counter.text(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                b.column(0),
                pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(count, schema)


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)
