"""Spelling variant grouping: near words by dynamic programming over sorted lists.

The vocabulary is dealt into groups in which every near pair (one inserted,
deleted or replaced character) must meet: cut the shorter word in two halves,
then the edit lies in one of them and the other half is equal in both words, at
the same end.  A word joins the groups of its own halves and, as the longer word
of a pair, the groups for words one character shorter.  A group that is still
large is cut again on what is left of its words, so groups shrink until one
character is left and only the alphabet bounds them; no group is capped.

Within a group the words that remain are sorted.  Each is compared with those
after it by a band of three cells of the edit matrix; the rows that belong to the
common prefix with the word before (LCP) are used again, and where a row has no
cell of at most one edit, all words that share that prefix are skipped.

A word's form is its most frequent near word (ties: least in code-point order)
where that is at least ``ratio`` times as frequent; the root is the last form.  A
form chain gains that factor at each step, so the largest count bounds its length
and the number of joins that follow it, each of which doubles the step.

Results: a null text has no words; a null id writes as an empty string in the
hash; repeated rows count each; other columns are ignored; no rows, no words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspan.llm.common import LOWER, slices, written

#: Runs of letters, once A-Z are lower-cased (a fixed value of the contract).
RUNS = re.compile("[a-zÀ-ÿ]+").findall
#: Groups above so many words are cut again.
SPLIT_ABOVE = 512
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
#: Links that a task gathers before it passes them on.
LINKS = 50_000


def with_slips(doc_id: str, counts: Counter, one_in: int) -> Iterator[tuple[str, int]]:
    """The runs of a document with their counts; where ``one_in`` divides the crc32 h
    of ``<doc_id>:<run>``, character h % length is left out."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in counts.items():
        h = zlib.crc32(run.encode("utf-8"), start)
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


def vocabulary(docs: DataFrame, least_length: int = 6, least_count: int = 5, one_in: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: words of at least ``least_length`` characters that occur ``least_count`` times or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in slices(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                low = text.encode("utf-8").translate(LOWER).decode("utf-8")
                # shorter runs cannot become words: a slip only shortens
                runs = Counter(r for r in RUNS(low) if len(r) >= least_length)
                for word, n in with_slips(doc_id, runs, one_in):
                    if len(word) >= least_length:
                        total[word] = total.get(word, 0) + n
                if len(total) > COUNTED:
                    yield flushed()
        yield flushed()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _halves(key: Column, word: str, left: Column, size: Column, longer: Column) -> Column:
    """The two groups of a row: what is left of its word begins at ``left`` (from 1),
    and the shorter words of its pairs have ``size`` characters left (``longer``: 1 if
    this one has one more).  Structs (key, left, size, longer)."""
    first = F.floor(size / 2).cast("int")
    last = size - first
    w = F.col(word)
    # each half has a known length, so keys of one kind are unambiguous
    head = F.struct(F.concat(key, F.lit("<"), F.substring(w, left, first)).alias("key"), (left + first).alias("left"), last.alias("size"), longer.alias("longer"))
    tail = F.struct(F.concat(key, F.lit(">"), F.substring(w, left + first + longer, last)).alias("key"), left.alias("left"), first.alias("size"), longer.alias("longer"))
    return F.array(head, tail)


def _first_groups(words: DataFrame, least_length: int) -> DataFrame:
    size, one = F.length("word"), F.lit(1)
    own = _halves(size.cast("string"), "word", one, size, F.lit(0))
    shorter = _halves((size - 1).cast("string"), "word", one, size - 1, one)
    both = F.when(size > least_length, F.concat(own, shorter)).otherwise(own)
    return words.select("word", F.inline(both))


def _near_in_order(rest: list[str], longer: list[int]) -> Iterator[tuple[int, int]]:
    """Places i < j of a sorted list whose strings are one edit apart."""
    n = len(rest)
    lcp = [0] * (n + 1)  # with the string before
    for j in range(1, n):
        a, b, k = rest[j - 1], rest[j], 0
        top = min(len(a), len(b))
        while k < top and a[k] == b[k]:
            k += 1
        lcp[j] = k
    for i in range(n - 1):
        q = rest[i]
        size = len(q)
        # rows[d]: edits from the first d characters of the other word to d-1, d, d+1 characters of q
        rows = [(2, 0, 1)] + [(1, 0, 1)] * size
        j = i + 1
        while j < n:
            w, d = rest[j], min(lcp[j], len(rows) - 1)
            del rows[d + 1:]
            end = len(w)
            while d < end:
                c, (a, b, e) = w[d], rows[d]
                # the cell to the left, the one above and the one across; beyond q there is none
                x = min(a + (0 < d <= size and q[d - 1] != c), b + 1) if d <= size else 2
                y = min(b + (d >= size or q[d] != c), e + 1, x + 1) if d < size else 2
                z = min(e + (d + 1 >= size or q[d + 1] != c), y + 1) if d + 1 < size else 2
                if x > 1 and y > 1 and z > 1:
                    break
                rows.append((x, y, z))
                d += 1
            if d == end:
                off = size - end
                if -1 <= off <= 1 and rows[end][off + 1] == 1 and not (longer[i] and longer[j]):
                    yield i, j
                j += 1
            else:  # no word with this prefix of d + 1 characters is near
                j += 1
                while j < n and lcp[j] > d:
                    j += 1


def _links(groups: DataFrame) -> DataFrame:
    """word, near: both directions of every near pair within a group."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, rest, longer = None, [], [], []
        one, other = [], []

        def close() -> None:
            for i, j in _near_in_order(rest, longer):
                one.extend((words[i], words[j]))
                other.extend((words[j], words[i]))

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(one, pa.string()), pa.array(other, pa.string())], names=["word", "near"])
            one.clear()
            other.clear()
            return b

        for b in slices(batches, 4096):
            for k, r, w, more in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    close()
                    if len(one) >= LINKS:
                        yield out()
                    key, words, rest, longer = k, [], [], []
                words.append(w)
                rest.append(r)
                longer.append(more)
        close()
        yield out()

    rest = F.substring(F.col("word"), F.col("left"), F.col("size") + F.col("longer"))
    rows = groups.select("key", rest.alias("rest"), "word", "longer").repartition("key").sortWithinPartitions("key", "rest")
    return rows.mapInArrow(scan, "word string, near string")


def near_words(words: DataFrame, least_length: int = 6, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """word, near of every pair of distinct words that one edit joins, both directions.
    ``words``: distinct words of at least ``least_length`` (2 or more) characters."""
    groups = written(_first_groups(words.select("word"), least_length))
    found = None
    while True:
        sizes = groups.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.max("size").alias("left_over"))
        large = written(sizes.where((F.col("members") > split_above) & (F.col("left_over") > 1)).select("key"))
        last = large.isEmpty()
        here = groups if last else groups.join(large, "key", "left_anti")
        links = _links(here)
        found = links if found is None else found.unionByName(links)
        if last:
            return found.distinct()  # an edit between the halves is met on both sides
        again = groups.join(large, "key", "left_semi")
        groups = written(again.select("word", F.inline(_halves(F.col("key"), "word", F.col("left"), F.col("size"), F.col("longer")))))


def variants(words: DataFrame, ratio: int = 5, least_length: int = 6, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``words`` (word, n)."""
    words = written(words.select("word", "n"))
    links = near_words(words, least_length, split_above)
    # the least of (-n, word) is the most frequent near word, the first of ties
    near = links.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"))
    rows = words.join(best, "word", "left")
    is_form = -F.col("best.minus_n") >= ratio * F.col("n")
    rows = written(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus_n")).alias("form_n")))
    return rows.join(_roots(rows, ratio), "word", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def _roots(rows: DataFrame, ratio: int) -> DataFrame:
    """word, last (end of its chain of forms) of the words that have a form."""
    steps = rows.where("form IS NOT NULL").select("word", F.col("form").alias("last"))
    most = rows.agg(F.max("n"), F.min("n")).first()
    longest = int(math.log(max(1, (most[0] or 1) / (most[1] or 1)), ratio)) + 1
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        onward = steps.select(F.col("word").alias("last"), F.col("last").alias("beyond"))
        steps = written(steps.join(onward, "last", "left").select("word", F.coalesce("beyond", "last").alias("last")))
    return steps
