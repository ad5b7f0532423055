"""Exact n-gram Jaccard join in the metric space of shingle sets.

A document's set is its distinct ``width``-word shingles (with fewer words, the
whole sequence as one), each a 63-bit hash.  Two documents link when
Jaccard >= ``least``; the result is the connected components of the links.

Unrelated texts all lie at a distance near 1 from each other and from any
document pivot, so document pivots alone prune nothing.  The pivots of the first
level are therefore the one-shingle sets {s}: d(x, {s}) is 1 - 1/|x| where s is
in x and 1 elsewhere, and equal distances are ordered by one global order of
shingles (those of many documents last, else by hash).

1. *Regions.*  The Voronoi region of {s} holds the documents whose nearest pivot
   it is.  A link leaves two sets at least ``least`` of each in common, so with a
   document replicated into its |x| - ceil(least |x|) + 1 nearest pivots (the
   boundary window) two linked documents share a region for certain.
2. *Frequent shingles.*  Shingle counts over all documents give the at most
   ``HOT_MAX`` most frequent ones above ``HOT`` documents, which go last in the order,
   so that a passage in many documents makes no region unless a document holds
   little else.
3. *Recursion.*  In each region documents become pivots: distances to a few
   centres are computed exactly and links join components; regions whose
   documents are all in one component are done, the others go on with other
   centres.  Once the pairs of different components in a region are few, or centres
   stop joining them, they are met pair by pair, within the size window that a
   link allows and only where the region's pivot could be the first that both
   hold: what follows it in the order must suffice for a link, else they are met
   under an earlier pivot or don't link.  No pair within a component is made.
   Large regions, which hold groups of near copies, have more centres.
4. *Sketches.*  A set's sketch has a bit for each of its hash classes: whether
   the number of its shingles there is odd.  A short one travels with the regions and tells
   which of their rows have a partner at all; only these take along one of WIDE bits a shingle
   or more (folded to the other's length), by which their pairs are made.  Two sketches differ in at most as many bits
   as the sets have shingles that only one of them holds, which is a lower bound of their
   distance: pairs that it shows to be too far apart are never made, so that
   texts are shipped for hardly more pairs than link.  What is left is compared exactly.

Any choice of frequent shingles, centres and rounds gives the same result.

Results: A-Z count as a-z; words are ``[^\\x20\\x09-\\x0D]+``.  Null or empty texts, or
those without words, have no shingles and link with nothing, not even each
other.  ``component_id`` is the smallest id reachable by links, the id itself
included.  Repeated rows are each returned.  Rows with a null id take part and
have the smallest id among their component, null if there is none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspan.llm.common import LOWER, slices, text_or_empty, written

#: Documents that a shingle may lie in before it counts as frequent, and how many frequent ones are sent to the tasks.
HOT, HOT_MAX = 100, 500_000
#: Shingles counted per document, as a multiple of its pivots.
COUNTED = 1.3
#: Rows of a frequent pivot in one task.
SALT_ROWS = 2000
#: Centres a region and round; rounds at most; pairs whose sketches are compared one by one, as a multiple of the regions' rows.
CENTRES, ROUNDS, PAIRS = 2, 10, 256
#: Rows from which a region is large, and its centres a round.
LARGE, MANY = 64, 8
#: 64-bit words of a sketch; bits a shingle, at least, of the whole one.
SKETCH, WIDE = 4, 2
#: Rows of a region that meet the whole region in one task.
BLOCK = 4096
#: First shared pivots of a set by which a pair's later ones are known as such.
LEAD = 8
#: Sets that a task remembers, and shingles that it counts, at a time.
SEEN, BUFFER = 100_000, 500_000
#: Values of the screen through which texts are picked for comparison.
SCREEN_VALUES = 1 << 20

_BLANK = bytes(32 if 9 <= c <= 13 else c for c in LOWER)
_RANDOM = np.random.default_rng(20240601)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _M = 0xD1342543DE82EF95, np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 17
_SKETCH = [f"s{i}" for i in range(SKETCH)]
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        row = np.full(max(n, 1 << 14), base, np.uint64)
        row[0] = 1
        _powers[name] = np.cumprod(row, dtype=np.uint64)
    return _powers[name][:n]


def _word_hashes(data: bytes) -> np.ndarray:
    """A hash of each blank-separated word: a polynomial over its bytes, mixed."""
    raw = np.frombuffer(data, np.uint8)
    inside = raw != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _power("up", _BASE, len(raw)), dtype=np.uint64)))
    h = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(raw))[starts]
    h ^= h >> np.uint64(32)
    h = h * _M + (ends - starts).astype(np.uint64)
    return h ^ (h >> np.uint64(29))


def shingles(text: str, width: int = 5) -> np.ndarray:
    """The distinct shingle hashes (63 bits), ascending."""
    data = text.encode("utf-8").translate(_BLANK)
    if len(data) <= _PIECE:
        words = _word_hashes(data)
    else:  # cut at blanks, to bound the arrays
        parts, at = [], 0
        while at < len(data):
            end = len(data) if len(data) - at <= _PIECE else data.rfind(b" ", at, at + _PIECE)
            if end <= at:
                end = data.find(b" ", at + _PIECE)
                end = len(data) if end < 0 else end
            parts.append(_word_hashes(data[at: end + 1]))
            at = end + 1
        words = np.concatenate(parts)
    n = len(words)
    if not n:
        return words
    size = min(width, n)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h = (h ^ words[j: n - size + 1 + j]) * _M
        h ^= h >> np.uint64(31)
    return np.unique(h >> np.uint64(1))


def _node(keys: np.ndarray) -> tuple[int, int]:
    """A name of the set, and a second hash by which equal names of different sets are noticed."""
    d = hashlib.blake2b(keys.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _ratio(least: float) -> tuple[int, int]:
    """``least`` as a fraction, so that comparisons are exact."""
    top, bottom = round(least * 1_000_000), 1_000_000
    g = math.gcd(top, bottom)
    return top // g, bottom // g


def _pivots(n: int, least: tuple[int, int]) -> int:
    return n - -(-n * least[0] // least[1]) + 1


def _new_sets(batch: pa.RecordBatch, width: int, seen: set) -> Iterator[tuple[int, np.ndarray]]:
    """(node, keys) of the sets in a batch of (text) that this task has not had."""
    for text in batch.column(0).to_pylist():
        keys = shingles(text, width)
        if len(keys):
            node, _ = _node(keys)
            if node not in seen:
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(node)
                yield node, keys


def sketch(keys: np.ndarray) -> tuple[list[int], list[int]]:
    """Which hash classes hold an odd number of the shingles: 64 * SKETCH classes, and
    a power of two, at least that many and at least WIDE times the shingles."""
    classes = 64 * SKETCH
    while classes < WIDE * len(keys):
        classes *= 2
    odd = np.bincount((keys * _M >> np.uint64(32)).astype(np.int64) % classes, minlength=classes) & 1
    wide = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return np.bitwise_xor.reduce(wide.reshape(-1, SKETCH), axis=0).tolist(), wide.tolist()


def _folded(one: str, other: str):
    """A sketch at the length of the other, where that is half as long."""
    half = F.size(other)
    xor = F.zip_with(F.slice(one, F.lit(1), half), F.slice(one, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(one) > half, xor).otherwise(F.col(one))


def _near_sketches(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose whole sketches are as near as a link allows.  Sizes
    within ``least`` >= 1/2 of each other have sketches of the same length or twice that."""
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}")), x)
    return pairs.where(_close_wide("wa", "wb", "na", "nb", least)).select("a", "b")


def _close_wide(one: str, other: str, n: str, m: str, least: tuple[int, int]):
    """Whether two whole sketches are as near as a link allows, if they can be folded to one length."""
    if 2 * least[0] < least[1]:
        return F.lit(True)
    apart = F.aggregate(F.zip_with(_folded(one, other), _folded(other, one), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return apart * (least[0] + least[1]) <= (F.col(n) + F.col(m)) * (least[1] - least[0])


def _close(one: str, other: str, n: str, m: str, least: tuple[int, int]):
    """Whether two sketches, of sets of n and m shingles, are as near as a link allows."""
    apart = reduce(add, [F.bit_count(F.col(one.format(i)).bitwiseXOR(F.col(other.format(i)))) for i in range(SKETCH)])
    return apart * (least[0] + least[1]) <= (F.col(n) + F.col(m)) * (least[1] - least[0])


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, n, node (null without shingles), check, the words s0 and so on of the short sketch, and the whole sketch."""
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, node, check, words, wide = [], [], [], [], []
            for text in b.column(1).to_pylist():
                keys = shingles(text, width)
                a, c = _node(keys) if len(keys) else (None, None)
                n.append(len(keys))
                node.append(a)
                check.append(c)
                short, long = sketch(keys)
                words.append(short)
                wide.append(long)
            parts = [pa.array(x, pa.int64()) for x in (n, node, check, *zip(*words))]
            yield pa.RecordBatch.from_arrays([b.column(0), *parts, pa.array(wide, pa.list_(pa.int64()))], names=["id", "n", "node", "check", *_SKETCH, "wide"])

    return source.mapInArrow(sign, f"id {source.schema['id'].dataType.simpleString()}, n long, node long, check long, {' long, '.join(_SKETCH)} long, wide array<long>")


def frequent(texts: DataFrame, width: int, least: tuple[int, int], hot: int) -> list[tuple[int, int]]:
    """The (at most HOT_MAX) shingles among the pivots of more than ``hot`` sets, with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        parts, size = [], 0
        for b in slices(batches):
            for _, keys in _new_sets(b, width, seen):
                parts.append(keys[: int(COUNTED * _pivots(len(keys), least)) + 1])
                size += len(parts[-1])
            if size > BUFFER:
                yield _counts(parts)
                parts, size = [], 0
        if parts:
            yield _counts(parts)

    counts = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > hot)
    return [(r["key"], r["n"]) for r in counts.orderBy(F.desc("n"), "key").limit(HOT_MAX).collect()]


def _counts(parts: list[np.ndarray]) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate(parts), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


def regions(texts: DataFrame, width: int, least: tuple[int, int], hot: list[tuple[int, int]]) -> DataFrame:
    """pivot, node, pos, n: the regions of two sets or more (all rows of frequent
    pivots); pos is the pivot's place among the set's shingles in the global order,
    n the set's size."""
    spark = texts.sparkSession
    hot = sorted(hot)
    sent = spark.sparkContext.broadcast((np.array([k for k, _ in hot], np.uint64), np.array([max(1, -(-n // SALT_ROWS)) for _, n in hot], np.int64)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pieces = sent.value
        seen: set = set()
        for b in slices(batches):
            keys_out, nodes, salts, places = [], [], [], []
            for node, keys in _new_sets(b, width, seen):
                n, k = len(keys), _pivots(len(keys), least)
                at = np.searchsorted(last, keys)
                late = (last[np.minimum(at, len(last) - 1)] == keys) if len(last) else np.zeros(len(keys), bool)
                salt = np.zeros(k, np.int64)
                if late[:k].any():
                    order = np.concatenate((np.flatnonzero(~late), np.flatnonzero(late)))[:k]
                    salt = np.where(late[order], 1 + (node & 0x7FFFFFFF) % pieces[np.minimum(at[order], len(last) - 1)], 0)
                    keys = keys[order]
                keys_out.append(keys[:k].astype(np.int64))
                salts.append(salt)
                nodes.append(np.full(k, node, np.int64))
                places.append(np.arange(k) | n << 32)
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys_out, nodes, salts, places)], names=["pivot", "node", "salt", "pos"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of sorted (pivot, node, salt, pos) the distinct rows, without pivots of one set."""
        held, paired = np.zeros((4, 0), np.int64), False
        for b in batches:
            rows = np.concatenate((held, np.stack([np.asarray(b.column(i)) for i in range(4)])), axis=1)
            rows = rows[:, np.append(True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0))[: rows.shape[1]]]
            if not rows.shape[1]:
                continue
            same = rows[0, 1:] == rows[0, :-1]
            keep = np.append(same, False) | np.append(paired, same) | (rows[2] > 0)
            paired = bool(same[-1]) if len(same) else paired
            held, out = rows[:, -1:], rows[:, :-1][:, keep[:-1]]  # the last row waits for what follows
            yield _pairs_batch(out)
        if held.shape[1] and (paired or held[2, 0] > 0):
            yield _pairs_batch(held)

    rows = texts.mapInArrow(replicate, "pivot long, node long, salt long, pos long")
    return rows.repartition(parts, "pivot", "salt").sortWithinPartitions("pivot", "node").mapInArrow(shared, "pivot long, node long, place long").select("pivot", "node", F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("pos"), F.shiftright("place", 32).alias("n"))


def _pairs_batch(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[3])], names=["pivot", "node", "place"])


def linked(docs: DataFrame, ids: DataFrame, pairs: DataFrame, width: int, least: tuple[int, int]) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose sets link, by exact comparison of whole
    sets.  ``docs``: id, text; ``ids``: node, id of one document with that set.

    Texts are picked by a screen of id hashes, at most SCREEN_VALUES numbers at
    any size of the table, so that few texts of other documents are shuffled."""
    value = F.pmod(F.xxhash64("id"), F.lit(SCREEN_VALUES))
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(ids.join(nodes, "node", "left_semi"))
    screen = wanted.select(value.alias("value")).distinct()
    picked = docs.withColumn("value", value).join(F.broadcast(screen), "value", "left_semi").select("text")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in slices(batches):
            out = []
            for text in b.column(0).to_pylist():
                keys = shingles(text, width)
                if len(keys):
                    node, _ = _node(keys)
                    if node not in seen:
                        if len(seen) > SEEN:
                            seen.clear()
                        seen.add(node)
                        out.append((node, text))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.string())], names=["node", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for b in slices(batches):
            ok = []
            for x, y, tx, ty in zip(*(c.to_pylist() for c in b.columns)):
                if len(kept) > 200:
                    kept.clear()
                if y not in kept:
                    kept[y] = shingles(ty, width)
                p, q = shingles(tx, width), kept[y]
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(least[1] * both >= least[0] * (len(p) + len(q) - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = picked.mapInArrow(name, "node long, text string").join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    met = pairs.select("a", "b").join(one.withColumnsRenamed({"node": "a", "text": "ta"}), "a").join(one.withColumnsRenamed({"node": "b", "text": "tb"}), "b")
    return met.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long")


def components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, comp) with the components of equal comp or joined by ``edges``
    (a, b) merged; comp becomes the smallest among them.  Labels of neighbours and
    labels of labels spread until nothing changes."""
    ends = edges.join(labels.withColumnsRenamed({"node": "a", "comp": "ca"}), "a", "left").join(labels.withColumnsRenamed({"node": "b", "comp": "cb"}), "b", "left")
    ends = ends.select(F.coalesce("ca", "a").alias("u"), F.coalesce("cb", "b").alias("v")).where("u <> v")
    both = written(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    now = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("comp")))
    while True:
        heard = both.join(now.withColumnsRenamed({"u": "v", "comp": "c"}), "v").groupBy("u").agg(F.min("c").alias("c"))
        step = now.join(heard, "u").select("u", F.least("comp", "c").alias("near"), F.col("comp").alias("was"))
        up = now.withColumnsRenamed({"u": "near", "comp": "far"})
        new = written(step.join(up, "near", "left").select("u", F.least("near", "far").alias("comp"), "was"))
        changed = not new.where("comp <> was").isEmpty()
        now = new.drop("was")
        if not changed:
            break
    merged = labels.join(now.select(F.col("comp").alias("to"), F.col("u").alias("comp")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return written(merged)


def link_components(docs: DataFrame, width: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, rounds: int = ROUNDS, pairs_per_row: int = PAIRS) -> DataFrame:
    """``id_col``, n_shingles, component_id of every row."""
    ratio = _ratio(least)
    texts = docs.select(text_or_empty(text_col).alias("text"))
    named = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    signed = written(signatures(docs, width, id_col, text_col))
    sets = written(signed.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.min("check").alias("lo"), F.max("check").alias("hi"), F.first("n").alias("n"), *[F.first(s).alias(s) for s in (*_SKETCH, "wide")]))
    if not sets.where("lo <> hi").isEmpty():
        raise ValueError("two sets share a 64-bit name")
    ids, sketches, wide = sets.select("node", "id"), sets.select("node", *_SKETCH), sets.select("node", "n", "wide")
    rows = written(regions(texts, width, ratio, frequent(texts, width, ratio, hot)))
    labels = written(rows.select("node").distinct().withColumn("comp", F.col("node")))
    total = rows.count()

    before = None
    for turn in range(rounds + 1):
        live, cross = _live(rows, labels)
        if not cross:
            break
        slow = before is not None and cross > 0.8 * before  # what is left hardly links
        before = cross
        if turn and (cross <= pairs_per_row * total or slow or turn == rounds):
            labels = components(labels, linked(named, ids, written(_each_pair(live, sketches, ratio, wide=wide).distinct()), width, ratio))
            break
        labels = components(labels, linked(named, ids, written(_near_sketches(_centres(live, sketches, ratio, turn), wide, ratio)), width, ratio))

    marked = signed.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    smallest = marked.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("component_id"))
    whole = marked.join(smallest, "comp", "left")
    return whole.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _live(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """The rows (pivot, node, pos, n, comp, big, blocks, g) of regions with more than one
    component, big: whether comp is its region's largest, blocks: how many tasks its
    rows are dealt to, g: how many these are; and the number of pairs of different components in them."""
    named = rows.join(labels, "node")
    sizes = named.groupBy("pivot", "comp").agg(F.count(F.lit(1)).alias("c"))
    per = sizes.groupBy("pivot").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("g"), F.sum(F.col("c") * F.col("c")).alias("sq"), F.count(F.lit(1)).alias("k")).where("k > 1")
    live = written(named.join(per.select("pivot", F.col("top.comp").alias("topmost"), "g", "sq"), "pivot").select("pivot", "node", "pos", "n", "comp", (F.col("comp") == F.col("topmost")).alias("big"), F.ceil(F.col("g") / BLOCK).cast("int").alias("blocks"), "g", "sq"))
    # every region gives (g^2 - sq) / 2 pairs, spread over its g rows
    cross = live.agg(F.sum((F.col("g") * F.col("g") - F.col("sq")) / F.col("g") / 2)).first()[0]
    return live.drop("sq"), int(math.ceil(cross or 0))


def _near(n: str, m: str, least: tuple[int, int]):
    """The size window: sets that link have sizes within ``least`` of each other."""
    return F.least(n, m) * least[1] >= F.greatest(n, m) * least[0]


def _centres(live: DataFrame, sketches: DataFrame, least: tuple[int, int], turn: int) -> DataFrame:
    """Pairs (a, b) of a document and a centre of its region, of different components.
    The first centre is the document that has the fewest shingles before the pivot in
    the order: what the copies of a large group were made from has no rare ones of its own.
    In the first round half of a large region's centres are of that kind."""
    few, large = CENTRES if turn else 1, F.col("g") >= LARGE
    picks = _picks(live.where(~large), turn, few, 0 if turn else few).unionByName(_picks(live.where(large), turn, MANY, 0 if turn else MANY // 2))
    met = live.join(picks, "pivot").where(F.col("comp") != F.col("cb")).where(_near("n", "m", least))
    pairs = met.select(F.col("node").alias("a"), "b", "n", "m").distinct()
    pairs = pairs.join(_named(sketches, "a", "p"), "a").join(_named(sketches, "b", "q"), "b")
    return pairs.where(_close("p{}", "q{}", "n", "m", least)).select("a", "b")


def _picks(live: DataFrame, turn: int, centres: int, early: int) -> DataFrame:
    """pivot, b, m, cb: centres of each region, the first ``early`` of them with the least pos, the others any."""
    rank = [F.struct((F.col("pos") if i < early else F.lit(0)).cast("long").alias("s"), F.xxhash64("node", F.lit(turn * MANY + i)).alias("h"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("comp").alias("cb")) for i in range(centres)]
    picks = live.groupBy("pivot").agg(*[F.min(r).alias(f"c{i}") for i, r in enumerate(rank)])
    return picks.select("pivot", F.explode(F.array_distinct(F.array(*[F.struct(f"c{i}.b", f"c{i}.m", f"c{i}.cb") for i in range(centres)]))).alias("c")).select("pivot", "c.*")


def _named(sketches: DataFrame, node: str, prefix: str, *more: str) -> DataFrame:
    return sketches.select(F.col("node").alias(node), *[F.col(s).alias(f"{prefix}{i}") for i, s in enumerate(_SKETCH)], *more)


def _leads(live: DataFrame, lead: int = LEAD) -> DataFrame:
    """node, lead: its first ``lead`` pivots among the rows, as (pos, pivot) in the order."""
    return live.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("pos", "pivot"))), 1, lead).alias("lead"))


def _earlier(at: str):
    """The pivots of ``lead`` before the row's own."""
    return F.transform(F.filter("lead", lambda x: x["pos"] < F.col(at)), lambda x: x["pivot"])


def _each_pair(live: DataFrame, sketches: DataFrame, least: tuple[int, int], lead: int = LEAD, wide: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of different components that share a region and may link, some of them more than once.

    A pair in a region has a member outside the region's largest component, so
    joining those with all rows of the region meets each pair.  Under the first
    pivot that two sets share, all that they have in common is that pivot and what
    follows it in the order; elsewhere the pair need not be met.  Near sets share
    most of their pivots, but hardly ever none of their first ``lead``: where these show
    an earlier one of both, the pair is met there.  The condition of the
    join holds that and the sketches too, so that few but near pairs leave it, most of them once.

    Short sketches tell little of long sets and of copies that are almost near enough:
    such pairs grow as the square of a group.  With ``wide`` (node, wide) a semi join
    first keeps the rows that have any partner by the short ones, and these bring
    their whole sketches to the join that makes the pairs."""
    rows = live.drop("g").join(_named(sketches.join(_leads(live, lead), "node"), "node", "p", "lead"), "node").withColumn("before", _earlier("pos")).drop("lead")
    if wide is None:
        met = _met(rows.where("NOT big"), rows, least, "inner", F.col("big_") | (F.col("node") < F.col("node_")))
    else:
        rows = written(_met(rows, rows, least, "left_semi").drop("block")).join(wide.select("node", "wide"), "node")
        met = _met(rows.where("NOT big"), rows, least, "inner", F.col("big_") | (F.col("node") < F.col("node_")), _close_wide("wide", "wide_", "n", "n_", least))
    return met.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b"))


def _met(left: DataFrame, right: DataFrame, least: tuple[int, int], how: str, *more) -> DataFrame:
    """The rows of ``left`` joined with those of ``right`` (its columns get a "_") of other components
    in their region that they may link with.  The rows of a large region are dealt in
    blocks, each of which meets all of the region."""
    left = left.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    right = right.select(*[F.col(c).alias(f"{c}_") for c in right.columns]).withColumn("block_", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)))
    first = F.least(F.col("n") - F.col("pos"), F.col("n_") - F.col("pos_")) * (least[0] + least[1]) >= (F.col("n") + F.col("n_")) * least[0]
    close = _close("p{}", "p{}_", "n", "n_", least)
    meets = [F.col("pivot") == F.col("pivot_"), F.col("block") == F.col("block_"), F.col("comp") != F.col("comp_"), _near("n", "n_", least), first, close, ~F.arrays_overlap("before", "before_"), *more]
    return left.join(right, reduce(and_, meets), how)
