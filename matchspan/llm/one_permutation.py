"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each word shingle of a text is hashed once.  The top bits of the hash name a bin
and the least hash of a bin stands for it.  An empty bin borrows from a filled one
(optimal densification): bin ``i`` walks an order of all bins of its own, some
drawn probes first and then the other bins by a hash of (i, bin), and takes the
first filled one, so two texts borrow alike wherever their shingles agree.  Only
the low ``bits`` bits of every bin are kept, packed into 64-bit words.  The share
of equal bins, less what low bits agree by chance, estimates the Jaccard
similarity of the shingle sets.

Words are what lies between ASCII white space in the lower-cased text; a text of
fewer words than ``WIDTH`` is one shingle.

Results: a null text counts as empty; a text without words has an empty
fingerprint, which is like another empty one (1) and unlike all others (0).
``edited_pairs`` orders documents by descending id, null ids last, then by text
digest; rows equal in id and text are one document there and each row is
returned; a table of one document is its own next one.  Other columns of the
input are ignored.  Ids may be numbers or strings.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchspan.llm.common import text_or_empty, written

#: Words of a shingle.
WIDTH = 5
#: Bins of a fingerprint (a power of two) and bits kept of each (1, 2, 4, 8, 16).
BINS, BITS = 256, 8
#: Drawn probes of an empty bin before it compares all filled ones.
PROBES = 4
#: The same value in the rows of one group of copies is written out in runs of so many.
RUN = 4096

KEY = ["no_id", "id", "digest"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all word shingles, in order of place."""
    words = F.array_remove(F.split(F.lower(text), r"[ \t-\r]+"), "")

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - width)
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) < width, F.array(F.xxhash64(h)))
                .otherwise(F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), windows)


def _bins(hashes: Column, bins: int) -> Column:
    """One value a bin, in order: the least hash with its last bit 0, or, where the
    bin is empty, its largest number, whose last bit is 1.  Those numbers are sorted
    among the hashes and the first value of each bin is taken."""
    shift = 64 - (bins.bit_length() - 1)
    last = F.array(*[F.lit(_signed((((b - bins // 2) << shift) | ((1 << shift) - 1)) % (1 << 64))) for b in range(bins)])
    every = F.sort_array(F.concat(F.transform(hashes, lambda h: h.bitwiseAND(F.lit(-2))), last))
    return _let(every, lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(s, i - 1), shift))))


def _probes(bins: int) -> list[Column]:
    draw = random.Random(20011)
    return [F.array(*[F.lit(draw.randrange(bins)) for _ in range(bins)]) for _ in range(PROBES)]


def _densified(dense: Column, bins: int, bits: int) -> Column:
    """The low bits of every bin, empty ones filled."""
    shift, low = 64 - (bins.bit_length() - 1), (1 << bits) - 1
    drawn = _probes(bins)

    def kept(x: Column) -> Column:
        return F.shiftright(x, 1).bitwiseAND(F.lit(low))

    def filled(x: Column) -> Column:
        return x.bitwiseAND(F.lit(1)) == 0

    def fill(d: Column) -> Column:
        def others(full: Column) -> Column:
            def value(x: Column, i: Column) -> Column:
                out = F.when(filled(x), kept(x))
                for probe in drawn:
                    y = F.get(d, F.get(probe, i))
                    out = out.when(filled(y), kept(y))
                # the rest of the order: by a hash, whose low bits carry the value along
                rest = F.transform(full, lambda y: F.xxhash64(i, F.shiftright(y, shift)).bitwiseAND(F.lit(~low)).bitwiseOR(kept(y)))
                return out.otherwise(F.array_min(rest).bitwiseAND(F.lit(low)))

            return F.transform(d, value)

        return _let(F.filter(d, filled), others)

    return _let(dense, fill)


def _packed(values: Column, bins: int, bits: int) -> Column:
    """``64 / bits`` values a word, the first one lowest."""
    lanes = 64 // bits

    def words(v: Column) -> Column:
        def word(i: Column) -> Column:
            out = F.get(v, i * lanes)
            for k in range(1, lanes):
                out = out.bitwiseOR(F.shiftleft(F.get(v, i * lanes + k), k * bits))
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(bins // lanes - 1)), word)

    return _let(values, words)


def fingerprint(text: Column, width: int = WIDTH, bins: int = BINS, bits: int = BITS) -> Column:
    """Packed words (array of bigint) of the fingerprint; no words for a text without words."""
    if bins & (bins - 1) or bits not in (1, 2, 4, 8, 16) or bins * bits % 64:
        raise ValueError("bins is a power of two, bits 1, 2, 4, 8 or 16, and together they fill 64-bit words")
    return _let(shingle_hashes(text, width), lambda h: F.when(F.size(h) == 0, h).otherwise(_packed(_densified(_bins(h, bins), bins, bits), bins, bits)))


def _fold(step: int) -> Callable[[Column], Column]:
    return lambda z: z.bitwiseOR(F.shiftrightunsigned(z, step))


def likeness(one: Column, other: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two fingerprints."""
    unequal = F.zip_with(one, other, lambda x, y: x.bitwiseXOR(y))
    for step in [s for s in (1, 2, 4, 8) if s < bits]:  # fold every lane into its lowest bit
        unequal = F.transform(unequal, _fold(step))
    ones = _signed(sum(1 << k for k in range(0, 64, bits)))
    differing = F.aggregate(unequal, F.lit(0), lambda acc, z: acc + F.bit_count(z.bitwiseAND(F.lit(ones))))
    chance = 2.0 ** -bits
    share = (F.lit(1.0) - differing / F.lit(float(bins)) - chance) / (1 - chance)
    empty = F.size(one) == 0
    return (F.when(empty & (F.size(other) == 0), F.lit(1.0)).when(empty | (F.size(other) == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), share)))


def as_bytes(words: Column) -> Column:
    """The packed words as binary, high byte first."""
    return F.unhex(F.array_join(F.transform(words, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col), F.lit(0).cast(kind)).alias("id"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))


def next_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """before (key), n_before (its characters) and the key of the document that
    follows it, by descending id; after the last one comes the first.  The keys are
    dealt into ranges; within a range the next key is a window's ``lead``, and the
    last key of a range takes the first of the next range (one row a range)."""
    order = [F.col("no_id").asc(), F.col("id").desc(), F.col("digest").asc()]
    keys = _keys(docs, id_col, text_col).select(*KEY, F.length("text").alias("n")).distinct()
    ranged = written(keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    inside, key = W.partitionBy("range").orderBy(*order), F.struct(*KEY)
    rows = ranged.select("*", F.lead(key).over(inside).alias("next"), F.row_number().over(inside).alias("at"))
    # one row a range: no more rows than the shuffle has partitions
    ends = W.orderBy("range")
    firsts = rows.where("at = 1").select("range", key.alias("first"))
    firsts = firsts.select("range", F.coalesce(F.lead("first").over(ends), F.first("first").over(ends.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("after"))
    return rows.join(firsts, "range").select(key.alias("before"), F.col("n").alias("n_before"), F.coalesce("next", "after").alias("key")).select("before", "n_before", "key.*")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_chars, edited (the text whose last floor(n_chars / 2) characters
    are replaced by the first as many, or all, of the next document), the packed
    fingerprints of text, edited text and next text (fp, edited_fp, next_fp).

    Texts are shuffled once by key, and of each document only the beginning that its
    predecessor needs once more."""
    order = written(next_documents(docs, id_col, text_col))
    rows = _keys(docs, id_col, text_col).select("*", fingerprint(F.col("text")).alias("fp"))
    # copies fold in each task; both branches below read the same exchange
    one = rows.groupBy(*KEY).agg(F.max("text").alias("text"), F.max("fp").alias("fp"), F.count(F.lit(1)).alias("copies")).where("copies > 0")
    need = F.floor(F.col("n_before") / 2).cast("int")
    heads = one.join(order.hint("merge"), KEY).select("before.*", F.substring(F.col("text"), F.lit(1), need).alias("head"), F.col("fp").alias("next_fp"))
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 2).cast("int")), F.col("head"))
    whole = one.join(heads.hint("merge"), KEY).select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp", "copies")
    return whole.select("*", fingerprint(F.col("edited")).alias("edited_fp"))


def each_copy(rows: DataFrame) -> DataFrame:
    """A row for each of its ``copies``."""
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN)))
    some = rows.select("*", runs.alias("_run"))
    size = F.least(F.lit(RUN), F.col("copies") - F.col("_run") * RUN).cast("int")
    return some.select("*", F.explode(F.array_repeat(F.lit(True), size)).alias("_one")).drop("_run", "_one", "copies")


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_chars, edited_sha256, both fingerprints as binary, near_edited
    and near_next: likeness to the edited text and to the next document."""
    pairs = edited_pairs(docs, id_col, text_col)
    return each_copy(pairs.select(
        id_col, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_bytes(F.col("fp")).alias("fingerprint"), as_bytes(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "copies"))
