"""Fingerprints, spelling variants and tokenizer alignment against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from matchspan.llm import alignment, one_permutation, spelling
from matchspan.llm.common import known_to_workers, read, written
from matchspan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = [None, "", " ", "\n\n", "one", "one", "It's 12  o'clock,\tÉté 中文 😀\x00!", "a<|endoftext|>b <s>", "x" * 40_000, "la " * 20_000, "<0x41> ▁ ▁x"]


def table(spark, rows):
    """doc_id, text and columns whose names operators use inside."""
    known_to_workers(spark)
    return spark.createDataFrame([(i, t, "n", 1, "w", 2, 3) for i, t in rows], "doc_id long, text string, key string, id int, word string, n int, block int").repartition(3)


# --- fingerprints -----------------------------------------------------------

def long_hash(x, seed):
    h = xxhash.xxh64_intdigest((x % (1 << 64)).to_bytes(8, "little"), seed=seed % (1 << 64))
    return h - (1 << 64) if h >= 1 << 63 else h


def int_hash(x, seed):
    h = xxhash.xxh64_intdigest((x % (1 << 32)).to_bytes(4, "little"), seed=seed % (1 << 64))
    return h - (1 << 64) if h >= 1 << 63 else h


def plain_fingerprint(text, width=5, bins=256, bits=8):
    """Bin by bin, with loops: one value a bin, in order; None for a text without words."""
    words = [w for w in re.split("[ \t-\r]+", text.lower()) if w]
    hashes = []
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        hashes.append(h - (1 << 64) if h >= 1 << 63 else h)
    if not words:
        return None
    size = min(width, len(words))
    least = {}
    for k in range(len(words) - size + 1):
        h = 42
        for x in hashes[k:k + size]:
            h = long_hash(x, h)
        b = (h >> (64 - bins.bit_length() + 1)) + bins // 2
        least[b] = min(least.get(b, h & -2), h & -2)
    low = (1 << bits) - 1
    draw = random.Random(20011)
    probes = [[draw.randrange(bins) for _ in range(bins)] for _ in range(one_permutation.PROBES)]
    out = []
    for i in range(bins):
        taken = i if i in least else next((p[i] for p in probes if p[i] in least), None)
        if taken is None:  # the rest of the order, by a hash of (bin, other bin)
            def place(b):
                # the low bits of the hash carry the value along
                return (long_hash(b - bins // 2, int_hash(i, 42)) & ~low) | ((least[b] >> 1) & low)
            out.append(min(map(place, least)) & low)
        else:
            out.append((least[taken] >> 1) & low)
    return out


def unpacked(words, bits=8):
    return [(w % (1 << 64)) >> k & ((1 << bits) - 1) for w in words for k in range(0, 64, bits)]


@pytest.mark.parametrize("width,bins,bits", [(5, 256, 8), (2, 64, 4), (3, 128, 16), (1, 64, 1)])
def test_fingerprint_is_the_plain_one(spark, width, bins, bits):
    draw = random.Random(bins)
    texts = [t or "" for t in ODD] + [" ".join(draw.choice("abcdefghijk") * draw.randrange(1, 4) for _ in range(n)) for n in (1, 3, 4, 5, 6, 40, 200, 900)]
    rows = table(spark, enumerate(texts)).select("doc_id", one_permutation.fingerprint(F.col("text"), width, bins, bits).alias("f")).collect()
    for i, words in rows:
        want = plain_fingerprint(texts[i], width, bins, bits)
        assert (unpacked(words, bits) if words else None) == want, (i, texts[i][:30])


def shingles(text):
    w = [x for x in re.split("[ \t-\r]+", text.lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_next_documents_and_edits(spark):
    rows = [(30, "a b c d e f g"), (None, "nobody"), (7, None), (7, ""), (7, ""), (12, "été 😀 x"), (12, "other"), (-5, "z")] + [(100 + i, t) for i, t in enumerate(ODD)]
    order = sorted({(i is None, -(i or 0), hashlib.sha256((t or "").encode()).digest(), t or "") for i, t in rows})
    for parts in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = {(r.doc_id, r.edited_sha256): r for r in one_permutation.near_documents(table(spark, rows)).collect()}
            count = one_permutation.near_documents(table(spark, rows)).count()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert count == len(rows)
        for k, (no_id, minus, _, text) in enumerate(order):
            after = order[(k + 1) % len(order)][3]
            n = len(text)
            edited = text[:n - n // 2] + after[:n // 2]
            r = got[None if no_id else -minus, hashlib.sha256(edited.encode()).hexdigest()]
            assert r.n_chars == n
            assert abs(r.near_edited - jaccard(text, edited)) < 0.15 and abs(r.near_next - jaccard(text, after)) < 0.15
            assert len(r.fingerprint) == (256 if shingles(text) else 0)
    one = one_permutation.near_documents(table(spark, [(1, "abcd")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0
    assert one_permutation.near_documents(table(spark, [])).count() == 0


def test_copies_are_written_out(spark):
    rows = table(spark, [(1, "same text")] * 9000)
    out = one_permutation.near_documents(rows)
    assert out.count() == 9000 and out.distinct().count() == 1


@given
def test_fingerprint_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op11_fingerprints"](spark, SF).collect()}
    docs = sorted(((r.doc_id, r.text or "") for r in read(spark, SF, "documents").collect()), reverse=True)
    assert len(rows) == len(docs)
    errors, prints = [], {}
    for k, (i, text) in enumerate(docs):
        after, n = docs[(k + 1) % len(docs)][1], len(text)
        edited = text[:n - n // 2] + after[:n // 2]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[i].n_chars == n
        errors += [rows[i].near_edited - jaccard(text, edited), rows[i].near_next - jaccard(text, after)]
        assert prints.setdefault(text, rows[i].fingerprint) == rows[i].fingerprint
    assert abs(sum(errors) / len(errors)) < 0.01 and max(map(abs, errors)) < 0.15


# --- spelling variants ------------------------------------------------------

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_words(rows, length=6, least=5, one_in=199):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= length and c >= least}


def plain_variants(words, ratio=5):
    out, forms = [], {}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    found = {w: [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, []) if near(w, v)] for w in words}
    for w, vs in found.items():
        f = min(vs, key=lambda v: (-words[v], v), default=None)
        forms[w] = f if f is not None and words[f] >= ratio * words[w] else None
    for w, vs in found.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, words[w], len(vs), words.get(forms[w])))
    return sorted(out, key=repr)


def test_sorted_list_scan():
    draw = random.Random(3)
    for _ in range(500):
        words = sorted({"".join(draw.choice("aab\xe9") for _ in range(draw.randrange(7))) for _ in range(draw.randrange(1, 30))})
        pairs = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])}
        got = list(spelling._near_in_order(words, [0] * len(words)))
        assert len(got) == len(set(got)) and set(got) == pairs


@pytest.mark.parametrize("above", [512, 4, 1])
def test_variants_of_hot_halves(spark, above):
    """Most words share their first half, so groups are cut again and again."""
    draw = random.Random(above)
    words = {"".join(["pre" * 4, *(draw.choice("ab") for _ in range(draw.randrange(2, 7)))]) for _ in range(150)}
    words |= {"".join(draw.choice("xy\xe9") for _ in range(draw.randrange(6, 9))) for _ in range(120)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa"}
    counts = {w: draw.choice([5, 25, 25, 125, 700, 3500]) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = sorted(map(tuple, spelling.variants(df, split_above=above).collect()), key=repr)
    assert got == plain_variants(counts)


def test_vocabulary_of_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "Ansonsten ÀÉÿ×÷ " * 7), (2, "Letters, letters LETTERS lettérs " * 3), (2, "Letters, letters LETTERS lettérs " * 3), (3, "x" * 40_000 + " short")] + [(i, "wonderful occasionally wonderfull") for i in range(300)]
    got = {r.word: r.n for r in spelling.vocabulary(table(spark, rows), one_in=7).collect()}
    assert got == plain_words(rows, one_in=7)
    assert any(len(w) == 8 for w in got)  # slips are among them
    assert spelling.variants(spelling.vocabulary(table(spark, []))).count() == 0


@given
def test_spelling_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    got = sorted(map(tuple, QUERIES["op12_spelling"](spark, SF).collect()), key=repr)
    assert got == plain_variants(plain_words(rows))


# --- alignment --------------------------------------------------------------

def plain_alignment(rows):
    """doc_id, n_a, n_b, n_groups, groups, n_links, n_best, count_sum, by sets of ends."""
    t, docs, count = alignment.Tokenizers(A, B), [], Counter()
    for i, text in rows:
        text = text or ""
        a, b = next(iter(t.encode([text])))
        ends_a, ends_b, groups, at = [], [], [], [0, 0]
        for ids, sizes, ends in ((a, t.a_size, ends_a), (b, t.b_size, ends_b)):
            for x in ids:
                ends.append((ends[-1] if ends else 0) + sizes[x])
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append((a[at[0]:x], b[at[1]:y]))
            at = [x, y]
        links = [(g[0][-1], g[1][-1]) for g in groups]
        count.update(links)
        docs.append((i, len(a), len(b), groups, links))
    most = Counter()
    for (x, y), n in count.items():
        most[y] = max(most[y], n)
    told = lambda gs: ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in gs)
    return sorted(((i, na, nb, len(gs), told(gs), len(ls), sum(count[k] == most[k[1]] for k in ls), sum(count[k] for k in ls)) for i, na, nb, gs, ls in docs), key=repr)


@pytest.mark.parametrize("block", [alignment.BLOCK_LINKS, 5])
def test_alignment(spark, block):
    short = [t if t is None or len(t) < 1000 else t[:3000] for t in ODD]
    rows = list(enumerate(short)) + [(None, "The cat sat"), (4, "Überraschung! naïve   coöperation\n\n x=1;"), (50, " leading"), (51, "the the the cat sat on the mat")]
    out = alignment.link_figures(written(alignment.align(table(spark, rows), A, B, block_links=block)))
    cols = ["doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]
    got = sorted((tuple(r[c] for c in cols) for r in out.collect()), key=repr)
    assert got == plain_alignment(rows)
    zero = [r for r in got if r[0] in (0, 1, 10)]  # null, empty, and U+2581, which B reads as a space
    assert len(zero) == 3 and all(r[1:] == (0, 0, 0, "", 0, 0, 0) for r in zero)


def test_alignment_of_odd_tables(spark):
    out = alignment.link_figures(written(alignment.align(table(spark, enumerate(ODD)), A, B)))
    assert out.count() == len(ODD)
    assert alignment.link_figures(written(alignment.align(table(spark, []), A, B))).count() == 0


def test_runs_of_equal_shift():
    draw = random.Random(9)
    for _ in range(300):
        end = draw.randrange(1, 60)
        a, b = (sorted({end, *(draw.randrange(1, end + 1) for _ in range(draw.randrange(60)))}) for _ in "ab")
        common, i, j = [], 0, 0
        for x, x_end, y, y_end in alignment.runs(a, b):
            assert (x, y) == (i, j)
            i, j = x_end, y_end
            common += a[x:x_end] if a[x] == b[y] else [a[x_end - 1]]
        assert (i, j) == (len(a), len(b)) and common == sorted(set(a) & set(b))


@pytest.mark.parametrize("size", [np.uint8, np.uint32])
def test_texts_of_a_call_are_aligned_in_one_pass(monkeypatch, size):
    """Each text alone, and its groups as strings one by one, took half of the operator's time."""
    passes, irregular = [], alignment.irregular
    monkeypatch.setattr(alignment, "irregular", lambda *sides: passes.append(1) or irregular(*sides))
    t = alignment.Tokenizers(A, B)
    t.a_sizes, t.b_sizes = t.a_sizes.astype(size), t.b_sizes.astype(size)
    texts = ["", "The cat sat", "Überraschung! naïve   coöperation\n\n x=1;", "", "osciónga asciónrr", "x" * 300, ""]
    ids = list(t.encode(texts))
    groups, keys, n = alignment.align_tokens(*zip(*ids), t)
    want = [plain_alignment([(0, text)])[0] for text in texts]
    assert len(passes) == 1 and groups.to_pylist() == [w[4] for w in want] and n.tolist() == [w[5] for w in want]
    last = [tuple(int(side.split(",")[-1]) for side in g.split("|")) for w in want for g in w[4].split(";") if g]
    assert [(k >> 32, k & 0xFFFFFFFF) for k in keys.tolist()] == last


@given
def test_alignment_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    got = sorted(map(tuple, QUERIES["op13_alignment"](spark, SF).select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum").collect()))
    want = [(*r[:4], hashlib.sha256(r[4].encode()).hexdigest() if r[4] else "", *r[5:]) for r in plain_alignment(rows)]
    assert got == sorted(want)
