"""The operators against libraries and brute force, on small tables with nulls,
empty and long texts, ties, repeated rows, no rows and clashing columns."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from matchspan.llm import bpe, chat_format, common, decontaminate, exact_dedup, jaccard_join, license_scan, quality, token_count, toxicity, warc
from matchspan.llm.common import held_out, known_to_workers

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "\n\n", "one", "one", "It's 12  o'clock,\tÉté 中文 😀\x00!", "a<|endoftext|>b", "x" * 70_000, "la " * 20_000]


def words(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (s or "").translate(LOW))


def table(spark, texts, first=0):
    """doc_id, text and columns whose names operators use inside."""
    known_to_workers(spark)
    rows = [(first + i, t, "n", i, "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, id int, words string").repartition(3)


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_token_counts(spark):
    library = Tokenizer.from_file(token_count.public_vocabulary())
    got = by_id(token_count.token_counts(table(spark, ODD), token_count.public_vocabulary(), 512))
    for i, t in enumerate(ODD):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 512)
    assert token_count.token_counts(table(spark, []), token_count.public_vocabulary(), 512).count() == 0


def test_bpe_round_trip(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.public_ranks(), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for block in (bpe.BLOCK_WORDS, 3):  # many blocks: words meet their documents again
        whole = bpe.decode(bpe.encode(table(spark, ODD), bpe.public_ranks(), block_words=block), bpe.public_ranks())
        got = by_id(whole)
        assert len(got) == len(ODD)
        for i, t in enumerate(ODD):
            assert bytes(got[i][0]) == np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
            assert bytes(got[i][1]) == (t or "").encode()
    assert bpe.encode(table(spark, []), bpe.public_ranks()).count() == 0


def test_packed_numbers():
    v = np.array([0, 191, 192, 12479, 12480, 700_000, 995_519, 995_520, 1 << 31])
    assert (bpe._unpack(bpe._pack(v)) == v).all()
    assert len(bpe._unpack(bpe._pack(v[:0]))) == 0


LICENCES = [None, "", "Released under the MIT License.", "under the mit license under the mit\nlicense", "Licensed under the Apache License, Version 2.0.",
            "This work is licensed under the GNU General Public License, version 3.", "CC BY NC cc by-nc", "mit " * 500, "license under the mit", "É under the MIT license é"]


def test_license_scan(spark):
    got = by_id(license_scan.scan(table(spark, LICENCES)))
    base = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    for i, t in enumerate(LICENCES):
        w = words(t)
        places = [(k, label) for label, p in base.items() for k in range(len(w)) if w[k: k + len(p.split())] == p.split()]
        n, n_base, first, last, base_labels, labels, score = got[i]
        assert (n, n_base) == (len(w), len(places))
        assert (first, last) == ((min(k for k, _ in places), max(k for k, _ in places)) if places else (None, None))
        assert base_labels == ",".join(sorted({x for _, x in places})) and 0 <= score <= 1
        assert set(base_labels.split(",")) <= set(labels.split(",")) or not base_labels
    assert got[5][5] == "gpl-3" and got[7][5] == ""
    assert license_scan.scan(table(spark, [])).count() == 0


def brute_hits(texts, items, window):
    wins = {}
    for key, t in items:
        w = words(t)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[i: i + k]), set()).add(key)
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if keys := wins.get(tuple(w[i: i + k])):
                    hit.update(range(i, i + k))
                    found |= keys
        out.append((len(w), len(hit), sorted(x for x in found if x is not None)))
    return out


def test_decontamination(spark):
    rng = random.Random(4)
    voc = "a b c d".split()
    items = [(str(i), " ".join(rng.choice(voc) for _ in range(rng.choice([0, 1, 3, 5, 9, 14])))) for i in range(12)] + [("x", None), (None, "d d d d d d"), ("y", "Élan vital")]
    texts = ODD[:9] + [" ".join(rng.choice(voc) for _ in range(rng.randint(0, 40))).upper() for _ in range(60)] + ["élan Vital"]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block in (10_000, 12):
        found = decontaminate.find(table(spark, texts), bench, window=5, block_words=block).select("doc_id", "n_words", "n_hit", "items")
        got = {r[0]: (r[1], r[2], list(r[3])) for r in found.collect()}
        assert [got[i] for i in range(len(texts))] == brute_hits(texts, items, 5)
    none = decontaminate.find(table(spark, texts), bench.limit(0)).where("n_hit > 0")
    assert none.count() == 0 and decontaminate.find(table(spark, []), bench).count() == 0


def test_decontamination_scans_once_and_holds_one_worker_a_core(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = decontaminate.clean(table(spark, ["own words " * 12 + passage, None, "plain"]), bench)
    assert [t.strip() for _, (t, *_) in sorted(by_id(out).items()) if t] == [("own words " * 12).strip(), "plain"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_decontamination_cuts_passages(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Clean start here now. {passage.title()}, and a clean end after all of these extra words", 0), (2, passage, 0), (3, "clean", 7), (4, None, 5)], "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = by_id(decontaminate.clean(docs, bench))
    assert got == {1: ("Clean start here now. , and a clean end after all of these extra words", 70), 3: ("clean", 7), 4: (None, 5)}


@pytest.mark.parametrize("short", [False, True])
def test_exact_dedup(spark, short):
    texts = [None, "", "a b", "a  b", "a\tb", " a b", "A b", "q", "a b", *["copy of all"] * 40]
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    # a digest of two bits puts different texts under one digest
    digest = F.unhex(F.substring(F.sha2(F.col("text"), 256), 1, 1)) if short else None
    found = exact_dedup.dedup(table(spark, texts), F.col("doc_id") % 2 == 0, digest=digest, bucket_keys=4)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()}
    for i, t in enumerate(norm):
        same = [k for k, u in enumerate(norm) if u == t]
        assert got[i] == (same[0], len(same), i == same[0])
    for snapshot in (F.lit(True), F.lit(False)):
        assert exact_dedup.dedup(table(spark, texts), snapshot).where("kept").count() == len(set(norm))
    assert exact_dedup.dedup(table(spark, []), F.lit(True)).count() == 0


def test_fuse_filter():
    rng = np.random.default_rng(1)
    for n in (1, 2, 10, 5000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        f = exact_dedup.FuseFilter.build(np.concatenate((keys, keys)))
        assert f.has(keys).all()
        assert f.has(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.01


def shingle_set(s):
    w = re.findall(r"[^\x20\x09-\x0D]+", (s or "").translate(LOW))
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets, root = [shingle_set(t) for t in texts], list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [(len(s), top(i)) for i, s in enumerate(sets)]


def test_jaccard_join(spark):
    rng = random.Random(8)
    voc = [f"w{i}" for i in range(200)]
    texts = ODD[:9]
    for _ in range(25):
        base = [rng.choice(voc) for _ in range(rng.choice([2, 5, 30, 60]))]
        for _ in range(rng.choice([1, 2, 8])):
            t = list(base)
            for _ in range(rng.randint(0, len(t) // 20)):
                t[rng.randrange(len(t))] = rng.choice(voc)
            texts.append("  ".join(t))
    got = by_id(jaccard_join.link_components(table(spark, texts), hot=3))
    assert [got[i] for i in range(len(texts))] == brute_components(texts)
    assert jaccard_join.link_components(table(spark, [])).count() == 0


def test_jaccard_join_around_a_frequent_text(spark):
    """Copies of one text with one to six edits, some of them not linked to any
    other, and texts that share a passage: the pairs are met one by one."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(146)]
    texts = []
    for _ in range(120):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(40)}"
        texts.append(" ".join(t))
    for _ in range(30):
        texts.append(" ".join(base[20:70] + [f"y{rng.randrange(10_000)}" for _ in range(rng.randint(3, 60))]))
    want = brute_components(texts)
    got = by_id(jaccard_join.link_components(table(spark, texts), hot=3, rounds=1))
    assert [got[i] for i in range(len(texts))] == want


def test_near_pairs_are_met_once(spark):
    """Near texts share most of their pivots: the join met each pair under many of them."""
    base = [f"b{i}" for i in range(300)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in range(10, 290, 20)]
    docs, least = table(spark, texts), (4, 5)
    sets = common.written(jaccard_join.signatures(docs, 5, "doc_id", "text"))
    rows = common.written(jaccard_join.regions(docs.select("text"), 5, least, []))
    live, _ = jaccard_join._live(rows, rows.select("node").distinct().withColumn("comp", F.col("node")))
    sketches = sets.select("node", *jaccard_join._SKETCH)
    met = [tuple(r) for r in jaccard_join._each_pair(live, sketches, least).collect()]
    nodes = sorted(r.node for r in sets.collect())
    assert set(met) == {(a, b) for a in nodes for b in nodes if a < b} and len(met) <= 1.2 * len(set(met))
    assert jaccard_join._each_pair(live, sketches, least, lead=0).count() > 10 * len(met)


def test_pairs_that_are_almost_near_are_not_made(spark, monkeypatch):
    """Copies of one text a little too far apart to link, and long texts that share a
    passage: the pairs that the join made grew as the square of their number."""
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(3000)]
    base, texts = [rng.choice(voc) for _ in range(400)], []
    for _ in range(160):
        t = list(base)
        for _ in range(rng.randint(6, 30)):
            t[rng.randrange(400)] = rng.choice(voc)
        texts.append(" ".join(t))
    for _ in range(40):
        texts.append(" ".join([rng.choice(voc) for _ in range(700)] + base[:30] + [rng.choice(voc) for _ in range(700)]))
    made, each = [], jaccard_join._each_pair

    def counted(*args, **more):
        made.append(common.written(each(*args, **more)))
        return made[-1]

    monkeypatch.setattr(jaccard_join, "_each_pair", counted)
    got = by_id(jaccard_join.link_components(table(spark, texts), hot=20))
    assert [got[i] for i in range(len(texts))] == brute_components(texts)
    assert len(made) == 1 and made[0].count() < len(texts)


PAGES = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u v\r\n", None), (4, "http://c", ""), (5, "d", "\x1f\x8b\x08 é\r\n\r\n" * 9000), (6, "e", "WARC/1.1\r\n"), (None, "f", "alone")]


@pytest.mark.parametrize("size", [1 << 23, 97])
def test_warc_round_trip(spark, tmp_path, size):
    pages = known_to_workers(spark).createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    files = warc.write(pages, str(tmp_path / "w"))
    got = {r[0]: tuple(r)[1:] for r in warc.payloads(warc.read(spark, files, size)).collect()}
    first = {}
    for k, _, html in PAGES:
        body = (html or "").encode()
        keep = first.setdefault(body, k)
        assert got[k] == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if keep == k else "revisit", None if keep == k else keep)
    assert len(got) == len(PAGES)


def test_warc_of_long_heads(spark):
    """A url of megabytes that does not compress, repeated ids, clashing columns."""
    draw = random.Random(1)
    url = "http://a/" + "".join(draw.choice("0123456789abcdefghijklmnopqrstuvwxyz") for _ in range(2_500_000))
    pages = known_to_workers(spark).createDataFrame([(1, "u", "<p>1", 1, "d"), (2, url, "<p>2", 2, "d"), (3, "u", "<p>3", 3, "d"), (3, "v", "<p>4", 3, "d")], "page_id long, url string, html string, first int, digest string")
    got = sorted(tuple(r)[:2] for r in warc.round_trip(pages).collect())
    assert got == [(1, 4), (2, 4), (3, 4), (3, 4)]


def test_warc_of_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_preference_pairs(spark):
    talk = [(1, 0, "user", "hi"), (1, 1, "assistant", "a<|im_end|>"), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, None, None), (3, 0, None, None), (5, 0, "assistant", "x")]
    turns = chat_format.ordered_turns(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"))
    got = by_id(chat_format.format_pairs(*chat_format.mismatched_answers(turns), "conv_id"))
    start, end = chat_format.START, chat_format.END
    assert got[1] == (2, 2, 1, f"{start}user\nhi{end}\n", f"{start}assistant\na< |im_end|>{end}\n", f"{start}assistant\nother{end}\n", "22-44", "22-37")
    assert got[2][5] == f"{start}assistant\nx{end}\n"  # the next answer by id, over a gap
    assert got[3][:3] == (2, 2, 2) and got[3][4:] == ("", "", "", "")
    assert got[5][5] == f"{start}assistant\n{end}\n"


@pytest.mark.parametrize("kind,ids", [("string", ["a", "b", "é"]), ("long", [-(1 << 63), 10, (1 << 63) - 1])])
def test_preference_pairs_of_any_id(spark, kind, ids):
    """Turns after the last answer stay on both sides; null ids, long texts, other columns."""
    talk = [(i, k, role, text, "n", 1) for i in (*ids, None) for k, (role, text) in enumerate([("user", "q"), ("assistant", f"A{i}"), ("user", "thanks" * 20_000)])]
    table = spark.createDataFrame(talk, f"conv_id {kind}, turn long, role string, text string, side string, pos int")
    got = by_id(chat_format.format_pairs(*chat_format.mismatched_answers(chat_format.ordered_turns(table)), "conv_id"))
    start, end = chat_format.START, chat_format.END
    thanks = f"{start}user\n{'thanks' * 20_000}{end}\n"
    for i, after in zip((*ids, None), (*[f"A{x}" for x in ids[1:]], "", "")):
        assert got[i][:3] == (3, 3, 1)
        assert got[i][4:6] == (f"{start}assistant\nA{i}{end}\n{thanks}", f"{start}assistant\n{after}{end}\n{thanks}")
    none = chat_format.ordered_turns(table.where("false"))
    assert chat_format.format_pairs(*chat_format.mismatched_answers(none), "conv_id").count() == 0


def labelled(spark, n=400):
    rng = random.Random(2)
    voc = ["".join(rng.choice("abdeilmnorst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        t = [rng.choice(voc) for _ in range(rng.randint(20, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                t.insert(rng.randrange(len(t)), rng.choice(["grumblefitz", "snorkwad", "blatherskite"]))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad), int(bad)))
    docs = spark.createDataFrame(rows + [(n, None), (n + 1, "")], "doc_id long, text string").repartition(3)
    return docs, spark.createDataFrame(labels + [(0, None, None), (n + 7, 1, 1)], "doc_id long, quality int, toxic int")


def test_quality_learns_from_all_features_of_long_texts(spark):
    """What tells the classes apart stands only in texts of far over 6,000 features, and
    is few of them; rows repeat, columns clash."""
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(60):
        filler = "".join(chr(draw.randrange(0x4E00, 0x9FFF)) if draw.random() < 0.9 else " " for _ in range(9000))
        rows.append((i, filler + (" qzx jvw" * 40 if i % 2 else ""), "n", i))
        labels.append((i, i % 2))
    docs = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string, y string, half int").repartition(3)
    assert min(len(quality.features(t)) for _, t, *_ in rows) > 6000
    held = held_out(5, 0)
    out = quality.score(docs, quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"), "quality", held), held).collect()
    assert len(out) == 65
    assert sum((r.score > 0.5) == bool(r.doc_id % 2) for r in out) >= 60


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_held_out_rows(spark, module, label):
    docs, labels = labelled(known_to_workers(spark))
    held = held_out(4, 2)
    rows = module.score(docs, module.fit(docs, labels, label, held), held).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    hits = [(r["predicted"] == 1) == (r["doc_id"] % 4 == 0) for r in rows if r["held_out"] and r["doc_id"] < 400]
    assert np.mean(hits) > 0.9
    none = module.fit(docs, labels.limit(0), label, held)
    assert {r["score"] for r in module.score(docs, none, held).collect()} == {0.5}
    assert module.score(docs.limit(0), none, held).count() == 0


def test_toxicity_learns_words_of_few_toxic_documents(spark):
    """Every twelfth toxic document has words of its own, the others share a few."""
    rng = random.Random(5)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9))) for _ in range(300)]
    many, few = ["loser", "trash", "stupid"], ["vequsse", "lostraan", "chllach"]

    def text(*bad):
        found = rng.choices(plain, k=40) + list(bad) * 3
        rng.shuffle(found)
        return " ".join(found)

    rows = [(i, text(*(() if i % 2 else few if i % 24 == 0 else many))) for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(2400)], "doc_id long, toxic int")
    score = toxicity.fit(docs, labels, "toxic", held_out(4, 2)).scorer()
    hits = lambda *bad: np.mean([score(text(*bad)) >= 0.3 for _ in range(50)])
    assert hits(*many) > 0.9 and hits(*few) > 0.8 and hits() < 0.1


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    passage = " ".join(f"b{i}" for i in range(14))
    docs, labels = labelled(known_to_workers(spark), 240)
    extra = [(1001, "clean text of its own kind " * 3), (1002, "clean  text of its own kind " * 3), (1003, "some words before " + passage + " and quite a few words after the passage so that it is cut")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) as long) AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        now.write.parquet(str(tmp_path / f"s{i}"))
        now = spark.read.parquet(str(tmp_path / f"s{i}"))
    kept = {r["doc_id"]: r["text"] for r in now.collect()}
    assert 1001 in kept and 1002 not in kept and passage not in kept[1003]
    toxic = [i for i in range(240) if i % 4 == 0]
    assert sum(i in kept for i in toxic) <= 6 and sum(i in kept for i in range(240) if i % 4) >= 165
    out = corpus_pipeline.encode(spark, now, str(tmp_path))
    assert {r["doc_id"]: r["decoded_sha256"] for r in out.collect()} == {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t in kept.items()}


def stage_rows(spark, stage, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r["doc_id"], r["text"]) for r in stage(known_to_workers(spark), docs, "").collect()), key=str)


def test_exact_dedup_stage_decides_by_row(spark):
    got = stage_rows(spark, corpus_pipeline.drop_copies, [(1, "A"), (1, "B"), (2, "B"), (1, "A"), (None, "A"), (3, "C"), (None, "C"), (None, "D"), (None, "D"), (None, "E  e"), (None, "E e"), (4, None), (None, "")])
    assert got == sorted([(1, "A"), (1, "B"), (3, "C"), (None, "D"), (None, "E  e"), (4, None)], key=str)


def test_near_dedup_stage_decides_by_row(spark):
    base = {k: [f"{k}{i}" for i in range(60)] for k in "abcde"}
    whole = {k: " ".join(w) for k, w in base.items()}
    near = {k: " ".join(w[:-1]) for k, w in base.items()}
    rows = [(1, whole["a"]), (1, whole["b"]), (2, near["b"]), (None, near["a"]), (None, whole["c"]), (None, near["c"]), (None, whole["d"]), (None, whole["d"]), (5, whole["e"]), (5, near["e"]), (6, ""), (6, ""), (None, None)]
    got = stage_rows(spark, corpus_pipeline.drop_near_copies, rows)
    ids = sorted((str(i), (t or "")[:1]) for i, t in got)
    assert ids == [("1", "a"), ("1", "b"), ("5", "e"), ("6", ""), ("None", ""), ("None", "c"), ("None", "d")]
    assert got == stage_rows(spark, corpus_pipeline.drop_near_copies, rows[::-1])


@pytest.mark.parametrize("stage", ["drop_copies", "drop_near_copies", "drop_benchmark"])
def test_pipeline_stages_with_odd_columns(spark, stage, tmp_path):
    """Maps, dots and backticks in names, null ids, repeated rows, no rows."""
    text = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"other{i}" for i in range(30))
    rows = [(5, text, {"a": 1}, "x", 1), (2, text, {"b": None}, "y", 2), (2, text, None, "y", 3), (None, text, {}, "z", 4), (9, other, {"c": 3}, None, 5), (None, "alone", None, None, 6)]
    schema = "doc_id long, text string, m map<string,int>, `a.b` string, `c``d` int"
    docs = known_to_workers(spark).createDataFrame(rows, schema)
    spark.createDataFrame([("q1", "never there at all")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    run = getattr(corpus_pipeline, stage)
    out = run(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"][:5]) for r in out.collect())
    if stage == "drop_benchmark":
        assert len(got) == len(rows)
    else:
        assert got == [(False, 2, "word0"), (False, 9, "other"), (True, 0, "alone")]
    assert run(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_workers_give_back_what_is_not_used(monkeypatch):
    """Kept objects stay for the next tasks of their operator and go with the first later task of another."""
    common.worker_cache()["big"] = 1
    batch = pa.RecordBatch.from_arrays([pa.array(range(600))], names=["x"])
    assert [b.num_rows for b in common.slices([batch])] == [256, 256, 88] and common.worker_cache()["big"] == 1
    monkeypatch.setattr(common, "_asked", common._asked - common.IDLE_S - 1)
    assert sum(b.num_rows for b in common.slices([batch])) == 600 and not common._CACHE
