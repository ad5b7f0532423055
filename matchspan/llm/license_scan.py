"""License scans by a positional rare-token index, in DataFrame functions only.

Templates are short word sequences with a label, and a mandatory key phrase
inside.  The document frequencies of the templates' words are counted over the
whole table.  Each template is indexed under its rarest words (``LOOKUPS`` of
them); a file's occurrences of those words give postings (template, offset),
and position less offset is where the template would start.  At each start the
words are compared by relative position: the key phrase must stand there whole,
and the idf weight of the words that agree must reach ``LEAST`` of the template.
A base phrase is a template that is all key phrase, so it is found exactly and at
every place: any copy of it contains its rarest word.

Results: A-Z count as a-z.  A null or empty text, or one without words, has no
words, no labels, null first_word and last_word, and score 0.  Repeated rows are
each returned and each counted in the document frequencies.  Score is the
largest agreeing share over the accepted starts, rounded to 6 places.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspan.llm.common import LOWER_AZ, UPPER_AZ, WORD_PATTERN, text_or_empty

LOOKUPS = 2
LEAST = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[int, int]  # from, to: the key phrase's words
    base: bool = False


def template(label: str, text: str, key: str, base: bool = False) -> Template:
    words, inner = tuple(text.split()), tuple(key.split())
    at = next(i for i in range(len(words)) if words[i: i + len(inner)] == inner)
    return Template(label, words, (at, at + len(inner)), base)


#: Phrases and labels of the contract.
BASE = [template(label, text, text, True) for label, text in (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)]
TEMPLATES = BASE + [
    template("mit", "released under the mit license", "mit license"),
    template("apache-2", "licensed under the apache license version 2 0", "apache license"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("gpl-3", "this work is licensed under the gnu general public license version 3", "general public license"),
    template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
]


def words_column(text_col: str = "text") -> Column:
    return F.regexp_extract_all(F.translate(text_or_empty(text_col), UPPER_AZ, LOWER_AZ), F.lit(WORD_PATTERN), F.lit(0))


def idf_of(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each word of the (bounded) vocabulary over all rows of ``words``."""
    known = F.array(*map(F.lit, vocabulary))
    # one row per vocabulary word and one for the number of rows
    counts = words.select(F.explode(F.array_append(F.array_intersect("words", known), F.lit(""))).alias("w")).groupBy("w").count().collect()
    df = {r["w"]: r["count"] for r in counts}
    n = df.get("", 0)
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}


def scan(docs: DataFrame, templates: list[Template] | None = None, lookups: int = LOOKUPS, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    templates = TEMPLATES if templates is None else templates
    words = docs.select(F.col(id_col).alias("id"), words_column(text_col).alias("words"))
    vocabulary = sorted({w for t in templates for w in t.words})
    idf = idf_of(words, vocabulary)
    # rarest first; equal idf by the word
    rare = {t: sorted(set(t.words), key=lambda w: (-idf[w], w))[:lookups] for t in templates}
    looked = sorted({w for ws in rare.values() for w in ws})

    at = F.filter(F.transform("words", lambda w, i: F.when(w.isin(looked), i)), lambda i: i.isNotNull())
    rows = words.select("id", F.size("words").cast("long").alias("n_words"), "words", at.alias("at"))
    rows = rows.select("id", "n_words", *[_starts(t, rare[t], idf, least).alias(f"s{k}") for k, t in enumerate(templates)])

    base = [F.col(f"s{k}.start") for k, t in enumerate(templates) if t.base]
    places = F.concat(*base)

    def labels(only_base: bool) -> Column:
        met = [F.when(F.size(f"s{k}") > 0, F.lit(t.label)) for k, t in enumerate(templates) if t.base or not only_base]
        return F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*met), lambda x: x.isNotNull()))), ",")

    share = F.concat(*[F.col(f"s{k}.share") for k in range(len(templates))])
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        labels(True).alias("base_labels"), labels(False).alias("labels"),
        F.round(F.coalesce(F.array_max(share), F.lit(0.0)), 6).alias("score"),
    )


def _starts(t: Template, rare: list[str], idf: dict[str, float], least: float) -> Column:
    """array<struct<start, share>>: the accepted starts of a template among ``at``."""
    def postings(p: Column) -> Column:
        word = F.get("words", p)
        hits = [F.when(word == w, p - offset) for offset, w in enumerate(t.words) if w in rare]
        return F.array(*hits)

    starts = F.array_distinct(F.filter(F.flatten(F.transform("at", postings)), lambda s: s.isNotNull()))
    total = sum(idf[w] for w in t.words)

    def judge(s: Column) -> Column:
        same = [F.get("words", s + j).eqNullSafe(F.lit(w)) for j, w in enumerate(t.words)]
        key = F.lit(True)
        for x in same[t.key[0]: t.key[1]]:
            key = key & x
        weight = F.lit(0.0)
        for x, w in zip(same, t.words):
            weight = weight + F.when(x, F.lit(idf[w])).otherwise(F.lit(0.0))
        return F.struct(s.alias("start"), F.when(key, weight / F.lit(total)).otherwise(F.lit(-1.0)).alias("share"))

    return F.filter(F.transform(starts, judge), lambda x: x["share"] >= least - 1e-9)


def oracle_sql() -> str:
    """The same in DuckDB SQL, by joins over (row, place, word)."""
    quoted = lambda s: "'" + s + "'"
    t_rows = ", ".join(f"({k}, {quoted(t.label)}, {'true' if t.base else 'false'})" for k, t in enumerate(TEMPLATES))
    w_rows = ", ".join(f"({k}, {j}, {quoted(w)}, {'true' if t.key[0] <= j < t.key[1] else 'false'})" for k, t in enumerate(TEMPLATES) for j, w in enumerate(t.words))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER_AZ}', '{LOWER_AZ}'), '{WORD_PATTERN}') AS ws FROM documents),
toks AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM docs),
tpl(tid, label, base) AS (VALUES {t_rows}),
tw(tid, j, word, is_key) AS (VALUES {w_rows}),
df AS (SELECT v.word, count(DISTINCT toks.rid) AS df FROM (SELECT DISTINCT word FROM tw) v LEFT JOIN toks USING (word) GROUP BY v.word),
idf AS (SELECT word, ln(((SELECT count(*) FROM docs) + 1) / (df + 1)) + 1 AS idf FROM df),
rare AS (SELECT tid, word FROM (SELECT DISTINCT tid, word FROM tw) JOIN idf USING (word)
    QUALIFY row_number() OVER (PARTITION BY tid ORDER BY idf DESC, word) <= {LOOKUPS}),
starts AS (SELECT DISTINCT toks.rid, tw.tid, toks.pos - tw.j AS s FROM rare JOIN tw USING (tid, word) JOIN toks USING (word)),
judged AS (SELECT s.rid, s.tid, s.s, sum(CASE WHEN k.word IS NOT NULL THEN i.idf ELSE 0 END) / sum(i.idf) AS share,
        bool_and(k.word IS NOT NULL) FILTER (WHERE tw.is_key) AS key_met
    FROM starts s JOIN tw USING (tid) JOIN idf i USING (word)
    LEFT JOIN toks k ON k.rid = s.rid AND k.pos = s.s + tw.j AND k.word = tw.word GROUP BY ALL),
met AS (SELECT rid, label, base, s, share FROM judged JOIN tpl USING (tid) WHERE key_met AND share >= {LEAST} - 1e-9),
per AS (SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM met GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0.0), 6)::DOUBLE AS score
FROM docs LEFT JOIN per USING (rid)"""
