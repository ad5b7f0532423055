"""Preference formatting of conversations, in DataFrame functions only.

A pair has a chosen and a rejected conversation.  Their longest common prefix of
turns (equal role and text) is rendered once as the prompt; the turns after it
are rendered as the two completions.  The mask of a completion lists the spans
of characters to train on: the text of assistant turns with the end marker.

Turns are rows throughout, so a task handles rows of a pair in sorted order and
spills; only the last step puts the turns of a pair together, as the pair is one
row of the result.

Results: null roles and texts count as empty.  Turns of a conversation are
ordered by turn (nulls first), then role and text, so ties have a fixed order
and repeated rows are turns of their own.  Control strings inside a text are
broken ("<|" becomes "< |").  If one side is a prefix of the other its
completion is empty.  Rows with a null conversation id are one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchspan.llm.common import written

START, END = "<|im_start|>", "<|im_end|>"


def _clean(c: Column) -> Column:
    return F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """id, pos (from 0), role, text."""
    rows = conversations.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), _clean(F.col("role")).alias("role"), _clean(F.col("text")).alias("text"))
    order = W.partitionBy("id").orderBy("turn", "role", "text")
    return rows.select("id", (F.row_number().over(order) - 1).alias("pos"), "role", "text")


def mismatched_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns (id, pos, role, text) out of conversations: the
    chosen side is a conversation as it is; on the rejected side its last assistant
    turn holds the last answer of the next conversation that has one, by id (empty
    after the last id, and for rows without an id).  Ids may be of any type that orders."""
    answers = turns.where("role = 'assistant'").groupBy("id").agg(F.max(F.struct("pos", "text")).alias("last"))
    # ids are dealt into ranges; the last one of a range takes the first of the next (one row a range)
    ranged = written(answers.where("id IS NOT NULL").repartitionByRange("id").select("id", "last", F.spark_partition_id().alias("range")))
    inside = W.partitionBy("range").orderBy("id")
    rows = ranged.select("id", "range", F.lead("last.text").over(inside).alias("next"), F.row_number().over(inside).alias("at"), "last.text")
    after = rows.where("at = 1").select("range", F.lead("text").over(W.orderBy("range")).alias("after"))
    other = rows.join(after, "range").select(F.col("id").alias("oid"), F.coalesce("next", "after").alias("other"))
    last = answers.select(F.col("id").alias("aid"), F.col("last.pos").alias("last")).join(other, F.col("aid") == F.col("oid"), "left").select("aid", "last", "other")
    whole = turns.join(last, F.col("id").eqNullSafe(F.col("aid")), "left")
    swapped = F.when(F.col("pos") == F.col("last"), F.coalesce("other", F.lit(""))).otherwise(F.col("text"))
    return whole.select("id", "pos", "role", "text"), whole.select("id", "pos", "role", swapped.alias("text"))


def format_pairs(chosen: DataFrame, rejected: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """``id_col``, n_chosen, n_rejected, n_prefix (turns), prompt, chosen, rejected,
    chosen_mask and rejected_mask (spans from-to within the completion)."""
    sides = chosen.withColumn("side", F.lit("c")).unionByName(rejected.withColumn("side", F.lit("r")))
    turn = F.struct("role", "text")
    rows = sides.groupBy("id", "pos").agg(F.max(F.when(F.col("side") == "c", turn)).alias("c"), F.max(F.when(F.col("side") == "r", turn)).alias("r"))
    whole = W.partitionBy("id")
    first = F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("pos"))).over(whole)
    rows = rows.withColumn("first", first).withColumn("common", F.col("first").isNull() | (F.col("pos") < F.col("first")))

    def rendered(side: str) -> Column:
        return F.when(F.col(side).isNotNull(), F.concat(F.lit(START), F.col(f"{side}.role"), F.lit("\n"), F.col(f"{side}.text"), F.lit(END + "\n")))

    rows = rows.withColumns({"ct": rendered("c"), "rt": rendered("r")})
    before = W.partitionBy("id").orderBy("pos")

    def span(side: str) -> Column:
        own = F.when(~F.col("common"), F.length(f"{side}t"))
        end = F.sum(own).over(before) - 1  # the last line feed is not trained on
        size = F.length(f"{side}.text") + len(END)
        return F.when(~F.col("common") & (F.col(f"{side}.role") == "assistant"), F.concat((end - size).cast("string"), F.lit("-"), end.cast("string")))

    rows = rows.withColumns({"cs": span("c"), "rs": span("r")})

    def joined(value: Column, glue: str) -> Column:
        kept = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct("pos", value.alias("v")))))
        return F.array_join(F.transform(kept, lambda x: x["v"]), glue)

    return rows.groupBy(F.col("id").alias(id_col)).agg(
        F.count("c").alias("n_chosen"), F.count("r").alias("n_rejected"), F.count_if(F.col("common")).alias("n_prefix"),
        joined(F.when(F.col("common"), F.col("ct")), "").alias("prompt"),
        joined(F.when(~F.col("common"), F.col("ct")), "").alias("chosen"),
        joined(F.when(~F.col("common"), F.col("rt")), "").alias("rejected"),
        joined(F.col("cs"), ",").alias("chosen_mask"), joined(F.col("rs"), ",").alias("rejected_mask"),
    )


def oracle_sql() -> str:
    clean = lambda c: f"replace(coalesce({c}, ''), '<|', '< |')"
    seg = lambda s: f"CASE WHEN {s}_role IS NOT NULL THEN '{START}' || {s}_role || chr(10) || {s}_text || '{END}' || chr(10) END"
    span = lambda s: f"""CASE WHEN NOT common AND {s}_role = 'assistant' THEN
        (sum(CASE WHEN NOT common THEN length({s}t) END) OVER w - 1 - length({s}_text) - {len(END)})::BIGINT || '-' || (sum(CASE WHEN NOT common THEN length({s}t) END) OVER w - 1)::BIGINT END"""  # noqa: E731
    return f"""
WITH raw AS (SELECT conv_id, turn, {clean('role')} AS role, {clean('text')} AS text FROM conversations),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos, role, text FROM raw),
answers AS (SELECT conv_id, max(pos) AS last, arg_max(text, pos) AS text FROM turns WHERE role = 'assistant' GROUP BY conv_id),
others AS (SELECT conv_id, lead(text) OVER (ORDER BY conv_id) AS text FROM answers WHERE conv_id IS NOT NULL),
rows AS (SELECT t.conv_id, t.pos, t.role AS c_role, t.text AS c_text, t.role AS r_role,
        CASE WHEN t.pos = a.last THEN coalesce(o.text, '') ELSE t.text END AS r_text
    FROM turns t LEFT JOIN answers a ON a.conv_id IS NOT DISTINCT FROM t.conv_id LEFT JOIN others o ON o.conv_id = a.conv_id),
firsts AS (SELECT *, min(CASE WHEN c_text <> r_text THEN pos END) OVER (PARTITION BY conv_id) AS first FROM rows),
segs AS (SELECT *, first IS NULL OR pos < first AS common, {seg('c')} AS ct, {seg('r')} AS rt FROM firsts),
spans AS (SELECT *, {span('c')} AS cs, {span('r')} AS rs FROM segs WINDOW w AS (PARTITION BY conv_id ORDER BY pos))
SELECT conv_id, count(c_role) AS n_chosen, count(r_role) AS n_rejected, count(*) FILTER (WHERE common) AS n_prefix,
    coalesce(string_agg(ct, '' ORDER BY pos) FILTER (WHERE common), '') AS prompt,
    coalesce(string_agg(ct, '' ORDER BY pos) FILTER (WHERE NOT common), '') AS chosen,
    coalesce(string_agg(rt, '' ORDER BY pos) FILTER (WHERE NOT common), '') AS rejected,
    coalesce(string_agg(cs, ',' ORDER BY pos), '') AS chosen_mask, coalesce(string_agg(rs, ',' ORDER BY pos), '') AS rejected_mask
FROM spans GROUP BY conv_id"""
