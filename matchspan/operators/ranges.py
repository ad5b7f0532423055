"""Match ranges (T0, T5-T9): from START/UPDATE/END rows about pairs (a, b)
to exclusive time ranges [start_time, final_end_time) with the reason each
range ended, adjacent ranges of a pair merged.

Physical shape of :func:`match_ranges` (full-data exchanges in brackets):

0. prepare -> [hash of all columns] distinct (partial aggregate map-side) ->
   prepared rows, written once: the only scan of the source
1. one job counts rows a key; for hot keys another draws the edges of their buckets
2. [hash a, a-bucket] -> validate on (a, t) -> distinct
3. [hash b, b-bucket, null-b spread] -> validate on (b, t)
   -> next row by ``b`` -> end candidate B
4. [hash a, a-bucket] -> next row by ``a`` -> end candidate A
   -> least(A, B) = chosen end (row-local, no window) -> checkpoint
5. ranges only: [hash a, b, bucket] -> islands of adjacent ranges
   -> partial/final aggregate per island
6. with ``payload``: start rows folded by (a, b, start) -> [hash] -> joined to the ranges

A bucket is a monotone function of the next-row order per key (see ``timeline``): a
fixed width of time, and for hot keys as many rows as others, so a hot key spreads
over many tasks whatever its times are.  Rows on bucket edges take the next bucket's
first row from small per-bucket summaries, which are partial aggregates of the
prepared rows; value sets of ties that a bucket cuts are partial aggregates as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    END_REASON_NAME,
    END_REASON_ORDINAL,
    END_TIME,
    FINAL_END_REASON,
    FINAL_END_TIME,
    START_TIME,
    EndReason,
    MatchConfig,
    Status,
)
from ..session import ensure_checkpoint_dir, write_once
from .aggregates import dedup_keep_first, quoted
from .prepare import initialize
from .timeline import (
    Edges,
    asc_nulls_last_key,
    bucket_by_rows,
    bucket_by_time,
    cold_bucket,
    default_width,
    desc_nulls_last_key,
    first_bucket_of_time,
    hot_edges,
    lead_across_buckets,
    next_bucket_first,
    time_units,
)
from .validate import reduce_and_validate, start_flag, tie_sets

START, END = Status.START.value, Status.END.value
TB_A, TB_B = "_tba", "_tbb"  # buckets of a-keyed and b-keyed windows
FIRST_A, LAST_A, FIRST_B, LAST_B = "_fta", "_lta", "_ftb", "_ltb"  # buckets of a row's time; they differ in a cut tie
NB = "_nb"  # spreads null-b rows (never valid, never keyed) over tasks
_HELPERS = {TB_A, TB_B, FIRST_A, LAST_A, FIRST_B, LAST_B, NB, "_edges", "_cut"}


def _reason_name(ordinal: Column) -> Column:
    pairs = [x for r in EndReason for x in (F.lit(r.value), F.lit(r.name))]
    return F.try_element_at(F.create_map(*pairs), ordinal)


def _cold(t: Column, tdt: T.DataType, cfg: MatchConfig) -> Column:
    units = time_units(t, tdt)
    return cold_bucket(units if units is not None else F.lit(None).cast("double"), default_width(tdt, cfg.split_width))


def _tuple_of(cfg: MatchConfig, counterpart: str) -> list[Column]:
    """Fields whose ascending order is the next-row order up to the counterpart.  Rows
    equal in all of them stay together; no stage changes these fields of a valid start."""
    s, c = F.col(cfg.status_col), F.col(counterpart)
    return [F.col(cfg.time_col), *desc_nulls_last_key(s), *asc_nulls_last_key(c)]


def _with_buckets(x: DataFrame, cfg: MatchConfig, b_side: bool = True) -> tuple[DataFrame, Edges | None, Edges | None]:
    """``x`` with per-side buckets and the null-b spread; hot keys are cut by rows.
    ``x`` is read by the hot-key jobs: pass a scan or a written table.
    ``b_side=False`` skips the hot-key search for ``b`` when only ``a``-keyed windows
    follow."""
    clash = sorted(_HELPERS & set(x.columns))
    if clash:
        raise ValueError(f"column names {clash} are reserved for the analysis")
    t, tdt = F.col(cfg.time_col), x.schema[cfg.time_col].dataType
    sides = [(cfg.a_col, _tuple_of(cfg, cfg.b_col)), (cfg.b_col, _tuple_of(cfg, cfg.a_col))]
    edges = hot_edges(x, sides[:2 if b_side else 1], cfg.rows_per_bucket, cfg.max_hot_keys) + ([] if b_side else [None])
    columns, cold = x.columns, _cold(t, tdt, cfg)
    for side, (_, order), bucket, first, last in zip(edges, sides, (TB_A, TB_B), (FIRST_A, FIRST_B), (LAST_A, LAST_B)):
        if side is None:
            x = x.select(*columns, cold.alias(bucket))
        else:
            own = [bucket_by_rows(order, cold).alias(bucket)]
            if side.ties:
                own += [first_bucket_of_time(t).alias(first), bucket_by_time(t, F.lit(None).cast("long")).alias(last)]
            x = side.on(x).select(*columns, *own)
        columns = x.columns
    a, b = F.col(cfg.a_col), F.col(cfg.b_col)
    return x.select("*", F.when(b.isNull(), F.xxhash64(a, t)).otherwise(F.lit(0).cast("long")).alias(NB)), *edges


def _order(cfg: MatchConfig, counterpart: str) -> list[Column]:
    """Next-row order of one direction: time, END before START, counterpart, others."""
    return [
        F.col(cfg.time_col).asc(),
        F.col(cfg.status_col).desc_nulls_last(),
        F.col(counterpart).asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in cfg.other_matches],
    ]


def _bucket_firsts(df: DataFrame, cfg: MatchConfig, keys: list[str], counterpart: str, bucket: str) -> DataFrame:
    """First row of each (keys, bucket) in next-row order, as a struct of
    (time, status, counterpart).  A min over a struct whose leading fields
    encode the order; others only break ties between rows that agree on all
    three values, so they can be left out."""
    order_key = F.struct(*[x.alias(f"k{i}") for i, x in enumerate(_tuple_of(cfg, counterpart))])
    mins = df.groupBy(*keys, bucket).agg(F.min(order_key).alias("_k"))
    first = F.struct(
        F.col("_k.k0").alias(cfg.time_col),
        (-F.col("_k.k2")).alias(cfg.status_col),
        F.col("_k.k4").alias(counterpart),
    )
    return next_bucket_first(mins.select(*keys, bucket, first.alias("_first")), keys, bucket, "_first")


def _firsts_b(x: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Per-bucket first rows keyed by ``b``.  Rows with null ``b`` all fall in
    one group per bucket here (their spread value is not a key); they never
    join back, because null ``b`` never equals anything, so no filter is
    needed.

    The spread value of a keyed row is 0.  It is written as an expression that
    the optimizer does not fold: a literal would drop out of the join keys, the
    join would no longer fit the partitioning by (b, bucket, spread), and every
    row would be exchanged once more, all null ``b`` to one task."""
    firsts = _bucket_firsts(x, cfg, [cfg.b_col], cfg.a_col, TB_B)
    return firsts.select(cfg.b_col, _unfolded_zero(cfg).alias(NB), TB_B, "_bucket_next")


def _unfolded_zero(cfg: MatchConfig) -> Column:
    return F.pmod(F.xxhash64(F.col(cfg.b_col)), F.lit(1).cast("long"))


def _candidate(cfg: MatchConfig, key: str, counterpart: str, prefix: str) -> Column:
    """End candidate of one direction from the next row's (time, status,
    counterpart): a struct (end_time, ordinal, name) or null.  The six cells
    are exclusive, so one direction yields at most one candidate; a reason
    that is not enabled leaves the direction without a candidate."""
    nx_t = F.col(prefix + cfg.time_col)
    nx_s = F.col(prefix + cfg.status_col)
    nx_c = F.col(prefix + counterpart)
    here_c = F.col(counterpart)
    valid_start = (
        (F.col(cfg.status_col) == F.lit(START))
        & (F.col(cfg.valid_col) == F.lit(True))
        & F.col(key).isNotNull()
    )
    R = EndReason
    on_end = (F.when(nx_c.isNull(), R.NEXT_END_NULL.value)
              .when(nx_c == here_c, R.NEXT_END_FOR_SAME_MATCH.value)
              .otherwise(R.NEXT_END_MATCH_BREAK.value))
    on_start = (F.when(nx_c.isNull(), R.NEXT_START_MATCH_NULL.value)
                .when(nx_c == here_c, R.NEXT_START_SAME_MATCH.value)
                .otherwise(R.NEXT_START_MATCH_BREAK.value))
    ordinal = (F.when(valid_start & (nx_s == F.lit(END)), on_end)
               .when(valid_start & (nx_s == F.lit(START)), on_start))
    allowed = [r.value for r in cfg.allowed_reasons]
    if len(allowed) < len(EndReason):
        ordinal = F.when(ordinal.isin(allowed), ordinal)
    ordinal = ordinal.cast("int")
    return F.when(
        ordinal.isNotNull(),
        F.struct(nx_t.alias(END_TIME), ordinal.alias(END_REASON_ORDINAL), _reason_name(ordinal).alias(END_REASON_NAME)),
    )


def _direction_b(x: DataFrame, cfg: MatchConfig, firsts_b: DataFrame) -> DataFrame:
    with_next = lead_across_buckets(
        x, [cfg.b_col, NB], TB_B, _order(cfg, cfg.a_col),
        [cfg.time_col, cfg.status_col, cfg.a_col], firsts_b, "_nxb_",
    )
    return with_next.select(
        *x.columns, _candidate(cfg, cfg.b_col, cfg.a_col, "_nxb_").alias("_cand_b")
    )


def _direction_a(x: DataFrame, cfg: MatchConfig, firsts_a: DataFrame) -> DataFrame:
    with_next = lead_across_buckets(
        x, [cfg.a_col], TB_A, _order(cfg, cfg.b_col),
        [cfg.time_col, cfg.status_col, cfg.b_col], firsts_a, "_nxa_",
    )
    return with_next.select(
        *x.columns, _candidate(cfg, cfg.a_col, cfg.b_col, "_nxa_").alias("_cand_a")
    )


def _validate_both(x: DataFrame, cfg: MatchConfig, edges_a: Edges | None, edges_b: Edges | None) -> DataFrame:
    """T3 passes on distinct rows with buckets; the result is partitioned by
    (b, b-bucket, spread).

    After the first pass all valid STARTs of one (a, time) are filled to the
    same values and collapse to one row (they agree in the bucket's order tuple, so
    they lie in one bucket); the second pass can then only invalidate or fill
    that single row, so it cannot create duplicates and needs no distinct of its own.

    Where a tie on (key, time) is large enough to be cut, the value sets of the cut
    groups come from a partial aggregate.  The one of the second pass needs the rows
    of the first, which are then written once."""
    keys_a, match_a = [cfg.a_col, cfg.time_col], [*cfg.other_matches, cfg.b_col]
    keys_b, match_b = [cfg.b_col, cfg.time_col], [*cfg.other_matches, cfg.a_col]
    cut = tie_sets(x, keys_a, match_a, FIRST_A, LAST_A, TB_A) if edges_a is not None and edges_a.ties else None
    p1 = reduce_and_validate(x.repartition(cfg.a_col, TB_A), cfg, keys_a, match_a, split_cols=[TB_A], cut_ties=cut)
    cut = None
    if edges_b is not None and edges_b.ties:
        p1 = write_once(p1, "first-pass")
        cut = tie_sets(p1, keys_b, match_b, FIRST_B, LAST_B, TB_B).withColumn(NB, _unfolded_zero(cfg))
    return reduce_and_validate(p1.repartition(cfg.b_col, TB_B, NB), cfg, keys_b, match_b,
                               split_cols=[TB_B, NB], dedupe=False, cut_ties=cut)


def _output_columns(df_columns: list[str], cfg: MatchConfig) -> list[str]:
    cols = [c for c in df_columns if c not in _HELPERS]
    if cfg.valid_col not in cols:
        cols.append(cfg.valid_col)
    return cols


# ---------------------------------------------------------------------------
# Stage operators (each usable on its own, as in the original's stage tests)
# ---------------------------------------------------------------------------

def mark_valid_starts(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Set the validity flag, then validate per (a, time) and per (b, time)."""
    cols = _output_columns(df.columns, cfg)
    x = df.withColumn(cfg.valid_col, start_flag(cfg)).distinct()
    x, edges_a, edges_b = _with_buckets(write_once(x, "rows"), cfg)
    return _validate_both(x, cfg, edges_a, edges_b).select(*cols)


def end_candidates(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """T5: one row per end candidate (null candidate kept), with start_time,
    end_reason_ordinal, end_reason_name and end_time.  Expects validated rows
    whose status is START, END or null.  The input is read by three branches
    (rows, bucket-edge summaries, hot keys): checkpoint an expensive input."""
    cols = list(df.columns)
    x, _, _ = _with_buckets(df, cfg)
    firsts_b = _firsts_b(x, cfg)
    firsts_a = _bucket_firsts(x, cfg, [cfg.a_col], cfg.b_col, TB_A)
    x = _direction_b(x.repartition(cfg.b_col, TB_B, NB), cfg, firsts_b)
    x = _direction_a(x.repartition(cfg.a_col, TB_A), cfg, firsts_a)
    cands = F.array_distinct(F.filter(F.array("_cand_a", "_cand_b"), lambda c: c.isNotNull()))
    start_time = F.when(F.col(cfg.status_col) == F.lit(START), F.col(cfg.time_col))
    out = x.select(*cols, start_time.alias(START_TIME), F.explode_outer(cands).alias("_cand"))
    return out.select(
        *cols, START_TIME,
        F.col("_cand").getField(END_REASON_ORDINAL).alias(END_REASON_ORDINAL),
        F.col("_cand").getField(END_REASON_NAME).alias(END_REASON_NAME),
        F.col("_cand").getField(END_TIME).alias(END_TIME),
    ).distinct()


def choose_final_end(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Per (a, b, start_time) keep the earliest end, then the lowest
    reason ordinal; rows without an end are dropped."""
    keep = [c for c in df.columns if c not in (END_TIME, END_REASON_ORDINAL, END_REASON_NAME)]
    w = Window.partitionBy(cfg.a_col, cfg.b_col, START_TIME)
    best = F.min(F.struct(F.col(END_TIME), F.col(END_REASON_ORDINAL), F.col(END_REASON_NAME))).over(w)
    x = df.where(F.col(END_TIME).isNotNull()).select("*", best.alias("_best"))
    x = x.where(F.col(END_TIME) == F.col("_best").getField(END_TIME))
    return x.select(
        *keep,
        F.col("_best").getField(END_TIME).alias(FINAL_END_TIME),
        F.col("_best").getField(END_REASON_NAME).alias(FINAL_END_REASON),
    ).distinct()


def connect_ranges(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Merge ranges of a pair that follow on exactly (end = next start).
    The first range of a chain keeps its own columns and takes the end time
    and reason of the last one.  The input is read more than once:
    checkpoint an expensive input."""
    cols = list(df.columns)
    return _merge(df.where(F.col(FINAL_END_TIME).isNotNull()), cfg).select(*cols)


def _merge(r: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Islands of adjacent ranges per (a, b), split by time bucket.

    A range whose end lies in a later bucket is copied into that bucket as a
    ghost so the first range there sees its true predecessor.  Heads are
    found per bucket; a bucket that starts inside an island takes the island
    head from a running max over the per-bucket summary.  The final grouping
    aggregates partially per bucket before its shuffle.
    """
    a, b = cfg.a_col, cfg.b_col
    cols = r.columns
    head_cols = [c for c in cols if c not in (a, b, START_TIME, FINAL_END_TIME, FINAL_END_REASON)]
    tdt, start, end = r.schema[START_TIME].dataType, F.col(START_TIME), F.col(FINAL_END_TIME)
    edges = hot_edges(r, [(a, [start])], cfg.rows_per_bucket, cfg.max_hot_keys)[0]
    if edges is None:
        r = r.select(*cols, _cold(start, tdt, cfg).alias(TB_A), _cold(end, tdt, cfg).alias("_eb"))
    else:
        r = edges.on(r).select(*cols, bucket_by_time(start, _cold(start, tdt, cfg)).alias(TB_A), bucket_by_time(end, _cold(end, tdt, cfg)).alias("_eb"))
    ghost = F.explode(
        F.when(F.col("_eb") != F.col(TB_A), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    )
    x = r.select(*cols, TB_A, "_eb", ghost.alias("_ghost"))
    x = x.select(*cols, F.when(F.col("_ghost"), F.col("_eb")).otherwise(F.col(TB_A)).alias("_mb"), "_ghost")
    x = x.repartition(a, b, "_mb")

    w = Window.partitionBy(a, b, "_mb").orderBy(F.col(START_TIME).asc())
    follows = F.coalesce(F.lag(FINAL_END_TIME, 1).over(w) == F.col(START_TIME), F.lit(False))
    x = x.select("*", F.when(~F.col("_ghost") & ~follows, F.col(START_TIME)).alias("_head_here"))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.select("*", F.max("_head_here").over(running).alias("_local_head")).where(~F.col("_ghost"))

    per_bucket = x.groupBy(a, b, "_mb").agg(F.max("_local_head").alias("_bucket_head"))
    earlier = Window.partitionBy(a, b).orderBy("_mb").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(a, b, "_mb", F.max("_bucket_head").over(earlier).alias("_carry"))
    x = x.join(carry, on=[a, b, "_mb"], how="left")
    x = x.select(*cols, F.coalesce("_local_head", "_carry").alias("_island"))

    out = x.groupBy(a, b, "_island").agg(
        F.min(F.struct(START_TIME, *head_cols)).alias("_h"),
        F.max(F.struct(START_TIME, FINAL_END_TIME, FINAL_END_REASON)).alias("_tl"),
    )
    proj = {a: F.col(a), b: F.col(b), START_TIME: F.col("_h").getField(START_TIME),
            FINAL_END_TIME: F.col("_tl").getField(FINAL_END_TIME),
            FINAL_END_REASON: F.col("_tl").getField(FINAL_END_REASON)}
    proj.update({c: F.col("_h").getField(c) for c in head_cols})
    return out.select(*[proj[c].alias(c) for c in cols])


# ---------------------------------------------------------------------------
# The whole analysis
# ---------------------------------------------------------------------------

def prepared_rows(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """T2 and the start flag: the distinct prepared rows, written once.  Copies of an
    event change nothing (value sets ignore multiplicity and every stage drops
    duplicates), and the partial aggregate folds them before the only shuffle."""
    x = initialize(df, cfg)
    return write_once(x.withColumn(cfg.valid_col, start_flag(cfg)).distinct(), "prepared")


def chosen_ranges(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """T2-T8 fused: one row per valid start that has an end, with
    ``start_time``, ``final_end_time`` and ``final_end_reason`` (not yet
    merged).  The source is scanned once, to write the prepared rows; the hot-key
    jobs, the bucket edges and the main path read those.  Full-data exchanges: the
    distinct, then (a, bucket), (b, bucket, spread), (a, bucket)."""
    rows = prepared_rows(df, cfg)
    out_cols = rows.columns
    x, edges_a, edges_b = _with_buckets(rows, cfg)

    # Per-bucket first rows, aggregated map-side: only one row per (key, bucket)
    # and task crosses the network.
    firsts_a = _bucket_firsts(x, cfg, [cfg.a_col], cfg.b_col, TB_A)
    firsts_b = _firsts_b(x, cfg)

    x2 = _direction_b(_validate_both(x, cfg, edges_a, edges_b), cfg, firsts_b)
    x3 = _direction_a(x2.repartition(cfg.a_col, TB_A), cfg, firsts_a)

    chosen = F.least(F.col("_cand_a"), F.col("_cand_b"))
    return x3.select(
        *out_cols,
        F.col(cfg.time_col).alias(START_TIME),
        chosen.getField(END_TIME).alias(FINAL_END_TIME),
        chosen.getField(END_REASON_NAME).alias(FINAL_END_REASON),
    ).where(F.col(FINAL_END_TIME).isNotNull())


def unexpected_statuses(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Prepared rows whose status is neither START nor END (null passes, as
    in the original's precondition).  Empty for a well-formed input."""
    x = initialize(df, cfg)
    return x.where(~F.col(cfg.status_col).isin(START, END))


def _with_payload(ranges: DataFrame, df: DataFrame, cfg: MatchConfig, payload: Sequence[str]) -> DataFrame:
    """Late materialisation: the analysis ran without the payload; now each range takes
    that of one start row.  Start rows of a range are the prepared rows with a START
    status and its a, b and start time; of several the one whose payload sorts first
    is taken (columns in the given order, nulls first, maps by their JSON text).  The
    payload is folded in each task and shuffled once, by the ranges' key."""
    taken = {*cfg.declared_columns, *ranges.columns, *_HELPERS}
    bad = [c for c in payload if c in taken or c not in df.columns]
    if bad or len(set(payload)) < len(payload):
        raise ValueError(f"payload columns {bad or list(payload)} are missing, given twice, or names of the result")
    key = [cfg.a_col, cfg.b_col, START_TIME]
    rows = initialize(df.select(*map(quoted, [*cfg.declared_columns, *payload])), cfg, allow_extra=True).where(start_flag(cfg))
    starts = rows.select(quoted(cfg.a_col), quoted(cfg.b_col), quoted(cfg.time_col).alias(START_TIME), *map(quoted, payload))
    first = dedup_keep_first(starts, key, [])
    return ranges.join(first, key).select(*map(quoted, [*ranges.columns, *payload]))


def match_ranges(df: DataFrame, cfg: MatchConfig, checkpoint: bool = True, validate: bool = False, payload: Sequence[str] = ()) -> DataFrame:
    """Prepare -> validate starts -> end candidates -> choose -> merge.

    Output: the declared input columns (status as ordinal 1, time = start),
    the validity flag, ``start_time``, ``final_end_time`` and
    ``final_end_reason``.  Open ranges (no end found) are not output.  Row
    order is not defined; callers sort.  ``payload`` names further columns of ``df``
    that the result carries along (see :func:`_with_payload` for the row they are
    taken from); columns that are neither declared nor payload are an error.

    With ``checkpoint`` (default) the chosen ranges are written to the
    session's checkpoint folder (``spark.checkpoint.dir``) before the merge,
    which runs a job at call time.  ``validate`` first checks that no row has
    a status other than START or END after preparation (it cannot happen with
    the two update policies; it guards hand-made status maps).
    """
    if payload:
        names = [c for c in df.columns if c not in payload]
        return _with_payload(match_ranges(df.select(*map(quoted, names)), cfg, checkpoint, validate), df, cfg, payload)
    if validate:
        # Opt-in eager check (one job); the original always ran it.
        bad = unexpected_statuses(df, cfg).limit(1).count()
        if bad:
            raise ValueError("rows with a status other than START or END after preparation")
    ranges = chosen_ranges(df, cfg)
    if checkpoint:
        # The merge reads the ranges twice (rows and per-bucket summary); cut
        # the lineage here so the upstream stages run once, and so a lost
        # executor does not send the job back to the event scan.
        ensure_checkpoint_dir(ranges.sparkSession)
        ranges = ranges.checkpoint(eager=True)
    return _merge(ranges, cfg)


def next_event(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """The next row of each row by ``a`` in next-row order (time, END
    before START, b and others nulls last) as next_t, next_status, next_b --
    exact across time buckets."""
    cols = list(df.columns)
    x, _, _ = _with_buckets(df, cfg, b_side=False)
    firsts = _bucket_firsts(x, cfg, [cfg.a_col], cfg.b_col, TB_A)
    out = lead_across_buckets(
        x.repartition(cfg.a_col, TB_A), [cfg.a_col], TB_A, _order(cfg, cfg.b_col),
        [cfg.time_col, cfg.status_col, cfg.b_col], firsts, "next_",
    )
    return out.select(*cols, F.col("next_" + cfg.time_col).alias("next_t"),
                      F.col("next_" + cfg.status_col).alias("next_status"),
                      F.col("next_" + cfg.b_col).alias("next_b"))
