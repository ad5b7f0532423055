"""Start-point validation.

Per key, every match column must have at most one distinct non-null value.
The distinct-value set of the original is replaced by ``min``/``max`` over
the same window: |S| > 1 iff min != max, and |S| = 1 iff min = max (non-null).
That keeps the per-key state bounded and lets all columns share one Window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MatchConfig, Status

START = Status.START.value


def start_flag(cfg: MatchConfig) -> Column:
    """T3 flag: START with both ``a`` and ``b`` present."""
    return F.when(
        (F.col(cfg.status_col) == F.lit(START))
        & F.col(cfg.a_col).isNotNull()
        & F.col(cfg.b_col).isNotNull(),
        F.lit(True),
    ).otherwise(F.lit(False))


def reduce_and_validate(
    df: DataFrame,
    cfg: MatchConfig,
    key_cols: Sequence[str],
    match_cols: Sequence[str],
    split_cols: Sequence[str] = (),
    dedupe: bool = True,
    cut_ties: DataFrame | None = None,
) -> DataFrame:
    """T4: per key, invalidate START rows whose match columns disagree, fill
    the single agreed value into the others, then drop duplicate rows.

    Columns are taken in list order; a START that fails on one column keeps
    the fills of the columns before it.  The value sets are computed over all
    rows of the key, whatever their status or validity.  ``split_cols`` are
    extra partition columns that are functions of the key (e.g. a time
    bucket); they refine the partitioning without changing the groups.
    ``dedupe=False`` skips the final distinct where the caller knows it
    cannot find duplicates.  Where ``split_cols`` cut through groups, ``cut_ties``
    (see :func:`tie_sets`) holds the value sets of those groups, keyed by
    ``split_cols`` and ``key_cols``; the few rows are joined to the split rows, so a
    group that holds much of the data is never gathered.
    """
    overlap = set(key_cols) & set(match_cols) | ({cfg.valid_col} & (set(key_cols) | set(match_cols)))
    if overlap:
        raise ValueError(f"key and match columns overlap: {sorted(overlap)}")
    missing = [c for c in [*key_cols, *match_cols, cfg.valid_col] if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in the frame {df.columns}")

    w = Window.partitionBy(*split_cols, *key_cols)
    lo = {c: F.min(c).over(w) for c in match_cols}
    hi = {c: F.max(c).over(w) for c in match_cols}
    lo_names = {c: f"_lo_{i}" for i, c in enumerate(match_cols)}
    hi_names = {c: f"_hi_{i}" for i, c in enumerate(match_cols)}
    base = df.columns
    staged = df.select(
        "*",
        *[lo[c].alias(lo_names[c]) for c in match_cols],
        *[hi[c].alias(hi_names[c]) for c in match_cols],
    )

    if cut_ties is not None:
        staged = staged.join(cut_ties, [*split_cols, *key_cols], "left")
        seen = F.col("_cut").isNotNull()
        whole = {f"{side}{i}": F.when(seen, F.col(f"_cut.{i}{side}")).otherwise(F.col(f"{side}{i}")).alias(f"{side}{i}")
                 for i in range(len(match_cols)) for side in ("_lo_", "_hi_")}
        staged = staged.select(*base, *whole.values())

    valid_start = (F.col(cfg.status_col) == F.lit(START)) & (F.col(cfg.valid_col) == F.lit(True))
    prefix_ok: Column = F.lit(True)
    new_cols: dict[str, Column] = {}
    for c in match_cols:
        lo_c, hi_c = F.col(lo_names[c]), F.col(hi_names[c])
        at_most_one = F.coalesce(lo_c == hi_c, F.lit(True))
        prefix_ok = prefix_ok & at_most_one
        new_cols[c] = F.when(valid_start & prefix_ok & lo_c.isNotNull(), lo_c).otherwise(F.col(c)).alias(c)
    new_cols[cfg.valid_col] = (
        F.when(valid_start & ~prefix_ok, F.lit(False)).otherwise(F.col(cfg.valid_col)).alias(cfg.valid_col)
    )
    out = staged.select(*[new_cols.get(c, F.col(c)) for c in base])
    return out.distinct() if dedupe else out


def tie_sets(df: DataFrame, key_cols: Sequence[str], match_cols: Sequence[str], first: str, last: str, bucket: str) -> DataFrame:
    """The value sets (``_cut``: least and largest of every match column) of the groups
    that buckets cut, that is whose ``first`` and ``last`` bucket differ, once for each
    of their buckets.  A partial aggregate: a tie of any size costs a row a task."""
    sets = [x for i, c in enumerate(match_cols) for x in (F.min(c).alias(f"{i}_lo_"), F.max(c).alias(f"{i}_hi_"))]
    rows = df.where(F.col(first) < F.col(last)).groupBy(*key_cols, first, last).agg(*sets)
    names = [f"{i}{side}" for i in range(len(match_cols)) for side in ("_lo_", "_hi_")]
    return rows.select(*key_cols, F.explode(F.sequence(first, last)).alias(bucket), F.struct(*names).alias("_cut"))
