"""Input preparation for the match-range operator (status recode, filters,
update policy).  Everything here is a narrow Project/Filter: no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MatchConfig, OptionalFilter, Status, UpdatePolicy

START, UPDATE, END = Status.START.value, Status.UPDATE.value, Status.END.value


def check_columns(df: DataFrame, cfg: MatchConfig, allow_extra: bool = False) -> None:
    """Required roles must exist.  Columns the config does not declare are
    rejected: they would pass through and make duplicate start points."""
    have = set(df.columns)
    missing = [c for c in cfg.declared_columns if c not in have]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")
    if not allow_extra:
        extra = [c for c in df.columns if c not in set(cfg.declared_columns) | {cfg.valid_col}]
        if extra:
            raise ValueError(
                f"undeclared columns {extra}: list them in other_matches or join them back "
                f"on ({cfg.a_col}, {cfg.b_col}, start_time) after the analysis"
            )


def _check_status_type(df: DataFrame, cfg: MatchConfig) -> None:
    dtype = df.schema[cfg.status_col].dataType
    keys = list(cfg.status_names)
    if isinstance(dtype, T.StringType):
        ok = all(isinstance(k, str) for k in keys)
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        ok = all(isinstance(k, int) and not isinstance(k, bool) for k in keys)
    else:
        ok = True
    if not ok:
        raise ValueError(
            f"status column {cfg.status_col!r} is {dtype.simpleString()} but status names are {keys}; "
            "the key type must match the column type"
        )


def recode_status(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Map user status values to ordinals; unmapped values and null give null."""
    _check_status_type(df, cfg)
    s = F.col(cfg.status_col)
    expr: Column | None = None
    for name, ordinal in cfg.status_names.items():
        expr = (F.when(s == F.lit(name), F.lit(ordinal)) if expr is None
                else expr.when(s == F.lit(name), F.lit(ordinal)))
    recoded = (expr if expr is not None else F.lit(None)).cast("int")
    return df.withColumn(cfg.status_col, recoded)


def filter_null_time(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Drop rows with null time -- and, as in the original, null ``a``."""
    return df.where(F.col(cfg.a_col).isNotNull() & F.col(cfg.time_col).isNotNull())


def filter_both_null(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Drop rows where ``a`` and ``b`` are both null."""
    return df.where(F.col(cfg.a_col).isNotNull() | F.col(cfg.b_col).isNotNull())


def filter_ignore_updates(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Keep START and END rows only (IGNORE policy)."""
    return df.where(F.col(cfg.status_col).isin(START, END))


def filter_null_a(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """P5: drop rows with null ``a``."""
    return df.where(F.col(cfg.a_col).isNotNull())


def filter_null_b_on_start(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Drop START rows with null ``b`` (three-valued: null status with null b is dropped too)."""
    return df.where(F.col(cfg.b_col).isNotNull() | (F.col(cfg.status_col) != F.lit(START)))


_FILTERS = {
    OptionalFilter.IGNORE_UPDATES: filter_ignore_updates,
    OptionalFilter.NULL_A: filter_null_a,
    OptionalFilter.NULL_B_ON_START: filter_null_b_on_start,
}


def apply_optional_filters(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """The optional filters, in registration order (IGNORE policy first)."""
    return reduce(lambda acc, flt: _FILTERS[flt](acc, cfg), cfg.filters_in_order, df)


def assume_start(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """UPDATE rows become START rows."""
    s = F.col(cfg.status_col)
    return df.withColumn(cfg.status_col, F.when(s == F.lit(UPDATE), F.lit(START)).otherwise(s))


def initialize(df: DataFrame, cfg: MatchConfig, allow_extra: bool = False) -> DataFrame:
    """Column check, recode, mandatory filters, optional filters, update policy -- in that order."""
    check_columns(df, cfg, allow_extra=allow_extra)
    df = recode_status(df, cfg)
    df = filter_null_time(df, cfg)
    df = filter_both_null(df, cfg)
    df = apply_optional_filters(df, cfg)
    if cfg.update_policy is UpdatePolicy.ASSUME_START:
        df = assume_start(df, cfg)
    return df
