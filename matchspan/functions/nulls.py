"""Null handling."""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame


def drop_null_rows(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any (or all) null in ``subset``."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Per-column replacement of nulls."""
    return df.na.fill(dict(values))


def replace_values(df: DataFrame, old: Any, new: Any, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace a value in every type-compatible column (numeric values
    leave string columns untouched)."""
    return df.na.replace(old, new, subset=list(subset) if subset else None)
