"""Configuration of the match-range operator.

A ``MatchConfig`` names the columns that play each role in an event log and
the knobs of the analysis.  It is immutable: the fluent ``with_*`` methods
return a new config instead of mutating shared state.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from enum import Enum
from typing import Any, Mapping, Sequence


class Status(Enum):
    """Status ordinals.  Ordering matters: END sorts before START at equal
    time because the next-event order uses status descending."""

    # Fixed values (must equal the reference's ordinals).
    START = 1
    UPDATE = 2
    END = 3


class EndReason(Enum):
    """Why a match range ended.  The value is the preference ordinal used to
    break ties between candidate ends at the same time (lower wins)."""

    # Fixed values (must equal the reference's names and ordinals).
    NEXT_END_FOR_SAME_MATCH = 1
    NEXT_END_MATCH_BREAK = 2
    NEXT_END_NULL = 3
    NEXT_START_MATCH_BREAK = 4
    NEXT_START_SAME_MATCH = 5
    NEXT_START_MATCH_NULL = 6


class UpdatePolicy(Enum):
    """IGNORE drops UPDATE rows; ASSUME_START treats them as starts."""

    IGNORE = 1
    ASSUME_START = 2


class OptionalFilter(Enum):
    """Row filters a caller can switch on, applied in registration order."""

    IGNORE_UPDATES = "ignore_updates"
    NULL_A = "null_a"
    NULL_B_ON_START = "null_b_on_start"


# Output column names (fixed, not configurable).
START_TIME = "start_time"
FINAL_END_TIME = "final_end_time"
FINAL_END_REASON = "final_end_reason"
END_TIME = "end_time"
END_REASON_ORDINAL = "end_reason_ordinal"
END_REASON_NAME = "end_reason_name"


@dataclass(frozen=True)
class MatchConfig:
    """Column roles and options of the match-range analysis.

    ``status_names`` maps the user's status values to ``Status`` ordinals
    (e.g. ``{"start": 1, "update": 2, "end": 3}``).  ``other_matches`` are
    columns that must agree within a start point.  ``valid_col`` is the name
    of the start-validity flag written into the output.

    ``split_width`` controls how a key's timeline is cut into buckets so that
    a hot key is spread over many tasks; results do not depend on it.  It is
    in time units for numeric time, in days for dates and in hours for
    timestamps.  ``None`` picks 24 hours for timestamps, 30 days for dates
    and one bucket for numeric time.  On top of that, all keys with more than
    ``rows_per_bucket`` rows get their own, finer width
    (``rows_per_bucket=None`` switches this off).  If these are more than
    ``max_hot_keys``, the bound on rows is raised until they are not, so that
    no key above the bound is left whole and what is sent stays bounded.
    """

    a_col: str
    b_col: str
    time_col: str
    status_col: str
    status_names: Mapping[Any, int]
    other_matches: Sequence[str] = ()
    valid_col: str = "v"
    end_reasons: Sequence[EndReason] | None = None
    update_policy: UpdatePolicy = UpdatePolicy.IGNORE
    optional_filters: tuple[OptionalFilter, ...] = field(default=())
    split_width: float | None = None
    rows_per_bucket: int | None = 1_000_000
    max_hot_keys: int = 65_536

    def __post_init__(self) -> None:
        roles = [self.valid_col, self.a_col, self.b_col, self.time_col, self.status_col, *self.other_matches]
        if len(set(roles)) != len(roles):
            raise ValueError(f"column roles must be distinct, got {roles}")
        object.__setattr__(self, "other_matches", tuple(self.other_matches))
        object.__setattr__(self, "status_names", dict(self.status_names))
        bad = [v for v in self.status_names.values() if v not in {s.value for s in Status}]
        if bad:
            raise ValueError(f"status ordinals must be one of 1, 2, 3; got {bad}")
        if self.end_reasons is not None:
            reasons = tuple(self.end_reasons)
            for r in reasons:
                if not isinstance(r, EndReason):
                    raise ValueError(f"unsupported end reason {r!r}")
            object.__setattr__(self, "end_reasons", reasons)
        if self.split_width is not None and self.split_width <= 0:
            raise ValueError("split_width must be positive")
        if self.rows_per_bucket is not None and self.rows_per_bucket < 1:
            raise ValueError("rows_per_bucket must be at least 1")
        if self.max_hot_keys < 1:
            raise ValueError("max_hot_keys must be at least 1")

    # -- fluent, immutable builders -------------------------------------
    def with_filter(self, flt: OptionalFilter) -> "MatchConfig":
        return dataclasses.replace(self, optional_filters=self.optional_filters + (flt,))

    def filter_null_a(self) -> "MatchConfig":
        return self.with_filter(OptionalFilter.NULL_A)

    def filter_null_b_on_start(self) -> "MatchConfig":
        return self.with_filter(OptionalFilter.NULL_B_ON_START)

    def with_policy(self, policy: UpdatePolicy) -> "MatchConfig":
        return dataclasses.replace(self, update_policy=policy)

    def with_end_reasons(self, reasons: Sequence[EndReason]) -> "MatchConfig":
        return dataclasses.replace(self, end_reasons=tuple(reasons))

    def with_split_width(self, width: float | None) -> "MatchConfig":
        return dataclasses.replace(self, split_width=width)

    def with_hot_keys(self, rows_per_bucket: int | None, max_hot_keys: int = 65_536) -> "MatchConfig":
        return dataclasses.replace(self, rows_per_bucket=rows_per_bucket, max_hot_keys=max_hot_keys)

    # -- derived ----------------------------------------------------------
    @property
    def allowed_reasons(self) -> tuple[EndReason, ...]:
        return tuple(EndReason) if self.end_reasons is None else tuple(self.end_reasons)

    @property
    def filters_in_order(self) -> tuple[OptionalFilter, ...]:
        """The IGNORE policy registers its filter first, before any fluent one."""
        head = (OptionalFilter.IGNORE_UPDATES,) if self.update_policy is UpdatePolicy.IGNORE else ()
        return head + self.optional_filters

    @property
    def declared_columns(self) -> list[str]:
        return [self.a_col, self.b_col, self.status_col, self.time_col, *self.other_matches]
