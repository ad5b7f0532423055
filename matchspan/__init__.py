"""matchspan: match-range analysis of event logs, and the DataFrame
operations around it, as Spark jobs."""

from .config import EndReason, MatchConfig, OptionalFilter, Status, UpdatePolicy
from .operators.ranges import (
    choose_final_end,
    connect_ranges,
    end_candidates,
    mark_valid_starts,
    match_ranges,
    next_event,
)

__all__ = [
    "EndReason", "MatchConfig", "OptionalFilter", "Status", "UpdatePolicy",
    "choose_final_end", "connect_ranges", "end_candidates", "mark_valid_starts",
    "match_ranges", "next_event",
]
