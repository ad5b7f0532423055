"""All registered queries and their SQL oracles."""

from __future__ import annotations

from . import match_queries, ops_queries

QUERIES = {**match_queries.QUERIES, **ops_queries.QUERIES}
ORACLE = {**match_queries.ORACLE, **ops_queries.ORACLE}

missing = sorted(set(ORACLE) - set(QUERIES))
assert not missing, f"oracle without query: {missing}"
