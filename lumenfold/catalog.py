"""All queries of the engine and their DuckDB equivalents."""

from __future__ import annotations

from lumenfold.plans import clustering, evaluation, joins, raster, refinement, shaping, state, text, votes  # noqa: F401
from lumenfold.plans.registry import QUERIES, SQL, Query

FLAGSHIP = "a4_weighted_vote"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
