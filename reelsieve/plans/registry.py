"""All queries of the library, by name, with their SQL twins."""

from __future__ import annotations

from reelsieve.plans import discovery_queries, extra_queries, identity_queries, media_queries, record_queries, report_queries, score_queries, series_queries  # noqa: F401  they register their queries
from reelsieve.plans.base import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
