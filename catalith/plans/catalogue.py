"""All registered queries, importable in one place."""

from __future__ import annotations

from catalith.plans import (  # noqa: F401
    change_queries,
    consumer_queries,
    contract_queries,
    expression_queries,
    hierarchy_queries,
    key_queries,
    load_queries,
    placement_queries,
)
from catalith.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
