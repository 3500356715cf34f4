"""Every query over the bound entities, with its DuckDB counterpart."""

from __future__ import annotations

from tidemark.plans import base, check_queries, gold_queries, silver_queries  # noqa: F401  (they register themselves)


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict:
    return dict(base.ORACLES)
