"""Registered queries over the given tables, each with its SQL twin."""

from __future__ import annotations


def all_queries():
    """(queries, SQL twins), both by name."""
    from snapwatch.plans import (  # noqa: F401
        churn_queries,
        extract_queries,
        registry,
        scalar_queries,
        stream_queries,
        table_queries,
    )

    return dict(registry.QUERIES), dict(registry.ORACLES)
