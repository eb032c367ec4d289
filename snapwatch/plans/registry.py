"""Where queries and their SQL twins are registered."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2024, 1, 15)
START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 12)
BOARD = "click"
# The event types are the boards; the last one has no rows.
BOARDS = ("click", "error", "purchase", "signup", "view", "download")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; without ``sql`` only its rows are checked."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
