"""Frames of the board exports and the change report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwatch.schema import COMBINED_EXPORT_SITES, POSTING_COLUMNS


def board_day(postings: DataFrame, site: str, as_of: dt.date) -> DataFrame:
    """All columns of one board on one day."""
    return postings.where((F.col("Site") == site) & (F.col("Crawl_Date") == F.lit(as_of))).select(*POSTING_COLUMNS)


def board_export(postings: DataFrame, site: str, as_of: dt.date) -> DataFrame:
    """One board on one day ordered by company, NULL first.

    The id breaks ties, so that a company with very many postings is split over sort ranges.
    """
    return board_day(postings, site, as_of).orderBy(F.col("Company").asc_nulls_first(), "unique_id")


def combined_export(exports: DataFrame, sites: Sequence[str] = COMBINED_EXPORT_SITES, as_of: dt.date | None = None) -> DataFrame:
    """Whole-row de-duplication of the listed boards, then board and company order with NULL last.

    With ``as_of`` the exports of that day alone, as a day's combined export holds them.
    """
    listed = exports.where(F.col("Site").isin(list(sites)))
    rows = (listed if as_of is None else listed.where(F.col("Crawl_Date") == F.lit(as_of))).dropDuplicates()
    return rows.orderBy("Site", F.col("Company").asc_nulls_last(), "unique_id")
