"""Sliding-window retention of table rows and dated artifacts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwatch.functions.dates import artifact_day, last_days
from snapwatch.operators.churn import in_window

LIVE_DAYS = 30
MANUAL_DAYS = 70
ARTIFACT_DAYS = 10


def _kept(as_of: dt.date, days: int):
    # As in SQL, a row without a day is not deleted by NOT IN.
    return in_window(as_of, days) | F.col("Crawl_Date").isNull()


def retained(postings: DataFrame, as_of: dt.date, days: int = LIVE_DAYS) -> DataFrame:
    """Rows that stay: the last ``days`` days counting ``as_of``. Later days go too."""
    return postings.where(_kept(as_of, days))


def deleted(postings: DataFrame, as_of: dt.date, days: int = LIVE_DAYS) -> DataFrame:
    return postings.where(~_kept(as_of, days))


def expired_days(postings: DataFrame, as_of: dt.date, days: int = LIVE_DAYS) -> DataFrame:
    """Day partitions to drop."""
    return deleted(postings, as_of, days).select("Crawl_Date").distinct()


def expired_artifacts(manifest: DataFrame, as_of: dt.date, name: str = "name", days: int = ARTIFACT_DAYS) -> DataFrame:
    """Manifest rows whose date text is none of the last ``days`` days; names without a date expire."""
    keep = [d.strftime("%Y_%m_%d") for d in last_days(as_of, days)]
    return manifest.where(~F.coalesce(artifact_day(F.col(name)).isin(keep), F.lit(False)))
