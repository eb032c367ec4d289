"""Companies that are new or gone in the snapshot of one day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.operators.grouping import first_per_key, with_group_count
from snapwatch.schema import CHURN_COLUMNS, CONTACT_COLUMNS, REPORT_COLUMNS

_TRIPLE = ["Site", "Company", "Crawl_Date"]


def days_in(postings: DataFrame, days: list[dt.date]) -> DataFrame:
    return postings.where(F.col("Crawl_Date").isin(days))


def in_window(as_of: dt.date, n: int) -> Column:
    """The ``n`` days that end with ``as_of``. A range, so it prunes partitions and reaches a timestamp scan too."""
    return F.col("Crawl_Date").between(F.lit(as_of - dt.timedelta(days=n - 1)), F.lit(as_of))


def snapshot_window(postings: DataFrame, as_of: dt.date, lookback_days: int = 2) -> DataFrame:
    """The churn columns of the last ``lookback_days`` days, ``as_of`` included."""
    return postings.where(in_window(as_of, lookback_days)).select(*CHURN_COLUMNS)


def company_day_counts(postings: DataFrame) -> DataFrame:
    """Postings per board, company and day. Rows with a NULL key belong to no group."""
    return (
        postings.dropna(subset=_TRIPLE)
        .groupBy(*_TRIPLE)
        .agg(F.count("unique_id").alias("Num_Company_jobs"))
    )


def snapshot_days(postings: DataFrame) -> DataFrame:
    """Number of days on which each company of a board was seen."""
    return company_day_counts(postings).groupBy("Site", "Company").agg(F.count("*").alias("crawl_date_count"))


def company_window(postings: DataFrame, as_of: dt.date, lookback_days: int = 2) -> DataFrame:
    """One row per board and company of the window: what new, left and totals are read from.

    A single exchange with partial aggregates in front. ``jobs_today`` / ``jobs_before`` count the
    postings of ``as_of`` and of the day before; ``seen_before`` says whether any earlier day of the
    window has the company; ``first_today`` / ``first_before`` hold the posting with the smallest id.
    """
    today = F.col("Crawl_Date") == F.lit(as_of)
    before = F.col("Crawl_Date") == F.lit(as_of - dt.timedelta(days=1))
    first = F.struct("unique_id", "Company_jobs")
    return (
        postings.where(in_window(as_of, max(lookback_days, 2)))
        .select("Site", "Company", "Company_jobs", "Crawl_Date", "unique_id")
        .dropna(subset=["Site", "Company"])
        .groupBy("Site", "Company")
        .agg(
            F.count(F.when(today, F.col("unique_id"))).alias("jobs_today"),
            F.count(F.when(before, F.col("unique_id"))).alias("jobs_before"),
            F.bool_or(in_window(as_of, lookback_days) & ~today).alias("seen_before"),
            F.min(F.when(today, first)).alias("first_today"),
            F.min(F.when(before, first)).alias("first_before"),
        )
    )


def is_new() -> Column:
    """On rows of ``company_window``: seen on ``as_of`` and on no other day of the window."""
    return (F.col("jobs_today") > 0) & ~F.col("seen_before")


def is_left() -> Column:
    """On rows of ``company_window``: seen on the day before and not on ``as_of``."""
    return (F.col("jobs_before") > 0) & (F.col("jobs_today") == 0)


def new_report(companies: DataFrame) -> DataFrame:
    """The *new* rows of a ``company_window``, with the blank contact columns."""
    return (
        companies.where(is_new())
        .select("Site", "Company", F.col("first_today.Company_jobs"), F.col("jobs_today").alias("Num_Company_jobs"))
        .withColumns({c: F.lit("") for c in CONTACT_COLUMNS})
    )


def left_report(companies: DataFrame) -> DataFrame:
    """The *left* rows of a ``company_window``; the count is that of the day before."""
    return companies.where(is_left()).select(
        "Site", "Company", F.col("first_before.Company_jobs"), F.col("jobs_before").alias("Num_Company_jobs")
    )


def sort_report(report: DataFrame, order: str = "by_name") -> DataFrame:
    """Board, then company (NULL last); ``by_size`` puts large companies of a board first."""
    name = F.col("Company").asc_nulls_last()
    if order == "by_size":
        return report.orderBy("Site", F.col("Num_Company_jobs").desc(), name)
    return report.orderBy("Site", name)


def new_companies(postings: DataFrame, as_of: dt.date, lookback_days: int = 2, order: str = "by_name") -> DataFrame:
    """Companies whose only day in the look-back window is ``as_of``. A NULL company never counts."""
    return sort_report(new_report(company_window(postings, as_of, lookback_days)), order)


def left_companies(postings: DataFrame, as_of: dt.date, order: str = "by_name") -> DataFrame:
    """Companies of the day before ``as_of`` that are gone; always two days, however wide the scan."""
    return sort_report(left_report(company_window(postings, as_of, 2)), order)


def labelled_rows(postings: DataFrame, as_of: dt.date, lookback_days: int = 2) -> DataFrame:
    """The row-keeping form: counts on every row, one row per triple, days per company on each of them.

    Slower than ``company_window`` and used to check it.
    """
    counted = with_group_count(
        snapshot_window(postings, as_of, lookback_days), _TRIPLE, "unique_id", "Num_Company_jobs", "unique_id"
    )
    one_per_day = first_per_key(counted, _TRIPLE, ["unique_id"])
    return with_group_count(one_per_day, ["Site", "Company"], "unique_id", "crawl_date_count", "unique_id")


def new_companies_by_rows(postings: DataFrame, as_of: dt.date, lookback_days: int = 2) -> DataFrame:
    labelled = labelled_rows(postings, as_of, lookback_days)
    kept = labelled.where((F.col("crawl_date_count") == 1) & (F.col("Crawl_Date") == F.lit(as_of)))
    return kept.select(*REPORT_COLUMNS).withColumns({c: F.lit("") for c in CONTACT_COLUMNS})


def left_companies_by_rows(postings: DataFrame, as_of: dt.date) -> DataFrame:
    labelled = labelled_rows(postings, as_of, 2)
    yesterday = as_of - dt.timedelta(days=1)
    kept = labelled.where((F.col("crawl_date_count") == 1) & (F.col("Crawl_Date") == F.lit(yesterday)))
    return kept.select(*REPORT_COLUMNS)
