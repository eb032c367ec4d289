"""Reports from day summaries: what a day adds is aggregated once, when it is loaded, and merged for any window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.operators.churn import in_window
from snapwatch.operators.stats import stats_of_companies
from snapwatch.schema import SITES

SUMMARY = (
    "Crawl_Date date, Site string, Company string, rows bigint, jobs bigint, "
    "first struct<unique_id: string, Company_jobs: string>"
)


def summarise_days(postings: DataFrame) -> DataFrame:
    """One row per day, board and company (NULL is one): rows, rows with an id, and the posting with the smallest id."""
    return postings.groupBy("Crawl_Date", "Site", "Company").agg(
        F.count("*").alias("rows"), F.count("unique_id").alias("jobs"), F.min(F.struct("unique_id", "Company_jobs")).alias("first")
    )


def refresh_summaries(postings: DataFrame, days: Sequence[dt.date], path: str) -> None:
    """Make or repair the summaries of ``days`` from the table: their folders are replaced, no other one is touched.

    A day that has no postings any more keeps a row without them, so that its old summary goes. Run it for the days of
    every load; it reads those days only.
    """
    spark = postings.sparkSession
    made = summarise_days(postings.where(F.col("Crawl_Date").isin(list(days))))
    listed = F.explode(F.array(*(F.lit(d) for d in days))).alias("Crawl_Date")
    empty = spark.range(0, 1, 1, 1).select(
        listed, *(F.lit(None).cast("string").alias(c) for c in ("Site", "Company")), F.lit(0).cast("bigint").alias("rows"),
        F.lit(0).cast("bigint").alias("jobs"), F.expr("named_struct('unique_id', cast(null AS string), 'Company_jobs', cast(null AS string))").alias("first"),
    )
    rows = made.unionByName(empty).hint("rebalance", "Crawl_Date")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Crawl_Date").parquet(path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The summaries; day filters prune their folders."""
    return spark.read.schema(SUMMARY).parquet(path).where("rows > 0")


def company_window_of(summaries: DataFrame, as_of: dt.date, lookback_days: int = 2) -> DataFrame:
    """What ``churn.company_window`` gives for the same days, from their summaries."""
    today = F.col("Crawl_Date") == F.lit(as_of)
    before = F.col("Crawl_Date") == F.lit(as_of - dt.timedelta(days=1))
    total = lambda day: F.coalesce(F.sum(F.when(day, F.col("jobs"))), F.lit(0))
    return (
        summaries.where(in_window(as_of, max(lookback_days, 2)))
        .dropna(subset=["Site", "Company"])
        .groupBy("Site", "Company")
        .agg(
            total(today).alias("jobs_today"),
            total(before).alias("jobs_before"),
            F.bool_or(in_window(as_of, lookback_days) & ~today).alias("seen_before"),
            F.min(F.when(today, F.col("first"))).alias("first_today"),
            F.min(F.when(before, F.col("first"))).alias("first_before"),
        )
    )


def company_day_counts_of(summaries: DataFrame) -> DataFrame:
    """Postings per board, company and day, as ``churn.company_day_counts``: no aggregation is left."""
    named = summaries.dropna(subset=["Site", "Company", "Crawl_Date"])
    return named.select("Site", "Company", "Crawl_Date", F.col("jobs").alias("Num_Company_jobs"))


def snapshot_days_of(summaries: DataFrame) -> DataFrame:
    """Days of each company, as ``churn.snapshot_days``."""
    return company_day_counts_of(summaries).groupBy("Site", "Company").agg(F.count("*").alias("crawl_date_count"))


def daily_stats_of(summaries: DataFrame, as_of: dt.date, lookback_days: int = 2, sites: Sequence[str] = SITES) -> DataFrame:
    """The statistics of a day, as ``stats.daily_stats``, from the summaries of its window."""
    today = F.col("Crawl_Date") == F.lit(as_of)
    yesterday = F.col("Crawl_Date") == F.lit(as_of - dt.timedelta(days=1))
    companies = (
        summaries.where(in_window(as_of, max(lookback_days, 2)))
        .groupBy("Site", "Company")
        .agg(
            F.coalesce(F.sum(F.when(today, F.col("rows"))), F.lit(0)).alias("jobs"),
            F.bool_or(yesterday).alias("seen_yesterday"),
            F.bool_or(in_window(as_of, lookback_days) & ~today).alias("seen_before"),
        )
    )
    return stats_of_companies(companies, sites)
