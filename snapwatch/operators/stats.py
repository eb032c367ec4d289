"""Zero-filled statistics per board."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.operators.churn import in_window
from snapwatch.operators.grouping import literal_rows
from snapwatch.schema import SITES

METRICS = ("new", "removed", "total_jobs", "total_companies")


def fill_sites(counts: DataFrame, sites: Sequence[str] = SITES) -> DataFrame:
    """One row per board of the fixed list; a board without counts gets zeros, other boards go."""
    boards = literal_rows(counts.sparkSession, "Site", sites)
    names = [c for c in counts.columns if c != "Site"]
    # At most one row per board of the list.
    listed = F.broadcast(counts.where(F.col("Site").isin(list(sites))))
    return boards.join(listed, "Site", "left").select("Site", *(F.coalesce(c, F.lit(0)).alias(c) for c in names))


def rows_per_site(df: DataFrame, name: str, sites: Sequence[str] | None = None) -> DataFrame:
    counts = df.groupBy("Site").agg(F.count("*").alias(name))
    return fill_sites(counts, sites) if sites else counts


def total_jobs(postings: DataFrame, as_of: dt.date, sites: Sequence[str] = SITES) -> DataFrame:
    """Rows per board on one day."""
    return rows_per_site(postings.where(F.col("Crawl_Date") == F.lit(as_of)), "total_jobs", sites)


def total_companies(
    postings: DataFrame, as_of: dt.date, sites: Sequence[str] = SITES, collation: str | None = None
) -> DataFrame:
    """Distinct companies per board on one day, NULL not counted.

    ``collation`` compares names as a database would, e.g. ``UNICODE_CI_AI_RTRIM``; exact by default.
    """
    company: Column = F.collate("Company", collation) if collation else F.col("Company")
    day = postings.where(F.col("Crawl_Date") == F.lit(as_of))
    return fill_sites(day.groupBy("Site").agg(F.count_distinct(company).alias("total_companies")), sites)


def daily_stats(
    postings: DataFrame, as_of: dt.date, lookback_days: int = 2, sites: Sequence[str] = SITES
) -> DataFrame:
    """(Site, new, removed, total_jobs, total_companies), all from one scan.

    One exchange on (Site, Company) behind partial aggregates, then one on the few boards.
    """
    today = F.col("Crawl_Date") == F.lit(as_of)
    yesterday = F.col("Crawl_Date") == F.lit(as_of - dt.timedelta(days=1))
    earlier = in_window(as_of, lookback_days) & ~today
    companies = (
        postings.where(in_window(as_of, max(lookback_days, 2)))
        .groupBy("Site", "Company")
        .agg(
            F.count_if(today).alias("jobs"),
            F.bool_or(yesterday).alias("seen_yesterday"),
            F.bool_or(earlier).alias("seen_before"),
        )
    )
    return stats_of_companies(companies, sites)


def stats_of_companies(companies: DataFrame, sites: Sequence[str]) -> DataFrame:
    """The statistics from a row per board and company: rows of the day, whether seen the day before and earlier."""
    named, present = F.col("Company").isNotNull(), F.col("jobs") > 0
    per_site = companies.groupBy("Site").agg(
        F.count_if(named & present & ~F.col("seen_before")).alias("new"),
        F.count_if(named & ~present & F.col("seen_yesterday")).alias("removed"),
        F.sum("jobs").alias("total_jobs"),
        F.count_if(named & present).alias("total_companies"),
    )
    return fill_sites(per_site, sites)


def merge_stats(totals: Sequence[DataFrame], reports: Sequence[DataFrame] | None) -> DataFrame:
    """Merge frames of (Site, one metric) into one row per board; unreadable reports leave only the totals."""
    frames = [*(reports or []), *totals]
    named = [next(c for c in f.columns if c != "Site") for f in frames]
    merged = None
    for frame, name in zip(frames, named):
        part = frame.select("Site", F.lit(name).alias("metric"), F.col(name).cast("bigint").alias("n"))
        merged = part if merged is None else merged.unionByName(part)
    return merged.groupBy("Site").pivot("metric", named).agg(F.first("n"))


def stats_as_map(stats: DataFrame) -> DataFrame:
    """The map form: metric to (board to count)."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("n")) for m in METRICS)))
    tall = stats.select("Site", pairs.alias("p")).select("Site", "p.*")
    # One entry per board of the fixed list.
    return tall.groupBy("metric").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("Site", "n")))).alias("by_site")
    )


def completeness_gate(stats: DataFrame) -> DataFrame:
    """One row: whether every board has postings, and the boards without."""
    return stats.agg(
        F.bool_and(F.col("total_jobs") > 0).alias("complete"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("total_jobs") == 0, F.col("Site")))), ",").alias("missing"),
    )
