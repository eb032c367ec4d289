"""Day-over-day churn of one board over a range of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.operators.grouping import literal_rows, running_total


def day_range(start: dt.date, end: dt.date | None, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """The range with its default end; a start after the end is refused before any plan exists."""
    end = end or as_of
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return start, end


def calendar(postings: DataFrame, start: dt.date, end: dt.date, name: str = "Crawl_Date") -> DataFrame:
    """Every day of the range, with or without data."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return postings.sparkSession.range(0, 1, 1, 1).select(F.explode(days).alias(name))


def _name(collation: str | None) -> Column:
    """Companies as they are told apart: by ``collation`` as a database would, exactly without one."""
    return F.collate("Company", collation) if collation else F.col("Company")


def company_days(postings: DataFrame, site: str, start: dt.date, end: dt.date, collation: str | None = None) -> DataFrame:
    """Distinct (Company, Crawl_Date) of one board, the baseline day before ``start`` included. NULL is a company.

    Of names that ``collation`` holds to be equal the smallest one is shown.
    """
    first = start - dt.timedelta(days=1)
    rows = postings.where((F.col("Site") == site) & F.col("Crawl_Date").between(F.lit(first), F.lit(end)))
    if collation is None:
        return rows.select("Company", "Crawl_Date").distinct()
    named = rows.groupBy(_name(collation).alias("_name"), "Crawl_Date").agg(F.min("Company").alias("Company"))
    return named.select("Company", "Crawl_Date")


def churn_range(postings: DataFrame, site: str, start: dt.date, end: dt.date, collation: str | None = None) -> DataFrame:
    """(Company, Report Date, change) with change ``new`` or ``removed`` against the calendar day before.

    Every row counts for its own day and as the baseline of the next one, so one scan and one
    exchange answer all days: no join, and NULL is a company like any other. A day without data
    makes every company removed on it and new on the next. Of names that ``collation`` holds to be equal the smallest
    one is shown.
    """
    start, end = day_range(start, end, end)
    roles = F.array(
        F.struct(F.col("Crawl_Date").alias("day"), F.lit(True).alias("present")),
        F.struct(F.date_add("Crawl_Date", 1).alias("day"), F.lit(False).alias("present")),
    )
    first = start - dt.timedelta(days=1)
    changed = (
        postings.where((F.col("Site") == site) & F.col("Crawl_Date").between(F.lit(first), F.lit(end)))
        .select("Company", F.explode(roles).alias("role"))
        .where(F.col("role.day").between(F.lit(start), F.lit(end)))
        .groupBy(_name(collation).alias("_name"), F.col("role.day").alias("Report Date"))
        .agg(
            F.bool_or("role.present").alias("now"),
            F.bool_and("role.present").alias("only_now"),
            *([F.min("Company").alias("Company")] if collation else []),
        )
        .where("only_now or not now")
    )
    shown = F.col("Company" if collation else "_name").alias("Company")
    return changed.select(shown, "Report Date", F.when(F.col("now"), "new").otherwise("removed").alias("change"))


def changes(churn: DataFrame, change: str) -> DataFrame:
    """One of the two dumps: (Company, Report Date)."""
    return churn.where(F.col("change") == change).select("Company", "Report Date")


def new_by_anti_join(pairs: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Companies of a day that the day before does not have, from ``company_days`` pairs."""
    today, before = pairs.alias("t"), pairs.alias("b")
    on = F.col("t.Company").eqNullSafe(F.col("b.Company")) & (F.col("t.Crawl_Date") == F.date_add("b.Crawl_Date", 1))
    gone = today.join(before, on, "left_anti")
    return gone.where(F.col("Crawl_Date").between(F.lit(start), F.lit(end))).select(
        "Company", F.col("Crawl_Date").alias("Report Date")
    )


def removed_by_anti_join(pairs: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Companies of the day before that a day does not have, from ``company_days`` pairs."""
    before, today = pairs.alias("b"), pairs.alias("t")
    on = F.col("t.Company").eqNullSafe(F.col("b.Company")) & (F.col("t.Crawl_Date") == F.date_add("b.Crawl_Date", 1))
    gone = before.join(today, on, "left_anti").select("Company", F.date_add("Crawl_Date", 1).alias("Report Date"))
    return gone.where(F.col("Report Date").between(F.lit(start), F.lit(end)))


def companies_per_day(postings: DataFrame, site: str, start: dt.date, end: dt.date) -> DataFrame:
    """Companies seen on each day from the baseline day on; NULL counts as one, a day without rows gives 0."""
    counts = company_days(postings, site, start, end).groupBy("Crawl_Date").agg(F.count("*").alias("n"))
    days = calendar(postings, start - dt.timedelta(days=1), end)
    # One row per day of the range.
    joined = days.join(F.broadcast(counts), "Crawl_Date", "left")
    return joined.select("Crawl_Date", F.coalesce("n", F.lit(0)).alias("companies"))


def changes_per_day(churn: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """New and removed companies per report day, zero-filled over the range."""
    counts = churn.groupBy("Report Date").agg(
        F.count_if(F.col("change") == "new").alias("new"), F.count_if(F.col("change") == "removed").alias("removed")
    )
    # One row per day of the range.
    joined = calendar(churn, start, end, "Report Date").join(F.broadcast(counts), "Report Date", "left")
    return joined.select("Report Date", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("new", "removed")))


def running_changes(per_day: DataFrame) -> DataFrame:
    """Adds the totals so far by report day."""
    indexed = per_day.withColumn("_day", F.unix_date("Report Date").cast("bigint"))
    return running_total(indexed, "_day", ["new", "removed"]).drop("_day")


def distinct_companies(churn: DataFrame) -> DataFrame:
    """Distinct companies of the whole dump per kind of change; NULL is a member."""
    members = churn.select("change", "Company").distinct().groupBy("change").agg(F.count("*").alias("n"))
    kinds = literal_rows(churn.sparkSession, "change", ["new", "removed"])
    # Two rows at most.
    return kinds.join(F.broadcast(members), "change", "left").select("change", F.coalesce("n", F.lit(0)).alias("companies"))
