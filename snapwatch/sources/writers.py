"""Snapshot table, exports, reports and dumps as datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.operators.churn import company_window, left_report, new_report, sort_report
from snapwatch.operators.churn_range import changes, churn_range, day_range
from snapwatch.operators.exports import board_export, combined_export
from snapwatch.operators.ingest import as_postings, insert_unique
from snapwatch.operators.retention import LIVE_DAYS, expired_days
from snapwatch.sources.readers import CSV, LEFT_SHEET, NEW_SHEET, read_table

# The folder and dump names below.


def append_postings(rows: DataFrame, path: str, several_days: bool = True) -> None:
    """Append to the day partitions.

    With several days, ``rebalance`` gathers each day into few files and splits a day that is too large for one
    task. Rows of one day are written as they come, without another shuffle.
    """
    out = as_postings(rows)
    if several_days:
        out = out.hint("rebalance", "Crawl_Date")
    out.write.mode("append").partitionBy("Crawl_Date").parquet(path)


def load_unique(batch: DataFrame, path: str, order: Sequence[str | Column], days: Sequence[dt.date]) -> DataFrame:
    """Insert-unique ``batch`` into the table at ``path``; only the partitions of ``days`` are compared.

    Rows of other days would escape the comparison, so they raise. Returns the accepted rows as read back
    for those days. One writer per day: two at once could both accept a key.
    """
    spark = batch.sparkSession
    inside = F.col("Crawl_Date").isin(list(days))
    checked = batch.withColumn(
        "Crawl_Date",
        F.when(inside, F.col("Crawl_Date")).otherwise(F.raise_error(F.lit("batch has a day outside its days")).cast("date")),
    )
    try:
        stored = read_table(spark, path).where(inside)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = None  # the first load creates the table
    append_postings(insert_unique(checked, order, stored), path, several_days=len(days) > 1)
    return read_table(spark, path).where(inside)


def write_board_exports(accepted: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """Per-board daily exports with all 13 columns, below ``Crawl_Date=/Site=``.

    A board that holds most rows is split over several files by ``rebalance``. With ``order``, such as an arrival
    number, the rows of every file are in that order.
    """
    rows = accepted.hint("rebalance", "Crawl_Date", "Site").sortWithinPartitions("Crawl_Date", "Site", *order)
    # Spark sorts by folder before it writes, which keeps the order of equal rows, but it would first drop a sort that
    # stands right below its own.
    kept = as_postings(rows).select(F.inline(F.array(F.struct("*")))) if order else as_postings(rows)
    kept.write.mode("overwrite").partitionBy("Crawl_Date", "Site").parquet(path)


def rebuild_board_export(postings: DataFrame, site: str, as_of: dt.date, path: str) -> None:
    """CSV export of one board from the table; the part files in name order are the company order."""
    board_export(postings, site, as_of).write.mode("overwrite").csv(path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **CSV)


def write_combined_export(exports: DataFrame, path: str, as_of: dt.date | None = None) -> None:
    """De-duplicated, sorted boards of a day below ``Site=``, the board column last in the files' folder name."""
    combined_export(exports, as_of=as_of).write.mode("overwrite").partitionBy("Site").parquet(path)


def report_folder(root: str, as_of: dt.date) -> str:
    return f"{root.rstrip('/')}/{as_of:%Y_%m_%d}_Daily-Competitor-Client-Change"


def write_change_report(postings: DataFrame, as_of: dt.date, root: str, lookback_days: int = 2) -> str:
    """The two-sheet change report; both sheets come from one company frame. Returns its folder."""
    folder = report_folder(root, as_of)
    companies = company_window(postings, as_of, lookback_days).persist()
    try:
        sort_report(new_report(companies)).write.mode("overwrite").parquet(f"{folder}/{NEW_SHEET}")
        sort_report(left_report(companies)).write.mode("overwrite").parquet(f"{folder}/{LEFT_SHEET}")
    finally:
        companies.unpersist()
    return folder


def dump_prefix(start: dt.date, end: dt.date) -> str:
    return f"{start:%d-%m-%y}_to_{end:%d-%m-%y}"


def write_range_dump(
    postings: DataFrame, site: str, start: dt.date, end: dt.date | None, as_of: dt.date, root: str
) -> tuple[str, str]:
    """The two CSV dumps of a range, (Company, Report Date) with days as ``dd/MM/yyyy``. Returns their paths."""
    start, end = day_range(start, end, as_of)
    churn = churn_range(postings, site, start, end).persist()
    paths = []
    try:
        for change in ("new", "removed"):
            path = f"{root.rstrip('/')}/{dump_prefix(start, end)}_{change}_company_report_dump"
            changes(churn, change).write.mode("overwrite").csv(path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **CSV)
            paths.append(path)
    finally:
        churn.unpersist()
    return paths[0], paths[1]


def apply_retention(spark: SparkSession, path: str, as_of: dt.date, days: int = LIVE_DAYS) -> list[dt.date]:
    """Drop the day partitions outside the window and return their days.

    Only day values reach the driver, one per partition; nothing that is kept is read or rewritten.
    """
    gone = sorted(r[0] for r in expired_days(read_table(spark, path), as_of, days).collect())
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    for day in gone:
        folder = hadoop_path(f"{path.rstrip('/')}/Crawl_Date={day.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
