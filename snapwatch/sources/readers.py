"""Snapshot table, saved pages and written reports as DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapwatch.functions.dates import DATA_DAY
from snapwatch.operators.stats import rows_per_site
from snapwatch.schema import POSTING, POSTING_COLUMNS

# CSV with a header: quotes are doubled, and an empty text differs from NULL.
CSV = {"header": True, "escape": '"', "encoding": "utf-8", "nullValue": "\\N", "emptyValue": '""', "dateFormat": DATA_DAY}

# The sheets of a report.
NEW_SHEET, LEFT_SHEET = "New_Companies", "Companies_That_left"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot table: parquet below ``Crawl_Date=`` partitions. Day filters prune partitions."""
    return spark.read.schema(POSTING).parquet(path).select(*POSTING_COLUMNS)


FETCH_SIZE = 10_000


def jdbc_day_predicates(days: Sequence[dt.date], slices: int = 16) -> list[str]:
    """One WHERE text per read task: every day is cut into ``slices`` parts by a checksum of the id."""
    return [
        f"Crawl_Date = '{day:%d/%m/%Y}' AND MOD(CRC32(unique_id), {slices}) = {i}" for day in days for i in range(slices)
    ]


def read_jdbc(
    spark: SparkSession,
    url: str,
    days: Sequence[dt.date],
    properties: dict[str, str],
    table: str = "sites_datas",
    slices: int = 16,
) -> DataFrame:
    """The same table from a MySQL database: read in parallel, only the listed days, days as dates.

    Rows come through a cursor, FETCH_SIZE at a time, unless ``properties`` say otherwise: the driver would else hold
    a partition's whole result. Fixed value: the table's name.
    """
    properties = {"fetchsize": str(FETCH_SIZE), "useCursorFetch": "true", **properties}
    raw = spark.read.jdbc(url, table, predicates=jdbc_day_predicates(days, slices), properties=properties)
    return raw.withColumn("Crawl_Date", F.try_to_date("Crawl_Date", DATA_DAY)).select(*POSTING_COLUMNS)


def read_pages(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    """Saved pages as (page_id, url, html): a parquet table, or a folder with one HTML file per page."""
    if layout == "parquet":
        return spark.read.parquet(path).select("page_id", "url", "html")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    name = F.input_file_name()
    return files.select(name.alias("page_id"), name.alias("url"), F.col("value").alias("html"))


def read_bodies_text(spark: SparkSession, path: str) -> DataFrame:
    """API pages saved one body per line, as (page, body); the page number is the one in the file name."""
    lines = spark.read.text(path, recursiveFileLookup=True)
    number = F.regexp_extract(F.input_file_name(), r"([0-9]+)[^0-9/]*$", 1).try_cast("bigint")
    return lines.select(number.alias("page"), F.col("value").alias("body"))


def read_sheet(spark: SparkSession, report_path: str, sheet: str) -> DataFrame:
    """A sheet of a written change report."""
    return spark.read.parquet(f"{report_path}/{sheet}")


# Conditions of a sheet that is not there, has no files, is damaged or has other columns.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "UNRESOLVED_COLUMN")


def read_report_counts(spark: SparkSession, report_path: str, sites: Sequence[str]) -> list[DataFrame] | None:
    """(Site, new) and (Site, removed) of a written change report; None if a sheet is not there or can't be read."""
    counts = []
    for sheet, name in ((NEW_SHEET, "new"), (LEFT_SHEET, "removed")):
        try:
            # The sheet's files are opened here for their columns, so a damaged one is found now.
            counts.append(rows_per_site(read_sheet(spark, report_path, sheet).select("Site"), name, sites))
        except (PySparkException, Py4JJavaError) as error:
            if not any(f"[{condition}" in str(error) for condition in UNREADABLE):
                raise
            return None
    return counts


def read_board_export(spark: SparkSession, path: str, site: str | None = None) -> DataFrame:
    """Per-board exports, one board or all."""
    exports = spark.read.schema(POSTING).parquet(path)
    return (exports.where(F.col("Site") == site) if site else exports).select(*POSTING_COLUMNS)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV dataset as the writers make it; texts may hold line ends."""
    options = {**CSV, "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.schema(schema).csv(path, multiLine=True, **options)


def read_csv_export(spark: SparkSession, path: str) -> DataFrame:
    """A CSV export of all 13 columns; days are written as ``dd/MM/yyyy``."""
    return read_csv(spark, path, POSTING)
