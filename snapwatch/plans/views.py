"""Posting-shaped views over the given tables, as DataFrames and as the same SQL for the twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- One posting per event; the company is missing for some users. ----


def postings_of(events: DataFrame) -> DataFrame:
    day = F.to_date("ts")
    user = F.col("user_id").cast("string")
    event = F.col("event_id").cast("string")
    return events.select(
        F.col("event_type").alias("Site"),
        F.when(F.col("user_id") % 11 != 0, F.concat(F.lit("c"), user)).alias("Company"),
        F.concat(F.lit("https://example.org/co/"), user).alias("Company_jobs"),
        event.alias("Job_id"),
        F.concat(F.lit("Job "), F.col("props")).alias("Job_title"),
        F.concat(F.col("props"), F.lit("\n"), F.lit("by "), user).alias("Job_Description"),
        F.date_format(F.date_sub(day, (F.col("user_id") % 40).cast("int")), "dd/MM/yyyy").alias("Job_Post_Date"),
        F.concat(F.lit("https://example.org/job/"), event).alias("Job_URL"),
        F.concat(F.lit("area "), (F.col("user_id") % 9).cast("string")).alias("Country_Areas"),
        F.lit("").alias("Job_categories"),
        F.lit("").alias("AllJobs_Job_class"),
        day.alias("Crawl_Date"),
        F.concat_ws("_", "event_type", "event_id").alias("unique_id"),
    )


def v_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings_of(table(spark, sf_dir, "events"))


V_POST = """
v_post AS (
  SELECT event_type AS "Site",
         CASE WHEN user_id % 11 <> 0 THEN 'c' || user_id END AS "Company",
         'https://example.org/co/' || user_id AS "Company_jobs",
         CAST(event_id AS VARCHAR) AS "Job_id",
         'Job ' || props AS "Job_title",
         props || chr(10) || 'by ' || user_id AS "Job_Description",
         strftime(CAST(ts AS DATE) - CAST(user_id % 40 AS INTEGER), '%d/%m/%Y') AS "Job_Post_Date",
         'https://example.org/job/' || event_id AS "Job_URL",
         'area ' || (user_id % 9) AS "Country_Areas",
         '' AS "Job_categories",
         '' AS "AllJobs_Job_class",
         CAST(ts AS DATE) AS "Crawl_Date",
         event_type || '_' || event_id AS "unique_id"
  FROM events)
"""

# ---- Arrivals: the id is the user's, so a user with several events on a board and day arrives again. ----


def v_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_arrival(table(spark, sf_dir, "events"))


def with_arrival(events: DataFrame) -> DataFrame:
    """(Site, Company, Crawl_Date, unique_id, arrival, ingest_ts); works on a stream too."""
    user = F.col("user_id").cast("string")
    return events.select(
        F.col("event_type").alias("Site"),
        F.when(F.col("user_id") % 11 != 0, F.concat(F.lit("c"), user)).alias("Company"),
        F.to_date("ts").alias("Crawl_Date"),
        F.concat_ws("_", F.col("event_type"), user).alias("unique_id"),
        F.col("event_id").alias("arrival"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
    )


ARRIVAL_COLUMNS = ("Site", "Company", "Crawl_Date", "unique_id", "arrival")

V_ARRIVALS = """
v_arrivals AS (
  SELECT event_type AS "Site",
         CASE WHEN user_id % 11 <> 0 THEN 'c' || user_id END AS "Company",
         CAST(ts AS DATE) AS "Crawl_Date",
         event_type || '_' || user_id AS "unique_id",
         event_id AS "arrival",
         ts AS "ingest_ts"
  FROM events),
accepted AS (
  SELECT "Site", "Company", "Crawl_Date", "unique_id", "arrival" FROM v_arrivals
  QUALIFY row_number() OVER (PARTITION BY "Crawl_Date", "unique_id" ORDER BY "arrival") = 1)
"""

# ---- Postings by page and region. ----


def v_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paged_of(table(spark, sf_dir, "events"))


def paged_of(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        *more,
        F.col("event_type").alias("Site"),
        F.floor(F.col("event_id") / 20).alias("page"),
        F.concat_ws("_", F.col("user_id") % 7, F.dayofmonth("ts")).alias("location_id"),
        F.concat_ws("_", "event_type", "event_id").alias("unique_id"),
    )


V_PAGED = """
v_paged AS (
  SELECT event_type AS "Site", event_id // 20 AS page,
         (user_id % 7) || '_' || day(ts) AS location_id,
         event_type || '_' || event_id AS unique_id
  FROM events)
"""

# ---- Relative date texts. ----


def v_reldate(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, shape = F.col("user_id").cast("string"), F.col("event_id") % 8
    text = (
        F.when(shape == 0, F.concat(F.lit("לפני "), user, F.lit(" ימים")))
        .when(shape == 1, F.concat(F.lit("לפני "), user, F.lit(" שעות")))
        .when(shape == 2, "לפני דקה")
        .when(shape == 3, F.date_format("ts", "dd/MM/yyyy"))
        .when(shape == 4, F.concat(F.lit("לפני "), user, F.lit(" יְוֹם 3 שעות")))
        .when(shape == 5, F.concat(F.lit("לפני 999999"), user, F.lit(" ימים")))
        .when(shape == 6, F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("txt"))


V_RELDATE = """
v_reldate AS (
  SELECT event_id, user_id, CASE event_id % 8
           WHEN 0 THEN 'לפני ' || user_id || ' ימים' WHEN 1 THEN 'לפני ' || user_id || ' שעות'
           WHEN 2 THEN 'לפני דקה' WHEN 3 THEN strftime(ts, '%d/%m/%Y')
           WHEN 4 THEN 'לפני ' || user_id || ' יְוֹם 3 שעות' WHEN 5 THEN 'לפני 999999' || user_id || ' ימים'
           WHEN 6 THEN event_type END AS txt
  FROM events)
"""


def reldate_sql(fallback: str, last_token: bool = False) -> str:
    """The expected texts straight from the view's own numbers; ``fallback`` is for texts without a usable number."""
    value = f"""
      CASE event_id % 8
        WHEN 0 THEN CASE WHEN user_id = 0 THEN txt ELSE strftime(DATE '2024-01-15' - CAST(user_id AS INTEGER), '%d/%m/%Y') END
        WHEN 1 THEN CASE WHEN user_id = 0 THEN txt ELSE '15/01/2024' END
        WHEN 2 THEN '15/01/2024' WHEN 3 THEN txt
        WHEN 4 THEN CASE WHEN user_id = 0 THEN txt ELSE strftime(DATE '2024-01-15' - CAST(user_id AS INTEGER), '%d/%m/%Y') END
        ELSE {fallback} END"""
    return f"split_part({value}, ' ', -1)" if last_token else value


# ---- Manifest of dated artifacts. ----


def v_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 4
    name = (
        F.when(kind == 0, F.concat(F.date_format("ts", "yyyy_MM_dd"), F.lit("_"), F.initcap("event_type"), F.lit(".xlsx")))
        .when(kind == 1, F.concat(F.lit("scrapy_log_output_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".txt")))
        .when(kind == 2, F.concat(F.date_format("ts", "yyyy_MM_dd"), F.lit("_Daily.xlsx")))
        .otherwise(F.concat(F.col("event_type"), F.lit("-notes.txt")))
    )
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"))


V_MANIFEST = """
v_manifest AS (
  SELECT event_id, CASE event_id % 4
           WHEN 0 THEN strftime(ts, '%Y_%m_%d') || '_' || upper(event_type[1]) || event_type[2:] || '.xlsx'
           WHEN 1 THEN 'scrapy_log_output_' || strftime(ts, '%Y-%m-%d') || '.txt'
           WHEN 2 THEN strftime(ts, '%Y_%m_%d') || '_Daily.xlsx'
           ELSE event_type || '-notes.txt' END AS name
  FROM events)
"""
