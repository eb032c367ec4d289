"""Scans, loads, exports, retention, projections and predicates over the snapshot table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.functions.dates import artifact_day
from snapwatch.operators.churn import days_in, snapshot_window
from snapwatch.operators.churn_range import company_days, day_range
from snapwatch.operators.digests import distinct_rows, rows_once
from snapwatch.operators.exports import board_export, combined_export
from snapwatch.operators.grouping import first_per_key, once_only, rows_by_key
from snapwatch.operators.ingest import (
    as_postings,
    count_arrivals,
    insert_unique,
    not_stored,
    rejected_per_site,
    stamp,
)
from snapwatch.operators.retention import LIVE_DAYS, MANUAL_DAYS, deleted, expired_artifacts, expired_days, retained
from snapwatch.operators.stats import daily_stats, rows_per_site
from snapwatch.plans.registry import AS_OF, BOARD, BOARDS, END, START, query
from snapwatch.plans.views import (
    ARRIVAL_COLUMNS,
    V_ARRIVALS,
    V_MANIFEST,
    V_POST,
    table,
    v_arrivals,
    v_manifest,
    v_post,
)
from snapwatch.schema import CHURN_COLUMNS, CONTACT_COLUMNS, POSTING_COLUMNS, REPORT_COLUMNS, numeric_job_id
from snapwatch.session import work_dir
from snapwatch.sources import readers, writers

SIX = '"Site", "Company", "Company_jobs", "Crawl_Date", "Job_Post_Date", "unique_id"'
ALL = ", ".join(f'"{c}"' for c in POSTING_COLUMNS)
DAY = "DATE '2024-01-15'"
BOARD_LIST = "(VALUES " + ", ".join(f"('{b}')" for b in BOARDS) + ') AS boards("Site")'


def _post(select: str) -> str:
    return f"WITH {V_POST} {select}"


# ---- Scans ----


@query(
    "src1_snapshot_scan_2d",
    _post(f"""SELECT {SIX} FROM v_post WHERE "Crawl_Date" BETWEEN {DAY} - 1 AND {DAY}"""),
)
def snapshot_scan_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_window(v_post(spark, sf_dir), AS_OF, 2)


@query(
    "src2_snapshot_scan_8d",
    _post(f"""SELECT {SIX} FROM v_post WHERE "Crawl_Date" BETWEEN {DAY} - 7 AND {DAY}"""),
)
def snapshot_scan_8d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_window(v_post(spark, sf_dir), AS_OF, 8)


@query(
    "src3_board_day_by_company",
    _post(f"""SELECT {ALL} FROM v_post WHERE "Site" = 'click' AND "Crawl_Date" = {DAY} ORDER BY "Company" """),
)
def board_day_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_export(v_post(spark, sf_dir), BOARD, AS_OF)


@query(
    "src4_company_days",
    _post("""SELECT DISTINCT "Company", "Crawl_Date" FROM v_post
             WHERE "Site" = 'click' AND "Crawl_Date" BETWEEN DATE '2024-01-04' AND DATE '2024-01-12'"""),
)
def company_days_of_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_days(v_post(spark, sf_dir), BOARD, START, END)


@query(
    "src5_board_counts",
    _post(f"""SELECT b."Site", count(p."Site") AS total_jobs, count(DISTINCT p."Company") AS total_companies
              FROM {BOARD_LIST.replace("boards", "b")} LEFT JOIN v_post p
                ON p."Site" = b."Site" AND p."Crawl_Date" = {DAY} GROUP BY b."Site" """),
)
def board_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_stats(v_post(spark, sf_dir), AS_OF, sites=BOARDS).select("Site", "total_jobs", "total_companies")


@query("src8_saved_pages", "SELECT page_id, url, length(html) AS chars, md5(html) AS digest FROM pages")
def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = readers.read_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select(
        "page_id", "url", F.length("html").cast("bigint").alias("chars"), F.md5("html").alias("digest")
    )


def _report_sql(which: str) -> str:
    days = f"""d AS (SELECT "Site", "Company", "Crawl_Date", count(*) AS n, arg_min("Company_jobs", "unique_id") AS jobs
                FROM v_post WHERE "Company" IS NOT NULL AND "Crawl_Date" BETWEEN {DAY} - 1 AND {DAY} GROUP BY ALL),
         c AS (SELECT "Site", "Company", max("Crawl_Date") AS day, max(n) AS n, max(jobs) AS jobs
                FROM d GROUP BY ALL HAVING count(*) = 1)"""
    day = DAY if which == "new" else f"{DAY} - 1"
    return f"""{V_POST}, {days} SELECT "Site", "Company", jobs AS "Company_jobs", n AS "Num_Company_jobs"
               FROM c WHERE day = {day}"""


@query(
    "src9_report_sheets_counted",
    f"""WITH n AS (SELECT "Site", count(*) AS new FROM (WITH {_report_sql("new")}) GROUP BY 1),
             r AS (SELECT "Site", count(*) AS removed FROM (WITH {_report_sql("left")}) GROUP BY 1)
        SELECT "Site", coalesce(new, 0) AS new, coalesce(removed, 0) AS removed
        FROM {BOARD_LIST} LEFT JOIN n USING ("Site") LEFT JOIN r USING ("Site")""",
)
def report_sheets_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = writers.write_change_report(v_post(spark, sf_dir), AS_OF, work_dir(spark, "report"))
    new = rows_per_site(readers.read_sheet(spark, folder, writers.NEW_SHEET), "new", BOARDS)
    removed = rows_per_site(readers.read_sheet(spark, folder, writers.LEFT_SHEET), "removed", BOARDS)
    return new.join(F.broadcast(removed), "Site")  # one row per board


@query("src10_board_exports_read_back", _post(f"SELECT {ALL} FROM v_post"))
def board_exports_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "exports")
    writers.write_board_exports(v_post(spark, sf_dir), path)
    return readers.read_board_export(spark, path)


# ---- Loads and exports ----


def _arrivals(select: str) -> str:
    return f"WITH {V_ARRIVALS} {select}"


_ACCEPTED = 'SELECT "Site", "Company", "Crawl_Date", "unique_id", "arrival" FROM accepted'


@query("snk1_accepted", _arrivals(_ACCEPTED))
def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insert_unique(v_arrivals(spark, sf_dir).select(*ARRIVAL_COLUMNS), ["arrival"])


def _morning_and_rest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = v_arrivals(spark, sf_dir)
    early = F.hour("ingest_ts") < 12
    return rows.where(early).select(*ARRIVAL_COLUMNS), rows.where(~early).select(*ARRIVAL_COLUMNS)


_MORNING = """, stored AS (
  SELECT * FROM v_arrivals WHERE hour("ingest_ts") < 12
  QUALIFY row_number() OVER (PARTITION BY "Crawl_Date", "unique_id" ORDER BY "arrival") = 1)"""


@query(
    "snk1_accepted_into_stored",
    f"""WITH {V_ARRIVALS}{_MORNING}
        SELECT "Site", "Company", "Crawl_Date", "unique_id", "arrival" FROM v_arrivals a
        WHERE hour("ingest_ts") >= 12 AND NOT EXISTS (SELECT 1 FROM stored s
              WHERE s."Crawl_Date" = a."Crawl_Date" AND s."unique_id" = a."unique_id")
        QUALIFY row_number() OVER (PARTITION BY "Crawl_Date", "unique_id" ORDER BY "arrival") = 1""",
)
def accepted_into_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    morning, rest = _morning_and_rest(spark, sf_dir)
    return insert_unique(rest, ["arrival"], stored=insert_unique(morning, ["arrival"]))


@query(
    "snk1_table_after_two_loads",
    f"""WITH {V_ARRIVALS}, p AS (SELECT {ALL} FROM (WITH {V_POST} SELECT * FROM v_post))
        SELECT {ALL} FROM p""",
)
def table_after_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings that come twice in a batch, in two such batches: every one is stored once."""
    path, once = work_dir(spark, "table"), v_post(spark, sf_dir)
    postings = once.unionByName(once)
    # One value per day partition.
    days = [r[0] for r in postings.select("Crawl_Date").distinct().collect()]
    writers.load_unique(postings, path, ["unique_id"], days)
    return writers.load_unique(postings, path, ["unique_id"], days)


@query("snk2_board_exports", _post(f"SELECT {ALL} FROM v_post"))
def board_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "exports")
    writers.write_board_exports(insert_unique(v_post(spark, sf_dir), ["Job_id"]), path, ["Job_id"])
    return readers.read_board_export(spark, path)


@query(
    "snk3_rebuilt_board_export",
    _post(f"""SELECT {ALL} FROM v_post WHERE "Site" = 'click' AND "Crawl_Date" = {DAY}"""),
)
def rebuilt_board_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "rebuilt")
    writers.rebuild_board_export(v_post(spark, sf_dir), BOARD, AS_OF, path)
    return readers.read_csv_export(spark, path)


_TWICE = f"(SELECT {ALL} FROM v_post UNION ALL SELECT {ALL} FROM v_post)"


@query(
    "snk4_combined_export",
    _post(f"""SELECT DISTINCT {ALL} FROM {_TWICE} WHERE "Site" IN ('click', 'error', 'view')"""),
)
def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = v_post(spark, sf_dir)
    path = work_dir(spark, "combined")
    both = postings.unionByName(postings).where(F.col("Site").isin("click", "error", "view"))
    combined_export(both, ["click", "error", "view"]).write.partitionBy("Site").parquet(path)
    return readers.read_board_export(spark, path)


@query(
    "snk4_combined_export_of_a_day",
    _post(f"""SELECT DISTINCT {ALL} FROM {_TWICE} WHERE "Site" IN ('click', 'error', 'view') AND "Crawl_Date" = {DAY}"""),
)
def combined_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = v_post(spark, sf_dir)
    return combined_export(postings.unionByName(postings), ["click", "error", "view"], AS_OF).select(*POSTING_COLUMNS)


@query(
    "src4_company_days_by_collation",
    _post("""SELECT min("Company") AS "Company", "Crawl_Date" FROM (
               SELECT CASE WHEN unique_id LIKE '%1' THEN upper("Company") ELSE "Company" END AS "Company", "Crawl_Date" FROM v_post
               WHERE "Site" = 'click' AND "Crawl_Date" BETWEEN DATE '2024-01-04' AND DATE '2024-01-12') p
             GROUP BY lower("Company"), "Crawl_Date" """),
)
def company_days_by_collation(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(F.col("unique_id").endswith("1"), F.upper("Company")).otherwise(F.col("Company"))
    return company_days(v_post(spark, sf_dir).withColumn("Company", mixed), BOARD, START, END, collation="UNICODE_CI")


@query(
    "snk5_change_report",
    f"""SELECT 'New_Companies' AS sheet, * FROM (WITH {_report_sql("new")})
        UNION ALL SELECT 'Companies_That_left', * FROM (WITH {_report_sql("left")})""",
)
def change_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = writers.write_change_report(v_post(spark, sf_dir), AS_OF, work_dir(spark, "report"))
    sheets = [
        readers.read_sheet(spark, folder, name).select(F.lit(name).alias("sheet"), *REPORT_COLUMNS)
        for name in (writers.NEW_SHEET, writers.LEFT_SHEET)
    ]
    return sheets[0].unionByName(sheets[1])


def dump_sql() -> str:
    return f"""{V_POST}, d AS (SELECT DISTINCT "Company" AS c, "Crawl_Date" AS day FROM v_post
                  WHERE "Site" = 'click' AND "Crawl_Date" BETWEEN DATE '2024-01-04' AND DATE '2024-01-12'),
        n AS (SELECT c, day FROM d a WHERE day >= DATE '2024-01-05' AND NOT EXISTS
               (SELECT 1 FROM d b WHERE b.c IS NOT DISTINCT FROM a.c AND b.day = a.day - 1)),
        r AS (SELECT c, day + 1 AS day FROM d a WHERE day <= DATE '2024-01-11' AND NOT EXISTS
               (SELECT 1 FROM d b WHERE b.c IS NOT DISTINCT FROM a.c AND b.day = a.day + 1))"""


@query(
    "snk6_range_dump",
    f"""WITH {dump_sql()} SELECT 'new' AS change, c AS "Company", strftime(day, '%d/%m/%Y') AS "Report Date" FROM n
        UNION ALL SELECT 'removed', c, strftime(day, '%d/%m/%Y') FROM r""",
)
def range_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = writers.write_range_dump(v_post(spark, sf_dir), BOARD, START, END, AS_OF, work_dir(spark, "dump"))
    parts = [
        readers.read_csv(spark, path, "Company string, `Report Date` string").select(
            F.lit(change).alias("change"), "Company", "Report Date"
        )
        for change, path in zip(("new", "removed"), paths)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "snk7_retained",
    _post(f"""SELECT {ALL} FROM v_post WHERE "Crawl_Date" BETWEEN {DAY} - 9 AND {DAY}"""),
)
def retained_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retained(v_post(spark, sf_dir), AS_OF, 10)


@query(
    "snk7_deleted_30d",
    _post(f"""SELECT "Crawl_Date", "unique_id" FROM v_post
              WHERE NOT ("Crawl_Date" BETWEEN {DAY} - 29 AND {DAY})"""),
)
def deleted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted(v_post(spark, sf_dir), AS_OF, LIVE_DAYS).select("Crawl_Date", "unique_id")


@query(
    "snk7_deleted_70d",
    _post(f"""SELECT "Crawl_Date", "unique_id" FROM v_post
              WHERE NOT ("Crawl_Date" BETWEEN {DAY} - 69 AND {DAY})"""),
)
def deleted_rows_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted(v_post(spark, sf_dir), AS_OF, MANUAL_DAYS).select("Crawl_Date", "unique_id")


@query(
    "snk7_table_after_retention",
    _post(f"""SELECT {ALL} FROM v_post WHERE "Crawl_Date" BETWEEN {DAY} - 9 AND {DAY}"""),
)
def table_after_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "table")
    writers.append_postings(v_post(spark, sf_dir), path)
    writers.apply_retention(spark, path, AS_OF, 10)
    return readers.read_table(spark, path)


@query(
    "snk7_expired_days",
    _post(f"""SELECT DISTINCT "Crawl_Date" FROM v_post WHERE NOT ("Crawl_Date" BETWEEN {DAY} - 9 AND {DAY})"""),
)
def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expired_days(v_post(spark, sf_dir), AS_OF, 10)


@query(
    "snk8_expired_artifacts",
    f"""WITH {V_MANIFEST} SELECT event_id, name FROM v_manifest
        WHERE coalesce(NOT (try_strptime(regexp_extract(name, '[0-9]{{4}}[-_][0-9]{{2}}[-_][0-9]{{2}}').replace('-', '_'),
              '%Y_%m_%d')::DATE BETWEEN {DAY} - 9 AND {DAY}), true)""",
)
def expired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expired_artifacts(v_manifest(spark, sf_dir), AS_OF)


# ---- Projections ----


@query("p1_churn_columns", _post(f"SELECT {SIX} FROM v_post"))
def churn_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_post(spark, sf_dir).select(*CHURN_COLUMNS)


@query("p2_all_columns", _post(f'SELECT {ALL}, TRY_CAST("Job_id" AS BIGINT) AS job_number FROM v_post'))
def all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_postings(v_post(spark, sf_dir)).withColumn("job_number", numeric_job_id())


@query(
    "p3_contact_columns",
    _post("""SELECT "unique_id", '' AS "Company Site URL", '' AS "Company Phone", '' AS "Company Email" FROM v_post"""),
)
def contact_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_post(spark, sf_dir).select("unique_id").withColumns({c: F.lit("") for c in CONTACT_COLUMNS})


@query(
    "p5_day_of_ingest",
    _arrivals('SELECT "unique_id", "arrival", CAST("ingest_ts" AS DATE) AS "Crawl_Date" FROM v_arrivals'),
)
def day_of_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v_arrivals(spark, sf_dir).select("unique_id", "arrival", "ingest_ts")
    return stamp(rows, ingest_ts="ingest_ts").drop("ingest_ts")


@query(
    "p6_fixed_columns",
    "SELECT event_id, 'JobNet' AS \"Site\", '' AS \"AllJobs_Job_class\", DATE '2024-01-15' AS \"Crawl_Date\" FROM events",
)
def fixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.lit("JobNet").alias("Site"), F.lit("").alias("AllJobs_Job_class")
    )
    return stamp(rows, AS_OF)


# ---- Predicates ----


@query(
    "f1_board_and_day",
    _post(f"""SELECT "unique_id" FROM v_post WHERE "Site" = 'click' AND "Crawl_Date" = {DAY}"""),
)
def board_and_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = v_post(spark, sf_dir)
    return postings.where((F.col("Site") == BOARD) & (F.col("Crawl_Date") == F.lit(AS_OF))).select("unique_id")


@query(
    "f2_day_in_list",
    _post("""SELECT "unique_id", "Crawl_Date" FROM v_post
             WHERE "Crawl_Date" IN (DATE '2024-01-05', DATE '2024-01-12', DATE '2024-01-15')"""),
)
def day_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days_in(v_post(spark, sf_dir), [START, END, AS_OF]).select("unique_id", "Crawl_Date")


@query(
    "f3_day_not_in_list",
    _post(f"""SELECT "Site", "Crawl_Date", count(*) AS n FROM v_post
              WHERE "Crawl_Date" < {DAY} - 9 OR "Crawl_Date" > {DAY} GROUP BY ALL"""),
)
def day_not_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted(v_post(spark, sf_dir), AS_OF, 10).groupBy("Site", "Crawl_Date").agg(F.count("*").alias("n"))


@query(
    "f8_usable_first_seen_ids",
    _post("""SELECT "Job_id", "Site" FROM (SELECT coalesce(nullif(regexp_replace("Company", '^c', ''), '0'), '') AS "Job_id",
                    "Site", "unique_id" FROM v_post)
             WHERE "Job_id" <> '' QUALIFY row_number() OVER (PARTITION BY "Job_id" ORDER BY "unique_id") = 1"""),
)
def usable_first_seen_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.coalesce(F.nullif(F.regexp_replace("Company", "^c", ""), F.lit("0")), F.lit(""))
    rows = v_post(spark, sf_dir).select(ids.alias("Job_id"), "Site", "unique_id").where("Job_id <> ''")
    return first_per_key(rows, ["Job_id"], ["unique_id"]).select("Job_id", "Site")


@query(
    "f10_f11_guarded_range",
    _post(f"""SELECT "Crawl_Date", count(*) AS n FROM v_post
              WHERE "Crawl_Date" BETWEEN DATE '2024-01-05' AND {DAY} GROUP BY ALL"""),
)
def guarded_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = day_range(START, None, AS_OF)
    rows = v_post(spark, sf_dir).where(F.col("Crawl_Date").between(F.lit(start), F.lit(end)))
    return rows.groupBy("Crawl_Date").agg(F.count("*").alias("n"))


@query(
    "f12_attribute_match",
    """SELECT page_id, url LIKE 'https://%' AS secure, contains(url, '/en/') AS english,
              contains(html, 'class="ad"') AS has_ad FROM pages""",
)
def attribute_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.startswith("url", F.lit("https://")).alias("secure"),
        F.contains("url", F.lit("/en/")).alias("english"),
        F.contains("html", F.lit('class="ad"')).alias("has_ad"),
    )


# ---- Keys and duplicates ----


@query(
    "j4_not_stored",
    f"""WITH {V_ARRIVALS}{_MORNING}
        SELECT "unique_id", "Crawl_Date", "arrival" FROM v_arrivals a WHERE hour("ingest_ts") >= 12
          AND ("Crawl_Date", "unique_id") NOT IN (SELECT "Crawl_Date", "unique_id" FROM stored)""",
)
def rows_not_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    morning, rest = _morning_and_rest(spark, sf_dir)
    return not_stored(rest, morning).select("unique_id", "Crawl_Date", "arrival")


@query(
    "j6_ids_seen_before",
    """WITH m AS (SELECT DISTINCT user_id FROM events WHERE hour(ts) < 12)
       SELECT event_id, user_id FROM events WHERE hour(ts) >= 12 AND user_id IN (SELECT user_id FROM m)""",
)
def ids_seen_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.hour("ts").alias("h"))
    later = events.where("h >= 12").select("event_id", "user_id")
    return rows_by_key(later, events.where("h < 12"), ["user_id"], present=True, spread_by="event_id")


_COUNTS = """SELECT v."Site", count(*) FILTER (WHERE a."arrival" IS NOT NULL) AS accepted,
                    count(*) FILTER (WHERE a."arrival" IS NULL) AS rejected
             FROM v_arrivals v LEFT JOIN accepted a ON a."arrival" = v."arrival" GROUP BY v."Site" """


@query("a6_duplicates", _arrivals(_COUNTS))
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_arrivals(v_arrivals(spark, sf_dir).select("Site", "Crawl_Date", "unique_id"))


@query("a6_rejected_by_load", _arrivals(_COUNTS))
def rejected_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = v_arrivals(spark, sf_dir).select("Site", "Crawl_Date", "unique_id", "arrival")
    return rejected_per_site(batch, insert_unique(batch, ["arrival"]))


@query("a7_accepted_rows", _arrivals('SELECT "Site", count(*) AS accepted FROM accepted GROUP BY 1'))
def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_arrivals(v_arrivals(spark, sf_dir).select("Site", "Crawl_Date", "unique_id")).drop("rejected")


# ---- Orders and set operations on exports ----


@query(
    "o1_company_nulls_first",
    _post(f"""SELECT "Company", "unique_id" FROM v_post WHERE "Site" = 'click' AND "Crawl_Date" = {DAY}
              ORDER BY "Company" NULLS FIRST, "unique_id" """),
)
def company_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_export(v_post(spark, sf_dir), BOARD, AS_OF).select("Company", "unique_id")


@query(
    "o3_deduplicated_then_sorted",
    _post(f"""SELECT DISTINCT "Site", "Company", "unique_id" FROM {_TWICE}"""),
)
def deduplicated_then_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = v_post(spark, sf_dir).select("Site", "Company", "unique_id")
    return combined_export(postings.unionByName(postings), BOARDS)


@query("u3_distinct_companies", _post('SELECT DISTINCT "Site", "Company" FROM v_post'))
def distinct_companies_of_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_post(spark, sf_dir).select("Site", "Company").distinct()


@query("u4_whole_row_distinct", _post(f"SELECT DISTINCT {ALL} FROM {_TWICE}"))
def whole_row_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = v_post(spark, sf_dir)
    return postings.unionByName(postings).dropDuplicates()


@query(
    "u5_rows_that_occur_once",
    _post("""SELECT "Site", "Company", "Crawl_Date" FROM v_post GROUP BY ALL HAVING count(*) = 1"""),
)
def rows_that_occur_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once_only(v_post(spark, sf_dir).select("Site", "Company", "Crawl_Date"))


_DAY_TWICE = f"""(SELECT {ALL} FROM v_post UNION ALL SELECT {ALL} FROM v_post WHERE "Crawl_Date" = {DAY})"""


def _day_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings, those of one day loaded twice."""
    postings = v_post(spark, sf_dir)
    return postings.unionByName(postings.where(F.col("Crawl_Date") == F.lit(AS_OF)))


@query("u4_distinct_by_digest", _post(f"SELECT DISTINCT {ALL} FROM {_DAY_TWICE}"))
def distinct_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(_day_twice(spark, sf_dir))


@query("u5_once_by_digest", _post(f"SELECT {ALL} FROM {_DAY_TWICE} GROUP BY ALL HAVING count(*) = 1"))
def once_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_once(_day_twice(spark, sf_dir))


@query(
    "s25_date_in_file_name",
    f"""WITH {V_MANIFEST} SELECT event_id,
          replace(left(replace(name, 'scrapy_log_output_', ''), 10), '-', '_') AS day_text FROM v_manifest""",
)
def date_in_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_manifest(spark, sf_dir).select("event_id", artifact_day(F.col("name")).alias("day_text"))
