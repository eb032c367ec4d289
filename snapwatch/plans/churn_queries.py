"""Churn, statistics, joins, aggregates and windows over the snapshot table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.operators import churn, churn_range, coverage, day_summaries, distinct_sets, stats
from snapwatch.operators.churn import snapshot_window
from snapwatch.operators.grouping import first_per_key, with_group_count
from snapwatch.plans.registry import AS_OF, BOARD, BOARDS, END, START, query
from snapwatch.plans.table_queries import BOARD_LIST, DAY, _post, _report_sql, dump_sql
from snapwatch.plans.views import V_PAGED, V_POST, table, v_paged, v_post
from snapwatch.session import work_dir
from snapwatch.sources import readers, writers

_BLANKS = "'' AS \"Company Site URL\", '' AS \"Company Phone\", '' AS \"Company Email\""


def _window_sql(lookback: int) -> str:
    """The row-keeping definition, with windows."""
    return f"""{V_POST}, w AS (
        SELECT "Site", "Company", "Company_jobs", "Crawl_Date",
               count("unique_id") OVER (PARTITION BY "Site", "Company", "Crawl_Date") AS n,
               row_number() OVER (PARTITION BY "Site", "Company", "Crawl_Date" ORDER BY "unique_id") AS rn
        FROM v_post WHERE "Company" IS NOT NULL AND "Crawl_Date" BETWEEN {DAY} - {lookback - 1} AND {DAY}),
      labelled AS (SELECT *, count(*) OVER (PARTITION BY "Site", "Company") AS days FROM w WHERE rn = 1)"""


def _new_sql(lookback: int) -> str:
    return f"""WITH {_window_sql(lookback)} SELECT "Site", "Company", "Company_jobs", n AS "Num_Company_jobs", {_BLANKS}
               FROM labelled WHERE days = 1 AND "Crawl_Date" = {DAY} ORDER BY "Site", "Company" """


_LEFT_SQL = f"""WITH {_window_sql(2)} SELECT "Site", "Company", "Company_jobs", n AS "Num_Company_jobs"
                FROM labelled WHERE days = 1 AND "Crawl_Date" = {DAY} - 1 ORDER BY "Site", "Company" """


@query("ch1_new_companies_2d", _new_sql(2))
def new_companies_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.new_companies(v_post(spark, sf_dir), AS_OF, 2)


@query("ch1_new_companies_8d", _new_sql(8))
def new_companies_8d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.new_companies(v_post(spark, sf_dir), AS_OF, 8)


@query("ch1_new_companies_by_rows", _new_sql(2))
def new_companies_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.new_companies_by_rows(v_post(spark, sf_dir), AS_OF, 2)


@query("ch2_left_companies", _LEFT_SQL)
def left_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.left_companies(v_post(spark, sf_dir), AS_OF)


@query("ch2_left_companies_by_rows", _LEFT_SQL)
def left_companies_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.left_companies_by_rows(v_post(spark, sf_dir), AS_OF)


# ---- Range churn ----


def _churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.churn_range(v_post(spark, sf_dir), BOARD, START, END)


@query("ch3_new", f'WITH {dump_sql()} SELECT c AS "Company", day AS "Report Date" FROM n')
def range_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.changes(_churn(spark, sf_dir), "new")


@query("ch3_removed", f'WITH {dump_sql()} SELECT c AS "Company", day AS "Report Date" FROM r')
def range_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.changes(_churn(spark, sf_dir), "removed")


@query(
    "ch3_with_an_empty_day",
    f"""WITH {dump_sql().replace('"Crawl_Date" BETWEEN', '''"Crawl_Date" <> DATE '2024-01-09' AND "Crawl_Date" BETWEEN''')}
        SELECT c AS "Company", day AS "Report Date", 'new' AS change FROM n
        UNION ALL SELECT c, day, 'removed' FROM r""",
)
def range_with_an_empty_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nobody was crawled on one day: all companies leave on it and come back on the next."""
    crawled = v_post(spark, sf_dir).where("Crawl_Date <> date'2024-01-09'")
    return churn_range.churn_range(crawled, BOARD, START, END)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.company_days(v_post(spark, sf_dir), BOARD, START, END)


@query("j1_new_vs_day_before", f'WITH {dump_sql()} SELECT c AS "Company", day AS "Report Date" FROM n')
def new_vs_day_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.new_by_anti_join(_pairs(spark, sf_dir), START, END)


@query("j2_removed_vs_day_before", f'WITH {dump_sql()} SELECT c AS "Company", day AS "Report Date" FROM r')
def removed_vs_day_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.removed_by_anti_join(_pairs(spark, sf_dir), START, END)


@query(
    "j3_zero_filled_boards",
    _post(f"""SELECT b."Site", count(p."Site") AS n FROM {BOARD_LIST.replace("boards", "b")}
              LEFT JOIN v_post p ON p."Site" = b."Site" GROUP BY 1"""),
)
def zero_filled_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rows_per_site(v_post(spark, sf_dir), "n", BOARDS)


@query(
    "ch3_new_by_collation",
    """WITH p AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'C' ELSE 'c' END || user_id AS c, CAST(ts AS DATE) AS day FROM events
                  WHERE event_type = 'click' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-04' AND DATE '2024-01-12'),
            d AS (SELECT min(c) AS c, lower(c) AS k, day FROM p GROUP BY 2, 3)
       SELECT a.c AS "Company", a.day AS "Report Date" FROM d a
       WHERE a.day >= DATE '2024-01-05' AND NOT EXISTS (SELECT 1 FROM d b WHERE b.k = a.k AND b.day = a.day - 1)""",
)
def new_by_collation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in either case are one company."""
    name = F.concat(F.when(F.col("event_id") % 3 == 0, "C").otherwise("c"), F.col("user_id").cast("string"))
    events = table(spark, sf_dir, "events")
    postings = events.select(F.col("event_type").alias("Site"), name.alias("Company"), F.to_date("ts").alias("Crawl_Date"))
    return churn_range.changes(churn_range.churn_range(postings, BOARD, START, END, collation="UNICODE_CI"), "new")


_SPINE = """SELECT CAST(unnest(generate_series(DATE '2024-01-04', DATE '2024-01-12', INTERVAL 1 DAY)) AS DATE) AS day"""


@query(
    "j5_dense_calendar",
    _post(f"""SELECT s.day AS "Crawl_Date", count(p."Site") AS n FROM ({_SPINE}) s LEFT JOIN v_post p
              ON p."Crawl_Date" = s.day GROUP BY 1"""),
)
def dense_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily postings, with the days that have none."""
    days = churn_range.calendar(v_post(spark, sf_dir), START.replace(day=4), END)
    counts = v_post(spark, sf_dir).groupBy("Crawl_Date").agg(F.count("*").alias("n"))
    return days.join(counts, "Crawl_Date", "left").select("Crawl_Date", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "a10_companies_per_day",
    f"""WITH {V_POST}, d AS (SELECT DISTINCT "Company", "Crawl_Date" FROM v_post WHERE "Site" = 'click')
        SELECT s.day AS "Crawl_Date", count(d."Crawl_Date") AS companies
        FROM ({_SPINE}) s LEFT JOIN d ON d."Crawl_Date" = s.day GROUP BY 1""",
)
def companies_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.companies_per_day(v_post(spark, sf_dir), BOARD, START, END)


_PER_DAY = f"""{dump_sql()}, per_day AS (
    SELECT s.day, (SELECT count(*) FROM n WHERE n.day = s.day) AS new, (SELECT count(*) FROM r WHERE r.day = s.day) AS removed
    FROM ({_SPINE}) s WHERE s.day >= DATE '2024-01-05')"""


@query("a11_changes_per_day", f'WITH {_PER_DAY} SELECT day AS "Report Date", new, removed FROM per_day')
def changes_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.changes_per_day(_churn(spark, sf_dir), START, END)


@query(
    "a12_distinct_companies_of_dump",
    f"""WITH {dump_sql()} SELECT 'new' AS change, (SELECT count(*) FROM (SELECT DISTINCT c FROM n)) AS companies
        UNION ALL SELECT 'removed', (SELECT count(*) FROM (SELECT DISTINCT c FROM r))""",
)
def distinct_companies_of_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.distinct_companies(_churn(spark, sf_dir))


@query(
    "w5_running_changes",
    f"""WITH {_PER_DAY} SELECT day AS "Report Date", new, removed,
          CAST(sum(new) OVER (ORDER BY day) AS BIGINT) AS new_so_far,
          CAST(sum(removed) OVER (ORDER BY day) AS BIGINT) AS removed_so_far FROM per_day""",
)
def running_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_range.running_changes(churn_range.changes_per_day(_churn(spark, sf_dir), START, END))


@query(
    "w4_first_and_last_day_runs",
    _post("""SELECT "Site", "Company", "Crawl_Date" FROM (SELECT DISTINCT "Site", "Company", "Crawl_Date" FROM v_post) d
             WHERE NOT EXISTS (SELECT 1 FROM v_post p WHERE p."Site" = d."Site"
               AND p."Company" IS NOT DISTINCT FROM d."Company" AND p."Crawl_Date" = d."Crawl_Date" - 1)"""),
)
def comebacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day on which a company of any board is seen but was not seen the day before."""
    days = v_post(spark, sf_dir).select("Site", "Company", "Crawl_Date").distinct()
    d, p = days.alias("d"), days.alias("p")
    same = F.col("d.Company").eqNullSafe(F.col("p.Company")) & (F.col("d.Site") == F.col("p.Site"))
    return d.join(p, same & (F.col("d.Crawl_Date") == F.date_add("p.Crawl_Date", 1)), "left_anti")


@query(
    "u1_set_difference",
    _post(f"""(SELECT "Site", "Company" FROM v_post WHERE "Crawl_Date" = {DAY})
              EXCEPT (SELECT "Site", "Company" FROM v_post WHERE "Crawl_Date" = {DAY} - 1)"""),
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = v_post(spark, sf_dir)
    day = [postings.where(F.col("Crawl_Date") == F.date_sub(F.lit(AS_OF), n)).select("Site", "Company") for n in (0, 1)]
    return day[0].subtract(day[1])


@query(
    "u2_union_of_days",
    _post(f"""SELECT "unique_id", "Crawl_Date" FROM v_post WHERE "Crawl_Date" = {DAY}
              UNION ALL SELECT "unique_id", "Crawl_Date" FROM v_post WHERE "Crawl_Date" = {DAY} - 1"""),
)
def union_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = v_post(spark, sf_dir).select("unique_id", "Crawl_Date")
    today, before = (postings.where(F.col("Crawl_Date") == F.date_sub(F.lit(AS_OF), n)) for n in (0, 1))
    return today.unionByName(before)


# ---- Statistics ----

_TOTALS = f"""t AS (SELECT b."Site", count(p."Site") AS total_jobs, count(DISTINCT p."Company") AS total_companies
              FROM {BOARD_LIST.replace("boards", "b")} LEFT JOIN v_post p
              ON p."Site" = b."Site" AND p."Crawl_Date" = {DAY} GROUP BY 1)"""


def _stats_sql(lookback: int, select: str) -> str:
    return f"""WITH {V_POST}, {_TOTALS},
        n AS (SELECT "Site", count(*) AS new FROM ({_new_sql(lookback)}) GROUP BY 1),
        r AS (SELECT "Site", count(*) AS removed FROM ({_LEFT_SQL}) GROUP BY 1),
        s AS (SELECT "Site", coalesce(new, 0) AS new, coalesce(removed, 0) AS removed, total_jobs, total_companies
              FROM t LEFT JOIN n USING ("Site") LEFT JOIN r USING ("Site")) {select}"""


@query("ch4_daily_stats", _stats_sql(2, "SELECT * FROM s"))
def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.daily_stats(v_post(spark, sf_dir), AS_OF, 2, BOARDS)


@query("ch4_daily_stats_8d", _stats_sql(8, "SELECT * FROM s"))
def daily_stats_8d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.daily_stats(v_post(spark, sf_dir), AS_OF, 8, BOARDS)


@query(
    "a1_jobs_per_company_day",
    _post("""SELECT "Site", "Company", "Crawl_Date", count("unique_id") AS "Num_Company_jobs" FROM v_post
             WHERE "Company" IS NOT NULL GROUP BY ALL"""),
)
def jobs_per_company_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.company_day_counts(v_post(spark, sf_dir))


@query(
    "a2_days_per_company",
    _post("""SELECT "Site", "Company", count(DISTINCT "Crawl_Date") AS crawl_date_count FROM v_post
             WHERE "Company" IS NOT NULL GROUP BY ALL"""),
)
def days_per_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.snapshot_days(v_post(spark, sf_dir))


@query("a3_total_jobs", f'WITH {V_POST}, {_TOTALS} SELECT "Site", total_jobs FROM t')
def total_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.total_jobs(v_post(spark, sf_dir), AS_OF, BOARDS)


@query("a4_total_companies", f'WITH {V_POST}, {_TOTALS} SELECT "Site", total_companies FROM t')
def total_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.total_companies(v_post(spark, sf_dir), AS_OF, BOARDS)


@query(
    "a4_total_companies_folded",
    f"""WITH {V_POST}, {_TOTALS.replace('p."Company")', """lower(rtrim(CASE CAST("Job_id" AS BIGINT) % 3
          WHEN 0 THEN upper("Company") WHEN 1 THEN "Company" || ' ' ELSE "Company" END)))""")}
        SELECT "Site", total_companies FROM t""",
)
def total_companies_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in mixed case and with trailing blanks, compared as the database compares them."""
    shape = F.col("Job_id").cast("bigint") % 3
    name = F.when(shape == 0, F.upper("Company")).when(shape == 1, F.concat("Company", F.lit(" "))).otherwise(F.col("Company"))
    mixed = v_post(spark, sf_dir).withColumn("Company", name)
    return stats.total_companies(mixed, AS_OF, BOARDS, collation="UNICODE_CI_AI_RTRIM")


@query("a5_new_and_removed", _stats_sql(2, 'SELECT "Site", new, removed FROM s'))
def new_and_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_stats(spark, sf_dir).select("Site", "new", "removed")


@query("a13_merged_stats", _stats_sql(2, "SELECT * FROM s"))
def merged_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_stats(spark, sf_dir).select("Site", *stats.METRICS)


@query("a13_totals_without_report", _stats_sql(2, 'SELECT "Site", total_jobs, total_companies FROM s'))
def totals_without_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_stats(spark, sf_dir).select("Site", "total_jobs", "total_companies")


def _merged(spark: SparkSession, sf_dir: str, written: bool) -> DataFrame:
    postings, root = v_post(spark, sf_dir), work_dir(spark, "reports")
    folder = writers.write_change_report(postings, AS_OF, root) if written else writers.report_folder(root, AS_OF)
    reports = readers.read_report_counts(spark, folder, BOARDS)
    totals = [stats.total_jobs(postings, AS_OF, BOARDS), stats.total_companies(postings, AS_OF, BOARDS)]
    return stats.merge_stats(totals, reports)


@query("a13_merge_with_written_report", _stats_sql(2, "SELECT * FROM s"))
def merge_with_written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two totals merged with the counts of the two sheets of the day's written report."""
    return _merged(spark, sf_dir, written=True)


@query("a13_merge_without_readable_report", _stats_sql(2, 'SELECT "Site", total_jobs, total_companies FROM s'))
def merge_without_readable_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report was not written: only the totals remain."""
    return _merged(spark, sf_dir, written=False)


@query(
    "a13_stats_by_metric",
    _stats_sql(
        2,
        """SELECT metric, string_agg("Site" || '=' || n, ',' ORDER BY "Site") AS by_site
           FROM (UNPIVOT s ON new, removed, total_jobs, total_companies INTO NAME metric VALUE n) GROUP BY 1""",
    ),
)
def stats_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.map_entries("by_site")
    text = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return stats.stats_as_map(daily_stats(spark, sf_dir)).select("metric", text.alias("by_site"))


@query(
    "x2_completeness_gate",
    _stats_sql(
        2,
        """SELECT bool_and(total_jobs > 0) AS complete,
                  coalesce(string_agg(CASE WHEN total_jobs = 0 THEN "Site" END, ',' ORDER BY "Site"), '') AS missing FROM s""",
    ),
)
def completeness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.completeness_gate(total_jobs(spark, sf_dir))


# ---- Windows and orders ----


@query(
    "w1_count_on_every_row",
    _post("""SELECT "unique_id", "Company", CASE WHEN "Company" IS NOT NULL THEN
               count("unique_id") OVER (PARTITION BY "Site", "Company", "Crawl_Date") END AS "Num_Company_jobs" FROM v_post"""),
)
def count_on_every_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["Site", "Company", "Crawl_Date"]
    rows = v_post(spark, sf_dir).select(*keys, "unique_id")
    counted = with_group_count(rows, keys, "unique_id", "Num_Company_jobs", "unique_id")
    return counted.select("unique_id", "Company", "Num_Company_jobs")


@query(
    "w2_days_on_every_row",
    f"""WITH {_window_sql(8)} SELECT "Site", "Company", "Crawl_Date", n AS "Num_Company_jobs",
          days AS crawl_date_count FROM labelled""",
)
def days_on_every_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = churn.labelled_rows(v_post(spark, sf_dir).where("Company is not null"), AS_OF, 8)
    return labelled.select("Site", "Company", "Crawl_Date", "Num_Company_jobs", "crawl_date_count")


@query(
    "w3_first_row_per_key",
    _post("""SELECT "Site", "Company", "Crawl_Date", "Company_jobs", "unique_id" FROM v_post
             QUALIFY row_number() OVER (PARTITION BY "Site", "Company", "Crawl_Date" ORDER BY "unique_id") = 1"""),
)
def first_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["Site", "Company", "Crawl_Date"]
    rows = v_post(spark, sf_dir).select(*keys, "Company_jobs", "unique_id")
    return first_per_key(rows, keys, ["unique_id"])


@query(
    "f4_f5_f6_days_seen",
    f"""WITH {_window_sql(2)} SELECT "Site", "Company", "Crawl_Date" FROM labelled
        WHERE days = 1 AND "Crawl_Date" IN ({DAY}, {DAY} - 1)""",
)
def seen_on_one_of_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies of exactly one of the two days, with that day."""
    companies = churn.company_window(v_post(spark, sf_dir), AS_OF)
    day = F.when(churn.is_new(), F.lit(AS_OF)).when(churn.is_left(), F.date_sub(F.lit(AS_OF), 1))
    return companies.select("Site", "Company", day.alias("Crawl_Date")).where("Crawl_Date is not null")


@query("f7_report_rows_of_board", f"WITH {_report_sql('new').strip()} AND \"Site\" = 'click'")
def report_rows_of_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = churn.new_report(churn.company_window(v_post(spark, sf_dir), AS_OF))
    return report.where(F.col("Site") == BOARD).select("Site", "Company", "Company_jobs", "Num_Company_jobs")


@query("p4_report_columns", _LEFT_SQL)
def report_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.left_report(churn.company_window(v_post(spark, sf_dir), AS_OF))


@query("o2_by_board_and_company", _LEFT_SQL)
def by_board_and_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.left_companies(v_post(spark, sf_dir), AS_OF)


@query("o4_by_size", _new_sql(8))
def by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.new_companies(v_post(spark, sf_dir), AS_OF, 8, order="by_size")


# ---- Pages and regions ----


def _paged(select: str) -> str:
    return f"WITH {V_PAGED} {select}"


@query(
    "a8_postings_per_page_and_board",
    _paged('SELECT "Site", page, count(*) AS n FROM v_paged GROUP BY ROLLUP ("Site", page) HAVING GROUPING_ID("Site", page) < 3'),
)
def postings_per_page_and_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.page_and_board_counts(v_paged(spark, sf_dir))


@query("a9_postings_per_region", _paged("SELECT location_id, count(*) AS n FROM v_paged GROUP BY 1"))
def postings_per_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.postings_per_region(v_paged(spark, sf_dir))


@query("a14_region_count", _paged("SELECT count(DISTINCT location_id) AS regions FROM v_paged"))
def region_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.region_count(v_paged(spark, sf_dir))


@query(
    "w5_running_postings_by_page",
    _paged("""SELECT "Site", page, count(*) AS n,
                CAST(sum(count(*)) OVER (PARTITION BY "Site" ORDER BY page) AS BIGINT) AS n_so_far
              FROM v_paged GROUP BY "Site", page"""),
)
def running_postings_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.running_postings(coverage.postings_per_page(v_paged(spark, sf_dir)))


@query(
    "x3_uncovered_pages",
    _paged("""SELECT b."Site", p.page, 'missing' AS reason FROM (SELECT "Site", max(page) AS last FROM v_paged GROUP BY 1) b,
                LATERAL (SELECT unnest(generate_series(0, b.last)) AS page) p
              WHERE NOT EXISTS (SELECT 1 FROM v_paged v WHERE v."Site" = b."Site" AND v.page = p.page)
              UNION ALL
              SELECT 'all', p.page_id, 'empty' FROM pages p WHERE NOT contains(p.html, '<ul>')"""),
)
def uncovered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board pages without postings, and saved pages without a list."""
    return coverage.uncovered_pages(_seen_pages(spark, sf_dir, F.col("page")))


def _seen_pages(spark: SparkSession, sf_dir: str, total: Column) -> DataFrame:
    per_page = coverage.postings_per_page(v_paged(spark, sf_dir)).withColumn("total_pages", total)
    saved = table(spark, sf_dir, "pages").select(
        F.lit("all").alias("Site"),
        F.col("page_id").alias("page"),
        F.contains("html", F.lit("<ul>")).cast("bigint").alias("n"),
        F.lit(-1).cast("bigint").alias("total_pages"),
    )
    return per_page.unionByName(saved)


@query(
    "x3_page_gaps",
    _paged("""SELECT "Site", from_page, to_page, 'missing' AS reason FROM (
                SELECT "Site", page + 1 AS from_page, coalesce(lead(page) OVER (PARTITION BY "Site" ORDER BY page) - 1, last) AS to_page
                FROM (SELECT DISTINCT "Site", page FROM v_paged UNION ALL SELECT DISTINCT "Site", -1 FROM v_paged)
                JOIN (SELECT "Site", max(page) + CASE "Site" WHEN 'click' THEN 1000000000000000 ELSE 3 END AS last
                      FROM v_paged GROUP BY 1) USING ("Site"))
              WHERE from_page <= to_page
              UNION ALL
              SELECT 'all', min(page_id), max(page_id), 'empty'
              FROM (SELECT page_id, page_id - row_number() OVER (ORDER BY page_id) AS island FROM pages WHERE NOT contains(html, '<ul>'))
              GROUP BY island"""),
)
def page_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ranges, while every board announces three pages too many and one board very many."""
    total = F.col("page") + F.when(F.col("Site") == BOARD, F.lit(10**15)).otherwise(F.lit(3))
    return coverage.page_gaps(_seen_pages(spark, sf_dir, total))


# ---- From day summaries, without the days' postings ----


def _summaries(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Summaries of the last ``n`` days, made by two loads of which the second repairs a day of the first."""
    postings, path = v_post(spark, sf_dir), f"{work_dir(spark, 'summaries')}/days"
    days = [AS_OF - dt.timedelta(days=i) for i in range(n)]
    half = postings.where(F.col("Job_id").cast("bigint") % 2 == 0)
    day_summaries.refresh_summaries(half.where(F.col("Crawl_Date") == F.lit(AS_OF)), [AS_OF], path)
    day_summaries.refresh_summaries(postings, days, path)
    return day_summaries.read_summaries(spark, path)


def _new_from_summaries(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    companies = day_summaries.company_window_of(_summaries(spark, sf_dir, n), AS_OF, n)
    return churn.sort_report(churn.new_report(companies))


@query("ch1_from_summaries_8d", _new_sql(8))
def new_from_summaries_8d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _new_from_summaries(spark, sf_dir, 8)


@query("ch1_from_summaries_70d", _new_sql(70))
def new_from_summaries_70d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _new_from_summaries(spark, sf_dir, 70)


@query("ch2_from_summaries", _LEFT_SQL)
def left_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = day_summaries.company_window_of(_summaries(spark, sf_dir, 8), AS_OF)
    return churn.sort_report(churn.left_report(companies))


@query("ch4_from_summaries_8d", _stats_sql(8, "SELECT * FROM s"))
def stats_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_summaries.daily_stats_of(_summaries(spark, sf_dir, 8), AS_OF, 8, BOARDS)


@query(
    "a2_from_summaries",
    _post(f"""SELECT "Site", "Company", count(DISTINCT "Crawl_Date") AS crawl_date_count FROM v_post
             WHERE "Company" IS NOT NULL AND "Crawl_Date" BETWEEN {DAY} - 69 AND {DAY} GROUP BY ALL"""),
)
def days_per_company_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_summaries.snapshot_days_of(_summaries(spark, sf_dir, 70))


# ---- From sets of companies per board and day ----


def _company_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps per board and day, the days before and from START on loaded one after the other."""
    postings, path = v_post(spark, sf_dir), f"{work_dir(spark, 'sets')}/dictionary"
    first = F.col("Crawl_Date") < F.lit(START)
    distinct_sets.number_values(postings.where(first), "Company", path, "1")
    dictionary = distinct_sets.number_values(postings.where(~first), "Company", path, "2")
    sets = f"{work_dir(spark, 'sets')}/bitmaps"
    distinct_sets.bitmaps(postings, ["Site", "Crawl_Date"], "Company", dictionary).write.parquet(sets)
    return spark.read.parquet(sets)


def _range_sql(select: str) -> str:
    day = "DATE '{:%Y-%m-%d}'"
    return _post(f'{select} FROM v_post WHERE "Crawl_Date" BETWEEN {day.format(START)} AND {day.format(END)} GROUP BY ALL')


@query("a4_companies_of_range_by_bitmap", _range_sql('SELECT "Site", count(DISTINCT "Company") AS total_companies'))
def companies_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct companies of a range of days, NULL not counted."""
    sets = _company_sets(spark, sf_dir).where(F.col("Crawl_Date").between(F.lit(START), F.lit(END)))
    return distinct_sets.count_of_bitmaps(sets, ["Site"], "total_companies", with_null=False)


@query(
    "a10_companies_per_day_by_bitmap",
    _range_sql('SELECT "Site", "Crawl_Date", count(DISTINCT "Company") + count(DISTINCT CASE WHEN "Company" IS NULL THEN 1 END) AS companies'),
)
def companies_per_day_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct companies of each day of a range, NULL counted as one."""
    sets = _company_sets(spark, sf_dir).where(F.col("Crawl_Date").between(F.lit(START), F.lit(END)))
    return distinct_sets.count_of_bitmaps(sets, ["Site", "Crawl_Date"], "companies", with_null=True)


@query("a12_companies_of_range_by_sketch", _range_sql('SELECT "Site", true AS near'))
def companies_of_range_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the estimate from the days' sketches lies within three standard errors of the exact count."""
    postings, path = v_post(spark, sf_dir), f"{work_dir(spark, 'sets')}/sketches"
    distinct_sets.sketches(postings, ["Site", "Crawl_Date"], "Company").write.parquet(path)
    days = F.col("Crawl_Date").between(F.lit(START), F.lit(END))
    about = distinct_sets.estimate_of_sketches(spark.read.parquet(path).where(days), ["Site"], "about")
    exact = companies_of_range(spark, sf_dir)
    return about.join(exact, "Site").select("Site", distinct_sets.within_error(F.col("about"), F.col("total_companies")).alias("near"))


@query("a14_regions_by_bitmap", _paged('SELECT "Site", count(DISTINCT location_id) AS regions FROM v_paged GROUP BY 1'))
def regions_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct regions of a board, united over its pages."""
    paged, path = v_paged(spark, sf_dir), f"{work_dir(spark, 'sets')}/dictionary"
    dictionary = distinct_sets.number_values(paged, "location_id", path, "1")
    sets = distinct_sets.bitmaps(paged, ["Site", "page"], "location_id", dictionary)
    return distinct_sets.count_of_bitmaps(sets, ["Site"], "regions", with_null=False)
