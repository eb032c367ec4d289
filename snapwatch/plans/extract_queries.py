"""Extraction queries: pages rendered from events are read back, and the saved pages table itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.functions.text import normalize_space
from snapwatch.operators import coverage, extract_html, extract_json, json_keys, links
from snapwatch.operators.html_fields import Board, Field, Step, raw_records
from snapwatch.plans import board_pages
from snapwatch.plans.registry import AS_OF, query
from snapwatch.plans.views import table
from snapwatch.schema import RECORD_COLUMNS

_TODAY = "'15/01/2024'"
_NL = "chr(10)"
_AGO = "strftime(DATE '2024-01-15' - CAST(user_id AS INTEGER), '%d/%m/%Y')"


def _records(site: str, prefix: str, job_class: str = "''", **columns: str) -> str:
    """SELECT of the 12 record columns plus page_id over events times the two postings of each page."""
    known = {"Site": f"'{site}'", "AllJobs_Job_class": job_class, "unique_id": f"'{prefix}_' || \"Job_id\""}
    first = ", ".join(f'{sql} AS "{name}"' for name, sql in columns.items())
    rest = ", ".join(f'{sql} AS "{name}"' for name, sql in known.items())
    return f"SELECT *, {rest} FROM (SELECT event_id AS page_id, {first} FROM e)"


_EVENTS = """WITH e AS (SELECT *, event_id * 2 + i AS job, 'area ' || (user_id % 9) AS area
                        FROM events CROSS JOIN (VALUES (0), (1)) t(i))"""

# ---- JSON board ----

_API_COLUMNS = {
    "Company": "CASE WHEN user_id % 11 <> 0 THEN 'c' || user_id || ' & co' END",
    "Company_jobs": "CASE WHEN user_id % 13 <> 0 THEN 'https://www.drushim.co.il/company/' || user_id END",
    "Job_id": "event_id || '-' || event_type || i",
    "Job_title": "'Job ' || props",
    "Job_Description": f"props || {_NL} || CASE WHEN user_id % 5 <> 0 THEN 'by ' || user_id ELSE '' END",
    "Job_Post_Date": f"CASE i WHEN 0 THEN strftime(ts, '%d/%m/%Y') ELSE {_TODAY} END",
    "Job_URL": "'https://www.drushim.co.il/job/' || event_id || '/' || event_type || i || '/'",
    "Country_Areas": "'city' || (user_id % 7) || '  '",
    "Job_categories": "event_type || ' משרה'",
}


@query("ext1_json_postings", f"{_EVENTS} {_records('Drushim', 'drushim', **_API_COLUMNS)}")
def json_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_json.extract(board_pages.api_pages(spark, sf_dir), AS_OF, first_seen=False)
    return found.select(F.col("_page").alias("page_id"), *RECORD_COLUMNS)


@query(
    "ext1_first_seen_ids",
    f"""{_EVENTS.replace("FROM events CROSS JOIN (VALUES (0), (1)) t(i))", """FROM events CROSS JOIN (VALUES (0), (1)) t(i)
           QUALIFY row_number() OVER (PARTITION BY user_id, event_type, i ORDER BY event_id) = 1)""")}
       {_records('Drushim', 'drushim', **{c: sql.replace("event_id", "user_id") for c, sql in _API_COLUMNS.items()})}""",
)
def json_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_json.extract(board_pages.api_pages(spark, sf_dir, by_user=True), AS_OF)
    return found.select(F.col("_page").alias("page_id"), *RECORD_COLUMNS)


@query(
    "src7_unknown_keys",
    """SELECT path, type, sum(times)::BIGINT AS n, min(event_id) AS first_page
       FROM events JOIN (VALUES (5, 1, '$.Promo', 'OBJECT', 1), (3, 0, '$.ResultList[].JobInfo.Salary', 'DECIMAL', 2),
                                (4, 2, '$.ResultList[].JobContent.Categories', 'STRING', 2),
                                (4, 2, '$.ResultList[].JobContent.Labels', 'ARRAY', 2)) k(every, rest, path, type, times)
         ON event_id % every = rest
       GROUP BY path, type""",
)
def unknown_json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_keys.unknown_keys(board_pages.grown_api_pages(spark, sf_dir))


@query(
    "src7_api_page_status",
    """SELECT event_id AS page, CASE WHEN event_id % 7 IN (1, 5) THEN 'broken' WHEN event_id % 7 = 2 THEN 'no_results'
              ELSE 'ok' END AS status FROM events""",
)
def api_page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_json.read_bodies(board_pages.damaged_api_pages(spark, sf_dir)).select("page", "status")


@query(
    "src7_quarantine",
    """SELECT event_id AS page, CASE event_id % 7 WHEN 2 THEN 'no_results' WHEN 4 THEN 'no_link' ELSE 'broken' END AS reason
       FROM events WHERE event_id % 7 IN (1, 2, 4, 5)""",
)
def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_json.quarantine(board_pages.damaged_api_pages(spark, sf_dir)).select("page", "reason")


@query(
    "a8_postings_per_api_page",
    """SELECT event_id AS page, event_id + 1 AS next_page, CAST(5000 AS BIGINT) AS total_pages, CAST(2 AS BIGINT) AS n
       FROM events""",
)
def postings_per_api_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_json.page_totals(board_pages.api_pages(spark, sf_dir))


# ---- HTML boards ----


def _read_back(pages: DataFrame, site: str) -> DataFrame:
    return extract_html.extract(pages, site, AS_OF).select("page_id", *RECORD_COLUMNS)


_ALLJOBS_URL = f"'{extract_html.ALLJOBS_JOB.format('')}' || job"


@query(
    "ext2_alljobs_postings",
    f"""{_EVENTS} {_records(
        "AllJobs",
        "alljobs",
        job_class="'full time'",
        Company=f'''CASE user_id % 11 WHEN 0 THEN '{extract_html.CONFIDENTIAL}' WHEN 1 THEN 'box ' || user_id || ' name'
                   ELSE 'c' || user_id || ' & co' END''',
        Company_jobs=f'''CASE WHEN user_id % 5 <> 0 THEN 'https://www.alljobs.co.il/Employer/?id=' || user_id || '&x=1'
                         ELSE {_ALLJOBS_URL} END''',
        Job_id="CAST(job AS VARCHAR)",
        Job_title="'Job ' || props",
        Job_Description=f"'by ' || user_id || {_NL} || props || ' for ' || event_type || {_NL}",
        Job_Post_Date=f'''CASE WHEN i = 1 THEN strftime(ts, '%d/%m/%Y') WHEN user_id = 0 THEN 'ימים' ELSE {_AGO} END''',
        Job_URL=_ALLJOBS_URL,
        Country_Areas="CASE event_id % 3 WHEN 0 THEN 'North, South' ELSE area END",
        Job_categories="''",
    )}""",
)
def alljobs_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(board_pages.alljobs_pages(spark, sf_dir), "AllJobs")


@query(
    "ext3_jobmaster_postings",
    f"""{_EVENTS} {_records(
        "JobMaster",
        "jobmaster",
        Company="CASE user_id % 11 WHEN 0 THEN 'hidden ' || event_type ELSE 'c' || user_id || ' & co' END",
        Company_jobs="CASE WHEN user_id % 5 <> 0 THEN 'https://www.jobmaster.co.il/co/' || user_id || '?x=1' END",
        Job_id="CAST(job AS VARCHAR)",
        Job_title="'Job ' || props",
        Job_Description=f'''area || event_type || ' job ' || {_NL} || 'by ' || user_id || {_NL} ||
            CASE i WHEN 0 THEN 'לפני ' || user_id || ' ימים' ELSE 'חדש' END || {_NL}'''.replace(
            "area || event_type || ' job '", "area || ' ' || event_type || ' job'"),
        Job_Post_Date=f'''CASE WHEN i = 1 THEN {_TODAY} WHEN user_id = 0 THEN 'לפני 0 ימים' ELSE {_AGO} END''',
        Job_URL=f"'{extract_html.JOBMASTER_JOB.format('')}' || job",
        Country_Areas="area",
        Job_categories="event_type || ' job'",
    )}""",
)
def jobmaster_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(board_pages.jobmaster_pages(spark, sf_dir), "JobMaster")


_JOBNET_ID = "CASE WHEN user_id % 6 <> 0 THEN CAST(job AS VARCHAR) ELSE '' END"


@query(
    "ext4_jobnet_postings",
    f"""{_EVENTS} {_records(
        "JobNet",
        "jobnet",
        Company="'c' || user_id || ' & co' || CASE WHEN user_id % 5 <> 0 THEN ' more' ELSE '' END",
        Company_jobs="CASE WHEN user_id % 5 <> 0 THEN 'http://www.jobnet.co.il/co/' || user_id ELSE '' END",
        Job_id=_JOBNET_ID,
        Job_title="'Job ' || props",
        Job_Description=f"'by ' || user_id || CASE WHEN user_id % 4 <> 0 THEN {_NL} || event_type ELSE '' END",
        Job_Post_Date="strftime(ts, '%d/%m/%Y')",
        Job_URL="CASE WHEN user_id % 6 <> 0 THEN 'http://www.jobnet.co.il/jobs?x=1&positionid=' || job ELSE '' END",
        Country_Areas="area",
        Job_categories="event_type",
    )}""",
)
def jobnet_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(board_pages.jobnet_pages(spark, sf_dir), "JobNet")


@query(
    "ext5_drushim_postings",
    f"""{_EVENTS} {_records(
        "Drushim",
        "drushim",
        Company="'c' || user_id || ' & co .'",
        Company_jobs="'/co/' || user_id",
        Job_id="event_type || '-' || job",
        Job_title="'Job ' || props",
        Job_Description="'by ' || user_id || event_type",
        Job_Post_Date=f'''CASE WHEN i = 1 THEN '' WHEN user_id = 0 THEN 'לפני 0 ימים' ELSE {_AGO} END''',
        Job_URL="'https://www.drushim.co.il/job/' || event_type || '/' || job",
        Country_Areas="area",
        Job_categories="CASE i WHEN 0 THEN event_type ELSE '' END",
    ).replace("FROM e)", "FROM e WHERE user_id % 6 <> 0)")}""",
)
def drushim_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(board_pages.drushim_pages(spark, sf_dir), "Drushim")


@query(
    "u6_box_lists_in_order",
    "SELECT event_id AS page_id, i AS pos, event_id * 2 + i AS job FROM events CROSS JOIN (VALUES (0), (1)) t(i)",
)
def box_lists_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open boxes come before organic ones."""
    found = extract_html.extract(board_pages.alljobs_pages(spark, sf_dir), "AllJobs", AS_OF)
    return found.select("page_id", "pos", F.col("Job_id").cast("bigint").alias("job"))


# ---- Links and pagers ----

_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script>|\z)|<style\b.*?(?:</style>|\z)"


@query(
    "ext6_outlinks",
    f"""SELECT page_id, CAST(pos - 1 AS INTEGER) AS position, href,
               CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
                    WHEN href LIKE '/%' THEN regexp_extract(url, '^https?://[^/]+') || href ELSE '?' END AS target
        FROM (SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS pos
              FROM (SELECT page_id, url, [replace(h, '&amp;', '&') FOR h IN
                      regexp_extract_all(regexp_replace(html, '{_HIDDEN}', '', 'g'), '<a [^>]*href="([^"]*)"', 1)] AS hrefs
                    FROM pages))""",
)
def outlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.outlinks(table(spark, sf_dir, "pages"))


@query(
    "ext6_links_by_pattern",
    """SELECT page_id, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href
         FROM pages) WHERE contains(href, 'er') GROUP BY 1""",
)
def links_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.outlinks(table(spark, sf_dir, "pages"), "er").groupBy("page_id").agg(F.count("*").alias("n"))


@query(
    "ext7_page_numbers",
    """SELECT page_id, selected, array_to_string(listed, ',') AS listed,
              CASE WHEN selected <> page_id % 50 THEN selected WHEN len(listed) > 0 AND listed[1] = selected + 1
                   THEN selected + 1 END AS next_page
       FROM (SELECT event_id AS page_id, event_id % 50 + (user_id % 10 = 0)::INTEGER AS selected,
                    CASE WHEN user_id % 3 <> 0 THEN [event_id % 50 + 1] ELSE [] END AS listed FROM events)""",
)
def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.page_numbers(board_pages.jobnet_pages(spark, sf_dir))
    return found.withColumn("listed", F.array_join(F.col("listed").cast("array<string>"), ","))


# ---- A board of one's own, over the saved pages ----

WEB = Board(
    records=((Step("article"),),),
    fields={
        "title": Field((Step("h1"),)),
        "paragraphs": Field((Step("p"),), only_first=False),
        "lang": Field((Step("p"),), "@lang"),
    },
    page_fields={"page_title": Field((Step("title"),)), "nav": Field((Step("nav"), Step("a")), "@href", only_first=False)},
)


@query(
    "x1_own_board_over_pages",
    """SELECT page_id, url, len(regexp_extract_all(html, '<nav>.*</nav>')) AS navs,
              len(regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<a ')) AS nav_links
       FROM pages WHERE contains(html, '<article')""",
)
def own_board_over_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the page's navigation, one row per article."""
    raw = raw_records(table(spark, sf_dir, "pages"), WEB)
    nav = F.size(F.col("nav")).cast("bigint")
    return raw.select("page_id", "url", (nav > 0).cast("bigint").alias("navs"), nav.alias("nav_links"))


# ---- A board of one's own that gives records ----

ARTICLES = Board(
    records=((Step("article"),),),
    fields={
        "id": Field((), "@id"),
        "title": Field((Step("h1"),)),
        "paragraphs": Field((Step("p"),), only_first=False),
    },
    page_fields={"base": Field((Step("link", "rel", equals="canonical"),), "@href")},
)


def _article_fields(as_of) -> dict:
    number = F.col("number")
    return {
        "Company": F.lit(None).cast("string"),
        "Company_jobs": F.col("page_base"),
        "Job_id": F.coalesce(number, F.lit("")),
        "Job_title": normalize_space(F.col("title")),
        "Job_Description": F.array_join("paragraphs", "|"),
        "Job_Post_Date": F.lit(as_of.strftime("%d/%m/%Y")),
        "Job_URL": F.concat(F.col("page_base"), F.lit("#"), number),
        "Country_Areas": F.lit(""),
        "Job_categories": F.lit(""),
        "AllJobs_Job_class": F.lit(""),
    }


@query(
    "x1_article_titles",
    f"""{_EVENTS} {_records(
        "Articles",
        "articles",
        Company="CAST(NULL AS VARCHAR)",
        Company_jobs="'https://blog.example/' || event_type",
        Job_id="CAST(job AS VARCHAR)",
        Job_title="'Title ' || props",
        Job_Description="'by ' || user_id || '|' || props || ' & more'",
        Job_Post_Date=_TODAY,
        Job_URL="'https://blog.example/' || event_type || '#' || job",
        Country_Areas="''",
        Job_categories="''",
    )}""",
)
def article_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of a board added with ``register_board``."""
    extract_html.register_board("Articles", "articles", ARTICLES, _article_fields)
    return _read_back(board_pages.article_pages(spark, sf_dir), "Articles")


# ---- All boards in one pass ----


def _all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of the four HTML boards in one table, every page with the name of its board."""
    boards = {
        "AllJobs": board_pages.alljobs_pages,
        "JobMaster": board_pages.jobmaster_pages,
        "JobNet": board_pages.jobnet_pages,
        "Drushim": board_pages.drushim_pages,
    }
    parts = [pages(spark, sf_dir).withColumn("site", F.lit(site)) for site, pages in boards.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "ext2_to_ext5_in_one_pass",
    """WITH e AS (SELECT *, event_id * 2 + i AS job FROM events CROSS JOIN (VALUES (0), (1)) t(i))
       SELECT 'AllJobs' AS "Site", event_id AS page_id, CAST(job AS VARCHAR) AS "Job_id", 'Job ' || props AS "Job_title" FROM e
       UNION ALL SELECT 'JobMaster', event_id, CAST(job AS VARCHAR), 'Job ' || props FROM e
       UNION ALL SELECT 'JobNet', event_id, CASE WHEN user_id % 6 <> 0 THEN CAST(job AS VARCHAR) ELSE '' END, 'Job ' || props FROM e
       UNION ALL SELECT 'Drushim', event_id, event_type || '-' || job, 'Job ' || props FROM e WHERE user_id % 6 <> 0""",
)
def all_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_html.extract_all(_all_pages(spark, sf_dir), AS_OF)
    return found.select("Site", "page_id", "Job_id", "Job_title")


# ---- Links that are written in many ways ----


@query(
    "ext6_awkward_links",
    """SELECT event_id AS page_id, position, href, target FROM events, LATERAL (
         SELECT unnest([0, 1, 2, 3, 4, 5]) AS position,
           unnest(['/plain/' || event_id, '/gt/' || user_id, '/q?a=' || event_id || '&b=' || chr(39) || event_type || chr(39),
                   'rel/' || user_id, '//other.example/' || event_type, '#top' || event_id]) AS href,
           unnest(['https://boards.example/plain/' || event_id, 'https://boards.example/gt/' || user_id,
                   'https://boards.example/q?a=' || event_id || '&b=' || chr(39) || event_type || chr(39),
                   'https://boards.example/list/' || event_type || '/rel/' || user_id,
                   'https://other.example/' || event_type,
                   'https://boards.example/list//' || event_type || '/page#top' || event_id]) AS target)""",
)
def awkward_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.outlinks(board_pages.link_pages(spark, sf_dir))


@query(
    "ext6_next_page_links",
    """SELECT event_id AS page_id, CASE WHEN event_id % 4 <> 0 THEN '?page=' || (event_id + 1) || '&type=' END AS href,
              CASE WHEN event_id % 4 <> 0 THEN 'https://www.alljobs.co.il/SearchResultsGuest.aspx?page=' || (event_id + 1) || '&type=' END AS target
       FROM events""",
)
def next_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.next_page_links(board_pages.alljobs_pages(spark, sf_dir), "AllJobs")


_LOCATIONS = """WITH l AS (SELECT user_id % 7 AS region, day(ts) AS day, dense_rank() OVER (PARTITION BY user_id % 7 ORDER BY day(ts)) - 1 AS sub
                           FROM events)"""


def location_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, location_id, target) of the region pages that the events give."""
    return links.sub_region_links(board_pages.region_pages(spark, sf_dir))


@query(
    "ext6_location_ids",
    f"""{_LOCATIONS} SELECT DISTINCT region AS page_id, region || '_' || sub AS location_id,
          'https://www.jobmaster.co.il/jobs/?l=' || region || '-' || day AS target FROM l""",
)
def location_ids_of_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return location_ids(spark, sf_dir)


def _with_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the location id of the sub-region link that they were found by."""
    link = F.concat(F.lit("https://www.jobmaster.co.il/jobs/?l="), F.col("user_id") % 7, F.lit("-"), F.dayofmonth("ts"))
    return table(spark, sf_dir, "events").select("event_id", link.alias("target")).join(location_ids(spark, sf_dir), "target")


@query("a9_postings_per_linked_region", f"{_LOCATIONS} SELECT region || '_' || sub AS location_id, count(*) AS n FROM l GROUP BY 1")
def postings_per_linked_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.postings_per_region(_with_location(spark, sf_dir))


@query("a14_linked_region_count", f"{_LOCATIONS} SELECT count(DISTINCT region || '_' || sub) AS regions FROM l")
def linked_region_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.region_count(_with_location(spark, sf_dir))
