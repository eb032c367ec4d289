"""Column functions over whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.functions import dates, text, urls
from snapwatch.plans.registry import AS_OF, query
from snapwatch.plans.views import V_RELDATE, reldate_sql, table, v_reldate
from snapwatch.schema import SITE_BY_TITLE

_TODAY = "'15/01/2024'"


# ---- Dates ----


def _reldate(spark: SparkSession, sf_dir: str, today: bool = False) -> DataFrame:
    rows = v_reldate(spark, sf_dir)
    return rows.select("event_id", "txt", dates.relative_date(F.col("txt"), AS_OF, today).alias("posted"))


@query("s1_relative_date_drushim", f"WITH {V_RELDATE} SELECT event_id, txt, {reldate_sql(chr(39) * 2)} AS posted FROM v_reldate")
def relative_date_or_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reldate(spark, sf_dir)


@query(
    "s1_relative_date_alljobs",
    f"WITH {V_RELDATE} SELECT event_id, txt, {reldate_sql(chr(39) * 2, last_token=True)} AS posted FROM v_reldate",
)
def relative_date_last_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reldate(spark, sf_dir).withColumn("posted", text.last_token(F.col("posted")))


@query("s1_relative_date_jobmaster", f"WITH {V_RELDATE} SELECT event_id, txt, {reldate_sql(_TODAY)} AS posted FROM v_reldate")
def relative_date_or_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reldate(spark, sf_dir, today=True)


@query(
    "s2_absolute_date",
    f"SELECT event_id, CASE event_id % 7 WHEN 6 THEN {_TODAY} ELSE strftime(ts, '%d/%m/%Y') END AS posted FROM events",
)
def absolute_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's day in one of several layouts, read back."""
    shape = F.col("event_id") % 7
    layouts = ("yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy", "yyyy-MM-dd", "d MMM yyyy", "MMMM d, yyyy", "yyyyMMdd")
    written = F.lit("no date")
    for i, layout in enumerate(layouts):
        written = F.when(shape == i, F.date_format("ts", layout)).otherwise(written)
    return table(spark, sf_dir, "events").select("event_id", dates.post_date(written, AS_OF).alias("posted"))


@query(
    "s2_more_absolute_dates",
    """SELECT event_id, CASE event_id % 6 WHEN 5 THEN '15/01/2024' WHEN 3 THEN '15/' || strftime(ts, '%m/%Y')
              ELSE strftime(ts, '%d/%m/%Y') END AS posted, event_id % 6 = 5 AS unread FROM events""",
)
def more_absolute_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of two digits, compact times, a month alone, and texts that are no date and reported as such."""
    shape = F.col("event_id") % 6
    written = F.lit("no date")
    for i, layout in enumerate(("M/d/yy", "d MMMM yy", "yyyyMMdd'T'HHmmss", "MMM yyyy", "d-MMM-yy")):
        written = F.when(shape == i, F.date_format("ts", layout)).otherwise(written)
    return table(spark, sf_dir, "events").select(
        "event_id", dates.post_date(written, AS_OF).alias("posted"), dates.unread_date(written, AS_OF).alias("unread")
    )


@query(
    "s22_day_layouts",
    """SELECT event_id, strftime(ts, '%d/%m/%Y') AS data_day, strftime(ts, '%Y_%m_%d') AS file_day,
              strftime(ts, '%d-%m-%y') AS dump_day, CAST(ts AS DATE) AS back FROM events""",
)
def day_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            F.date_format("ts", dates.DATA_DAY).alias("data_day"),
            F.date_format("ts", dates.FILE_DAY).alias("file_day"),
            F.date_format("ts", dates.DUMP_DAY).alias("dump_day"),
        )
        .withColumn("back", dates.to_day(F.col("data_day")))
    )


@query(
    "s23_day_arithmetic",
    """SELECT event_id, CAST(ts AS DATE) - 1 AS day_before, CAST(ts AS DATE) + 1 AS day_after,
              CAST(ts AS DATE) BETWEEN DATE '2024-01-15' - 7 AND DATE '2024-01-15' AS in_last_8 FROM events""",
)
def day_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_sub(day, 1).alias("day_before"),
        F.date_add(day, 1).alias("day_after"),
        day.isin(dates.last_days(AS_OF, 8)).alias("in_last_8"),
    )


# ---- Texts ----


@query(
    "s3_first_digits",
    "SELECT doc_id, nullif(regexp_extract(text, '([0-9]+)', 1), '') AS digits FROM documents",
)
def first_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.first_digits(F.col("text")).alias("digits"))


@query(
    "s4_normalized_space",
    """SELECT page_id, trim(regexp_replace(html, '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS clean FROM pages""",
)
def normalized_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.normalize_space(F.col("html")).alias("clean"))


_BLANKS = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(
    "s5_stripped",
    f"""SELECT doc_id, regexp_replace(regexp_replace(padded, '^{_BLANKS}+', ''), '{_BLANKS}+$', '') AS stripped
        FROM (SELECT doc_id, chr(160) || '  ' || text || chr(9) || chr(8195) AS padded FROM documents)""",
)
def stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("   "), F.col("text"), F.lit("\t "))
    return table(spark, sf_dir, "documents").select("doc_id", text.strip(padded).alias("stripped"))


@query(
    "s6_stripped_character",
    "SELECT page_id, trim(regexp_replace(url, '^https?:', ''), '/') AS bare FROM pages",
)
def stripped_character(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.regexp_replace("url", "^https?:", "")
    return table(spark, sf_dir, "pages").select("page_id", text.strip_char(rest, "/").alias("bare"))


@query(
    "s7_split_and_last",
    """SELECT page_id, split_part(url, '/', -1) AS last_part, split_part(url, '/', 3) AS host,
              array_to_string(string_split(url, '/')[-2:], '-') AS last_two FROM pages""",
)
def split_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("url", "/")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.last_token(F.col("url"), "/").alias("last_part"),
        F.get(parts, F.lit(2)).alias("host"),
        F.array_join(text.last_n(parts, 2), "-").alias("last_two"),
    )


@query(
    "s8_joined_lists",
    """SELECT conv_id, turn, array_to_string([coalesce(nullif(w, 'the'), '') FOR w IN string_split(text, ' ')], '-') AS joined
       FROM conversations""",
)
def joined_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each turn; one word is blanked and keeps its place."""
    words = F.transform(F.split("text", " "), lambda w: F.nullif(w, F.lit("the")))
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", text.join_list(words, "-").alias("joined"))


@query(
    "s9_filled_templates",
    """SELECT event_id, 'https://example.org/job?key=' || event_id || '&x=1' AS link,
              'alljobs_' || coalesce(CASE WHEN user_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END, '') AS unique_id FROM events""",
)
def filled_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    job_id = F.when(F.col("user_id") % 11 != 0, F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.fill("https://example.org/job?key={}&x=1", F.col("event_id").cast("string")).alias("link"),
        text.unique_id("alljobs", job_id).alias("unique_id"),
    )


@query(
    "s14_whole_numbers",
    """SELECT page_id, regexp_full_match(part, '[0-9]+') AS digits, CASE WHEN regexp_full_match(part, '[0-9]+')
              THEN CAST(part AS BIGINT) END AS number
       FROM (SELECT page_id, split_part(split_part(url, '/', 5), '?', 1) AS part FROM pages)""",
)
def whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.substring_index(F.get(F.split("url", "/"), F.lit(4)), "?", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", text.is_digits(part).alias("digits"), text.to_int(part).alias("number")
    )


@query(
    "s16_first_non_empty",
    """SELECT event_id, CASE WHEN user_id % 3 = 0 AND props <> '' THEN props WHEN user_id % 5 <> 0 THEN event_type
              ELSE 'חברה חסויה' END AS name FROM events""",
)
def first_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.col("user_id") % 3 == 0, F.col("props")).otherwise("")
    second = F.when(F.col("user_id") % 5 != 0, F.col("event_type"))
    name = text.first_non_empty(first, second, F.lit("חברה חסויה"))
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"))


@query(
    "s17_nested_default",
    """SELECT event_id, coalesce(CAST(props->>'k' AS VARCHAR), '') AS k, coalesce(props->>'missing', 'none') AS missing
       FROM events""",
)
def nested_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k string, missing string")
    return table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(parsed["k"], F.lit("")).alias("k"), F.coalesce(parsed["missing"], F.lit("none")).alias("missing")
    )


@query(
    "s18_mapped_and_filtered_list",
    """SELECT doc_id, array_to_string([lower(x) FOR x IN string_split(text, ' ') IF length(lower(x)) > 7], ' ') AS long_words
       FROM documents""",
)
def mapped_and_filtered_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.transform(F.split("text", " "), F.lower), lambda w: F.length(w) > 7)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(words, " ").alias("long_words"))


@query(
    "f9_non_empty_members",
    "SELECT doc_id, len([x FOR x IN string_split(text, ' ') IF x <> '']) AS words FROM documents",
)
def non_empty_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split("text", " "), lambda w: w != "")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(words).cast("bigint").alias("words"))


@query(
    "s19_between_markers",
    "SELECT event_id, '/co/' || user_id || '?t=' || event_type AS path FROM events",
)
def between_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.concat(
        F.lit("log('x');window.open('/co/"), F.col("user_id"), F.lit("?t="), F.col("event_type"), F.lit("','_blank')")
    )
    path = text.strip_char(text.between_markers(call, "window.open(", ","), "'")
    return table(spark, sf_dir, "events").select("event_id", path.alias("path"))


@query("s20_trailing_slash", "SELECT page_id, regexp_replace(url, '/$', '') AS url FROM pages")
def trailing_slash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.cut_trailing_slash(F.col("url")).alias("url"))


@query(
    "s21_bar_fields",
    """SELECT event_id, event_type AS area, CASE event_id % 2 WHEN 0 THEN 'kind ' || user_id ELSE '' END AS category,
              CASE event_id % 2 WHEN 0 THEN strftime(ts, '%d/%m/%Y') ELSE '' END AS posted FROM events""",
)
def bar_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four parts for even events, two for the others."""
    two = F.concat_ws(" | ", F.col("event_type"), F.lit("full time"))
    four = F.concat_ws(
        "|", two, F.concat(F.lit(" kind "), F.col("user_id"), F.lit(" ")), F.date_format("ts", " dd/MM/yyyy ")
    )
    area, category, posted = text.bar_fields(F.when(F.col("event_id") % 2 == 0, four).otherwise(two))
    return table(spark, sf_dir, "events").select(
        "event_id", area.alias("area"), category.alias("category"), posted.alias("posted")
    )


_SITE_CASES = " ".join(f"WHEN '{title.lower()}' THEN '{site}'" for title, site in SITE_BY_TITLE.items())


@query(
    "s24_site_of_name",
    f"""SELECT event_id, CASE lower(name) {_SITE_CASES} END AS site
        FROM (SELECT event_id, CASE user_id % 5 WHEN 0 THEN 'DRUSHIM' WHEN 1 THEN 'allJobs' WHEN 2 THEN 'jobmaster'
                     WHEN 3 THEN 'JobNet' ELSE event_type END AS name FROM events)""",
)
def site_of_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    spellings = F.array(*(F.lit(x) for x in ("DRUSHIM", "allJobs", "jobmaster", "JobNet")))
    name = F.coalesce(F.get(spellings, (F.col("user_id") % 5).cast("int")), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", text.site_of_name(name, SITE_BY_TITLE).alias("site"))


@query(
    "s26_lines_of_parts",
    """SELECT doc_id, array_to_string([x || chr(10) FOR x IN p[3:]], '') AS from_third,
              array_to_string([x || chr(10) FOR x IN p IF x <> ''], '') AS non_empty
       FROM (SELECT doc_id, [trim(regexp_replace(x, '[ \\t\\r\\n]+', ' ', 'g'), ' ') FOR x IN string_split(text, chr(10))] AS p
             FROM documents)""",
)
def lines_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.lines_of(parts, skip=2).alias("from_third"),
        text.lines_of(parts, keep_empty=False).alias("non_empty"),
    )


@query("s27_id_as_text", "SELECT event_id, CAST(user_id AS VARCHAR) AS \"Job_id\" FROM events")
def id_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("Job_id"))


@query(
    "o5_first_and_last_members",
    """SELECT doc_id, w[1] AS first, w[-1] AS last, array_to_string(w[-2:], ' ') AS last_two
       FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""",
)
def first_and_last_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.first_of(words).alias("first"),
        text.last_of(words).alias("last"),
        F.array_join(text.last_n(words, 2), " ").alias("last_two"),
    )


# ---- Links ----

_LINK_SHAPES = """SELECT event_id, 'https://jobs.example.org/list/it/page.html?page=' || user_id || '#top' AS base,
    CASE event_id % 9 WHEN 0 THEN '/job/' || user_id WHEN 1 THEN 'job' || user_id || '.html' WHEN 2 THEN '?p=' || user_id
      WHEN 3 THEN '//cdn.example.org/' || user_id WHEN 4 THEN 'http://other.example.com/' || user_id || '?a=1'
      WHEN 5 THEN '../' || user_id WHEN 6 THEN './a/../' || user_id || '?q=..' WHEN 7 THEN '#job' || user_id END AS href
  FROM events"""


@query(
    "s10_absolute_links",
    f"""SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'https://jobs.example.org' || href
           WHEN 1 THEN 'https://jobs.example.org/list/it/' || href WHEN 2 THEN 'https://jobs.example.org/list/it/page.html' || href
           WHEN 3 THEN 'https:' || href WHEN 4 THEN href WHEN 5 THEN 'https://jobs.example.org/list/' || substr(href, 4)
           WHEN 6 THEN 'https://jobs.example.org/list/it/' || substr(href, 8)
           WHEN 7 THEN split_part(base, '#', 1) || href ELSE base END AS link
        FROM ({_LINK_SHAPES})""",
)
def absolute_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, shape = F.col("user_id").cast("string"), F.col("event_id") % 9
    templates = (
        "/job/{}",
        "job{}.html",
        "?p={}",
        "//cdn.example.org/{}",
        "http://other.example.com/{}?a=1",
        "../{}",
        "./a/../{}?q=..",
        "#job{}",
    )
    href = F.lit(None).cast("string")
    for i, template in enumerate(templates):
        href = F.when(shape == i, text.fill(template, user)).otherwise(href)
    base = text.fill("https://jobs.example.org/list/it/page.html?page={}#top", user)
    return table(spark, sf_dir, "events").select("event_id", urls.url_join(base, href).alias("link"))


@query(
    "s11_s12_query_parameter",
    """SELECT page_id, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
              coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '1') AS page FROM pages""",
)
def query_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.query_param(url, "ref").alias("ref"), urls.query_param_or(url, "page", "1").alias("page")
    )


@query(
    "s13_next_page_link",
    """SELECT page_id, CASE WHEN p <> '' THEN replace(url, 'page=' || p, 'page=' || (CAST(p AS BIGINT) + 1)) END AS next_url
       FROM (SELECT page_id, url, regexp_extract(url, '[?&]page=([0-9]+)', 1) AS p FROM pages)""",
)
def next_page_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.next_page_url(F.col("url")).alias("next_url"))


@query(
    "s15_unless_marked",
    "SELECT page_id, CASE WHEN contains(url, '?page=') THEN 'job/' || page_id ELSE url END AS link FROM pages",
)
def unless_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = text.fill("job/{}", F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.unless_marked(F.col("url"), "?page=", job).alias("link")
    )
