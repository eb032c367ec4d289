"""Column functions against hand-written expectations and the Python standard library."""

import datetime as dt
from urllib.parse import urljoin

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from snapwatch.functions import dates, text, urls
from snapwatch.schema import SITE_BY_TITLE

RELATIVE = [
    # text, Drushim and AllJobs, JobMaster
    ("לפני 5 ימים", "10/01/2024", "10/01/2024"),
    ("לפני 2 יְוֹם", "13/01/2024", "13/01/2024"),
    ("לפני 3 שעות", "15/01/2024", "15/01/2024"),
    ("לפני 30 דקות 4 ימים", "16/12/2023", "16/12/2023"),
    ("לפני 0 ימים", "לפני 0 ימים", "לפני 0 ימים"),
    ("לפני 7 שבועות", "לפני 7 שבועות", "לפני 7 שבועות"),
    ("12/05/2016", "12/05/2016", "12/05/2016"),
    ("לפני דקה", "15/01/2024", "15/01/2024"),
    ("לפני שעה", "", "15/01/2024"),
    ("abc", "", "15/01/2024"),
    ("", "", "15/01/2024"),
    (None, "", "15/01/2024"),
    ("לפני 9999999 ימים", "", "15/01/2024"),
    ("לפני 99999999999999999999 ימים", "", "15/01/2024"),
    ("לפני 99999999999999999999 שעות", "15/01/2024", "15/01/2024"),
    ("לפני 5 שָׁעָה", "15/01/2024", "15/01/2024"),
]


def test_relative_date(apply):
    texts = [t for t, _, _ in RELATIVE]
    assert apply(lambda c: dates.relative_date(c, AS_OF), texts) == [x for _, x, _ in RELATIVE]
    assert apply(lambda c: dates.relative_date(c, AS_OF, otherwise_today=True), texts) == [x for _, _, x in RELATIVE]


def test_relative_date_at_the_first_day_of_the_calendar(apply):
    days = AS_OF.toordinal() - 1
    got = apply(lambda c: dates.relative_date(c, AS_OF), [f"לפני {days} ימים", f"לפני {days + 1} ימים"])
    assert got == ["01/01/1", ""]


def test_last_token_of_relative_date(apply):
    cut = lambda c: text.last_token(dates.relative_date(c, AS_OF))
    assert apply(cut, ["לפני 0 ימים", "לפני 5 ימים", None]) == ["ימים", "10/01/2024", ""]


ABSOLUTE = {
    "05/10/2016": "10/05/2016",  # month first
    "25/12/2016": "25/12/2016",  # no such month, so day first
    "2024-01-03T23:30:00+02:00": "03/01/2024",  # the zone does not shift the day
    "2024-01-03 10:00": "03/01/2024",
    "2024/02/29": "29/02/2024",
    "20240229": "29/02/2024",
    "3 Jan 2024": "03/01/2024",
    "January 3, 2024": "03/01/2024",
    "2023-02-30": "15/01/2024",
    "soon": "15/01/2024",
    "": "15/01/2024",
    None: "15/01/2024",
}


def test_post_date(apply):
    assert apply(lambda c: dates.post_date(c, AS_OF), list(ABSOLUTE)) == list(ABSOLUTE.values())


def test_post_date_agrees_with_dateutil(apply):
    parser = pytest.importorskip("dateutil.parser")
    texts = ["1/2/2024", "13/2/2024", "2.3.2024", "2024-12-31T00:00:00Z", "2024-12-31T05:06:07.123", "31-12-2024", "4 March 2024",
             "Mon, 15 Jan 2024 10:00:00 GMT", "Jan 15 2024", "15-Jan-2024", "Sunday, February 4th, 2024 3:05 PM", "4 sep. 2023", "MAY 1, 2024"]
    assert apply(lambda c: dates.post_date(c, AS_OF), texts) == [parser.parse(t).strftime("%d/%m/%Y") for t in texts]


def test_day_layouts(spark):
    row = spark.range(1).select(
        F.date_format(F.lit(AS_OF), dates.DATA_DAY),
        F.date_format(F.lit(AS_OF), dates.FILE_DAY),
        F.date_format(F.lit(AS_OF), dates.DUMP_DAY),
        dates.to_day(F.lit("15/01/2024")),
        dates.to_day(F.lit("not a day")),
    ).first()
    assert tuple(row) == ("15/01/2024", "2024_01_15", "15-01-24", AS_OF, None)
    assert dates.last_days(AS_OF, 2) == [AS_OF, dt.date(2024, 1, 14)]


def test_artifact_day(apply):
    names = ["2024_01_15_Drushim.xlsx", "scrapy_log_output_2024-01-05.txt", "notes.txt"]
    assert apply(dates.artifact_day, names) == ["2024_01_15", "2024_01_05", "notes.txt"]


def test_first_digits(apply):
    assert apply(text.first_digits, ["ab12c34", "none", "", None]) == ["12", None, None, None]


def test_normalize_space_keeps_the_no_break_space(apply):
    assert apply(text.normalize_space, [" a \t\r\n b ", " a ", "", None]) == ["a b", " a ", "", None]


def test_strip_cuts_what_python_cuts(apply):
    samples = ["  a b  \t", "\x1c\x1fx\x85", "　", "", "plain"]
    assert apply(text.strip, samples) == [s.strip() for s in samples]


def test_strip_char(apply):
    assert apply(lambda c: text.strip_char(c, "/"), ["//a/b/", "a", "///"]) == ["a/b", "a", ""]


def test_last_n_keeps_short_lists(apply):
    joined = lambda c: F.array_join(text.last_n(F.split(c, "/"), 2), "-")
    assert apply(joined, ["a/b/c", "a/b", "a", ""]) == ["b-c", "a-b", "a", ""]


def test_join_list_keeps_empty_members(spark):
    row = spark.sql("SELECT array('c1', '', NULL) a, array() e").select(text.join_list(F.col("a"), " "), text.join_list(F.col("e"), " "))
    assert tuple(row.first()) == ("c1  ", "")


def test_lines_of(spark):
    parts = spark.sql("SELECT array(' a ', 'b', '', 'c  d') p, array('a') short, cast(array() as array<string>) none")
    row = parts.select(
        text.lines_of(F.col("p"), skip=2), text.lines_of(F.col("p"), keep_empty=False),
        text.lines_of(F.col("short"), skip=2), text.lines_of(F.col("none")),
    ).first()
    assert tuple(row) == ("\nc d\n", "a\nb\nc d\n", "", "")


def test_between_markers(apply):
    pick = lambda c: text.strip_char(text.between_markers(c, "window.open(", ","), "'")
    samples = ["x;window.open('/co/1','_blank')", "window.open('/a',1);window.open('/b',2)", "other('/c',3)"]
    expected = [s.split("window.open(")[-1].split(",")[0].strip("'") for s in samples]
    assert apply(pick, samples) == expected


def test_bar_fields(apply):
    whole = lambda c: F.concat_ws("/", *text.bar_fields(c))
    assert apply(whole, ["a | b | c | d", "a|b", "a|b|c|d|e", "", None]) == ["a/c/d", "a//", "a//", "//", "//"]


def test_numbers(apply):
    assert apply(text.is_digits, ["12", "1a", "", None]) == [True, False, False, False]
    assert apply(text.to_int, [" 12 ", "1a", "", None, "-3"]) == [12, None, None, None, -3]


def test_site_of_name(apply):
    assert apply(lambda c: text.site_of_name(c, SITE_BY_TITLE), ["ALLJOBS", "jobNet", "other", None]) == [
        "AllJobs", "JobNet", None, None,
    ]


def test_empty_ids_share_one_key(apply):
    assert apply(lambda c: text.unique_id("jobnet", c), ["7", "", None]) == ["jobnet_7", "jobnet_", "jobnet_"]


BASES = ["http://x.org/a//b/", "https://x.org//a///b//c.html", "https://a.example/x/y.html?q=1", "http://b.example", "https://a.example/x/y/", "https://a.example/?page=2#f"]
LINKS = [
    "/abs", "rel", "rel/deep?z=1", "?only=1", "#frag", "//c.example/p", "http://d.example/q?a=b#c", "../up", "../../../up",
    "./here", "a/../b", "a/./b/..", "..", ".", "", "mailto:x@example.org", "/a/../b/./c", "javascript:void(0)", "x?y=../z",
]


def test_url_join_agrees_with_the_standard_library(spark):
    pairs = [(b, link) for b in BASES for link in LINKS]
    got = spark.createDataFrame(pairs, "b string, l string").select("b", "l", urls.url_join(F.col("b"), F.col("l")).alias("u"))
    wrong = [(r.b, r.l, r.u, urljoin(r.b, r.l)) for r in got.collect() if r.u != urljoin(r.b, r.l)]
    assert wrong == []


def test_url_join_without_link(apply):
    assert apply(lambda c: urls.url_join(c, F.lit(None).cast("string")), ["http://a.example/x"]) == ["http://a.example/x"]


def test_query_param(apply):
    links = ["/x?page=3&a=1", "/x?a=1&page=%D7%90+b#page=9", "/x?page=&page=2", "/x?mypage=2", "/x#page=2", "", None]
    assert apply(lambda c: urls.query_param(c, "page"), links) == ["3", "א b", "2", None, None, None, None]
    assert apply(lambda c: urls.query_param_or(c, "page", "1"), ["/x"]) == ["1"]


def test_next_page_url(apply):
    links = ["/s?page=9&x=1", "/s?page=a", "/s", "/s?page=1&backpage=1"]
    assert apply(urls.next_page_url, links) == ["/s?page=10&x=1", None, None, "/s?page=2&backpage=2"]


def test_bad_input_never_raises_with_ansi_on(spark, apply):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    odd = ["", " ", "%zz", "\\", "a|b", "99999999999999999999999", "http://[bad", "31/02/2024", None]
    for function in (
        text.first_digits, text.to_int, text.strip, text.normalize_space, urls.next_page_url,
        lambda c: urls.query_param(F.concat(F.lit("/?page="), c), "page"), lambda c: urls.url_join(c, c),
        lambda c: dates.post_date(c, AS_OF), lambda c: dates.relative_date(c, AS_OF), dates.to_day, dates.artifact_day,
        lambda c: text.first_of(F.split(c, ",")), lambda c: text.last_token(c),
    ):
        assert len(apply(function, odd)) == len(odd)


def test_more_layouts_and_unread_dates(apply):
    texts = {"5/10/16": "10/05/2016", "25/10/16": "25/10/2016", "10 January 24": "10/01/2024", "Feb 2024": "15/02/2024", "20240103T101112": "03/01/2024",
             "202401031011": "03/01/2024", "3-Feb-21 10:00": "03/02/2021"}
    assert apply(lambda c: dates.post_date(c, AS_OF), list(texts)) == list(texts.values())
    end = dt.date(2024, 1, 31)
    assert apply(lambda c: dates.post_date(c, end), ["February 2023"]) == ["28/02/2023"]
    odd = ["soon", "31/31/2024", "", " ", None, "5/10/16"]
    assert apply(lambda c: dates.unread_date(c, AS_OF), odd) == [True, True, False, False, False, False]
