"""Churn, statistics and ranges on the golden snapshot and by brute force."""

import datetime as dt
import random

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from snapwatch.operators import churn, churn_range, stats
from snapwatch.schema import CONTACT_COLUMNS

GOLDEN = [
    ("A", "acme", 14, "a1"), ("A", "acme", 15, "a1"), ("A", "acme", 15, "a2"), ("A", "beta", 14, "a3"), ("A", "beta", 14, "a4"),
    ("A", "gamma", 15, "a5"), ("A", None, 15, "a6"), ("A", "delta", 15, "a7"), ("A", "delta", 10, "a7"), ("A", "", 15, "a8"),
    ("B", "acme", 15, "b1"), ("B", "Acme", 14, "b2"),
]
SCHEMA = "Site string, Company string, Company_jobs string, Crawl_Date date, Job_Post_Date string, unique_id string"


def postings(spark, rows):
    return spark.createDataFrame(
        [(s, c, f"jobs/{u}", dt.date(2024, 1, d), "", u) for s, c, d, u in rows], SCHEMA
    )


@pytest.fixture(scope="module")
def golden(spark):
    return postings(spark, GOLDEN)


def named(df):
    return [(r["Site"], r["Company"], r["Num_Company_jobs"]) for r in df.collect()]


def test_new_companies(golden):
    report = churn.new_companies(golden, AS_OF, 2)
    assert named(report) == [("A", "", 1), ("A", "delta", 1), ("A", "gamma", 1), ("B", "acme", 1)]
    assert report.columns == ["Site", "Company", "Company_jobs", "Num_Company_jobs", *CONTACT_COLUMNS]
    assert {r[c] for r in report.collect() for c in CONTACT_COLUMNS} == {""}


def test_the_whole_look_back_window_counts_for_new(golden):
    assert named(churn.new_companies(golden, AS_OF, 8)) == [("A", "", 1), ("A", "gamma", 1), ("B", "acme", 1)]


def test_left_companies_use_two_days(golden):
    left = churn.left_companies(golden, AS_OF)
    assert named(left) == [("A", "beta", 2), ("B", "Acme", 1)]
    assert [r.Company_jobs for r in left.collect()] == ["jobs/a3", "jobs/b2"]


def test_row_keeping_form_agrees(golden):
    for days in (2, 8):
        assert sorted(map(tuple, churn.new_companies_by_rows(golden, AS_OF, days).collect())) == sorted(
            map(tuple, churn.new_companies(golden, AS_OF, days).collect())
        )
    assert sorted(map(tuple, churn.left_companies_by_rows(golden, AS_OF).collect())) == sorted(
        map(tuple, churn.left_companies(golden, AS_OF).collect())
    )


def test_order_by_size(spark):
    rows = [("B", "x", 15, "1"), ("A", "few", 15, "2"), ("A", "many", 15, "3"), ("A", "many", 15, "4"), ("A", "also", 15, "5")]
    assert named(churn.new_companies(postings(spark, rows), AS_OF, order="by_size")) == [
        ("A", "many", 2), ("A", "also", 1), ("A", "few", 1), ("B", "x", 1),
    ]


def test_daily_stats(golden):
    rows = {r.Site: tuple(r)[1:] for r in stats.daily_stats(golden, AS_OF, 2, ["A", "B", "C"]).collect()}
    assert rows == {"A": (3, 1, 6, 4), "B": (1, 1, 1, 1), "C": (0, 0, 0, 0)}
    gate = stats.completeness_gate(stats.daily_stats(golden, AS_OF, 2, ["A", "B", "C"])).first()
    assert tuple(gate) == (False, "C")
    assert stats.completeness_gate(stats.daily_stats(golden, AS_OF, 2, ["A", "B"])).first().complete


def test_merged_stats_equal_fused_stats(golden):
    sites = ["A", "B", "C"]
    companies = churn.company_window(golden, AS_OF)
    totals = [stats.total_jobs(golden, AS_OF, sites), stats.total_companies(golden, AS_OF, sites)]
    reports = [
        stats.rows_per_site(churn.new_report(companies), "new", sites),
        stats.rows_per_site(churn.left_report(companies), "removed", sites),
    ]
    merged = stats.merge_stats(totals, reports).select("Site", *stats.METRICS)
    assert sorted(merged.collect()) == sorted(stats.daily_stats(golden, AS_OF, 2, sites).collect())
    assert stats.merge_stats(totals, None).columns == ["Site", "total_jobs", "total_companies"]
    tall = {r.metric: r.by_site for r in stats.stats_as_map(merged).collect()}
    assert tall["new"] == {"A": 3, "B": 1, "C": 0}


def test_company_names_compare_exactly_unless_a_collation_is_given(spark):
    rows = [("A", n, 15, str(i)) for i, n in enumerate(["Ab", "ab", "áb", "ab ", None])]
    exact = stats.total_companies(postings(spark, rows), AS_OF, ["A"]).first()
    folded = stats.total_companies(postings(spark, rows), AS_OF, ["A"], collation="UNICODE_CI_AI_RTRIM").first()
    lower = stats.total_companies(postings(spark, rows), AS_OF, ["A"], collation="UTF8_LCASE").first()
    assert (exact.total_companies, folded.total_companies, lower.total_companies) == (4, 1, 3)


def test_churn_range_counts_null_as_a_company(golden):
    churned = churn_range.churn_range(golden, "A", AS_OF, AS_OF)
    got = {k: {r.Company for r in churn_range.changes(churned, k).collect()} for k in ("new", "removed")}
    assert got == {"new": {"gamma", "delta", "", None}, "removed": {"beta"}}
    assert {r.change: r.companies for r in churn_range.distinct_companies(churned).collect()} == {"new": 4, "removed": 1}


def brute_churn(rows, site, start, end):
    out, day = set(), start
    while day <= end:
        today = {c for s, c, d, _ in rows if s == site and dt.date(2024, 1, d) == day}
        before = {c for s, c, d, _ in rows if s == site and dt.date(2024, 1, d) == day - dt.timedelta(days=1)}
        out |= {(c, day, "new") for c in today - before} | {(c, day, "removed") for c in before - today}
        day += dt.timedelta(days=1)
    return out


def random_rows(seed, names=("a", "b", "c", "", None), days=range(1, 21)):
    rng = random.Random(seed)
    rows = [(rng.choice("AB"), rng.choice(names), rng.choice(list(days)), f"u{i}") for i in range(150)]
    return [r for r in rows if r[2] != 9]  # one day without any data


@pytest.mark.parametrize("seed", range(3))
def test_churn_range_by_brute_force(spark, seed):
    rows = random_rows(seed)
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 18)
    df = postings(spark, rows)
    churned = churn_range.churn_range(df, "A", start, end)
    got = [tuple(r) for r in churned.collect()]
    assert len(got) == len(set(got)) and set(got) == brute_churn(rows, "A", start, end)
    pairs = churn_range.company_days(df, "A", start, end)
    for change, join in (("new", churn_range.new_by_anti_join), ("removed", churn_range.removed_by_anti_join)):
        assert {(r[0], r[1], change) for r in join(pairs, start, end).collect()} == {x for x in set(got) if x[2] == change}
    per_day = churn_range.changes_per_day(churned, start, end)
    running, new, removed = sorted(churn_range.running_changes(per_day).collect()), 0, 0
    assert len(running) == 16
    for row in running:
        new, removed = new + row.new, removed + row.removed
        assert (row.new_so_far, row.removed_so_far) == (new, removed)
    assert new + removed == len(got)


@pytest.mark.parametrize("seed", range(2))
def test_one_day_range_agrees_with_the_daily_report(spark, seed):
    rows = random_rows(seed, names=("a", "b", "c", "d", "e", "f"), days=range(13, 17))
    df = postings(spark, rows)
    churned = churn_range.churn_range(df, "A", AS_OF, AS_OF)
    new = {r.Company for r in churn.new_companies(df.where("Site = 'A'"), AS_OF).collect()}
    left = {r.Company for r in churn.left_companies(df.where("Site = 'A'"), AS_OF).collect()}
    assert new == {r.Company for r in churn_range.changes(churned, "new").collect()}
    assert left == {r.Company for r in churn_range.changes(churned, "removed").collect()}
    assert not new & left
    per_day = {d: {c for s, c, x, _ in rows if s == "A" and x == d} for d in (14, 15)}
    assert (per_day[15] - new) | left == per_day[14]


def test_companies_per_day_has_empty_days(golden):
    got = {r.Crawl_Date.day: r.companies for r in churn_range.companies_per_day(golden, "A", dt.date(2024, 1, 11), AS_OF).collect()}
    assert got == {10: 1, 11: 0, 12: 0, 13: 0, 14: 2, 15: 5}


def test_range_guard():
    with pytest.raises(ValueError):
        churn_range.day_range(dt.date(2024, 1, 16), None, AS_OF)
    assert churn_range.day_range(AS_OF, None, AS_OF) == (AS_OF, AS_OF)


def test_day_counts_ignore_null_keys(golden):
    assert golden.where("Company is null").count() == 1
    assert churn.company_day_counts(golden).where("Company is null").count() == 0
    days = {(r.Site, r.Company): r.crawl_date_count for r in churn.snapshot_days(golden).collect()}
    assert days[("A", "acme")] == 2 and days[("A", "beta")] == 1


def test_report_needs_one_exchange_before_the_sort(golden, capsys):
    churn.new_report(churn.company_window(golden, AS_OF)).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_reports_are_sorted(golden):
    rows = [(r.Site, r.Company) for r in churn.sort_report(golden.select("Site", "Company", F.lit(1).alias("Num_Company_jobs"))).collect()]
    assert rows == sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or ""))


def test_statistics_read_the_table_once(spark):
    from snapwatch.plans import all_queries

    for name in ("src5_board_counts", "a5_new_and_removed", "a13_merged_stats", "a13_totals_without_report"):
        df = all_queries()[0][name](spark, "/root/testdata/sf0.001")
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1, name

