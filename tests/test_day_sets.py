"""Day summaries and distinct sets against the postings they are made of."""

import datetime as dt
import random

import pytest
from conftest import AS_OF
from pyspark.errors import PySparkException

from snapwatch.operators import churn, day_summaries, distinct_sets, stats

SCHEMA = "Site string, Company string, Company_jobs string, Crawl_Date date, unique_id string"


def postings(spark, seed, days=range(70), n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        company = rng.choice([None, "", *(f"c{k}" for k in range(40))])
        rows.append((rng.choice("AB"), company, f"u{rng.randint(0, 9)}", AS_OF - dt.timedelta(days=rng.choice(days)), rng.choice([None, f"i{i}"])))
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("n", [2, 8, 70])
def test_summaries_give_what_the_postings_give(spark, tmp_path, n):
    table, path = postings(spark, n, days=[*range(n), 0, 1, 1]).cache(), str(tmp_path / "s")
    day_summaries.refresh_summaries(table, [AS_OF - dt.timedelta(days=i) for i in range(n)], path)
    made = day_summaries.read_summaries(spark, path)
    companies = day_summaries.company_window_of(made, AS_OF, n)
    raw = churn.company_window(table, AS_OF, n)
    assert rows(companies) == rows(raw)
    assert rows(day_summaries.daily_stats_of(made, AS_OF, n, ["A", "B", "C"])) == rows(stats.daily_stats(table, AS_OF, n, ["A", "B", "C"]))
    assert rows(day_summaries.snapshot_days_of(made)) == rows(churn.snapshot_days(table))
    assert rows(day_summaries.company_day_counts_of(made)) == rows(churn.company_day_counts(table))


def test_a_report_scans_the_days_of_its_summaries_only(spark, tmp_path):
    path = str(tmp_path / "s")
    day_summaries.refresh_summaries(postings(spark, 1), [AS_OF - dt.timedelta(days=i) for i in range(30)], path)
    report = churn.new_report(day_summaries.company_window_of(day_summaries.read_summaries(spark, path), AS_OF, 8))
    files = report.inputFiles()
    assert files and all("/s/Crawl_Date=" in f for f in files)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(Crawl_Date" in plan


def test_reloaded_and_emptied_days_are_repaired(spark, tmp_path):
    path, day = str(tmp_path / "s"), AS_OF - dt.timedelta(days=1)
    first, second = postings(spark, 2, [0, 1]), postings(spark, 3, [0])
    day_summaries.refresh_summaries(first, [AS_OF, day], path)
    day_summaries.refresh_summaries(second, [AS_OF], path)
    made = day_summaries.read_summaries(spark, path)
    assert rows(made.drop("first")) == rows(day_summaries.summarise_days(second.unionByName(first.where(f"Crawl_Date = '{day}'"))).select(made.columns).drop("first"))
    day_summaries.refresh_summaries(second, [day], path)
    assert rows(day_summaries.read_summaries(spark, path).select("Crawl_Date").distinct()) == [f"Row(Crawl_Date={AS_OF!r})"]


VALUES = "g string, day int, v string"


def test_bitmaps_count_what_distinct_counts(spark, tmp_path):
    rng, path = random.Random(5), str(tmp_path / "d")
    loads = [[(rng.choice("ab"), day, rng.choice([None, "", *(f"v{k}" for k in range(day * 20, day * 20 + 60))])) for _ in range(300)] for day in range(3)]
    frames = [spark.createDataFrame(load, VALUES).repartition(3) for load in loads]
    for number in (0, 1, 1, 2):  # a repeated load changes nothing
        dictionary = distinct_sets.number_values(frames[number], "v", path, str(number))
    ids = sorted(r.id for r in dictionary.collect())
    assert ids == list(range(1, len(ids) + 1)) and dictionary.select("value").distinct().count() == len(ids)
    every = [r for load in loads for r in load]
    sets = distinct_sets.bitmaps(spark.createDataFrame(every, VALUES), ["g", "day"], "v", dictionary)
    for null in (True, False):
        got = {r.g: r.n for r in distinct_sets.count_of_bitmaps(sets.where("day <= 1"), ["g"], "n", null).collect()}
        assert got == {g: len({v for h, day, v in every if h == g and day <= 1 and (null or v is not None)}) for g in "ab"}
    with pytest.raises(PySparkException, match="not in the dictionary"):
        distinct_sets.bitmaps(spark.createDataFrame([("a", 1, "unknown")], VALUES), ["g"], "v", dictionary).collect()


def test_small_sets_take_little_room(spark, tmp_path):
    df = spark.range(6000).selectExpr("cast(id % 3000 AS string) AS g", "0 AS day", "cast(id % 2000 AS string) AS v")
    dictionary = distinct_sets.number_values(df, "v", str(tmp_path / "d"), "1")
    sets = distinct_sets.bitmaps(df, ["g"], "v", dictionary)
    assert dict(sets.dtypes)["bits"] == "bigint" and sets.count() <= 6000
    assert {r.n for r in distinct_sets.count_of_bitmaps(sets, ["g"], "n", True).collect()} == {2}
    assert distinct_sets.count_of_bitmaps(sets.selectExpr("1 AS x", "bucket", "bits"), ["x"], "n", False).first().n == 2000


def test_sets_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], VALUES)
    dictionary = distinct_sets.number_values(none, "v", str(tmp_path / "d"), "1")
    assert dictionary.collect() == []
    assert distinct_sets.count_of_bitmaps(distinct_sets.bitmaps(none, ["g"], "v", dictionary), ["g"], "n", True).collect() == []


def test_sketches_stay_within_their_error(spark):
    df = spark.range(60_000).selectExpr("id % 3 AS g", "cast(id % 7 AS int) AS day", "cast(id % 20000 AS string) AS v")
    sets = distinct_sets.sketches(df, ["g", "day"], "v")
    for r in distinct_sets.estimate_of_sketches(sets, ["g"], "n").collect():
        assert abs(r.n - 20_000) <= 3 * 1.04 / 64 * 20_000
    assert max(len(r.sketch) for r in sets.collect()) < 5_000
