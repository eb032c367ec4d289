"""Counts on every row, first rows and running totals, with hot and NULL groups."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapwatch.operators import coverage, digests, grouping


def test_group_count_with_a_hot_group(spark):
    rows = [("hot", i % 2, f"h{i}") for i in range(700)] + [(f"c{i % 900}", 0, f"x{i}") for i in range(1200)]
    rows += [(None, 1, f"n{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k string, d int, u string")
    got = grouping.with_group_count(df, ["k", "d"], "u", "n", "u").collect()
    sizes = Counter((k, d) for k, d, _ in rows)
    assert len(got) == len(rows)
    assert {(r.k, r.d, r.u): r.n for r in got} == {(k, d, u): None if k is None else sizes[(k, d)] for k, d, u in rows}


def test_group_count_counts_only_values(spark):
    df = spark.createDataFrame([("a", "1"), ("a", None), ("b", None)], "k string, u string")
    got = grouping.with_group_count(df, ["k"], "u", "n", "u").collect()
    assert sorted((r.k, r.n) for r in got) == [("a", 1), ("a", 1), ("b", 0)]


def test_group_count_in_a_shuffled_join(spark):
    """The same with broadcasts of unknown size turned off."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_group_count_with_a_hot_group(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_by_key_with_a_hot_key(spark):
    rows = [("hot", i) for i in range(500)] + [(f"c{i}", 1000 + i) for i in range(50)] + [(None, 2000 + i) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, i int")
    for known in (["hot", "c1", "c1", None], ["c2"], []):
        lookup = spark.createDataFrame([(k,) for k in known], "k string")
        inside = {r.i for r in grouping.rows_by_key(df, lookup, ["k"], True, "i").collect()}
        outside = [r.i for r in grouping.rows_by_key(df, lookup, ["k"], False, "i").collect()]
        assert inside == {i for k, i in rows if k is not None and k in known}
        assert sorted(outside) == sorted(i for k, i in rows if k is None or k not in known)


def test_first_per_key_limits_each_task_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, o int")
    firsts = grouping.first_per_key(df, ["k"], ["o"])
    assert sorted(firsts.collect()) == [("a", 1), ("b", 3)]
    firsts.explain()
    assert "row_number(), 1, Partial" in capsys.readouterr().out


def test_once_only(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, None), (None, None)], "k string, o int")
    assert [tuple(r) for r in grouping.once_only(df).collect()] == [("b", None)]


def test_running_total_over_many_blocks(spark):
    rng = random.Random(7)
    rows = [(site, i, rng.randint(0, 9)) for site in ("a", "b", None) for i in rng.sample(range(500), 120)]
    df = spark.createDataFrame(rows, "Site string, page long, n long")
    got = {(r.Site, r.page): r.n_so_far for r in grouping.running_total(df, "page", ["n"], by=["Site"], block=16).collect()}
    want = {(s, p): sum(n for s2, p2, n in rows if s2 == s and p2 <= p) for s, p, _ in rows}
    assert got == want


def test_page_counts_on_both_levels(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "Site string, page long")
    got = {(r.Site, r.page): r.n for r in coverage.page_and_board_counts(df).collect()}
    assert got == {("a", 1): 2, ("a", 2): 1, ("a", None): 3, ("b", 1): 1, ("b", None): 1}


def test_uncovered_pages(spark):
    rows = [("a", 0, 3, 12_500), ("a", 2, 0, 3), ("b", 1, 2, 1), ("c", 5, 1, 0), ("d", 0, 0, None)]
    df = spark.createDataFrame(rows, "Site string, page long, n long, total_pages long")
    got = coverage.uncovered_pages(df)
    by_site = {r.Site: r.n for r in got.groupBy("Site").agg(F.count("*").alias("n")).collect()}
    assert by_site == {"a": 12_501 - 2 + 1, "b": 1, "c": 1, "d": 1}
    assert {(r.page, r.reason) for r in got.where("Site = 'a' and page in (2, 12500)").collect()} == {(2, "empty"), (12_500, "missing")}


def test_page_gaps_are_bounded_by_the_pages_seen(spark):
    rows = [("a", 0, 3, 10**15), ("a", 2, 0, 3), ("a", 3, 0, 3), ("a", 3, 0, 3), ("a", 9, 0, 3), ("b", 1, 2, 1), ("c", 5, 1, 0)]
    rows += [("d", 0, 0, None), ("e", None, 0, 4), ("f", -2, 0, 1), (None, 1, 1, 2), ("g", 7, 1, -1), ("h", 70_000, 0, 140_001)]
    df = spark.createDataFrame(rows, "Site string, page long, n long, total_pages long")
    got = {tuple(r) for r in coverage.page_gaps(df).collect()}
    assert got == {
        ("a", 1, 1, "missing"), ("a", 4, 8, "missing"), ("a", 10, 10**15, "missing"), ("a", 2, 3, "empty"), ("a", 9, 9, "empty"),
        ("b", 0, 0, "missing"), ("c", 0, 0, "missing"), ("d", 0, 0, "empty"), ("e", 0, 4, "missing"), ("f", -2, -2, "empty"),
        ("f", 0, 1, "missing"), (None, 0, 0, "missing"), (None, 2, 2, "missing"), ("h", 0, 69_999, "missing"),
        ("h", 70_000, 70_000, "empty"), ("h", 70_001, 140_001, "missing"),
    }
    assert coverage.page_gaps(df.limit(0)).collect() == []


def test_next_over_many_blocks(spark):
    rng = random.Random(8)
    rows = [(site, i) for site in ("a", "b", None) for i in rng.sample(range(-300, 500), 90)]
    got = {tuple(r) for r in grouping.with_next(spark.createDataFrame(rows, "Site string, page long"), "page", "after", ["Site"], 16).collect()}
    assert got == {(s, p, min((q for t, q in rows if t == s and q > p), default=None)) for s, p in rows}


@pytest.mark.parametrize("same_digest", [False, True])
def test_distinct_and_once_by_digest(spark, monkeypatch, same_digest):
    """As distinct and once_only, also where rows that differ have one digest."""
    if same_digest:
        monkeypatch.setattr(digests, "digest", lambda columns: [F.lit(1).cast("long").alias(n) for n in digests._DIGEST])
    rows = [(1, "a", 0.0), (1, "a", -0.0), (2, None, 1.0), (None, None, None), (None, None, None), (3, "b", float("nan")), (3, "b", float("nan")), (4, "", 2.0), (None, "a", 2.0)]
    df = spark.createDataFrame(rows, "a long, b string, c double")
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, digests.rows_once(df).collect())) == sorted(map(key, [(2, None, 1.0), (4, "", 2.0), (None, "a", 2.0)]))
    got = digests.distinct_rows(df).withColumn("c", F.abs("c"))
    assert sorted(map(key, got.collect())) == sorted(map(key, df.withColumn("c", F.abs("c")).distinct().collect())) and got.count() == 6
    assert digests.distinct_rows(df.limit(0)).collect() == [] == digests.rows_once(df.limit(0)).collect()


def test_wide_rows_that_are_alone_are_not_shuffled(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 500).alias("wide"))
    alone, _ = digests._parted(df.unionByName(df.where("id < 3")))
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and alone.count() == 997
