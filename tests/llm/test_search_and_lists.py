"""Exact search and dated lists against brute force."""

import datetime as dt
import random

import numpy as np
import pytest

from snapwatch.llm import knn, url_lists

VECTORS = "vec_id long, embedding array<float>, v string, cell int, score long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)


def brute(rows, queries, k):
    usable = [
        (i, np.floor(64 * np.float32(v).astype(float)).tolist())
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = max((len(v) for _, v in usable), default=0)
    padded = [(i, np.array([*v, *[0.0] * (width - len(v))])) for i, v in usable]
    out = []
    for q, a in padded:
        if queries(q):
            best = sorted((-int(a @ b), i) for i, b in padded if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2_000, 20_000), (7, 40)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(knn, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(knn, "VECTOR_BLOCK", blocks[1])
    pick = np.random.default_rng(1)
    hot = pick.normal(size=8)
    rows = [(i, (hot + 0.05 * pick.normal(size=8) if i % 3 else pick.normal(size=8)).tolist()) for i in range(200)]
    rows += [(300 + i, [1.0] * 8) for i in range(10)]  # ties
    rows += [(10, rows[10][1]), (400, None), (405, []), (410, [1.0, None]), (415, [float("nan")] * 8), (420, [float("inf")] * 8)]
    rows += [(None, [1.0] * 8), (425, [3.0, 4.0]), (430, [0.0] * 8), (435, [-1e3] * 8)]
    vectors = knn.usable(frame(spark, rows))
    got = knn.top_k(vectors, vectors.where("vec_id % 5 = 0"), k=4, pivots=9).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda q: q % 5 == 0, 4)


@pytest.mark.parametrize("pivots", [1, 9, 40])
def test_top_k_with_repeated_ids_and_rows(spark, pivots):
    pick = np.random.default_rng(2)
    rows = [(20, pick.normal(size=6).tolist()) for _ in range(12)] + [(100 + i, pick.normal(size=6).tolist()) for i in range(60)]
    rows += [rows[20]] * 3 + [(40, rows[3][1])] * 2
    vectors = knn.usable(frame(spark, rows))
    got = knn.top_k(vectors, vectors.where("vec_id in (20, 40)"), k=3, pivots=pivots).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda q: q in (20, 40), 3) and len(got) == 14 * 3


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    vectors = knn.usable(frame(spark, rows))
    assert [tuple(r) for r in knn.top_k(vectors, vectors.where("vec_id = 0")).collect()] == [(0, 1, 1, 8192)]
    one = knn.usable(frame(spark, rows[:1]))
    assert knn.top_k(one, one).collect() == []
    none = knn.usable(frame(spark, []))
    assert knn.top_k(none, none).collect() == [] and knn.top_k(vectors, none).collect() == []


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_judgements(spark):
    pick = random.Random(8)
    entries = ["a.example.org", "example.org", "b.example.org/x", "b.example.org/x/y", "c.net", "host"]
    changes = [(pick.choice(entries), pick.choice(["block", "allow", None]), day(pick.randrange(40))) for _ in range(80)]
    urls = ["http://a.example.org/", "https://u:p@B.example.org:80/x/y?z#t", "http://b.example.org/x", "http://c.net.", "ftp://host/q", "nonsense", None, "http://d.example.org//x//"]
    captures = [(i, pick.choice(urls), day(pick.randrange(-2, 45))) for i in range(300)] + [(300, urls[0], None), (None, urls[0], day(3)), (0, urls[0], day(9)), (0, urls[0], day(9))]
    schema = "page_id long, url string, fetched_at timestamp_ntz, entry string, host string, blocked string"
    shots = spark.createDataFrame([(*c, "e", "h", "b") for c in captures], schema)
    listed = spark.createDataFrame([*changes, changes[0], (None, "block", day(0)), ("c.net", "block", None)], "entry string, verdict string, at timestamp_ntz")
    got = url_lists.judge_captures(shots, listed).collect()
    assert len(got) == len(captures)
    keys = {
        urls[0]: ["example.org", "a.example.org"],
        urls[1]: ["example.org", "b.example.org", "b.example.org/x", "b.example.org/x/y"],
        urls[2]: ["example.org", "b.example.org", "b.example.org/x"],
        urls[3]: ["c.net"],
        urls[4]: ["host", "host/q"],
        urls[7]: ["example.org", "d.example.org", "d.example.org/x"],
    }
    rank = {"allow": 2, "block": 1, None: 0}
    for r in got:
        active = []
        for key in keys.get(r.url, []) if r.fetched_at else []:
            past = [(at, rank[v], v) for e, v, at in changes if e == key and at <= r.fetched_at]
            if past and (last := max(past, key=lambda p: p[:2]))[2]:
                active.append((key, last))
        assert r.n_active == len(active)
        assert r.blocked == bool(active and active[-1][1][2] == "block")
        assert (r.entry, r.listed_at) == ((active[-1][0], r.listed_at) if active else (None, None))
    assert url_lists.judge_captures(shots.limit(0), listed).collect() == []
    assert not any(r.blocked for r in url_lists.judge_captures(shots, listed.limit(0)).collect())


def test_capitals_in_entries(spark):
    """Hosts are the same in either case, paths are not."""
    changes = spark.createDataFrame([("Example.COM/Ads", "block", day(0)), ("B.net", "block", day(0))], "entry string, verdict string, at timestamp_ntz")
    urls = ["http://example.com/Ads/1", "http://EXAMPLE.com/ads/1", "http://example.com/", "http://b.NET/X"]
    shots = spark.createDataFrame([(i, u, day(1)) for i, u in enumerate(urls)], "page_id long, url string, fetched_at timestamp_ntz")
    got = {r.page_id: (r.blocked, r.entry) for r in url_lists.judge_captures(shots, changes).collect()}
    assert got == {0: (True, "example.com/Ads"), 1: (False, None), 2: (False, None), 3: (True, "b.net")}


def test_entries_as_lists_write_them(spark):
    written = ["ex.org/ads/", "EX.org.", "http://ex.org", " ex.org ", "https://ex.org//Ads//x/", "ex.org/", None, " ", "http://"]
    df = spark.createDataFrame([(e,) for e in written], "entry string")
    got = [r[0] for r in df.select(url_lists.entry_of(df.entry)).collect()]
    assert got == ["ex.org/ads", "ex.org", "ex.org", "ex.org", "ex.org/Ads/x", "ex.org", None, "", ""]
