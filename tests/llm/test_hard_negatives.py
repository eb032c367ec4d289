"""Hard negatives against brute force, and the intervals against exact scores."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapwatch.llm import hard_negatives as hn

ROWS = "vec_id long, label int, embedding array<float>, v string, codes int, row long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], ROWS)


def brute(rows, anchor, positives=5, negatives=3, low=50, high=95):
    good = [
        (i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in good:
        if not anchor(i):
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))  # noqa: B023, E731
        alike = sorted((-score(w), j) for j, other, w in good if other == label and j != i)[:positives]
        unlike = sorted((-score(w), j) for j, other, w in good if other != label)
        for p, j in alike:
            fit = [(s, k) for s, k in unlike if -low * p <= -100 * s <= -high * p][:negatives]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def made(seed, count, width):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(5, width))
    return [(i, i % 5 if i % 3 else 0, (centres[i % 5] + 0.8 * pick.normal(size=width)).round(2).tolist()) for i in range(count)]


@pytest.mark.parametrize(("width", "blocks"), [(16, (10_000, 10_000)), (70, (7, 40))])
def test_hard_negatives(spark, monkeypatch, width, blocks):
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", blocks[0])
    monkeypatch.setattr(hn, "ROW_BLOCK", blocks[1])
    rows = made(1, 240, width)
    rows += [rows[10]] * 3 + [(10, 3, rows[11][2]), (10, 0, rows[12][2])]  # repeated rows and ids, also of an anchor
    rows += [(300 + i, i % 2, [1.0] * width) for i in range(12)]  # ties
    rows += [(400, 1, None), (410, None, [1.0] * width), (420, 1, [1.0, None]), (430, 1, [float("nan")] * width), (440, 2, [float("inf")] * width)]
    rows += [(None, 1, [1.0] * width), (450, 1, []), (460, 2, [3.0, 4.0]), (470, 9, [2.0] * width), (480, 1, [0.0] * width), (490, 1, [-1e3] * width)]
    got = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_scores_beyond_doubles(spark):
    rows = [(i, i % 2, [3e6 + i, 2e6 - i, 1.0]) for i in range(0, 40)]
    got = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, low=1, high=100)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0, low=1, high=100)


def test_few_and_none(spark):
    for rows in ([], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])]):
        assert hn.hard_negatives(frame(spark, rows), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("width", [1, 8, 64, 130])
def test_intervals_hold_and_filter(width):
    pick = np.random.default_rng(width)
    vectors = np.floor(256 * pick.normal(size=(300, width)))
    vectors[:3] = [[0.0] * width, [256.0] * width, [-1e9] * width]
    codes, along, rest = hn.encode(vectors)
    norm = np.sqrt((vectors**2).sum(1))
    coded = pd.DataFrame({"vec_id": range(300), "rest": rest, "norm": norm})
    for name, values in (("v", vectors), ("codes", codes), ("along", along)):
        coded[name] = [row.tobytes() for row in values]
    least, most = hn.Anchors(vectors[:50]).interval(slice(0, 50), hn.Rows(coded, width))
    exact = vectors[:50] @ vectors.T
    assert (least <= exact).all() and (exact <= most).all()
    spread = (most - least)[3:, 3:] / (norm[3:50, None] * norm[None, 3:])
    assert np.median(spread) < 0.5  # of the 2 that the norms alone allow
