"""Hard negatives by rotated one-bit codes: popcounts estimate scores, residual bounds filter, integers decide.

A vector is coded as the signs of its coordinates after a rotation. The stored alignment, its inner product with the
unit vector of these signs, gives its part along that code; what is left over is coded again after another rotation.
The norm of the last rest bounds, by Cauchy-Schwarz, how far the popcount estimate of a score can be off. Only rows
whose interval may still change the result are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwatch.llm.tables import Tables

# One-bit codes of a vector, each of the rest that the one before leaves, and bits of a quantised anchor coordinate.
# More of them narrow the intervals; no result depends on them.
CODES, BITS = 5, 6
SEED = 11
# About so many anchors and rows meet in one task at a time; estimates are made for so many pairs at a time.
ANCHOR_BLOCK, ROW_BLOCK, PAIRS = 10_000, 10_000, 1 << 20
# Estimates are floating-point numbers: intervals are widened by this share of the norms.
SLACK = 1e-9
EXACT = 2.0**53
MOST = 2**63 - 1

CODED = "vec_id long, label string, v binary, codes binary, along binary, rest double, norm double"


def rotation(width: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    return np.linalg.qr(np.random.default_rng([SEED, number, width]).normal(size=(width, width)))[0]


def _words(width: int) -> int:
    return -(-width // 64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, zeros at the end."""
    whole = np.zeros((len(bits), _words(bits.shape[1]) * 8), np.uint8)
    some = np.packbits(bits, axis=1, bitorder="little")
    whole[:, : some.shape[1]] = some
    return whole.view("<u8")


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``codes`` (row, code, word), ``along`` (row, code) and ``rest`` (row): alignments, and the norm of what is left."""
    width = vectors.shape[1]
    left, codes, along = vectors, [], []
    for number in range(CODES):
        turn = rotation(width, number)
        turned = left @ turn.T
        signs = turned >= 0
        unit = np.where(signs, 1.0, -1.0) / np.sqrt(width)
        part = (turned * unit).sum(1)
        codes.append(_packed(signs))
        along.append(part)
        left = left - (part[:, None] * unit) @ turn
    return np.stack(codes, 1), np.stack(along, 1), np.sqrt((left**2).sum(1))


class Anchors:
    """Anchors with their rotated coordinates quantised to bit planes, one per bit and code."""

    def __init__(self, vectors: np.ndarray):
        width = vectors.shape[1]
        self.vectors, self.norm, self.root = vectors, np.sqrt((vectors**2).sum(1)), np.sqrt(width)
        self.planes, self.low, self.step, self.total, self.off = [], [], [], [], []
        for number in range(CODES):
            turned = vectors @ rotation(width, number).T
            low, step = turned.min(1), np.ptp(turned, axis=1) / (2**BITS - 1)
            level = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype(np.int64)
            again = low[:, None] + step[:, None] * level
            gap = np.abs(turned - again)
            # What the quantising can change in the product with a unit vector of signs, by Cauchy-Schwarz or by sums.
            self.off.append(np.minimum(np.sqrt((gap**2).sum(1)), gap.sum(1) / self.root))
            self.planes.append([_packed(level >> bit & 1 == 1) for bit in range(BITS)])
            self.low.append(low)
            self.step.append(step)
            self.total.append(again.sum(1))

    def interval(self, which: slice, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score that each of these anchors may have with each row."""
        guess = np.zeros((len(self.norm[which]), len(rows.rest)))
        wide = self.norm[which][:, None] * (rows.rest + SLACK * rows.norm)[None] + SLACK
        for number in range(CODES):
            codes = rows.codes[:, number]
            count = np.zeros(guess.shape, np.int32)
            for bit, plane in enumerate(self.planes[number]):
                for word in range(codes.shape[1]):
                    shared = np.bitwise_count(plane[which, word][:, None] & codes[None, :, word])
                    count += shared.astype(np.int32) << bit
            inside = self.low[number][which][:, None] * rows.ones[:, number][None] + self.step[number][which][:, None] * count
            along = rows.along[:, number][None]
            guess += along * (2 * inside - self.total[number][which][:, None]) / self.root
            wide += along * self.off[number][which][:, None]
        return guess - wide, guess + wide


class Rows:
    """Coded rows as they come in a data frame."""

    def __init__(self, frame: pd.DataFrame, width: int):
        matrix = lambda name, kind: np.frombuffer(b"".join(frame[name]), kind)
        self.id = frame["vec_id"].to_numpy()
        self.vectors = matrix("v", "<f8").reshape(len(frame), width)
        self.codes = matrix("codes", "<u8").reshape(len(frame), CODES, _words(width))
        self.along = matrix("along", "<f8").reshape(len(frame), CODES)
        self.rest, self.norm = frame["rest"].to_numpy(), frame["norm"].to_numpy()
        self.ones = np.bitwise_count(self.codes).sum(2, dtype=np.int64)

    def of(self, which: np.ndarray) -> Rows:
        some = object.__new__(Rows)
        some.__dict__ = {name: values[which] for name, values in self.__dict__.items()}
        return some

    def scores(self, which: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Integer inner products, at most the limits of a long; beyond what a double holds exactly, with Python's integers."""
        chosen = self.vectors[which]
        if not len(chosen) or np.abs(chosen).max() * np.abs(anchor).max() * len(anchor) < EXACT:
            return (chosen @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor]
        return np.array([min(max(sum(int(x) * y for x, y in zip(row, whole)), -MOST - 1), MOST) for row in chosen], np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k greatest scores, ties by smaller id."""
    if len(scores) > k:
        best = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        scores, ids = scores[best], ids[best]
    order = np.lexsort((ids, ~scores))[:k]
    return list(zip(scores[order].tolist(), ids[order].tolist()))


def _strips(anchors: int, rows: int) -> Iterator[slice]:
    step = max(1, PAIRS // max(rows, 1))
    return (slice(start, min(anchors, start + step)) for start in range(0, anchors, step))


def nearest_alike(asked: pd.DataFrame, have: pd.DataFrame, width: int, k: int) -> pd.DataFrame:
    """The k best rows of each anchor's label in this block, the anchor's own vec_id left out."""
    rows, found = Rows(have, width), []
    for label, group in asked.groupby("label"):
        alike = rows.of(np.flatnonzero((have["label"] == label).to_numpy()))
        vectors = Rows(group, width)
        anchors = Anchors(vectors.vectors)
        numbers = group["row"].to_numpy()
        for strip in _strips(len(group), len(alike.id)):
            least, most = anchors.interval(strip, alike)
            own = vectors.id[strip][:, None] == alike.id[None]
            least[own], most[own] = -np.inf, -np.inf
            if len(alike.id) > k:
                sure = np.partition(least, -k, axis=1)[:, -k]
                most[most < sure[:, None]] = -np.inf
            for i, number in enumerate(range(strip.start, strip.stop)):
                which = np.flatnonzero(most[i] > -np.inf)
                best = _first(alike.scores(which, anchors.vectors[number]), alike.id[which], k)
                found += [(numbers[number], other, score) for score, other in best]
    return pd.DataFrame(found, columns=["row", "positive_id", "positive_score"]).astype("int64")


def _limits(scores: list[int], low: int, high: int) -> list[tuple[int, int, int]]:
    """Each different positive score with the least and the greatest integer from low to high percent of it, if any."""
    limits = [(score, -(-low * score // 100), high * score // 100) for score in sorted(set(map(int, scores)))]
    return [(score, from_, to) for score, from_, to in limits if from_ <= to]


def nearest_unlike(asked: pd.DataFrame, have: pd.DataFrame, width: int, k: int, low: int, high: int) -> pd.DataFrame:
    """For every anchor and positive score the k best rows of other labels within low to high percent of that score."""
    rows, found = Rows(have, width), []
    for label, group in asked.groupby("label"):
        unlike = rows.of(np.flatnonzero((have["label"] != label).to_numpy()))
        anchors = Anchors(Rows(group, width).vectors)
        numbers = group["row"].to_numpy()
        wanted = [_limits(scores, low, high) for scores in group["scores"]]
        for strip in _strips(len(group), len(unlike.id)):
            least, most = anchors.interval(strip, unlike)
            for i, number in enumerate(range(strip.start, strip.stop)):
                if not wanted[number]:
                    continue
                from_, to = min(w[1] for w in wanted[number]), max(w[2] for w in wanted[number])
                near = np.flatnonzero((most[i] >= from_) & (least[i] <= to))
                least_near, most_near, open_ = least[i, near], most[i, near], np.zeros(len(near), bool)
                for _, from_, to in wanted[number]:
                    sure = least_near[(least_near >= from_) & (most_near <= to)]
                    from_ = max(from_, np.partition(sure, -k)[-k]) if len(sure) >= k else from_
                    open_ |= (most_near >= from_) & (least_near <= to)
                which = near[open_]
                scores = unlike.scores(which, anchors.vectors[number])
                for score, from_, to in wanted[number]:
                    fit = (scores >= from_) & (scores <= to)
                    best = _first(scores[fit], unlike.id[which[fit]], k)
                    found += [(numbers[number], score, other, mine) for mine, other in best]
    return pd.DataFrame(found, columns=["row", "positive_score", "negative_id", "negative_score"]).astype("int64")


def _coded(rows: DataFrame, scale: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.zeros((batch.num_rows, width))
            for i, x in enumerate(batch["x"]):
                vectors[i, : len(x)] = x.values.to_numpy(zero_copy_only=False)
            vectors = np.floor(vectors * scale)
            codes, along, rest = encode(vectors)
            binary = lambda m: pa.array([row.tobytes() for row in m], pa.binary())
            columns = [batch["vec_id"], batch["label"], binary(vectors), binary(codes), binary(along), pa.array(rest), pa.array(np.sqrt((vectors**2).sum(1)))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "v", "codes", "along", "rest", "norm"])

    return rows.mapInArrow(run, CODED).withColumn("row", F.monotonically_increasing_id())


def _blocked(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int, *columns: str) -> DataFrame:
    """Rows in their block, once for each block of the other side."""
    place = F.pmod(F.xxhash64("row"), F.lit(own_blocks)).cast("int").alias(own)
    return df.select(place, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other), *columns)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from (vec_id, label, embedding).

    A component x counts as floor(scale * x); scores are integer inner products, higher ones come first, ties by smaller
    vec_id. A row for which ``is_anchor``, over (vec_id, label), holds has the ``positives`` best other rows of its label as
    positives, rows of its own vec_id left out. For each, its hard negatives are the ``negatives`` best rows of other
    labels with a score of ``low`` to ``high`` percent of the positive's; none if that is negative. Fewer: all of them.

    Rows with a NULL vec_id, label or vector or a NULL, NaN or infinite component take no part; an empty vector has score 0
    with all, unequal lengths are compared with zeros at the end. Repeated rows take part each, also as anchors. A
    score beyond a long counts as its limit. An empty table gives no rows. Other columns are not looked at.

    Anchors are a share of all rows, so no side is broadcast: blocks of anchors meet blocks of rows, and a block's result
    is bounded by its anchors. Within a task, estimates from codes come first and vectors are only scored where the
    estimate's interval reaches the k best so far or the wanted range.
    """
    tables = Tables(rows.sparkSession, "negatives")
    chosen = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("x")
    )
    odd = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    chosen = chosen.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~odd)
    width = max(1, chosen.agg(F.max(F.size("x"))).first()[0] or 0)
    coded = tables.keep(_coded(chosen, scale, width))
    anchors = tables.keep(coded.where(is_anchor))
    parts = lambda df, size: max(1, -(-df.count() // size))
    row_blocks, anchor_blocks = parts(coded, ROW_BLOCK), parts(anchors, ANCHOR_BLOCK)
    columns = ["vec_id", "label", "v", "codes", "along", "rest", "norm"]
    right = _blocked(coded, "b", row_blocks, "a", anchor_blocks, *columns).groupBy("a", "b")

    def meet(left: DataFrame, solve, schema: str, *more: str) -> DataFrame:
        asked = _blocked(left, "a", anchor_blocks, "b", row_blocks, "row", *columns, *more)
        return asked.groupBy("a", "b").cogroup(right).applyInPandas(solve, schema)

    alike = meet(anchors, lambda a, b: nearest_alike(a, b, width, positives), "row long, positive_id long, positive_score long")
    best = Window.partitionBy("row").orderBy(F.col("positive_score").desc(), "positive_id")
    first = tables.keep(alike.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives))
    scores = first.groupBy("row").agg(F.collect_set("positive_score").alias("scores"))  # ``positives`` at most
    unlike = meet(
        tables.keep(anchors.join(scores, "row")),
        lambda a, b: nearest_unlike(a, b, width, negatives, low, high),
        "row long, positive_score long, negative_id long, negative_score long",
        "scores",
    )
    best = Window.partitionBy("row", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
    hard = unlike.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    told = first.join(hard, ["row", "positive_score"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return told.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
