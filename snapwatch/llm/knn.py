"""Exact nearest neighbours by inner product: a Voronoi join that replicates only the vectors a group may need."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapwatch.llm.tables import cut

# So many vectors, chosen by a hash of their ids, are pivots; this bounds what is broadcast.
PIVOTS = 128
# About so many queries and vectors meet in one task at a time.
QUERY_BLOCK, VECTOR_BLOCK = 2_000, 20_000
# Distances are floating-point numbers: bounds are widened by this share.
SLACK = 1e-6
EXACT = 2.0**53


def usable(vectors: DataFrame, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, every component x as floor(scale * x), a row per input row.

    Left out: vectors that are NULL or empty or hold a NULL, NaN or infinite component.
    """
    doubles = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    odd = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    floors = F.transform("x", lambda x: F.floor(x * float(scale)).cast("double"))
    return doubles.where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & ~odd).select("vec_id", floors.alias("v"))


def _matrix(column: pa.Array | pd.Series, width: int) -> np.ndarray:
    """One row per vector; a shorter vector has zeros at its end."""
    rows = [np.asarray(v, np.float64) for v in (column.to_pylist() if isinstance(column, pa.Array) else column)]
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _lifted(vectors: np.ndarray, norm2: float) -> np.ndarray:
    """Vectors of one length, by one more component: a larger inner product with a query is then a smaller distance."""
    rest = np.sqrt(np.maximum(norm2 - (vectors**2).sum(1), 0))
    return np.hstack([vectors, rest[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond what a double holds exactly, with Python's integers."""
    if len(queries) and len(vectors) and np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return whole(queries) @ whole(vectors).T


def _best(rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of these vectors for each of these queries."""
    scores, found = _scores(queries, vectors), []
    for number, query, row in zip(rows, query_ids, scores):
        mine = np.flatnonzero(ids != query)
        if len(mine) > k:  # all that score as well as the k-th, ties among them
            mine = mine[row[mine] >= np.partition(row[mine], -k)[-k]]
        best = sorted(((-int(row[i]), int(ids[i])) for i in mine))[:k]
        found += [(int(number), int(query), i, min(max(-s, -(2**63)), 2**63 - 1)) for s, i in best]
    return pd.DataFrame(found, columns=["row", "query_id", "vec_id", "score"]).astype("int64")


def _nearest(parts: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Of a task's (cell, vec_id, distance) the k nearest different ids of each cell."""
    kept = None
    for part in parts:
        rows = part if kept is None else pd.concat([kept, part])
        once = rows.groupby(["cell", "vec_id"], as_index=False)["distance"].min().sort_values(["distance", "vec_id"])
        kept = once.groupby("cell").head(k)
    if kept is not None:
        yield kept


def _bound(cells: np.ndarray, ids: np.ndarray, k: int) -> float:
    """The distance within which k different ids lie."""
    order = np.argsort(cells, kind="stable")
    _, first = np.unique(ids[order], return_index=True)
    return float(np.sort(cells[order][first])[k - 1]) if len(first) >= k else float("inf")


def _groups(cells: dict[int, int], apart: np.ndarray) -> dict[int, list[int]]:
    """Groups of queries for each cell: neighbouring cells share a group of about QUERY_BLOCK, a large cell has several."""
    groups, number, held = {}, -1, QUERY_BLOCK
    left, at = set(cells), min(cells)
    while left:
        at = min(left, key=lambda c: (apart[at, c], c))
        left.discard(at)
        if cells[at] > QUERY_BLOCK:
            blocks = -(-cells[at] // QUERY_BLOCK)
            groups[at] = list(range(number + 1, number + 1 + blocks))
            number, held = number + blocks, QUERY_BLOCK
            continue
        if held + cells[at] > QUERY_BLOCK:
            number, held = number + 1, 0
        groups[at], held = [number], held + cells[at]
    return groups


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query, ties to the smaller vec_id.

    ``vectors`` and ``queries`` are results of ``usable``. Vectors with the query's own vec_id take no part; every other row
    does, repeated ones too, and every row of ``queries`` is a query with its own ranks. Vectors of unequal lengths are
    compared with zeros at the end. Fewer than ``k`` vectors: all of them. No vectors or no queries: no rows. Scores
    end at the limits of a long.

    Every vector goes to the cell of its nearest pivot. The summaries of the cells (size, radius, the distances of the
    k + 1 nearest different ids, of which one may be the query's own) give each cell of queries a distance within which its
    k neighbours must lie. A vector is replicated to a group of query cells only if its distances to the pivots do not
    rule out that it is as near as that. Groups hold about QUERY_BLOCK queries and meet the vectors that were replicated to
    them in blocks of about VECTOR_BLOCK, so that a cell with a third of all rows is many tasks, and the blocks' results are
    merged.
    """
    spark = vectors.sparkSession
    nothing = spark.range(0).selectExpr("id AS query_id", "int(id) AS rank", "id AS vec_id", "id AS score")
    number = F.monotonically_increasing_id().alias("row")
    vectors, queries = cut(vectors.select("vec_id", "v", number)), cut(queries.select("vec_id", "v", number))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    width, norm2, rows = vectors.agg(F.max(F.size("v")), F.max(square), F.count("*")).first()
    query_width = queries.agg(F.max(F.size("v"))).first()[0]
    if width is None or query_width is None:
        return nothing
    width = max(width, query_width)
    # At most ``pivots`` rows come to the driver and go to the tasks.
    chosen = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(pivots).collect()
    centres = _lifted(_matrix(pd.Series([r["v"] for r in chosen]), width), norm2)

    def lifted(batch: pa.RecordBatch, lift: bool) -> np.ndarray:
        points = _matrix(batch.column("v"), width)
        return _lifted(points, norm2) if lift else np.hstack([points, np.zeros((len(points), 1))])

    def assign(lift: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    distance = _distances(lifted(batch, lift), centres)
                    cell = distance.argmin(1)
                    columns = [batch.column("row"), batch.column("vec_id"), pa.array(cell.astype(np.int32)), pa.array(distance.min(1)), batch.column("v")]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "cell", "distance", "v"])

        return run

    placed = "row long, vec_id long, cell int, distance double, v array<double>"
    data, asked = cut(vectors.mapInArrow(assign(True), placed)), cut(queries.mapInArrow(assign(False), placed))
    # Summaries, of pivots * (k + 1) rows at most, and as many for each task before they are merged.
    by_task = data.select("cell", "vec_id", "distance").mapInPandas(lambda parts: _nearest(parts, k + 1), "cell int, vec_id long, distance double")
    by_distance = Window.partitionBy("cell").orderBy("distance", "vec_id")
    once = by_task.groupBy("cell", "vec_id").agg(F.min("distance").alias("distance"))
    nearest = once.withColumn("i", F.row_number().over(by_distance)).where(F.col("i") <= k + 1).select("cell", "vec_id", "distance").collect()
    cells = {r["cell"]: (r["n"], r["far"]) for r in asked.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("far")).collect()}

    apart = _distances(centres, centres)
    groups = _groups({c: n for c, (n, _) in cells.items()}, apart)
    near_cell, near_id, near_distance = (np.array([r[i] for r in nearest]) for i in range(3))
    # Of k + 1 ids within the bound one may be the query's own.
    reach = {cell: _bound(apart[cell, near_cell] + near_distance, near_id, k + 1) + far for cell, (_, far) in cells.items()}
    number_of = sorted(cells)
    groups_of = [np.array(groups[cell], np.int64) for cell in number_of]
    many, most = np.array([len(g) for g in groups_of]), 1 + max(g.max() for g in groups_of)

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, own = lifted(batch, True), batch.column("cell").to_numpy()
            distance = _distances(points, centres)
            mine, slack = batch.column("distance").to_numpy(), SLACK * (1 + norm2**0.5)
            open_ = np.zeros((len(own), len(number_of)), bool)
            for i, cell in enumerate(number_of):
                far, gap = cells[cell][1], apart[cell, own]
                # The triangle inequality by both pivots, and the plane between the two.
                least = np.maximum(np.abs(gap - mine) - far, distance[:, cell] - far)
                plane = np.where(gap > 0, (distance[:, cell] ** 2 - mine**2) / np.where(gap > 0, 2 * gap, 1), 0)
                open_[:, i] = np.maximum(least, plane) <= reach[cell] + slack
            rows, which = np.nonzero(open_)
            # Each row's groups once, in order.
            met = np.concatenate([groups_of[i] for i in which]) if len(which) else np.zeros(0, np.int64)
            pairs = np.unique(np.repeat(rows, many[which]) * most + met)
            offsets = np.searchsorted(pairs // most, np.arange(len(own) + 1))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pairs % most, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), batch.column("v"), lists], names=["row", "vec_id", "v", "groups"])

    dealt = cut(data.mapInArrow(needed, "row long, vec_id long, v array<double>, groups array<int>"))
    # A group has as many blocks as the vectors that it needs ask for.
    blocks = cut(
        dealt.select(F.explode("groups").alias("group")).groupBy("group").agg(F.ceil(F.count("*") / VECTOR_BLOCK).cast("int").alias("blocks"))
    )
    part = F.pmod(F.xxhash64("row"), "blocks").cast("int")
    right = dealt.select("row", "vec_id", "v", F.explode("groups").alias("group")).join(blocks, "group").select("vec_id", "v", "group", part.alias("block"))
    group_of = F.create_map(*[x for c, g in groups.items() for x in (F.lit(c), F.array(*[F.lit(i) for i in g]))])
    own_groups = F.element_at(group_of, F.col("cell"))
    left = asked.select("row", "vec_id", "v", own_groups.alias("g")).select(
        "row", "vec_id", "v", F.get("g", F.pmod(F.xxhash64("row"), F.size("g")).cast("int")).alias("group")
    )
    left = left.join(blocks, "group").select("row", "vec_id", "v", "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def solve(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        ids = (f["vec_id"].to_numpy() for f in (ask, have))
        return _best(ask["row"].to_numpy(), next(ids), _matrix(ask["v"], width), next(ids), _matrix(have["v"], width), k)

    met = left.groupBy("group", "block").cogroup(right.groupBy("group", "block"))
    found = met.applyInPandas(solve, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
