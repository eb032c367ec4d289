"""SimHash fingerprints, and groups of fingerprints within a small Hamming distance by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.llm.components import connected_components
from snapwatch.llm.tables import cut, slices

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4
# (lowest bit, bits, radius): two fingerprints that differ in DISTANCE bits or fewer differ in no more than the
# radius within at least one segment, as radius + 1 summed over the segments is above DISTANCE.
SEGMENTS = ((0, 22, 1), (22, 21, 1), (43, 21, 0))
# So many shingles are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles as an unsigned number; 0 without words."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and exactly the characters of SPACES
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - shingle_words + 1)
    spans = zip(starts[:last].tolist(), ends[min(shingle_words, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, last)
    ones = np.zeros(64, np.int64)
    for at in range(0, last, BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > last))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` (as a signed long), one row per input row; NULL text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.array([fingerprint(t.as_py() or "") for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "fingerprint"])

    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fingerprint long")


def _segment(value: Column, low: int, bits: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << bits) - 1))


def _near(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _hub_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints to the one with most documents among those that share one or two segments with it."""
    fp = F.col("fp")
    parts = [_segment(fp, low, bits) for low, bits, _ in SEGMENTS]
    keys = [F.struct(F.lit(1 << i).alias("kind"), p.alias("x"), F.lit(0).cast("long").alias("y")) for i, p in enumerate(parts)]
    keys += [
        F.struct(F.lit(1 << i | 1 << j).alias("kind"), parts[i].alias("x"), parts[j].alias("y"))
        for i in range(len(parts))
        for j in range(i)
    ]
    placed = prints.select("fp", "n", F.explode(F.array(*keys)).alias("key"))
    hubs = placed.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("n"), "fp"))["fp"].alias("hub"), F.count("*").alias("members"))
    linked = placed.join(hubs.where("members > 1"), "key").where((fp != F.col("hub")) & _near(fp, F.col("hub"), distance))
    return linked.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def _other_links(prints: DataFrame, distance: int) -> DataFrame:
    """All links between fingerprints of different groups (``group``), as links between the groups.

    Each fingerprint looks up the small Hamming ball around each of its segments in the tables of segments. Pairs
    within a table entry's largest group are never built: its members meet only what is outside of it.
    """
    fp = F.col("fp")
    entries = F.array(*[
        F.struct(F.lit(i).alias("segment"), _segment(fp, low, bits).alias("value")) for i, (low, bits, _) in enumerate(SEGMENTS)
    ])

    def ball(i: int, low: int, bits: int, radius: int) -> Column:
        flips = [0] + [1 << bit for bit in range(bits)] if radius else [0]
        near = lambda flip: _segment(fp, low, bits).bitwiseXOR(flip)
        return F.transform(
            F.array(*[F.lit(flip).cast("long") for flip in flips]),
            lambda flip: F.struct(F.lit(i).alias("segment"), near(flip).alias("value")),
        )

    balls = F.concat(*[ball(i, *segment) for i, segment in enumerate(SEGMENTS)])
    table = prints.select("fp", "group", F.explode(entries).alias("e")).select("fp", "group", "e.segment", "e.value")
    probes = prints.select("fp", "group", F.explode(balls).alias("e")).select("fp", "group", "e.segment", "e.value")
    largest = (
        table.groupBy("segment", "value", "group")
        .agg(F.count("*").alias("n"))
        .groupBy("segment", "value")
        .agg(F.max(F.struct("n", "group"))["group"].alias("largest"))
    )
    at = ["segment", "value"]
    stored = table.join(largest, at).select(*at, F.col("fp").alias("other"), F.col("group").alias("other_group"), (F.col("group") == F.col("largest")).alias("inner"))
    # A member of the largest group needs the rest only, any other fingerprint both parts.
    sides = F.when(F.col("group") == F.col("largest"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    asked = probes.join(largest, at).select(*at, "fp", "group", F.explode(sides).alias("inner"))
    met = asked.join(stored, [*at, "inner"]).where((F.col("group") != F.col("other_group")) & _near(fp, F.col("other"), distance))
    return met.select(F.col("group").alias("a"), F.col("other_group").alias("b")).distinct()


def near_duplicate_groups(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``component_id`` (smallest doc_id that links reach), one row per row of ``prints``.

    Equal fingerprints are one node, so exact copies cost nothing more. Links to hubs join most of a large group of
    near copies in one step; a complete search then finds every other link between what is still apart. A NULL doc_id
    takes part, but names no component; a component of nothing else has a NULL id. No rows give no rows.
    """
    if distance > DISTANCE:
        raise ValueError(f"the segments find links of {DISTANCE} bits at most")
    prints = cut(prints)
    nodes = cut(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("doc"), F.count("*").alias("n")))
    first = connected_components(_hub_links(nodes, distance)).select(F.col("node").alias("fp"), F.col("component").alias("found"))
    grouped = cut(nodes.join(first, "fp", "left").select("fp", "doc", F.coalesce("found", "fp").alias("group")))
    second = connected_components(_other_links(grouped, distance)).select(F.col("node").alias("group"), F.col("component").alias("found"))
    grouped = grouped.join(second, "group", "left").select("fp", "doc", F.coalesce("found", "group").alias("group"))
    least = grouped.groupBy("group").agg(F.min("doc").alias("component_id"))
    by_print = grouped.join(least, "group").select(F.col("fp").alias("fingerprint"), "component_id")
    return prints.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one_of_each(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: the row of the smallest doc_id of each group stays.

    Rows without doc_id can't be named and stay; of repeated rows of one doc_id, the first by its values stays.
    """
    groups = near_duplicate_groups(fingerprints(docs), distance)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    columns = docs.columns
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").select(*columns)
    row = F.min(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("_row")
    once = named.groupBy(F.col("doc_id").alias("_key")).agg(row).select("_row.*")
    return once.unionByName(docs.where(F.col("doc_id").isNull()))


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
