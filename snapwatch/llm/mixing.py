"""Mixing sources to target weights: whole documents whose sizes sum to each source's target."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwatch.llm.tables import cut, text_or_empty

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = 20240115
# A group of documents of one source and size is ranked in parts of about so many.
PART_ROWS = 10_000
# The exact part of a budget is put together from documents of at most so many words, which bounds its table.
EXACT_WORDS = 1 << 16


def word_count(text: str | Column) -> Column:
    """Words of a text without building them: places where a word ends."""
    body = text_or_empty(text)
    return F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]|\z)")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``k, source, source_size, target`` from (k, source, size, count); targets are words.

    The sources by code point, NULL last, take the weights in turn and share ``share`` times all words; no target is
    above ``most`` times its source's words, and what that frees is shared again by weight. So a target is the
    smaller of its limit and its weight times one level. The sources in the order of limit / weight give the level:
    it is shared by those from the first on that it does not cut off. There is one row per source here, which is
    all that one task sees.
    """
    totals = sizes.groupBy("k", "source").agg(F.sum(F.col("size") * F.col("count")).cast("long").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    totals = totals.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    totals = totals.withColumn("limit", F.col("source_size") * float(most))
    totals = totals.withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    free = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levels = totals.withColumn("level", free / F.sum("weight").over(onward))
    first = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(whole)
    target = F.least("limit", F.col("weight") * F.coalesce(first, F.lit(float("inf"))))
    return levels.select("k", "source", "source_size", target.alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take, for ``budget`` words or, where no choice gives them, somewhat fewer.

    An even share of every length is taken first: of those above EXACT_WORDS the nearest number that fits, and more of
    them where the others' words can't fill the budget. Then more of the others are taken while at least one longest
    document's words stay free. The rest of the budget, below twice that length, is filled by a bounded knapsack over the
    documents that are left: every reachable sum remembers the lot of documents that reached it first.
    """
    lengths, counts = [int(n) for n in lengths], [int(n) for n in counts]
    total, left = sum(n * c for n, c in zip(lengths, counts)), max(budget, 0)
    if budget >= total:
        return np.array(counts, np.int64)
    taken = [0] * len(lengths)
    short = [i for i in range(len(lengths)) if lengths[i] <= EXACT_WORDS]
    long = sorted(set(range(len(lengths))).difference(short), key=lambda i: lengths[i])
    for i in reversed(long):
        taken[i] = min((2 * counts[i] * left + total) // (2 * total), left // lengths[i], counts[i])
        left, total = left - taken[i] * lengths[i], total - counts[i] * lengths[i]
    # ``total`` is now that of the short ones.
    for i in long:
        more = max(0, min(counts[i] - taken[i], left // lengths[i], -(-(left - total) // lengths[i])))
        taken[i] += more
        left -= more * lengths[i]
    if left >= total:
        for i in short:
            taken[i] = counts[i]
        return np.array(taken, np.int64)
    for i in short:
        taken[i] = counts[i] * left // total
    left -= sum(lengths[i] * taken[i] for i in short)
    longest = max(lengths[i] for i in short)
    for i in sorted(short, key=lambda i: -lengths[i]):
        if left < 2 * longest:
            break  # short documents are kept for the exact part
        more = max(0, min(counts[i] - taken[i], (left - longest) // lengths[i]))
        taken[i] += more
        left -= more * lengths[i]
    lots = []  # by powers of two, so that any number of documents up to those left can be put together
    for i in short:
        many, lot = min(counts[i] - taken[i], left // lengths[i]), 1
        while many > 0:
            lots.append((i, min(lot, many)))
            many -= lot
            lot *= 2
    # In a seeded order sums of many sizes appear early, and the search ends at the first exact one.
    lots = [lots[j] for j in np.random.default_rng(seed).permutation(len(lots))]
    reached, first = np.zeros(left + 1, bool), np.full(left + 1, -1, np.int64)
    reached[0] = True
    for j, (i, lot) in enumerate(lots):
        step = lot * lengths[i]
        new = reached[: left + 1 - step] & ~reached[step:]
        first[step:][new] = j
        reached[step:] |= new
        if reached[left]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, lot = lots[first[at]]
        taken[i] += lot
        at -= lot * lengths[i]
    return np.array(taken, np.int64)


def _sized(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    """What a decision about a row needs: source, its key (never NULL), size, and a seeded place from 0 on."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 1)
    source = F.col("source").cast("string")
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("k"),
        source.alias("source"),
        word_count("text").alias("size"),
        place.alias("place"),
        *more,
    )


def _decisions(sized: DataFrame, targets: DataFrame, most: int, seed: int) -> DataFrame:
    """``k, size, whole, up_to, some``: a document is taken ``whole`` times, and once more if its place is below ``up_to``
    or there; but only ``some`` of several rows there, if not NULL.
    """

    def plan(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        lengths, many = group["size"].to_numpy(), group["count"].to_numpy()
        whole, rest = divmod(int(round(group["target"].iloc[0])), int((lengths * many).sum()))
        more = fit_budget(lengths, many, rest, seed) if whole < most else 0 * many
        return pd.DataFrame({"k": group["k"], "size": lengths, "count": many, "whole": whole, "more": more})

    counts = sized.where("size > 0").groupBy("k", "size").agg(F.count("*").alias("count"))
    plans = cut(
        counts.join(targets.select("k", "target"), "k")
        .groupBy("k")
        .applyInPandas(plan, "k string, size long, count long, whole long, more long")
    )
    # The place that cuts off the documents taken once more: parts of a group by place are counted first, and only
    # the places of the part with the cut are put in order.
    parts = F.ceil(F.col("count") / PART_ROWS)
    part = F.least(F.floor(F.col("place") / F.lit(2.0**63) * parts), parts - 1).cast("long")
    asked = sized.join(plans.where("more > 0 and more < count"), ["k", "size"]).select("k", "size", "place", "more", part.alias("part"))
    held = _crossed(asked.groupBy("k", "size", "more", "part").agg(F.count("*").alias("n")), "part", "more")
    near = asked.drop("more").join(held.select("k", "size", "part", "need"), ["k", "size", "part"])
    at = _crossed(near.groupBy("k", "size", "need", "place").agg(F.count("*").alias("n")), "place", "need")
    some = F.when(F.col("need") < F.col("n"), F.col("need")).alias("some")
    limit = F.coalesce("place", F.when(F.col("more") >= F.col("count"), F.lit(2**63 - 1)).otherwise(F.lit(-1)))
    return plans.join(at.select("k", "size", "place", some), ["k", "size"], "left").select("k", "size", "whole", limit.alias("up_to"), "some")


def _crossed(counts: DataFrame, by: str, wanted: str) -> DataFrame:
    """Of each (k, size) the row, in the order of ``by``, with which the counts ``n`` reach ``wanted``, and what it must give."""
    so_far = F.sum("n").over(Window.partitionBy("k", "size").orderBy(by)) - F.col("n")
    found = counts.withColumn("before", so_far).where((F.col("before") < F.col(wanted)) & (F.col(wanted) <= F.col("before") + F.col("n")))
    return found.select("k", "size", by, "n", (F.col(wanted) - F.col("before")).alias("need"))


def _plan(docs: DataFrame, weights: tuple, share: float, most: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    sized = cut(_sized(docs, seed, F.col("doc_id")))
    counts = sized.groupBy("k", "source", "size").agg(F.count("*").alias("count"))
    targets = cut(source_targets(counts, weights, share, most))
    return sized, targets, cut(_decisions(sized, targets, most, seed))


def _with_copies(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """``rows`` with ``copies``: how often each is taken.

    Repeated rows have one place. If the cut falls among them, they are written down, and the first ones of them are taken:
    the task that read the last one to be taken is found by counts, and only its rows are put in order.
    """
    met = rows.join(decided, ["k", "size"], "left")
    once_more = F.col("place") <= F.col("up_to")
    copies = F.coalesce(F.col("whole") + once_more.cast("long"), F.lit(0).cast("long")).alias("copies")
    if decided.where("some is not null").isEmpty():
        return met.select(*rows.columns, copies)
    tied = F.col("some").isNotNull() & (F.col("place") == F.col("up_to"))
    number = F.monotonically_increasing_id()
    at = cut(met.where(tied).withColumn("tie", number).withColumn("reader", F.shiftright("tie", 33)))
    readers = _crossed(at.groupBy("k", "size", "some", "reader").agg(F.count("*").alias("n")), "reader", "some")
    last = at.select("k", "size", "reader", "tie").join(readers.select("k", "size", "reader", "need"), ["k", "size", "reader"])
    in_order = Window.partitionBy("k", "size").orderBy("tie")
    ties = last.withColumn("i", F.row_number().over(in_order)).where("i = need").select("k", "size", F.col("tie").alias("tie_to"))
    taken = F.col("whole") + (F.col("tie") <= F.col("tie_to")).cast("long")
    among = at.join(ties, ["k", "size"]).select(*rows.columns, taken.alias("copies"))
    return met.where(~F.coalesce(tied, F.lit(False))).select(*rows.columns, copies).unionByName(among)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (words taken, copies counted), one row per input row.

    Every source takes all its documents as often as its target holds them whole, and some once more: how many of
    each length is fitted to the rest of the target, and which ones a seeded hash of the row decides, so that reruns
    agree. Documents without words, NULL texts among them, are taken 0 words. A NULL source is a source of its own.
    Repeated rows count as often as they occur; of those with one doc_id and text that the cut falls among, as many are
    taken as the target needs. An empty table gives no rows. Other columns
    are not looked at.

    Counts by source and length are combined before the shuffle. One source's lengths are fitted in one task: there
    are as many as there are lengths, however many rows. Rows are only put in order in parts of about PART_ROWS.
    """
    sized, targets, decided = _plan(docs, weights, share, most, seed)
    rows = _with_copies(sized, decided).join(targets.drop("source"), "k")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them, with their columns as they are."""
    _, _, decided = _plan(docs, weights, share, most, seed)
    rows = _with_copies(_sized(docs, seed, F.struct("*").alias("row")), decided).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
