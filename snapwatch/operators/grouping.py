"""Per-group counts on every row, first row per key and running totals, safe against hot groups.

A window over a hot group would run in one task. Here groups are reduced before a shuffle, and rows
of a hot group are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A group is hot above this share of all rows, so there are at most 1 / HOT_SHARE hot groups to broadcast.
HOT_SHARE = 0.0001


def literal_rows(spark: SparkSession, name: str, values: Sequence[str]) -> DataFrame:
    """A column of the given few values, built without Python workers."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*(F.lit(v) for v in values))).alias(name))


def _whole(keys: Sequence[str]) -> Column:
    """Whether no key column is NULL."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def _is_hot(counts: DataFrame) -> Column:
    """On (keys, _rows): whether the group has more than its share. Holds for at most 1 / HOT_SHARE groups."""
    return F.col("_rows") > counts.agg(F.sum("_rows")).scalar() * HOT_SHARE


def _join_lookup(df: DataFrame, hot: DataFrame, cold: DataFrame, keys: Sequence[str], spread_by: str) -> DataFrame:
    """``df`` with ``_value`` of its key, NULL without one.

    ``hot`` and ``cold`` are (keys, _value) with one row per key; ``hot`` has all hot keys, a bounded number,
    and is broadcast. Rows of hot groups and rows with a NULL key have nothing to find in ``cold``: they are
    spread over the tasks of that join by ``spread_by`` instead of all meeting in one.
    """
    hot = hot.select(*keys, F.col("_value").alias("_hot_value"), F.lit(True).alias("_hot"))
    cold = cold.select(*keys, F.col("_value").alias("_cold_value"), F.lit(-1).cast("bigint").alias("_spread"))
    marked = df.join(F.broadcast(hot), list(keys), "left")
    meets_cold = _whole(keys) & F.col("_hot").isNull()
    place = F.when(meets_cold, F.lit(-1)).otherwise(F.shiftrightunsigned(F.xxhash64(spread_by), 1))
    joined = marked.withColumn("_spread", place.cast("bigint")).join(cold, [*keys, "_spread"], "left")
    return joined.select(*df.columns, F.coalesce("_hot_value", "_cold_value").alias("_value"))


def with_group_count(df: DataFrame, keys: Sequence[str], counted: str, name: str, spread_by: str) -> DataFrame:
    """Every row of ``df`` plus the number of non-null ``counted`` values in its group.

    The count is NULL where a key is NULL. Counts are pre-aggregated and joined back; a hot group stays spread.
    """
    counts = (
        df.where(_whole(keys)).groupBy(*keys).agg(F.count(counted).alias("_value"), F.count("*").alias("_rows"))
    )
    hot = _is_hot(counts)
    joined = _join_lookup(df, counts.where(hot), counts.where(~hot), keys, spread_by)
    return joined.withColumnRenamed("_value", name)


def rows_by_key(df: DataFrame, known: DataFrame, keys: Sequence[str], present: bool, spread_by: str) -> DataFrame:
    """Rows whose key is (``present``) or is not among the ``known`` ones; a hot key in ``df`` stays spread.

    A NULL key is among none. For frames with few rows per key a plain semi or anti join is cheaper.
    """
    counts = df.where(_whole(keys)).groupBy(*keys).agg(F.count("*").alias("_rows"))
    lookup = known.select(*keys).distinct().withColumn("_value", F.lit(True))
    hot_keys = counts.where(_is_hot(counts)).select(*keys)
    joined = _join_lookup(df, hot_keys.join(lookup, list(keys), "left"), lookup, keys, spread_by)
    return joined.where(F.col("_value").isNotNull() if present else F.col("_value").isNull()).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key. ``order`` must be total within a key for a repeatable result.

    Catalyst limits every key to one row per map task before the shuffle, so a hot key sends only
    one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def once_only(df: DataFrame) -> DataFrame:
    """Rows that occur exactly once; every copy of a repeated row goes."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")


def running_total(
    df: DataFrame, index: str, values: Sequence[str], by: Sequence[str] = (), block: int = 65536
) -> DataFrame:
    """Running totals ``<value>_so_far`` over a whole-number ``index``, unique within ``by``.

    Two levels: totals of index blocks run first, then rows run inside their block, so no task sees
    more than ``block`` rows, or the block totals of one group.
    """
    blocked = df.withColumn("_block", F.floor(F.col(index) / block))
    keys = [*by, "_block"]
    sums = blocked.groupBy(*keys).agg(*(F.sum(v).alias(f"_{v}") for v in values))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"_of_{k}") for k in keys]
    offsets = sums.select(*named, *(F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_before_{v}") for v in values))
    inside = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = blocked.select("*", *(F.sum(v).over(inside).alias(f"_in_{v}") for v in values))
    # Grouping columns may be NULL: match them null-safely.
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    totals = [(F.col(f"_in_{v}") + F.col(f"_before_{v}")).alias(f"{v}_so_far") for v in values]
    return run.join(offsets, on, "left").select(*df.columns, *totals)


def with_next(df: DataFrame, index: str, name: str, by: Sequence[str] = (), block: int = 65536) -> DataFrame:
    """Every row plus ``name``, the next larger ``index`` of its group; ``index`` is a whole number, unique within ``by``.

    Two levels, as in ``running_total``: rows look ahead inside their block of indexes, and the last of a block takes
    the first index of the group's next block, so no task sees more than a block's rows or a group's blocks.
    """
    blocked = df.withColumn("_block", F.floor(F.col(index) / block))
    keys = [*by, "_block"]
    ahead = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_block")
    firsts = blocked.groupBy(*keys).agg(F.min(index).alias("_first"))
    named = [F.col(k).alias(f"_of_{k}") for k in keys]
    after = firsts.select(*named, F.lead("_first").over(ahead).alias("_after"))
    inside = blocked.withColumn("_inside", F.lead(index).over(Window.partitionBy(*keys).orderBy(index)))
    # Grouping columns may be NULL: match them null-safely.
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return inside.join(after, on, "left").select(*df.columns, F.coalesce("_inside", "_after").alias(name))
