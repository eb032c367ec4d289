"""Distinct counts that can be merged: a set of values per group and day, united over any range without its rows.

The exact form numbers every value once in a dictionary and keeps bitmaps of these numbers; the estimated form keeps
sketches of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A sketch has 2 ** SKETCH_BITS cells: its standard error is 1.04 / 2 ** (SKETCH_BITS / 2), 1.6 % here.
SKETCH_BITS = 12
DICTIONARY = "value string, id bigint, load string"


def _dictionary(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(DICTIONARY).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DICTIONARY)


def number_values(values: DataFrame, column: str, path: str, load: str) -> DataFrame:
    """Adds the values that the dictionary at ``path`` does not have, and returns it: ``value`` and ``id`` from 1 on.

    Numbers follow one another without gaps, which keeps the bitmaps dense. New values are numbered in each task and
    shifted by the tasks' counts, one row for each. ``load`` names this load's folder, so a repeated load replaces its
    own numbers. One load at a time.
    """
    spark = values.sparkSession
    earlier = _dictionary(spark, path).where(F.col("load") != load)
    new = values.select(F.col(column).cast("string").alias("value")).dropna().distinct().join(earlier, "value", "left_anti")
    row = F.monotonically_increasing_id()
    path_of = f"{path}-new/{load}"
    # Written first, as the numbers depend on how rows are dealt to tasks.
    new.select("value", F.shiftright(row, 33).alias("task"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("i")).write.mode("overwrite").parquet(path_of)
    placed = spark.read.schema("value string, task bigint, i bigint").parquet(path_of)
    start = earlier.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    # A row per task that wrote.
    tasks = placed.groupBy("task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.join(F.broadcast(tasks.select("task", before.alias("before"))), "task")
    numbered = numbered.select("value", (F.lit(start + 1) + F.col("before") + F.col("i")).alias("id"))
    numbered.write.mode("overwrite").parquet(f"{path}/load={load}")
    return _dictionary(spark, path)


def bitmaps(rows: DataFrame, by: Sequence[str], column: str, dictionary: DataFrame) -> DataFrame:
    """(by, bucket, bits): the exact set of a group's values, 64 numbers of the dictionary in every row; NULL is a value of
    its own, in bucket -1.

    Only words with a value are there, so a group has no more rows than values, and many small groups take no more room
    than their rows. Each (group, value) is looked up once, however many rows have it.
    """
    once = rows.select(*by, F.col(column).cast("string").alias("value")).distinct()
    ids = once.join(dictionary.select("value", "id"), "value", "left")
    checked = F.when(F.col("id").isNull(), F.raise_error(F.lit("a value is not in the dictionary")).cast("bigint")).otherwise(F.col("id"))
    known = F.col("value").isNotNull()
    placed = ids.select(
        *by,
        F.when(known, F.shiftright(checked, 6)).otherwise(F.lit(-1)).cast("bigint").alias("bucket"),
        F.when(known, F.expr("shiftleft(1L, cast(id & 63 AS int))")).otherwise(F.lit(1)).cast("bigint").alias("bits"),
    )
    return placed.groupBy(*by, "bucket").agg(F.bit_or("bits").alias("bits"))


def count_of_bitmaps(sets: DataFrame, by: Sequence[str], name: str, with_null: bool) -> DataFrame:
    """Distinct values of the union of all sets of a group; without NULL as ``count(DISTINCT)`` or with it as a member."""
    united = sets.groupBy(*by, "bucket").agg(F.bit_or("bits").alias("bits"))
    kept = F.bit_count("bits") if with_null else F.when(F.col("bucket") >= 0, F.bit_count("bits")).otherwise(0)
    return united.groupBy(*by).agg(F.sum(kept).cast("bigint").alias(name))


def sketches(rows: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """(by, sketch): the values of a group in a few KB, NULL not counted."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(F.col(column).cast("string"), F.lit(SKETCH_BITS)).alias("sketch"))


def estimate_of_sketches(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """About how many distinct values the union of a group's sketches has."""
    return sets.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def within_error(estimate: Column, exact: Column, errors: float = 3) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count."""
    return F.abs(estimate - exact) <= F.greatest(errors * 1.04 / 2 ** (SKETCH_BITS / 2) * exact, F.lit(1.0))
