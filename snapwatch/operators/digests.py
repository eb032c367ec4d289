"""Whole-row distinct and once-only for wide rows of which few are repeated: digests are shuffled in place of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.operators.grouping import once_only
from snapwatch.session import work_dir

_DIGEST = ["_digest_1", "_digest_2"]


def digest(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes; equal rows have equal ones, and what else has equal ones is told apart by its values."""
    return [F.xxhash64(*columns).alias(_DIGEST[0]), F.xxhash64(F.lit(1), *reversed(columns)).alias(_DIGEST[1])]


def _parted(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose digest no other row has, all others). Digests that are there twice are written to the shared folder,
    so that Spark knows their size: it broadcasts them while they are small, and joins by digest beyond that."""
    spark, path = df.sparkSession, f"{work_dir(df.sparkSession, 'digests')}/repeated"
    counts = df.select(*digest(df.columns)).groupBy(*_DIGEST).agg(F.count("*").alias("_n"))
    counts.where("_n > 1").select(*_DIGEST).write.parquet(path)
    repeated = spark.read.schema(", ".join(f"{name} long" for name in _DIGEST)).parquet(path)
    marked = df.select("*", *digest(df.columns))
    return tuple(marked.join(repeated, _DIGEST, how).select(*df.columns) for how in ("left_anti", "left_semi"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()``, with 16 bytes a row shuffled, and whole rows of repeated digests only.

    NULLs are equal to each other, as in ``distinct``; empty tables give no rows. ``df`` is read three times, so it must
    give the same rows each time. It pays where rows are wide and few are repeated; else ``distinct`` is better.
    """
    alone, others = _parted(df)
    return alone.unionByName(others.distinct())


def rows_once(df: DataFrame) -> DataFrame:
    """``grouping.once_only`` under the same terms: rows that occur exactly once; every copy of a repeated row goes."""
    alone, others = _parted(df)
    return alone.unionByName(once_only(others))
