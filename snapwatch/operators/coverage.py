"""How many postings each page, board and region gave, and which pages are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwatch.operators.grouping import running_total, with_next

_CHUNK = 10_000


def postings_per_page(postings: DataFrame) -> DataFrame:
    return postings.groupBy("Site", "page").agg(F.count("*").alias("n"))


def page_and_board_counts(postings: DataFrame) -> DataFrame:
    """Both levels in one pass; a board's total has ``page`` NULL."""
    levels = postings.rollup("Site", "page").agg(F.count("*").alias("n"), F.grouping_id().alias("_level"))
    return levels.where("_level < 3").drop("_level")


def running_postings(per_page: DataFrame) -> DataFrame:
    """Postings so far by page within each board."""
    return running_total(per_page, "page", ["n"], by=["Site"])


def postings_per_region(postings: DataFrame) -> DataFrame:
    return postings.groupBy("location_id").agg(F.count("*").alias("n"))


def region_count(postings: DataFrame) -> DataFrame:
    return postings.agg(F.count_distinct("location_id").alias("regions"))


def page_gaps(pages: DataFrame) -> DataFrame:
    """(Site, from_page, to_page, reason): ranges of pages without postings (``empty``) or never seen (``missing``).

    ``pages`` has (Site, page, n, total_pages). Pages are expected from 0 to the largest announced total of the board;
    none is expected of a board that announces nothing. A page is empty if all its rows have no postings. Rows without
    a page only count for the total.

    The result is bounded by the pages that were seen, at most two ranges for each, whatever totals are announced: the
    gaps lie between one seen page and the next, and runs of empty pages are islands of page minus rank.
    """
    seen = pages.where("page is not null").groupBy("Site", "page").agg(F.sum("n").alias("n"))
    last = pages.groupBy(F.col("Site").alias("_of")).agg(F.max("total_pages").cast("bigint").alias("last")).where("last >= 0")
    # Page -1 stands before the first expected page of every board.
    marks = seen.where("page >= 0").select("Site", F.col("page").cast("bigint").alias("page"))
    marks = marks.unionByName(last.select(F.col("_of").alias("Site"), F.lit(-1).cast("bigint").alias("page")))
    ahead = with_next(marks, "page", "next", by=["Site"]).join(last, F.col("Site").eqNullSafe(F.col("_of")))
    until = F.least(F.coalesce(F.col("next") - 1, F.col("last")), F.col("last"))
    missing = ahead.select("Site", (F.col("page") + 1).alias("from_page"), until.alias("to_page"), F.lit("missing").alias("reason"))
    empty = seen.where("n = 0").select("Site", F.col("page").cast("bigint").alias("page"), F.lit(1).cast("bigint").alias("one"))
    islands = running_total(empty, "page", ["one"], by=["Site"]).groupBy("Site", (F.col("page") - F.col("one_so_far")).alias("_island"))
    runs = islands.agg(F.min("page").alias("from_page"), F.max("page").alias("to_page")).drop("_island")
    return missing.where("from_page <= to_page").unionByName(runs.withColumn("reason", F.lit("empty")))


def uncovered_pages(pages: DataFrame) -> DataFrame:
    """(Site, page, reason) of every single page in ``page_gaps``, for boards whose announced totals can be trusted.

    A range is produced in two steps, so that no row ever holds the whole list.
    """
    chunk = lambda page: F.floor(F.col(page) / _CHUNK)
    chunks = page_gaps(pages).withColumn("chunk", F.explode(F.sequence(chunk("from_page"), chunk("to_page"))))
    lower, upper = F.col("chunk") * _CHUNK, (F.col("chunk") + 1) * _CHUNK - 1
    listed = F.sequence(F.greatest("from_page", lower), F.least("to_page", upper))
    return chunks.repartition("Site", "chunk").select("Site", F.explode(listed).alias("page"), "reason")
