"""Insert-unique into the snapshot table: the first row of a key wins, later ones are rejected and counted."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwatch.operators.grouping import first_per_key
from snapwatch.schema import POSTING_COLUMNS

KEY = ("Crawl_Date", "unique_id")


def stamp(records: DataFrame, day: dt.date | None = None, ingest_ts: str | None = None) -> DataFrame:
    """Add ``Crawl_Date``: a fixed day, or per row the day of its ingest time (a crawl past midnight splits)."""
    value = F.to_date(F.col(ingest_ts)) if ingest_ts else F.lit(day).cast("date")
    return records.withColumn("Crawl_Date", value)


def as_postings(df: DataFrame) -> DataFrame:
    """The 13 columns in export order, ids as text."""
    return df.select(*(F.col(c).cast("string").alias(c) if c == "Job_id" else F.col(c) for c in POSTING_COLUMNS))


def not_stored(rows: DataFrame, stored: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows whose key the table does not hold yet, for ``rows`` with one row per key."""
    return rows.join(stored.select(*key), list(key), "left_anti")


def insert_unique(
    batch: DataFrame,
    order: Sequence[str | Column],
    stored: DataFrame | None = None,
    key: Sequence[str] = KEY,
) -> DataFrame:
    """The accepted rows of ``batch``: first by ``order`` within their key, and not in ``stored``.

    A key needs a day and an id; rows without are not accepted. Copies of a hot key shrink to one
    row per map task before the shuffle. Pass ``stored`` already limited to the days of the batch
    so that only those partitions are read.
    """
    firsts = first_per_key(batch.dropna(subset=list(key)), key, order)
    return not_stored(firsts, stored, key) if stored is not None else firsts


def rejected_per_site(batch: DataFrame, accepted: DataFrame) -> DataFrame:
    """(Site, accepted, rejected) from the counts of both frames."""
    came = batch.select("Site", F.lit(1).alias("came"), F.lit(0).alias("took"))
    took = accepted.select("Site", F.lit(0).alias("came"), F.lit(1).alias("took"))
    return (
        came.unionByName(took)
        .groupBy("Site")
        .agg(F.sum("took").alias("accepted"), (F.sum("came") - F.sum("took")).alias("rejected"))
    )


def count_arrivals(batch: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(Site, accepted, rejected) of a batch into an empty table, by counting keys only.

    The rows themselves are not shuffled. A row without a key is rejected. A key belongs to one board, as ids carry the board prefix.
    """
    keys = batch.groupBy("Site", *[k for k in key if k != "Site"]).agg(F.count("*").alias("copies"))
    accepted = F.count_if(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key)))
    return keys.groupBy("Site").agg(accepted.alias("accepted"), (F.sum("copies") - accepted).alias("rejected"))
