"""Streams whose state ends: ids of a run, and the close of a board's day as an event."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructField, StructType

from snapwatch.streaming.ingest import CUTOFF_MINUTES, first_in_batches, in_time

# Rows are counted in so many parts, so that a board with most rows is many keys and no batch has more keys than that.
SLOTS = 64
# A run's ids are kept in so many parts, as a call for every single id costs far more than its row.
PARTS = 256
ROW, LATE, CLOSED = "row", "late", "closed"


def _filled(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Without the empty frames, which have no columns, of keys whose state has timed out."""
    return (part for part in parts if len(part))


def _millis(day: dt.date, minutes: int) -> int:
    """Milliseconds since 1970 of a UTC day and minute."""
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.UTC).timestamp() * 1000) + minutes * 60_000


def first_of_run(arrivals: DataFrame, run: str, key: str, order: str, event_time: str, delay: str) -> DataFrame:
    """A stream's first row of every ``key`` in a ``run`` (a day): the first batch that has it, and there the smallest ``order``.

    State is the ids of a run in PARTS parts, of which a batch reads those that its ids fall into. It ends when ``event_time``
    of the stream, less ``delay``, has passed the day, so it holds the ids of open days only. Rows without run or key
    never count; Spark drops rows that are older than the stream's time less ``delay`` and counts them in the progress.
    Any state store will do.
    """

    def first(of: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(_filled(parts)))
        before = state.get[0] if state.exists else []
        new = rows[~rows["run_id"].isin(before)].sort_values(order, kind="stable").drop_duplicates("run_id")
        if len(new):
            state.update(([*before, *new["run_id"]],))
            yield new[names]
        _until(state, _millis(of[0], 24 * 60))

    names = arrivals.columns
    named = arrivals.where(F.col(run).isNotNull() & F.col(key).isNotNull())
    timed = first_in_batches(named, [run, key], order).withWatermark(event_time, delay)
    dealt = timed.withColumns({"run_id": F.col(key).cast("string"), "run_part": F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")})
    return dealt.groupBy(run, "run_part").applyInPandasWithState(
        first, arrivals.schema, "seen array<string>", "append", GroupStateTimeout.EventTimeTimeout
    )


def _until(state: GroupState, end: int) -> bool:
    """Ends the state when the stream's time has come to ``end``; at once, and True, if it has already."""
    passed = state.getCurrentWatermarkMs() >= end
    if passed:
        state.remove()
    else:  # a state times out when the stream's time is greater than its own
        state.setTimeoutTimestamp(end - 1)
    return passed


def utc_day(ts: str) -> Column:
    """The UTC day of a time, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(F.col(ts)) / 86_400_000_000).cast("int"))


def start_day_close(
    arrivals: DataFrame, path: str, checkpoint: str, spread_by: str, board: str = "Site", ts: str = "ingest_ts", delay: str = "10 minutes"
) -> StreamingQuery:
    """Rows in time, late rows and the close of every board's day, all from one pass over the stream.

    A row is in time up to the daily cut-off (UTC); others, those without a time among them, are late and kept apart.
    When ``ts`` of the stream, less ``delay``, has passed a day's cut-off, the number of its rows in time is told once
    per board, and the state of that day is gone. A board without rows in time has no close. Rows of a board's day are
    dealt by ``spread_by`` to SLOTS counters; each holds all its open days and boards, so a batch calls a counter once, and
    all tell a day in the same batch. Any state store will do.

    ``ts`` is when a row came in, so it grows with the stream; Spark drops rows that are older than its time less
    ``delay`` and counts them in the progress.
    """
    names = ["close_day", *arrivals.columns]
    marked = arrivals.withWatermark(ts, delay).select(
        utc_day(ts).alias("close_day"),
        "*",
        F.coalesce(in_time(ts), F.lit(False)).alias("close_on_time"),
        F.pmod(F.xxhash64(spread_by), F.lit(SLOTS)).cast("int").alias("close_slot"),
    )
    # A close has no other values, so every column may be NULL.
    fields = [StructField(f.name, f.dataType) for f in marked.schema.fields if f.name in names]
    schema = StructType([*fields, StructField("kind", StringType()), StructField("n", LongType())])
    # Open days and boards as lists side by side, with the rows in time so far.
    kinds = {"day": DateType(), "board": marked.schema[board].dataType, "n": LongType()}
    counted = StructType([StructField(name, ArrayType(kind)) for name, kind in kinds.items()])

    def close(ended: list[tuple], counts: dict[tuple, int]) -> pd.DataFrame:
        filled = {"close_day": [of[0] for of in ended], board: [of[1] for of in ended]}
        empty = {name: [None] * len(ended) for name in names}
        return pd.DataFrame({**empty, **filled, "kind": CLOSED, "n": pd.array([counts[of] for of in ended], "Int64")})

    def count(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Rows with their kind; those in time are counted by day and board until the day's cut-off."""
        counts = dict(zip(zip(*state.get[:2]), state.get[2])) if state.exists else {}
        for part in _filled(parts):
            came = part.loc[part["close_on_time"], ["close_day", board]]
            for of, n in Counter((day, None if pd.isna(name) else name) for day, name in zip(came["close_day"], came[board])).items():
                counts[of] = counts.get(of, 0) + n
            kind = part["close_on_time"].map({True: ROW, False: LATE})
            yield part[names].assign(kind=kind, n=pd.array([None] * len(part), "Int64"))
        now = state.getCurrentWatermarkMs()
        if ended := [of for of in counts if _millis(of[0], CUTOFF_MINUTES) <= now]:
            yield close(ended, counts)
        if still := {of: n for of, n in counts.items() if _millis(of[0], CUTOFF_MINUTES) > now}:
            state.update(([day for day, _ in still], [name for _, name in still], list(still.values())))
            _until(state, min(_millis(day, CUTOFF_MINUTES) for day, _ in still))
        elif state.exists:
            state.remove()

    told = marked.groupBy("close_slot").applyInPandasWithState(count, schema, counted, "append", GroupStateTimeout.EventTimeTimeout)

    def write(batch: DataFrame, batch_id: int) -> None:
        # A retried batch replaces its own folders.
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch_id").parquet(path)

    return told.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _told(spark: SparkSession, path: str, schema: StructType, kind: str) -> DataFrame:
    written = StructType(
        [StructField("close_day", DateType()), *schema.fields]
        + [StructField("n", LongType()), StructField("kind", StringType()), StructField("batch_id", LongType())]
    )
    return spark.read.schema(written).parquet(path).where(F.col("kind") == kind)


def rows_in_time(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _told(spark, path, schema, ROW).select(*schema.names)


def late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _told(spark, path, schema, LATE).select(*schema.names)


def closed_days(spark: SparkSession, path: str, schema: StructType, board: str = "Site") -> DataFrame:
    """(day, board, n, batch_id) of every day that was closed, and the batch in which it was."""
    parts = _told(spark, path, schema, CLOSED)
    return parts.groupBy(F.col("close_day").alias("day"), board, "batch_id").agg(F.sum("n").alias("n")).select("day", board, "n", "batch_id")
