"""Streams of arriving postings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from snapwatch.operators.ingest import KEY, insert_unique, rejected_per_site

# Fixed value: nothing of a day counts after 12:25 UTC.
CUTOFF_MINUTES = 12 * 60 + 25

COUNTS = "Site string, accepted bigint, rejected bigint"


def read_arrivals(
    spark: SparkSession, folder: str, schema: StructType, files: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _days_of(spark: SparkSession, path: str, schema: StructType, day: str, days: Sequence) -> DataFrame | None:
    """The rows of these days, with the batch that wrote them; only their own folders are opened."""
    written = StructType([*schema.fields, StructField("batch_id", LongType())])
    if not days:
        return None
    reader = spark.read.schema(written).option("basePath", path)
    try:  # of the folders listed, those that are there
        return reader.parquet(f"{path}/{day}={{{','.join(map(str, days))}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # the first rows of these days


def _read_slot(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame | None:
    """What the batch before ``batch_id`` left."""
    try:
        rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{path}/slot={(batch_id + 1) % 2}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.where(F.col("batch_id") < batch_id).drop("batch_id")


def _write_slot(rows: DataFrame, path: str, batch_id: int) -> None:
    """Totals up to a batch, in one of two folders in turn: a batch that fails leaves the other one whole."""
    writer = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").parquet(f"{path}/slot={batch_id % 2}")


def _newest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = spark.read.schema(f"{schema}, batch_id bigint, slot int").parquet(path)
    return rows.where(F.col("batch_id") == rows.agg(F.max("batch_id")).scalar()).drop("batch_id", "slot")


def start_insert_unique(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    order: Sequence[str | Column],
    key: Sequence[str] = KEY,
    day: str = "Crawl_Date",
    within: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Continuous insert-unique: accepted rows below ``path/accepted``, running counts per board below ``path/counts``.

    The written table is the state, so the rule holds for any delay and no row is dropped as late. The table lies
    in ``day=/batch_id=`` folders: a batch opens those of its own days only, however many other days or batches
    there are, and overwrites its own, so a retry after a failure gives the same result. ``key`` holds the day.

    ``within``, an arrival time and a delay, puts state in front of the table that drops repeated keys as long as
    their first row is no older than the delay; then it ends, and the table refuses later ones. It spares the table
    most repeated rows, but which row of a key in one batch goes on is left to Spark, and rows older than the
    stream's time less the delay are dropped; the progress counts both (``dropped_rows``).
    """
    if within:
        arrivals = arrivals.withWatermark(*within).dropDuplicatesWithinWatermark(list(key))
    rows, counts = f"{path}/accepted", f"{path}/counts"
    if day not in key:
        raise ValueError(f"the key has no {day}; ids that count once over all days: start_first_seen")

    def accept(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        came = batch.persist()
        try:
            days = [r[0] for r in came.select(day).distinct().collect() if r[0] is not None]
            earlier = _days_of(spark, rows, batch.schema, day, days)
            # A retried batch does not see its own first attempt.
            stored = None if earlier is None else earlier.where(F.col("batch_id") < batch_id)
            accepted = insert_unique(came, order, stored, key).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            writer = accepted.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(day, "batch_id").parquet(rows)
            written = _days_of(spark, rows, batch.schema, day, days)
            written = came.limit(0) if written is None else written.where(F.col("batch_id") == batch_id)
            so_far = _read_slot(spark, counts, COUNTS, batch_id)
            now = rejected_per_site(came, written)
            total = now if so_far is None else so_far.unionByName(now)
            _write_slot(total.groupBy("Site").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), counts, batch_id)
        finally:
            came.unpersist()

    writer = arrivals.writeStream.foreachBatch(accept).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def dropped_rows(query: StreamingQuery) -> list[dict[str, int]]:
    """Per batch that is still in the query's progress: ids in state, repeated rows that it dropped, rows too old for it."""
    told = []
    for progress in query.recentProgress:
        for state in progress["stateOperators"]:
            repeated = state["customMetrics"].get("numDroppedDuplicateRows", 0)
            told.append({"batch": progress["batchId"], "ids": state["numRowsTotal"], "repeated": repeated, "late": state["numRowsDroppedByWatermark"]})
    return told


def accepted_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/accepted").select(*schema.names)


def running_counts(spark: SparkSession, path: str) -> DataFrame:
    """(Site, accepted, rejected) over all batches so far."""
    return _newest(spark, f"{path}/counts", COUNTS)


def first_in_batches(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Of each key the row with the smallest ``order`` within every Arrow batch.

    A combine in front of a shuffle, which works on streams too: of a key with most rows a few rows per task go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pd.DataFrame({name: batch[name].to_pandas() for name in dict.fromkeys([*keys, order])})
            kept = frame.sort_values(order, kind="stable").drop_duplicates(list(keys)).index
            yield batch.take(pa.array(sorted(kept), pa.int64()))

    return rows.mapInArrow(run, rows.schema)


def first_seen(arrivals: DataFrame, key: str, order: str) -> DataFrame:
    """A stream's first row of every ``key``: the first batch that has it, and there the smallest ``order``.

    The ids that were seen are the stream's state, so a batch costs what it holds, not what came before it; ids that
    count within a run only: ``runs.first_of_run``, whose state ends. Rows without the key never count.
    """
    schema = arrivals.schema

    def first(_, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        best = None
        for part in parts:  # all of them have to be read, seen or not
            if not state.exists and len(part):
                least = part.nsmallest(1, order)
                if best is None or least[order].iloc[0] < best[order].iloc[0]:
                    best = least
        if best is not None:
            state.update((True,))
            yield best

    named = first_in_batches(arrivals.where(F.col(key).isNotNull()), [key], order)
    return named.groupBy(key).applyInPandasWithState(first, schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def start_page_counts(
    arrivals: DataFrame, path: str, checkpoint: str, by: Sequence[str], within: tuple[str, str] | None = None
) -> StreamingQuery:
    """Running number of postings per group; a batch writes the groups that it changed, and nothing else.

    ``within``, an arrival time and a delay, counts each day by itself and ends a day's state when the stream's time,
    less the delay, has passed it: state then holds the groups of open days, whatever was counted before. Rows that
    come later than that are dropped.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        # A retried batch replaces its own folder.
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    if within:
        days = arrivals.withWatermark(*within).groupBy(*by, F.window(within[0], "1 day"))
        counted = days.agg(F.count("*").alias("n"))
        counted = counted.select(*by, F.col("window.start").alias("_day"), "n")
    else:
        counted = arrivals.groupBy(*by).agg(F.count("*").alias("n")).withColumn("_day", F.lit(None).cast("timestamp"))
    writer = counted.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_page_counts(spark: SparkSession, path: str, schema: str, by: Sequence[str]) -> DataFrame:
    """The newest count of each group, over all its days: counts only grow, so a day's newest is its largest."""
    rows = spark.read.schema(f"{schema}, _day timestamp, batch_id bigint").parquet(path)
    days = rows.groupBy(*by, "_day").agg(F.max("n").alias("n"))
    return days.groupBy(*by).agg(F.sum("n").alias("n"))


def in_time(ts: str) -> Column:
    """Whether a row came by the daily cut-off, in UTC whatever the session's zone."""
    day_micros = 86_400_000_000
    return F.pmod(F.unix_micros(F.col(ts)), F.lit(day_micros)) <= CUTOFF_MINUTES * 60_000_000


def split_at_cutoff(rows: DataFrame, ts: str = "ingest_ts") -> tuple[DataFrame, DataFrame]:
    """(in time, late); a row without a time is late."""
    on_time = F.coalesce(in_time(ts), F.lit(False))
    return rows.where(on_time), rows.where(~on_time)


def start_append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet dataset with exactly-once files."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
