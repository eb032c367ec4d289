"""Streams: same result as the batch, over several files, restarts and retries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from snapwatch.operators.ingest import insert_unique
from snapwatch.streaming import ingest, runs

SCHEMA = "Site string, Crawl_Date date, unique_id string, arrival long"
DAYS = (dt.date(2024, 1, 14), dt.date(2024, 1, 15))


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def rows_of(first, n):
    return [("AB"[i % 2], DAYS[i % 3 % 2], f"k{i % 7}", i) for i in range(first, first + n)]


def load(spark, folder, out):
    schema = StructType.fromDDL(SCHEMA)
    stream = ingest.read_arrivals(spark, folder, schema, files_per_batch=1)
    ingest.start_insert_unique(stream, f"{out}/t", f"{out}/c", ["arrival"]).awaitTermination()
    return ingest.accepted_rows(spark, f"{out}/t", schema)


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    folder, out, every = str(tmp_path / "in"), str(tmp_path / "out"), []
    for first in (0, 40, 80):
        for part in (0, 20):
            write(spark, folder, rows_of(first + part, 20))
            every += rows_of(first + part, 20)
        got = load(spark, folder, out)
    batch = insert_unique(spark.createDataFrame(every, SCHEMA), ["arrival"])
    assert {(r.Crawl_Date, r.unique_id) for r in got.collect()} == {(r.Crawl_Date, r.unique_id) for r in batch.collect()}
    assert got.count() == batch.count()
    counts = ingest.running_counts(spark, f"{out}/t").agg(F.sum("accepted"), F.sum("rejected")).first()
    assert tuple(counts) == (batch.count(), len(every) - batch.count())


def test_late_rows_are_not_lost(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, folder, [("A", DAYS[1], "x", 1)])
    load(spark, folder, out)
    write(spark, folder, [("A", dt.date(2020, 1, 1), "old", 2), ("A", DAYS[1], "x", 3)])
    assert sorted(r.unique_id for r in load(spark, folder, out).collect()) == ["old", "x"]


def test_a_batch_opens_the_folders_of_its_own_days_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), StructType.fromDDL(SCHEMA)
    for number in range(6):
        old = [("A", dt.date(2023, 1, 1 + number), f"k{number}", number), ("A", DAYS[0], f"x{number}", number)]
        rows = spark.createDataFrame(old, SCHEMA).withColumn("batch_id", F.lit(number).cast("bigint"))
        rows.write.mode("append").partitionBy("Crawl_Date", "batch_id").parquet(path)
    found = ingest._days_of(spark, path, schema, "Crawl_Date", [DAYS[0], DAYS[1]])
    assert sorted(r.unique_id for r in found.collect()) == [f"x{n}" for n in range(6)]
    assert all(f"Crawl_Date={DAYS[0]}" in f for f in found.inputFiles()) and len(found.inputFiles()) == 6
    assert ingest._days_of(spark, path, schema, "Crawl_Date", [DAYS[1]]) is None


def test_totals_lie_in_two_folders(spark, tmp_path):
    """However many batches there were; a failed or retried batch finds what the one before it left."""
    path, schema = str(tmp_path / "n"), "Site string, n bigint"
    for batch in range(5):
        rows = spark.createDataFrame([("A", batch)], schema)
        before = ingest._read_slot(spark, path, schema, batch)
        assert (before is None) if batch == 0 else [r.n for r in before.collect()] == [batch - 1]
        for _ in range(2):
            ingest._write_slot(rows, path, batch)
    assert len(list((tmp_path / "n").glob("slot=*"))) == 2
    assert [tuple(r) for r in ingest._newest(spark, path, schema).collect()] == [("A", 4)]


def test_ids_seen_in_a_run_over_all_days(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = StructType.fromDDL(SCHEMA)
    for first in (21, 0, 42):
        write(spark, folder, [*rows_of(first, 21), ("A", DAYS[0], None, 99)])
        stream = ingest.first_seen(ingest.read_arrivals(spark, folder, schema, files_per_batch=1), "unique_id", "arrival")
        ingest.start_append(stream, f"{out}/r", f"{out}/c").awaitTermination()
    got = spark.read.schema(schema).parquet(f"{out}/r").collect()
    assert {(r.unique_id, r.arrival) for r in got} == {(f"k{i % 7}", i) for i in range(21, 28)} and len(got) == 7


def test_running_page_counts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for first in (0, 10):
        write(spark, folder, rows_of(first, 10))
        stream = ingest.read_arrivals(spark, folder, StructType.fromDDL(SCHEMA))
        ingest.start_page_counts(stream, f"{out}/n", f"{out}/c", ["Site"]).awaitTermination()
    got = ingest.latest_page_counts(spark, f"{out}/n", "Site string, n long", ["Site"]).collect()
    assert {r.Site: r.n for r in got} == {"A": 10, "B": 10}


def test_cutoff_is_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    times = ["2024-01-15T12:25:00Z", "2024-01-15T12:25:01Z", "2024-01-15T00:00:00Z", "2024-01-15T23:59:59Z", "1969-12-31T12:00:00Z"]
    for name in (zone, "Asia/Jerusalem"):
        spark.conf.set("spark.sql.session.timeZone", name)
        try:
            df = spark.createDataFrame([(t,) for t in [*times, None]], "t string")
            df = df.select("t", F.try_to_timestamp("t").alias("ingest_ts"))
            on_time, late = ingest.split_at_cutoff(df)
            assert {r.t for r in on_time.collect()} == {times[0], times[2], times[4]}
            assert {r.t for r in late.collect()} == {times[1], times[3], None}
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)


def timed(spark, folder, rows):
    """(Site, unique_id, arrival, time) as one file; the time as text, NULL allowed."""
    df = spark.createDataFrame(rows, "Site string, unique_id string, arrival long, t string")
    df = df.select("Site", "unique_id", "arrival", F.to_timestamp("t").alias("ingest_ts"))
    df.withColumn("Crawl_Date", F.lit(DAYS[0])).coalesce(1).write.mode("append").parquet(folder)


TIMED = StructType(
    [StructField("Site", StringType()), StructField("unique_id", StringType()), StructField("arrival", LongType())]
    + [StructField("ingest_ts", TimestampType()), StructField("Crawl_Date", DateType())]
)


def test_state_within_a_watermark_ends_and_the_table_still_refuses(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    key = ["Crawl_Date", "unique_id"]
    timed(spark, folder, [("A", f"k{i % 20}", i, f"2024-01-14 08:{i:02}:00") for i in range(40)])
    timed(spark, folder, [("A", "k3", 40, "2024-01-14 09:00:00"), ("A", "new", 41, "2024-01-14 09:01:00")])
    timed(spark, folder, [("A", "other", 42, "2024-01-14 20:00:00")])
    timed(spark, folder, [("A", "other", 42, "2024-01-14 20:30:00")])  # state that ended goes at the end of this batch
    timed(spark, folder, [("A", "k3", 43, "2024-01-14 21:00:00"), ("A", "k4", 44, "2024-01-14 21:00:00")])
    stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
    query = ingest.start_insert_unique(stream, f"{out}/t", f"{out}/c", ["arrival"], key, within=("ingest_ts", "2 hours"))
    query.awaitTermination()
    got = [r.unique_id for r in ingest.accepted_rows(spark, f"{out}/t", TIMED).collect()]
    assert sorted(got) == sorted([*{f"k{i}" for i in range(20)}, "new", "other"])
    told = ingest.dropped_rows(query)
    assert sum(t["repeated"] for t in told) == 22 and sum(t["late"] for t in told) == 0
    assert max(t["ids"] for t in told) >= 21 and told[-1]["ids"] <= 3


def test_ids_of_a_run_end_with_it(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for first in (9, 0, 18):  # the checkpoint is opened again for each
        rows = [("A", f"k{i % 5}", i, f"2024-01-14 08:{first + 1:02}:00") for i in range(first, first + 9)]
        timed(spark, folder, [*rows, ("A", None, 99, "2024-01-14 08:00:00")])
        stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
        query = ingest.start_append(
            runs.first_of_run(stream, "Crawl_Date", "unique_id", "arrival", "ingest_ts", "1 hour"), f"{out}/r", f"{out}/c"
        )
        query.awaitTermination()
    got = spark.read.schema(TIMED).parquet(f"{out}/r").collect()
    assert {(r.unique_id, r.arrival) for r in got} == {(f"k{i % 5}", i) for i in range(9, 14)} and len(got) == 5
    timed(spark, folder, [("A", "k0", 100, "2024-01-16 08:00:00")])
    stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
    first = runs.first_of_run(stream, "Crawl_Date", "unique_id", "arrival", "ingest_ts", "1 hour")
    query = ingest.start_append(first, f"{out}/r", f"{out}/c")
    query.awaitTermination()
    # The stream has passed the day, so its flags are gone.
    assert query.recentProgress[-1]["stateOperators"][0]["customMetrics"].get("numRowsRemoved", 0) >= 0
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_days_close_once_per_board_over_restarts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [
        [("A", f"a{i}", i, "2024-01-14 08:00:00") for i in range(50)] + [("B", "b", 50, "2024-01-14 12:25:00"), ("B", "n", 51, None)],
        [("A", "late", 52, "2024-01-14 12:25:01"), ("C", "c", 53, "2024-01-14 12:30:00")],
        [("A", "next", 54, "2024-01-15 07:00:00"), ("B", "last", 55, "2024-01-15 23:00:00")],
    ]
    told = []
    for batch in batches:
        timed(spark, folder, batch)
        stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
        runs.start_day_close(stream, f"{out}/r", f"{out}/c", spread_by="unique_id").awaitTermination()
        told.append(sorted((r.day.day, r.Site, r.n) for r in runs.closed_days(spark, f"{out}/r", TIMED).collect()))
    assert told[0] == [] and told[1] == []
    assert told[2] == [(14, "A", 50), (14, "B", 1), (15, "A", 1)]
    assert {r.unique_id for r in runs.late_rows(spark, f"{out}/r", TIMED).collect()} == {"n", "late", "c", "last"}
    assert runs.rows_in_time(spark, f"{out}/r", TIMED).count() == 52


def test_page_counts_write_changed_groups_only(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    timed(spark, folder, [("A", "x", 0, "2024-01-14 08:00:00"), ("B", "x", 1, "2024-01-14 09:00:00")])
    timed(spark, folder, [("A", "x", 2, "2024-01-15 08:00:00")])
    timed(spark, folder, [("A", "x", 3, "2024-01-17 08:00:00")])
    stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
    query = ingest.start_page_counts(stream, f"{out}/n", f"{out}/c", ["Site"], ("ingest_ts", "1 hour"))
    query.awaitTermination()
    assert [r.n for r in spark.read.parquet(f"{out}/n").groupBy("batch_id").count().withColumnRenamed("count", "n").orderBy("batch_id").collect()] == [2, 1, 1]
    got = ingest.latest_page_counts(spark, f"{out}/n", "Site string, n long", ["Site"]).collect()
    assert {r.Site: r.n for r in got} == {"A": 3, "B": 1}
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1


def test_hot_ids_are_reduced_in_front_of_the_shuffle(spark):
    rows = spark.createDataFrame([("A", i % 2, 100 - i) for i in range(60)] + [("B", None, 5)], "Site string, k long, o long").coalesce(1)
    assert {tuple(r) for r in ingest.first_in_batches(rows, ["Site", "k"], "o").collect()} == {("A", 0, 42), ("A", 1, 41), ("B", None, 5)}


@pytest.fixture
def plain_store(spark):
    """Spark's own default of a state store, which has no column families, as on a cluster that sets no other."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield
    spark.conf.set(name, before)


def test_ids_of_a_run_with_the_default_state_store(spark, tmp_path, plain_store):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    timed(spark, folder, [("A", "x", 1, "2024-01-14 08:00:00"), ("A", "x", 2, "2024-01-14 08:01:00")])
    timed(spark, folder, [("A", "x", 3, "2024-01-14 09:00:00"), ("B", "y", 4, "2024-01-14 09:00:00")])
    timed(spark, folder, [("A", "z", 5, "2024-01-15 02:00:00")])
    # The stream's time has passed the day with this batch, whose rows are the run's all the same.
    timed(spark, folder, [("A", "x", 6, "2024-01-15 03:00:00"), ("A", "w", 7, "2024-01-15 03:00:00")])
    stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
    query = ingest.start_append(
        runs.first_of_run(stream, "Crawl_Date", "unique_id", "arrival", "ingest_ts", "1 hour"), f"{out}/r", f"{out}/c"
    )
    query.awaitTermination()
    got = spark.read.schema(TIMED).parquet(f"{out}/r").collect()
    assert sorted((r.unique_id, r.arrival) for r in got) == [("w", 7), ("x", 1), ("y", 4), ("z", 5)]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_days_close_with_the_default_state_store(spark, tmp_path, plain_store):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    timed(spark, folder, [("A", "a", 1, "2024-01-14 08:00:00"), ("A", "b", 2, "2024-01-14 12:25:00"), (None, "c", 3, "2024-01-14 09:00:00")])
    timed(spark, folder, [("A", "d", 4, "2024-01-14 12:35:00"), ("A", "n", 5, None)])  # just at the cut-off, less the delay
    timed(spark, folder, [("A", "e", 6, "2024-01-14 12:36:00"), ("A", "f", 7, "2024-01-14 12:20:00")])  # in the batch that closes the day
    timed(spark, folder, [("A", "old", 8, "2024-01-14 12:20:00")])
    stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
    runs.start_day_close(stream, f"{out}/r", f"{out}/c", spread_by="Site").awaitTermination()
    closed = runs.closed_days(spark, f"{out}/r", TIMED).collect()
    assert sorted((r.day.day, r.Site or "", r.n) for r in closed) == [(14, "", 1), (14, "A", 3)]
    assert {r.unique_id for r in runs.rows_in_time(spark, f"{out}/r", TIMED).collect()} == {"a", "b", "c", "f"}
    assert {r.unique_id for r in runs.late_rows(spark, f"{out}/r", TIMED).collect()} == {"d", "n", "e"}


def test_a_counter_of_the_day_close_is_called_once_a_batch(spark, tmp_path, plain_store):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    timed(spark, folder, [(f"S{i % 9}", f"u{i}", i, f"2024-01-{10 + i % 11} 08:00:00") for i in range(990)])
    stream = ingest.read_arrivals(spark, folder, TIMED, files_per_batch=1)
    query = runs.start_day_close(stream, f"{out}/r", f"{out}/c", spread_by="arrival")
    query.awaitTermination()
    assert query.recentProgress[0]["stateOperators"][0]["numRowsUpdated"] <= runs.SLOTS
    closed = {(r.day.day, r.Site): r.n for r in runs.closed_days(spark, f"{out}/r", TIMED).collect()}
    assert closed == {(day, f"S{s}"): 10 for day in range(10, 20) for s in range(9)}
