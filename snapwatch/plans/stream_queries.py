"""Streaming queries: the events table arrives as a file stream and is processed to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapwatch.operators.ingest import stamp
from snapwatch.plans.registry import query
from snapwatch.plans.table_queries import _ACCEPTED, _COUNTS, _arrivals
from snapwatch.plans.views import ARRIVAL_COLUMNS, EVENTS, V_PAGED, paged_of, table, with_arrival
from snapwatch.session import work_dir
from snapwatch.streaming import ingest, runs


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of four batches, in the order of their ids, each of as many files as tasks write."""
    folder = f"{work_dir(spark, 'arrivals')}/events"
    events = table(spark, sf_dir, "events")
    last, rows = events.agg(F.coalesce(F.max("event_id"), F.lit(0)), F.count("*")).first()
    quarter = F.floor(F.col("event_id") * 4 / (last + 1))
    files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 16))
    for number in range(4):  # one after the other, as the files' times give their order
        part = events.where(quarter == number).repartitionById(files, F.pmod("event_id", F.lit(files)).cast("int"))
        part.write.mode("append").parquet(folder)
    return ingest.read_arrivals(spark, folder, StructType.fromDDL(EVENTS), files_per_batch=files)


def _arrivals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_arrival(_events(spark, sf_dir)).select(*ARRIVAL_COLUMNS)


def _load(spark: SparkSession, arrivals: DataFrame) -> str:
    path = work_dir(spark, "stream")
    ingest.start_insert_unique(arrivals, f"{path}/table", f"{path}/checkpoint", ["arrival"]).awaitTermination()
    return f"{path}/table"


@query("st1_stream_insert_unique", _arrivals(_ACCEPTED))
def stream_insert_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = _arrivals_stream(spark, sf_dir)
    return ingest.accepted_rows(spark, _load(spark, arrivals), arrivals.schema)


@query(
    "st1_stream_within_watermark",
    _arrivals('SELECT "Site", "Company", "Crawl_Date", "unique_id" FROM accepted'),
)
def stream_within_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated ids of the last six hours end in state, older ones at the table; the row kept of an id is left open."""
    arrivals, path = with_arrival(_events(spark, sf_dir)), work_dir(spark, "stream")
    loading = ingest.start_insert_unique(
        arrivals, f"{path}/table", f"{path}/checkpoint", ["arrival"], within=("ingest_ts", "6 hours")
    )
    loading.awaitTermination()
    return ingest.accepted_rows(spark, f"{path}/table", arrivals.schema).select("Site", "Company", "Crawl_Date", "unique_id")


@query("st2_running_counts", _arrivals(_COUNTS))
def running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.running_counts(spark, _load(spark, _arrivals_stream(spark, sf_dir)))


@query(
    "st3_first_seen_ids",
    _arrivals("""SELECT "Site", "unique_id", "arrival" FROM v_arrivals
                 QUALIFY row_number() OVER (PARTITION BY "unique_id" ORDER BY "arrival") = 1"""),
)
def first_seen_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = _arrivals_stream(spark, sf_dir).select("Site", "unique_id", "arrival")
    path = work_dir(spark, "stream")
    ingest.start_append(ingest.first_seen(arrivals, "unique_id", "arrival"), f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(arrivals.schema).parquet(f"{path}/rows")


@query("st3_first_seen_ids_of_a_run", _arrivals('SELECT "Site", "Crawl_Date", "unique_id", "arrival" FROM accepted'))
def first_seen_ids_of_a_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is a day: its ids are state until the stream has passed it."""
    arrivals = with_arrival(_events(spark, sf_dir)).select("Site", "Crawl_Date", "unique_id", "arrival", "ingest_ts")
    path = work_dir(spark, "stream")
    first = runs.first_of_run(arrivals, "Crawl_Date", "unique_id", "arrival", "ingest_ts", "10 minutes")
    ingest.start_append(first, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(arrivals.schema).parquet(f"{path}/rows").drop("ingest_ts")


@query(
    "st4_running_page_counts",
    f"WITH {V_PAGED} SELECT \"Site\", location_id, page, count(*) AS n FROM v_paged GROUP BY ALL",
)
def running_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["Site", "location_id", "page"]
    path = work_dir(spark, "stream")
    counts = f"{path}/counts"
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    timed = paged_of(events, "ts")
    ingest.start_page_counts(timed, counts, f"{path}/checkpoint", by, ("ts", "1 hour")).awaitTermination()
    return ingest.latest_page_counts(spark, counts, "Site string, location_id string, page bigint, n bigint", by)


def _day_close(spark: SparkSession, sf_dir: str) -> tuple[str, StructType]:
    rows = with_arrival(_events(spark, sf_dir)).select("Site", "unique_id", "arrival", "ingest_ts")
    path = work_dir(spark, "stream")
    runs.start_day_close(rows, f"{path}/rows", f"{path}/checkpoint", spread_by="arrival").awaitTermination()
    return f"{path}/rows", rows.schema


_SELECT_CUT = 'SELECT "unique_id", "arrival", "Crawl_Date" FROM v_arrivals WHERE CAST("ingest_ts" AS TIME)'


@query("st5_before_cutoff", _arrivals(f"{_SELECT_CUT} <= TIME '12:25:00'"))
def before_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(runs.rows_in_time(spark, *_day_close(spark, sf_dir)), ingest_ts="ingest_ts").drop("Site", "ingest_ts")


@query("st5_late_rows", _arrivals(f"{_SELECT_CUT} > TIME '12:25:00'"))
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(runs.late_rows(spark, *_day_close(spark, sf_dir)), ingest_ts="ingest_ts").drop("Site", "ingest_ts")


@query(
    "st5_closed_days",
    _arrivals("""SELECT "Crawl_Date" AS day, "Site", count(*) AS n FROM v_arrivals WHERE CAST("ingest_ts" AS TIME) <= TIME '12:25:00'
                 GROUP BY 1, 2 HAVING "Crawl_Date" + INTERVAL '12 hours 35 minutes' <= (SELECT max(ts) FROM events)"""),
)
def closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every board had when its day closed, told once; the stream tells nothing of days that are still open."""
    return runs.closed_days(spark, *_day_close(spark, sf_dir)).drop("batch_id")


@query("p5_streamed_day_of_ingest", _arrivals('SELECT "Crawl_Date", count(*) AS n FROM v_arrivals GROUP BY 1'))
def streamed_day_of_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "stream")
    stamped = stamp(with_arrival(_events(spark, sf_dir)).drop("Crawl_Date"), ingest_ts="ingest_ts")
    days = ingest.start_page_counts(stamped, f"{path}/days", f"{path}/checkpoint", ["Crawl_Date"])
    days.awaitTermination()
    return ingest.latest_page_counts(spark, f"{path}/days", "Crawl_Date date, n bigint", ["Crawl_Date"])
