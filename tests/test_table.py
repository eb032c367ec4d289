"""Loads, exports, reports and retention on disk."""

import datetime as dt
import os

import pytest
from conftest import AS_OF
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapwatch.operators import exports, ingest, retention
from snapwatch.schema import POSTING, POSTING_COLUMNS, numeric_job_id
from snapwatch.session import work_dir
from snapwatch.sources import readers, writers

DAY = dt.date(2024, 1, 14)


def posting(unique, company="acme", site="JobNet", day=AS_OF, text="t", job_id="1"):
    values = dict.fromkeys(POSTING_COLUMNS, "")
    values.update(Site=site, Company=company, Crawl_Date=day, unique_id=unique, Job_Description=text, Job_id=job_id)
    return tuple(values[c] for c in POSTING_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), POSTING)


def ids(df):
    return sorted((r.Crawl_Date.day, r.unique_id, r.Job_Description) for r in df.collect())


def test_first_row_of_a_key_wins(spark):
    rows = spark.createDataFrame(
        [("s", AS_OF, "k", 2), ("s", AS_OF, "k", 1), ("s", DAY, "k", 3), ("t", AS_OF, None, 4), ("t", None, "k", 5)],
        "Site string, Crawl_Date date, unique_id string, arrival int",
    )
    accepted = ingest.insert_unique(rows, ["arrival"])
    assert sorted(r.arrival for r in accepted.collect()) == [1, 3]
    counts = {r.Site: (r.accepted, r.rejected) for r in ingest.rejected_per_site(rows, accepted).collect()}
    assert counts == {"s": (2, 1), "t": (0, 2)}
    assert {r.Site: (r.accepted, r.rejected) for r in ingest.count_arrivals(rows).collect()} == counts


def test_load_is_idempotent_and_keeps_stored_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    first = frame(spark, posting("a", text="old"), posting("b", day=DAY))
    writers.load_unique(first, path, ["unique_id"], [AS_OF, DAY])
    again = frame(spark, posting("a", text="new"), posting("c"), posting("c", text="z"))
    writers.load_unique(again, path, ["unique_id", "Job_Description"], [AS_OF])
    writers.load_unique(again, path, ["unique_id", "Job_Description"], [AS_OF])
    assert ids(readers.read_table(spark, path)) == [(14, "b", "t"), (15, "a", "old"), (15, "c", "t")]
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["Crawl_Date=2024-01-14", "Crawl_Date=2024-01-15"]


def test_load_refuses_rows_of_other_days(spark, tmp_path):
    with pytest.raises(PySparkException, match="outside"):
        writers.load_unique(frame(spark, posting("a", day=DAY)), str(tmp_path / "t"), ["unique_id"], [AS_OF])


def test_day_filter_prunes_partitions(spark, tmp_path, capsys):
    path = str(tmp_path / "table")
    writers.append_postings(frame(spark, posting("a"), posting("b", day=DAY)), path)
    day = readers.read_table(spark, path).where(F.col("Crawl_Date") == F.lit(AS_OF)).select("Company")
    day.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(Crawl_Date" in plan and "ReadSchema: struct<Company:string>" in plan


def test_stamp(spark):
    df = spark.sql("SELECT timestamp'2024-01-14 23:59:59' ts UNION ALL SELECT timestamp'2024-01-15 00:00:01'")
    assert sorted(r.Crawl_Date.day for r in ingest.stamp(df, ingest_ts="ts").collect()) == [14, 15]
    assert {r.Crawl_Date for r in ingest.stamp(df, AS_OF).collect()} == {AS_OF}


def test_ids_are_text_with_a_number_beside(spark):
    df = frame(spark, posting("a", job_id="12"), posting("b", job_id="1-ab"))
    assert [r.n for r in df.orderBy("unique_id").select(numeric_job_id().alias("n")).collect()] == [12, None]


ODD_TEXT = 'two\nlines, "quoted" \\ back\\"slash and a,comma '


def test_rebuilt_export_keeps_texts_nulls_and_order(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [posting("3", company="b", text=ODD_TEXT), posting("1", company=None), posting("2", company=""),
            posting("4", company="a"), posting("5", site="AllJobs"), posting("6", day=DAY)]
    writers.rebuild_board_export(frame(spark, *rows), "JobNet", AS_OF, path)
    back = readers.read_csv_export(spark, path)
    assert {(r.unique_id, r.Company, r.Job_Description, r.Crawl_Date) for r in back.collect()} == {
        ("3", "b", ODD_TEXT, AS_OF), ("1", None, "t", AS_OF), ("2", "", "t", AS_OF), ("4", "a", "t", AS_OF)}
    ordered = exports.board_export(frame(spark, *rows), "JobNet", AS_OF)
    assert [r.unique_id for r in ordered.collect()] == ["1", "2", "4", "3"]
    first = sorted(p for p in os.listdir(path) if p.endswith(".csv"))[0]
    assert (tmp_path / "csv" / first).read_text(encoding="utf-8").splitlines()[0] == ",".join(POSTING_COLUMNS)


def test_combined_export_has_three_boards_sorted_nulls_last(spark, tmp_path):
    rows = [posting("1", company=None, site="AllJobs"), posting("2", company="a", site="AllJobs"),
            posting("2", company="a", site="AllJobs"), posting("3", site="Drushim"), posting("4", site="JobNet")]
    out = exports.combined_export(frame(spark, *rows))
    assert [r.unique_id for r in out.collect()] == ["2", "1", "3"]
    writers.write_combined_export(frame(spark, *rows), str(tmp_path / "c"))
    assert sorted(n for n in os.listdir(tmp_path / "c") if "=" in n) == ["Site=AllJobs", "Site=Drushim"]


def test_board_exports(spark, tmp_path):
    path = str(tmp_path / "e")
    writers.write_board_exports(frame(spark, posting("1"), posting("2", site="AllJobs"), posting("3", day=DAY)), path)
    assert ids(readers.read_board_export(spark, path, "JobNet")) == [(14, "3", "t"), (15, "1", "t")]
    assert readers.read_board_export(spark, path).columns == list(POSTING_COLUMNS)


def test_change_report_sheets(spark, tmp_path):
    df = frame(spark, posting("1", company="new"), posting("2", company="gone", day=DAY), posting("3", company="both"),
               posting("4", company="both", day=DAY))
    folder = writers.write_change_report(df, AS_OF, str(tmp_path))
    assert folder.endswith("2024_01_15_Daily-Competitor-Client-Change")
    new = readers.read_sheet(spark, folder, writers.NEW_SHEET)
    assert [r.Company for r in new.collect()] == ["new"] and "Company Site URL" in new.columns
    assert [r.Company for r in readers.read_sheet(spark, folder, writers.LEFT_SHEET).collect()] == ["gone"]


def test_range_dump_files(spark, tmp_path):
    df = frame(spark, posting("1", company="x"), posting("2", company=None, day=DAY))
    new, removed = writers.write_range_dump(df, "JobNet", AS_OF, None, AS_OF, str(tmp_path))
    assert os.path.basename(new) == "15-01-24_to_15-01-24_new_company_report_dump"
    rows = readers.read_csv(spark, new, "Company string, `Report Date` string").collect()
    assert [tuple(r) for r in rows] == [("x", "15/01/2024")]
    rows = readers.read_csv(spark, removed, "Company string, `Report Date` string").collect()
    assert [tuple(r) for r in rows] == [(None, "15/01/2024")]
    with pytest.raises(ValueError):
        writers.write_range_dump(df, "JobNet", AS_OF, DAY, AS_OF, str(tmp_path))


def test_retention_counts_today_and_drops_the_future(spark, tmp_path):
    days = [AS_OF + dt.timedelta(days=i) for i in (-30, -29, 0, 1)]
    df = frame(spark, *(posting(str(i), day=d) for i, d in enumerate(days)), posting("none", day=None))
    assert {r.unique_id for r in retention.retained(df, AS_OF).collect()} == {"1", "2", "none"}
    assert {r.unique_id for r in retention.deleted(df, AS_OF).collect()} == {"0", "3"}
    assert {r.unique_id for r in retention.deleted(df, AS_OF, retention.MANUAL_DAYS).collect()} == {"3"}
    path = str(tmp_path / "t")
    writers.append_postings(df.where("Crawl_Date is not null"), path)
    assert writers.apply_retention(spark, path, AS_OF) == [days[0], days[3]]
    assert {r.unique_id for r in readers.read_table(spark, path).collect()} == {"1", "2"}


def test_expired_artifacts(spark):
    names = ["2024_01_15_Drushim.xlsx", "scrapy_log_output_2024-01-05.txt", "scrapy_log_output_2024-01-06.txt", "notes.txt",
             "2024_01_16_x.xlsx", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name for r in retention.expired_artifacts(df, AS_OF).collect()}
    assert got == {"scrapy_log_output_2024-01-05.txt", "notes.txt", "2024_01_16_x.xlsx", None}


def test_page_folder_and_body_lines(spark, tmp_path):
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "p1.html").write_text("<p>a\nb</p>", encoding="utf-8")
    page = readers.read_pages(spark, str(tmp_path / "html"), layout="files").first()
    assert page.html == "<p>a\nb</p>" and page.url.endswith("p1.html")
    (tmp_path / "api").mkdir()
    (tmp_path / "api" / "page_12.json").write_text('{"ResultList": []}', encoding="utf-8")
    assert tuple(readers.read_bodies_text(spark, str(tmp_path / "api")).first()) == (12, '{"ResultList": []}')


def test_jdbc_predicates_cover_each_day_once():
    parts = readers.jdbc_day_predicates([AS_OF, DAY], slices=2)
    assert parts == [
        "Crawl_Date = '15/01/2024' AND MOD(CRC32(unique_id), 2) = 0", "Crawl_Date = '15/01/2024' AND MOD(CRC32(unique_id), 2) = 1",
        "Crawl_Date = '14/01/2024' AND MOD(CRC32(unique_id), 2) = 0", "Crawl_Date = '14/01/2024' AND MOD(CRC32(unique_id), 2) = 1",
    ]


class _Session:
    def __init__(self, **conf):
        self.conf = {k.replace("__", "."): v for k, v in conf.items()}


def test_work_dir_follows_the_session():
    assert work_dir(_Session(spark__checkpoint__dir="/shared/"), "x").startswith("/shared/x-")
    assert "/snapwatch-" in work_dir(_Session(spark__master="local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(_Session(spark__master="yarn"), "x")


def test_rows_without_a_key_are_rejected_in_both_counts(spark):
    rows = spark.createDataFrame([("s", DAY, "a", 1), ("s", DAY, None, 2), ("s", None, "b", 3), ("t", DAY, None, 4)],
                                 "Site string, Crawl_Date date, unique_id string, arrival long")
    accepted = ingest.insert_unique(rows, ["arrival"])
    for counts in (ingest.rejected_per_site(rows, accepted), ingest.count_arrivals(rows)):
        assert {r.Site: (r.accepted, r.rejected) for r in counts.collect()} == {"s": (1, 2), "t": (0, 1)}


def test_exports_keep_the_order_of_arrival(spark, tmp_path):
    rows = [(i * 7 % 50, "AB"[i % 2]) for i in range(50)]
    df = spark.createDataFrame(rows, "arrival long, Site string").withColumn("Crawl_Date", F.lit(DAY))
    for column in (c for c in POSTING_COLUMNS if c not in df.columns):
        df = df.withColumn(column, F.col("arrival").cast("string"))
    writers.write_board_exports(df, str(tmp_path / "x"), ["arrival"])
    for site in "AB":
        files = sorted((tmp_path / "x").glob(f"Crawl_Date=*/Site={site}/*.parquet"))
        for file in files:
            ids = [int(r.unique_id) for r in spark.read.parquet(str(file)).collect()]
            assert ids == sorted(ids)


def test_combined_export_of_one_day(spark):
    df = spark.createDataFrame([("A", DAY, "x"), ("A", DAY - dt.timedelta(days=1), "y"), ("B", DAY, "z")], "Site string, Crawl_Date date, unique_id string")
    got = exports.combined_export(df.withColumn("Company", F.lit("c")), ["A"], DAY)
    assert [r.unique_id for r in got.collect()] == ["x"]


def test_unreadable_reports_leave_the_totals(spark, tmp_path):
    sites = ["JobNet", "AllJobs"]
    folder = writers.write_change_report(frame(spark, posting("a"), posting("b", company="gone", day=DAY)), AS_OF, str(tmp_path))
    counts = {tuple(r) for f in readers.read_report_counts(spark, folder, sites) for r in f.collect()}
    assert counts == {("JobNet", 1), ("AllJobs", 0)}
    assert readers.read_report_counts(spark, str(tmp_path / "none"), sites) is None
    sheet = tmp_path / folder.rsplit("/", 1)[1] / readers.LEFT_SHEET
    for part in sheet.glob("*.parquet"):
        part.write_bytes(b"damaged")
    for crc in sheet.glob(".*.crc"):
        crc.write_bytes(b"")
    assert readers.read_report_counts(spark, folder, sites) is None
    spark.range(1).write.mode("overwrite").parquet(str(sheet))
    assert readers.read_report_counts(spark, folder, sites) is None
