"""The posting record, the snapshot table and the boards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and their export order, and the boards with their id prefixes and sites.
POSTING_COLUMNS = (
    "Site",
    "Company",
    "Company_jobs",
    "Job_id",
    "Job_title",
    "Job_Description",
    "Job_Post_Date",
    "Job_URL",
    "Country_Areas",
    "Job_categories",
    "AllJobs_Job_class",
    "Crawl_Date",
    "unique_id",
)
RECORD_COLUMNS = tuple(c for c in POSTING_COLUMNS if c != "Crawl_Date")
CHURN_COLUMNS = ("Site", "Company", "Company_jobs", "Crawl_Date", "Job_Post_Date", "unique_id")
REPORT_COLUMNS = ("Site", "Company", "Company_jobs", "Num_Company_jobs")
CONTACT_COLUMNS = ("Company Site URL", "Company Phone", "Company Email")
SITES = ("Drushim", "AllJobs", "JobMaster", "JobNet")
COMBINED_EXPORT_SITES = ("Drushim", "AllJobs", "JobMaster")
SITE_BY_TITLE = {"Drushim": "Drushim", "Alljobs": "AllJobs", "Jobmaster": "JobMaster", "Jobnet": "JobNet"}

POSTING = T.StructType(
    [
        T.StructField(name, T.DateType() if name == "Crawl_Date" else T.StringType(), name != "unique_id")
        for name in POSTING_COLUMNS
    ]
)


def numeric_job_id() -> Column:
    """``Job_id`` as a number, NULL for the boards whose ids are not numeric."""
    return F.col("Job_id").try_cast("bigint")
