import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from snapwatch.session import build_session  # noqa: E402

AS_OF = dt.date(2024, 1, 15)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        app="tests",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate a column function over a list of texts, in order."""
    from pyspark.sql import functions as F

    def run(function, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r[0] for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").select("out").collect()]

    return run
