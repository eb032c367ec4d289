"""Every registered query against its SQL twin on the smallest tables, rows compared as whole sets."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check_queries import rows_of  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
QUERIES, TWINS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, str(SF_DIR))
    got = rows_of(df.columns, df.collect())
    if name not in TWINS:
        assert got
        return
    cursor = db.execute(TWINS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cursor.fetchall())


# The order that SQL gives, for results that are compared as sets above; names are unique within these keys.
ORDERS = {
    "o1_company_nulls_first": '"Company" NULLS FIRST, "unique_id"',
    "o2_by_board_and_company": '"Site", "Company" NULLS LAST',
    "o3_deduplicated_then_sorted": '"Site", "Company" NULLS LAST, "unique_id"',
    "o4_by_size": '"Site", "Num_Company_jobs" DESC, "Company" NULLS LAST',
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order(spark, db, name):
    df = QUERIES[name](spark, str(SF_DIR))
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = db.execute(f"WITH q AS ({TWINS[name]}) SELECT {columns} FROM q ORDER BY {ORDERS[name]}").fetchall()
    assert [tuple(r) for r in df.collect()] == want
