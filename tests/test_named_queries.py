"""Every named query against its SQL twin, computed from the raw columns."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check_queries import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry_points.QUERIES))
def test_equals_sql(spark, db, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    result = db.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    assert want
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == want


IN_ANOTHER_ZONE = [
    "log_top_day",
    "per_batch_count",
    "event_words",
    "window_counts",
    "window_counts_stream",
    "window_watermark_stream",
    "window_late_stream",
    "window_closed_stream",
    "group_pause_pandas",
    "stream_group_median",
]


@pytest.mark.parametrize("name", IN_ANOTHER_ZONE)
def test_equals_sql_in_another_zone(spark, db, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_equals_sql(spark, db, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["type", "totalMoney"]
    assert frame.count() > 0
