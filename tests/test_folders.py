"""Tables kept as folders of many files, taken by streams in several steps."""

import pytest
from conftest import tuples

import __spark_entry__ as entry_points
from tidewell.plans import stream_queries, text_queries

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name in ("documents", "orders", "events", "customer", "nation"):
        table = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        table.repartition(5).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def same(left, right):
    assert sorted(tuples(left), key=repr) == sorted(tuples(right), key=repr)


def test_running_count_over_several_batches(spark, folder, monkeypatch):
    monkeypatch.setattr(stream_queries, "BATCH_BYTES", 100_000)
    got = stream_queries.stream_running_count(spark, folder)
    same(got.select("word", "count"), text_queries.wordcount_df(spark, SOURCE))


def test_foreach_over_several_batches(spark, folder, monkeypatch):
    monkeypatch.setattr(stream_queries, "BATCH_BYTES", 100_000)
    got = stream_queries.foreach_rows(spark, folder)
    same(got.select("word", "count"), text_queries.wordcount_df(spark, SOURCE))


@pytest.mark.parametrize(
    "name",
    [
        "stream_multi_totals",
        "stream_three_queries",
        "window_counts_stream",
        "stream_call_etl",
        "stream_score_board",
        "log_report",
        "order_regions_shuffled",
    ],
)
def test_same_result_as_single_files(spark, folder, monkeypatch, name):
    build = entry_points.queries()[name]
    want = build(spark, SOURCE)
    monkeypatch.setattr(stream_queries, "BATCH_BYTES", 10_000)
    same(build(spark, folder), want)
