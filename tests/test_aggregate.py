import math

import pandas as pd
import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tidewell.operators import aggregate


def test_lines_containing(lines_of):
    # Line ends \n\r make two of the five lines empty.
    frame = lines_of("this is a test", "", "hello world", "", "aa bb")
    got = tuples(aggregate.count_lines_containing(frame, {"a": "a", "b": "b"}))
    assert got == [(2, 1)]


def test_word_counts(lines_of):
    frame = lines_of("cat dog", " dog  owl ", "", None)
    assert dict(tuples(aggregate.word_counts(frame))) == {"cat": 1, "dog": 2, "owl": 1, "": 4}
    assert dict(tuples(aggregate.word_counts(frame, strip="all"))) == {
        "cat": 1, "dog": 2, "owl": 1, "": 2,
    }
    assert dict(tuples(aggregate.word_counts(frame, keep_empty=False))) == {
        "cat": 1, "dog": 2, "owl": 1,
    }
    assert dict(tuples(aggregate.word_counts_sql(frame))) == {
        "cat": 1, "dog": 2, "owl": 1, "": 2,
    }


def test_words_keep_other_columns(spark):
    frame = spark.createDataFrame([("a b", 7)], "value string, n int")
    assert tuples(aggregate.words(frame)) == [("a", 7), ("b", 7)]


def test_top_counts_break_ties_by_key(spark):
    frame = spark.createDataFrame([(k,) for k in "ccbbadd"], "key string")
    assert tuples(aggregate.top_counts(frame, "key", 3)) == [("b", 2), ("c", 2), ("d", 2)]
    assert tuples(aggregate.counts_descending(frame, "key"))[-1] == ("a", 1)


def test_top_counts_each(spark):
    rows = [("x", 1)] * 3 + [("y", 2)] * 2 + [("z", 1), ("w", None)]
    frame = spark.createDataFrame(rows, "a string, b int")
    got = tuples(aggregate.top_counts_each(frame, {"a": "a", "b": "b"}, 2))
    assert sorted(got, key=repr) == sorted(
        [("a", "x", 3), ("a", "y", 2), ("b", "1", 4), ("b", "2", 2)], key=repr
    )


def test_top_counts_each_limits_before_the_ranking_shuffle(spark):
    frame = spark.createDataFrame([("x", 1)], "a string, b int")
    plan = aggregate.top_counts_each(frame, {"a": "a"})._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString()


def test_top_counts_is_a_bounded_take(spark):
    frame = spark.createDataFrame([("x",)], "key string")
    plan = aggregate.top_counts(frame, "key")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_totals(spark):
    rows = [("1", 10), ("x", 20), (None, 5)]
    frame = spark.createDataFrame(rows, "size string, money int")
    assert tuples(aggregate.total_bytes(frame)) == [(1,)]
    assert tuples(aggregate.total_bytes(frame.where("money > 99"))) == [(0,)]
    assert tuples(aggregate.total(frame, "money", "t")) == [(35,)]
    assert dict(tuples(aggregate.total_by(frame, "size", "money", "t"))) == {"1": 10, "x": 20, None: 5}
    chosen = aggregate.total_by_chosen(frame, "size", ["x"], "money", "t")
    assert tuples(chosen) == [("x", 20)]


def test_top_counts_each_with_many_keys(spark):
    frame = spark.range(9000).select((F.col("id") % 3000).alias("a"), F.lit("x").alias("b"))
    frame = frame.unionByName(spark.range(5).select(F.lit(7).cast("long").alias("a"), F.lit("y").alias("b")))
    got = tuples(aggregate.top_counts_each(frame, {"a": "a", "b": "b"}, 2000))
    a = sorted((r for r in got if r[0] == "a"), key=lambda r: (-r[2], r[1]))
    assert len(a) == 2000 and a[0] == ("a", "7", 8) and {r[2] for r in a[1:]} == {3}
    assert [r[1] for r in a[1:]] == sorted(str(n) for n in range(3000) if n != 7)[:1999]
    assert sorted(r for r in got if r[0] == "b") == [("b", "x", 9000), ("b", "y", 5)]


def test_score_board(spark):
    rows = [("a", 29, 80), ("b", 30, 80), ("c", None, 80), ("d", 1, 70), ("e", 2, 80)]
    people = spark.createDataFrame(rows, "name string, age int, score int")
    assert tuples(aggregate.score_board(people)) == [(70, 1), (80, 2)]


def test_mean_by_pandas_equals_pandas(spark):
    rows = [(i % 7, float(i)) for i in range(500)] + [(3, None), (3, float("nan")), (9, None)]
    rows += [(0, 1.0)] * 400
    frame = spark.createDataFrame(rows, "id int, x double").repartition(6)
    got = dict(tuples(aggregate.mean_by_pandas(frame, "id", "x", buckets=3)))
    want = pd.DataFrame(rows, columns=["id", "x"]).groupby("id")["x"].mean()
    assert set(got) == set(want.index)
    assert got.pop(9) is None
    for key, mean in got.items():
        assert math.isclose(mean, want[key])


def test_mean_by_pandas_text_and_null_keys(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), (None, 4)], "k string, x int")
    assert dict(tuples(aggregate.mean_by_pandas(frame, "k", "x"))) == {"a": 1.5, None: 4.0}


def test_mean_by_pandas_keeps_large_whole_keys(spark):
    big = (1 << 60) + 1
    frame = spark.createDataFrame([(big, 1.0), (None, 2.0), (big, 4.0)], "k long, x double")
    assert dict(tuples(aggregate.mean_by_pandas(frame, "k", "x", buckets=1))) == {big: 2.5, None: 2.0}


def test_query_view_with_derived_table(spark):
    frame = spark.range(5).select(F.col("id"), (F.col("id") % 2).alias("city"))
    sql = "SELECT city, sum(id) AS s FROM (SELECT * FROM nums WHERE city IN (1)) t GROUP BY city"
    out = aggregate.query_view(frame, "nums", sql)
    assert tuples(out) == [(1, 4)]


def test_unknown_column_is_an_error(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        aggregate.count_by(spark.range(1), "nope")
