from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from tidewell.functions import text
from tidewell.functions.udfs import predicate_udf
from tidewell.operators import aggregate


def one(frame, *columns):
    return tuple(frame.select(*columns).first())


def test_split_keeps_empty_parts_and_literal_separators(lines_of):
    frame = lines_of("a||b.c|")
    assert one(frame, text.split_on("value", "|"))[0] == ["a", "", "b.c", ""]
    assert one(frame, text.split_on("value", "||"))[0] == ["a", "b.c|"]
    assert one(frame, text.split_on("value", "."))[0] == ["a||b", "c|"]


def test_part_out_of_range_is_null(lines_of):
    parts = text.split_on("value", ",")
    frame = lines_of("a,b")
    assert one(frame, text.part(parts, 1), text.part(parts, 2)) == ("b", None)


def test_strip_all_equals_python(lines_of):
    samples = [" \t\n ab c　 \r", "\x1cx\x85", "​x", "", "   ", "x"]
    got = [r[0] for r in lines_of(*samples).select(text.strip_all("value")).collect()]
    assert got == [s.strip() for s in samples]


def test_strip_spaces_leaves_tabs(lines_of):
    assert one(lines_of("  a\t "), text.strip_spaces("value")) == ("a\t",)


def test_words_strip_modes(lines_of):
    frame = lines_of("\t a  b ")

    def words(mode):
        return one(frame, text.words_of("value", mode))[0]

    assert words("none") == ["\t", "a", "", "b", ""]
    assert words("spaces") == ["\t", "a", "", "b"]
    assert words("all") == ["a", "", "b"]
    with pytest.raises(ValueError):
        text.words_of("value", "left")


def test_casts_do_not_raise(lines_of):
    frame = lines_of("42\t", "abc", None, "7.100")
    got = tuples(
        frame.select(text.to_int("value"), text.to_bigint("value"), text.to_decimal("value"))
    )
    assert got == [
        (42, 42, Decimal("42.00")),
        (None, None, None),
        (None, None, None),
        (None, None, Decimal("7.10")),
    ]


def test_to_time(lines_of):
    frame = lines_of("2019-10-10 12:00:08\t", "zz", None)
    got = [r[0] for r in frame.select(text.to_time("value")).collect()]
    assert got == [datetime(2019, 10, 10, 12, 0, 8), None, None]


def test_log_day(lines_of):
    frame = lines_of("18/Oct/2022:19:40:51", "8/Oct/2022:9:4:5", "31/Feb/2022:00:00:00", "-", "")
    got = [r[0] for r in frame.select(text.log_day("value")).collect()]
    assert got == ["2022-10-18", "2022-10-08", "31/Feb/2022:00:00:00", "-", ""]


def test_predicates(lines_of):
    frame = lines_of("ab,c", "", None)
    got = tuples(
        frame.select(
            text.contains("value", "b"),
            text.longer_than("value", 3),
            text.not_empty("value"),
            text.has_fields("value", 2),
            text.equals_int("value", 0),
            text.one_of("value", ["ab,c"]),
        )
    )
    assert got == [
        (True, True, True, True, None, True),
        (False, False, False, False, None, False),
        (None, None, None, None, None, None),
    ]


def test_joined_and_row_json(spark):
    frame = spark.createDataFrame([("罗", 42, None)], "name string, age int, job string")
    assert one(frame, text.joined(" ", "name", F.col("age").cast("string"))) == ("罗 42",)
    assert one(frame, text.row_json()) == ('{"name":"罗","age":42}',)
    assert one(frame, text.row_json("age")) == ('{"age":42}',)


def test_predicate_udf_null_is_false(lines_of):
    check = predicate_udf(lambda s: len(s) > 0)
    got = [r[0] for r in lines_of("a", "", None).select(check("value")).collect()]
    assert got == [True, False, False]


def test_predicate_udf_stays_above_the_aggregate(lines_of):
    counts = aggregate.word_counts_where(lines_of("a b  a"), lambda s: len(s) > 0)
    assert sorted(tuples(counts)) == [("a", 2), ("b", 1)]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("EvalPython") < plan.index("Aggregate")
