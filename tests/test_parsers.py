from datetime import datetime
from decimal import Decimal

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tidewell.operators import parse

GOOD = (
    '198.51.100.7 - - [03/Feb/2024:07:08:09 +0100] "GET /path HTTP/1.1" 200 5120 '
    '"http://ref" "Lynx/2.9 (own test)" "-" "www.example.org"'
)
FIELDS = ("198.51.100.7", "03/Feb/2024:07:08:09", "GET", "/path", "HTTP/1.1", "200", "5120")


def test_access_log_fields(lines_of):
    got = tuples(parse.parse_access_log(lines_of(GOOD), user_agent=True))
    assert got == [(*FIELDS, "www.example.org", "Lynx/2.9 (own test)")]


def test_access_log_length_limit_counts_characters(lines_of):
    assert len(GOOD) > 100
    pad = GOOD[:100]
    assert parse.parse_access_log(lines_of(pad)).count() == 0
    wide = GOOD.replace("/path", "/" + "路" * 4)
    assert parse.parse_access_log(lines_of(wide), min_length=len(wide)).count() == 0
    assert parse.parse_access_log(lines_of(wide), min_length=len(wide) - 1).count() == 1


def test_access_log_outer_whitespace_and_trailing_text(lines_of):
    got = tuples(parse.parse_access_log(lines_of("\t" + GOOD + " tail ")))
    assert got == [(*FIELDS, "tail")]


def test_access_log_empty_quoted_field_does_not_count(lines_of):
    line = GOOD.replace('"http://ref"', '""')
    assert tuples(parse.parse_access_log(lines_of(line)))[0][:7] == FIELDS
    # Without a request the next section takes its place, which has too few words.
    line = GOOD.replace("GET /path HTTP/1.1", "")
    assert tuples(parse.parse_access_log(lines_of(line), min_length=10)) == []


@pytest.mark.parametrize(
    "line",
    [
        "",
        None,
        "x" * 120,
        '1.2.3.4 - - "GET / HTTP/1.1" 200 1 "-"',
        '1.2.3.4 - - [t +0] "GET /" 200 1 "-"',
        '1.2.3.4 - - [t +0] "GET / HTTP/1.1" 200',
        '"""',
    ],
)
def test_access_log_malformed_lines(lines_of, line):
    frame = lines_of(line, GOOD)
    assert parse.parse_access_log(frame, min_length=-1).count() == 1
    kept = parse.parse_access_log(frame, min_length=-1, keep_malformed=True)
    assert kept.count() == (1 if line is None else 2)


def test_word_score(lines_of):
    frame = lines_of("罗凤兰 42 83\t", "a b c", "solo", "", None, "x 1 2 3")
    assert tuples(parse.parse_word_score(frame)) == [
        ("罗凤兰", 42, 83),
        ("a", None, None),
        ("solo", None, None),
        ("", None, None),
        (None, None, None),
        ("x", 1, 2),
    ]


def test_order_json(lines_of):
    frame = lines_of(
        '{"getRandomIp": "1.2.3.4", "orderMoney": "7.100", "orderStatus": 0, "other": [1]}',
        '{"orderMoney": "x", "orderStatus": "pending"}',
        "not json",
        None,
        '{"getRandomIp": null, "orderMoney": 12.345, "orderStatus": 1}',
    )
    orders = parse.parse_order_json(frame)
    assert tuples(orders) == [
        ("1.2.3.4", Decimal("7.10"), "0"),
        (None, None, "pending"),
        (None, None, None),
        (None, None, None),
        (None, Decimal("12.35"), "1"),
    ]
    assert tuples(parse.valid_orders(orders)) == [("1.2.3.4", Decimal("7.10"), "0")]
    assert parse.valid_orders(orders, 1).count() == 1


def test_calls(lines_of):
    good = "station_3,18600001234,18900004321,success,1.5E12,5000"
    frame = lines_of(good, good.replace("success", "busy"), good + ",x", "success", "", None)
    kept = parse.successful_calls(frame)
    assert tuples(kept) == [(good,)]
    assert tuples(parse.parse_call_record(kept)) == [tuple(good.split(","))]
    short = tuples(parse.parse_call_record(lines_of("a,b")))
    assert short == [("a", "b", None, None, None, None)]


def test_timed_words(lines_of):
    frame = lines_of(
        "2019-10-12 09:00:02,cat dog", "bad,owl", "a,b,c", "", "2019-10-12 09:00:03,", None
    )
    t = datetime(2019, 10, 12, 9, 0, 2)
    assert tuples(parse.parse_timed_words(frame)) == [
        (t, "cat"),
        (t, "dog"),
        (None, "owl"),
        (t.replace(second=3), ""),
    ]


def test_word_time(lines_of):
    frame = lines_of("owl,2019-10-10 12:00:08\t", "owl,zz", "owl", "a,b,c")
    assert tuples(parse.parse_word_time(frame)) == [
        ("owl", datetime(2019, 10, 10, 12, 0, 8)),
        ("owl", None),
    ]


def test_explode_outer_keeps_null_arrays(spark):
    frame = spark.createDataFrame([(1, None), (2, ["x"])], "id int, words array<string>")
    got = tuples(frame.select("id", F.explode_outer("words")))
    assert got == [(1, None), (2, "x")]
