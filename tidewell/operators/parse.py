"""Line parsers. Bad fields become NULL, bad lines are dropped unless asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.clock import to_wall_time
from tidewell.functions.text import (
    contains,
    equals_int,
    has_fields,
    longer_than,
    part,
    split_on,
    strip_all,
    to_decimal,
    to_int,
)


def parse_access_log(
    lines: DataFrame,
    *,
    min_length: int = 100,
    keep_malformed: bool = False,
    user_agent: bool = False,
) -> DataFrame:
    """Access-log lines longer than ``min_length`` characters to eight text columns.

    ``agent`` is the last quoted field, which the common server format fills
    with the host name; ``user_agent`` adds the true one (third quoted field).
    Empty quoted fields do not count as fields.
    """
    kept = lines.where(longer_than("value", min_length))
    sections = kept.select(
        "value", F.array_remove(split_on("value", '"'), "").alias("sections")
    )
    cut = sections.select(
        "value",
        split_on(strip_all(part("sections", 0)), " ").alias("head"),
        split_on(strip_all(part("sections", 1)), " ").alias("request"),
        split_on(strip_all(part("sections", 2)), " ").alias("outcome"),
        strip_all(F.try_element_at("sections", F.lit(-1))).alias("agent"),
    )
    fields = [
        part("head", 0).alias("remote_ip"),
        F.replace(part("head", 3), F.lit("["), F.lit("")).alias("request_time"),
        part("request", 0).alias("method"),
        part("request", 1).alias("path"),
        part("request", 2).alias("version"),
        part("outcome", 0).alias("status"),
        part("outcome", 1).alias("size"),
        F.col("agent"),
    ]
    if user_agent:
        fields.append(strip_all(part(split_on("value", '"'), 5)).alias("user_agent"))
    record = F.array(F.struct(*fields))
    if not keep_malformed:
        # Sections too short, or missing, make no record. A filter would do the
        # same but split every line a second time.
        complete = (F.size("head") > 3) & (F.size("request") > 2) & (F.size("outcome") > 1)
        record = F.when(complete, record)
    return cut.select(F.inline(record))


def parse_word_score(lines: DataFrame) -> DataFrame:
    """``name age score`` lines, one space apart, to typed columns."""
    cut = lines.select(split_on("value", " ").alias("parts"))
    return cut.select(
        part("parts", 0).alias("name"),
        to_int(part("parts", 1)).alias("age"),
        to_int(part("parts", 2)).alias("score"),
    )


def parse_order_json(lines: DataFrame) -> DataFrame:
    """JSON orders to ``ip``, ``money`` decimal(10,2) and ``status`` text.

    One pass over each document serves all three fields.
    """
    fields = lines.select(
        F.json_tuple("value", "getRandomIp", "orderMoney", "orderStatus").alias(
            "ip", "money", "status"
        )
    )
    return fields.select("ip", to_decimal("money").alias("money"), "status")


def valid_orders(orders: DataFrame, status: int = 0) -> DataFrame:
    """Orders of one status; other text in the status field never matches."""
    return orders.where(equals_int("status", status))


def successful_calls(lines: DataFrame, word: str = "success", fields: int = 6) -> DataFrame:
    """Call records that mention ``word`` and have the right number of fields."""
    return lines.where(contains("value", word) & has_fields("value", fields))


def parse_call_record(lines: DataFrame) -> DataFrame:
    """Six comma fields to named text columns."""
    cut = lines.select(split_on("value", ",").alias("parts"))
    names = ("stationId", "callOut", "callIn", "callStatus", "callTime", "duration")
    return cut.select(*[part("parts", i).alias(n) for i, n in enumerate(names)])


def _exactly(parts: Column, lines: DataFrame, n: int) -> DataFrame:
    """Lines cut into exactly ``n`` parts. A filter on the parts would cut every line once more."""
    cut = lines.select(parts.alias("all"))
    whole = F.when(F.size("all") == n, F.array(F.col("all")))
    return cut.select(F.explode(whole).alias("parts"))


def parse_timed_words(lines: DataFrame) -> DataFrame:
    """``time,word word`` lines to one (time, word) row per word. Times are wall-clock times."""
    two = _exactly(split_on("value", ","), lines, 2)
    return two.select(
        to_wall_time(part("parts", 0)).alias("time"),
        F.explode_outer(split_on(part("parts", 1), " ")).alias("word"),
    )


def parse_word_time(lines: DataFrame) -> DataFrame:
    """``word,time`` lines to (word, time) rows. Times are wall-clock times."""
    two = _exactly(split_on("value", ","), lines, 2)
    return two.select(
        part("parts", 0).alias("word"),
        to_wall_time(strip_all(part("parts", 1))).alias("time"),
    )
