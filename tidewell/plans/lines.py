"""Input lines made from the test tables, and the same values in SQL.

Each builder is a plain projection, so it works on batch and streaming tables
and fuses with the parser that follows. Some rows turn into malformed lines;
the SQL twin leaves those out by the condition named beside the builder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.ip import long_to_ip

# 10.0.0.0, where all test addresses start.
BASE_IP = 10 << 24
# Nations own 70,000 of every 100,000 addresses, so ranges cross /16 borders
# and some addresses belong to nobody.
RANGE_STEP, RANGE_SIZE = 100_000, 70_000
ORDER_SPAN, ORDER_STRIDE = 2_500_000, 7919


def as_lines(frame: DataFrame, text: Column) -> DataFrame:
    """One ``value`` per row, made once.

    A one-element ``explode`` keeps the optimizer from copying the expression
    into every filter that the parser puts on the line.
    """
    return frame.select(F.explode(F.array(text)).alias("value"))


def document_lines(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("text").alias("value"))


# -- access log from events -----------------------------------------------------

# Lines of events below this value are short, lack quotes or lack request fields.
GOOD_EVENT = "value >= 2"

ACCESS_IP = "concat('10.', (user_id >> 16) & 255, '.', (user_id >> 8) & 255, '.', user_id & 255)"
ACCESS_DAY = "strftime(ts, '%Y-%m-%d')"
ACCESS_METHOD = """CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST'
    WHEN event_type = 'error' THEN 'PUT' ELSE 'GET' END"""
ACCESS_PATH = "concat('/', event_type, '/', CAST(floor(value / 10) AS BIGINT))"
ACCESS_STATUS = """CASE WHEN event_type = 'error' THEN '500' WHEN event_type = 'signup' THEN '201'
    WHEN event_type = 'click' AND value > 100 THEN '404' ELSE '200' END"""
ACCESS_SIZE = "event_id * 10 + 200"


def access_lines(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    value = F.col("value")
    ip = long_to_ip(F.lit(BASE_IP) + F.col("user_id"))
    method = (
        F.when(kind.isin("purchase", "signup"), "POST").when(kind == "error", "PUT").otherwise("GET")
    )
    path = F.concat(F.lit("/"), kind, F.lit("/"), F.floor(value / 10).cast("string"))
    status = (
        F.when(kind == "error", "500")
        .when(kind == "signup", "201")
        .when((kind == "click") & (value > 100), "404")
        .otherwise("200")
    )
    request = F.when(value < 2, method).otherwise(F.concat_ws(" ", method, path, F.lit("HTTP/1.1")))
    good = F.concat(
        ip,
        F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "'),
        request,
        F.lit('" '),
        status,
        F.lit(" "),
        (F.col("event_id") * 10 + 200).cast("string"),
        F.lit(' "-" "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36" "-" "shop.example.org"'),
    )
    line = (
        F.when(value < 1, F.concat_ws(" ", ip, method))
        .when(value < 1.5, F.rpad(F.concat(ip, F.lit(" no request ")), 120, "x"))
        .otherwise(good)
    )
    return as_lines(events, line)


# -- orders ------------------------------------------------------------------------

ORDER_IP = f"{BASE_IP} + (o_orderkey * {ORDER_STRIDE}) % {ORDER_SPAN}"
ORDER_BAD_IP = "o_orderpriority = '3-MEDIUM' AND o_totalprice < 50000"
ORDER_MONEY = "CAST(o_totalprice AS DECIMAL(10,2))"
ORDER_VALID = "o_orderstatus IN ('F', 'O')"


def order_lines(orders: DataFrame) -> DataFrame:
    """JSON orders. Some have an invalid address, a third decimal or a worded status."""
    priority, state = F.col("o_orderpriority"), F.col("o_orderstatus")
    number = F.lit(BASE_IP) + (F.col("o_orderkey") * ORDER_STRIDE) % ORDER_SPAN
    bad = (priority == "3-MEDIUM") & (F.col("o_totalprice") < 50000)
    money = F.col("o_totalprice").cast("decimal(10,2)").cast("string")
    fields = F.struct(
        F.col("o_orderkey").cast("string").alias("orderId"),
        F.col("o_custkey").cast("string").alias("userId"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("orderTime"),
        F.when(bad, "256.1.1.1").otherwise(long_to_ip(number)).alias("getRandomIp"),
        F.when(priority == "5-LOW", F.concat(money, F.lit("0"))).otherwise(money).alias("orderMoney"),
        F.when(state.isin("F", "O"), "0")
        .when(priority == "2-HIGH", "pending")
        .otherwise("1")
        .alias("orderStatus"),
    )
    return as_lines(orders, F.to_json(fields))


def nation_ranges(nation: DataFrame) -> DataFrame:
    start = F.lit(BASE_IP) + F.col("n_nationkey").cast("bigint") * RANGE_STEP
    return nation.select(
        start.alias("ip_start"),
        (start + RANGE_SIZE - 1).alias("ip_end"),
        F.col("n_name").alias("region"),
        F.col("n_regionkey").alias("province"),
        F.col("n_nationkey").alias("city"),
    )


PLACED_ORDERS = f"""
WITH o AS (
  SELECT CASE WHEN {ORDER_BAD_IP} THEN NULL ELSE {ORDER_IP} END AS ip, {ORDER_MONEY} AS money
  FROM orders WHERE {ORDER_VALID}
), r AS (
  SELECT {BASE_IP} + CAST(n_nationkey AS BIGINT) * {RANGE_STEP} AS ip_start, n_name AS region,
         n_regionkey AS province, n_nationkey AS city
  FROM nation
), placed AS (
  SELECT o.money, r.province, r.city, coalesce(r.region, '') AS region
  FROM o LEFT JOIN r ON o.ip BETWEEN r.ip_start AND r.ip_start + {RANGE_SIZE - 1}
)
"""

# -- call records from events ----------------------------------------------------------

CALL_STATUS = """CASE event_type WHEN 'signup' THEN 'busy' WHEN 'error' THEN 'error'
    ELSE 'success' END"""


def call_lines(events: DataFrame) -> DataFrame:
    """Six-field call records; events below value 2 lack the last field."""
    kind = F.col("event_type")
    status = F.when(kind == "signup", "busy").when(kind == "error", "error").otherwise("success")
    fields = [
        F.concat(F.lit("station_"), F.col("user_id").cast("string")),
        F.concat(F.lit("186"), F.col("event_id").cast("string")),
        F.concat(F.lit("189"), F.col("user_id").cast("string")),
        status,
        F.date_format("ts", "yyyyMMddHHmmss"),
    ]
    duration = F.when(F.col("value") >= 2, (F.floor("value") * 1000).cast("string"))
    # concat_ws leaves out the missing duration and its comma.
    return as_lines(events, F.concat_ws(",", *fields, duration))


# -- timed words from events -------------------------------------------------------------


def timed_lines(events: DataFrame) -> DataFrame:
    """``time,word word``; events below value 2 have a third field."""
    text = F.concat_ws(
        ",",
        F.col("ts").cast("string"),
        F.concat(F.col("event_type"), F.lit(" u"), F.col("user_id").cast("string")),
        F.when(F.col("value") < 2, "extra"),
    )
    return as_lines(events, text)


def word_time_lines(events: DataFrame) -> DataFrame:
    """``word,time`` with a trailing tab."""
    text = F.concat(F.col("event_type"), F.lit(","), F.col("ts").cast("string"), F.lit("\t"))
    return as_lines(events, text)


def word_lines(events: DataFrame) -> DataFrame:
    """``type uN`` lines with an empty word in between."""
    text = F.concat(F.col("event_type"), F.lit("  u"), F.col("user_id").cast("string"))
    return as_lines(events, text)


def word_value_lines(events: DataFrame) -> DataFrame:
    """``type,number``."""
    return as_lines(events, F.concat_ws(",", "event_type", F.col("value").cast("string")))


# -- people from customer -----------------------------------------------------------------

SCORE = "CAST(50 + floor(abs(c_acctbal)) % 51 AS INTEGER)"


def score_lines(customer: DataFrame) -> DataFrame:
    """``name age score`` and a tab; the machinery segment has no numeric age."""
    age = F.when(F.col("c_mktsegment") == "MACHINERY", "n/a").otherwise(
        (F.col("c_nationkey") * 2).cast("string")
    )
    score = F.lit(50) + F.floor(F.abs("c_acctbal")) % 51
    text = F.concat(F.concat_ws(" ", F.col("c_name"), age, score.cast("string")), F.lit("\t"))
    return as_lines(customer, text)


def positional_lines(orders: DataFrame) -> DataFrame:
    """Thirteen comma fields."""
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    texts = [F.col(c).cast("string") for c in fields]
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    filler = [F.lit(str(n)) for n in range(8)]
    return as_lines(orders, F.concat_ws(",", *texts, day, *filler))


# -- addresses from customer ------------------------------------------------------------------

ADDRESS_STRIDE = 2_654_435_761
ADDRESS_NUMBER = f"(c_custkey * {ADDRESS_STRIDE}) % 4294967296"


def customer_addresses(customer: DataFrame) -> DataFrame:
    """``c_custkey`` and ``address``: dotted, five groups, out of range, short, digits."""
    number = (F.col("c_custkey") * ADDRESS_STRIDE) % (1 << 32)
    dotted = long_to_ip(number)
    key = F.col("c_nationkey")
    address = (
        F.when(key == 0, F.concat(dotted, F.lit(".1")))
        .when(key == 1, F.concat(F.lit("256."), F.substring_index(dotted, ".", 3)))
        .when(key == 2, F.substring_index(dotted, ".", 3))
        .when(key == 3, number.cast("string"))
        .when(key == 4, F.concat(dotted, F.lit("x")))
        .otherwise(dotted)
    )
    return customer.select("c_custkey", address.alias("address"))
