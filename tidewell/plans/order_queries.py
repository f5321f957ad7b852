"""Order money by place, and address functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ip import ip_to_long, is_ip, long_to_ip
from tidewell.functions.udfs import place_udf
from tidewell.operators import aggregate, parse
from tidewell.operators.ip_region import RangeIndex, add_region, build_index, place_totals
from tidewell.plans import lines
from tidewell.plans.registry import register
from tidewell.sources import files

# The label of the overall total and the cities reported on their own.
TOTAL_LABEL = "国家"
CHOSEN_CITIES = [20, 30]

#: One type for totals, whichever way the range lookup goes.
TOTAL_TYPE = "decimal(20,2)"


def valid_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = lines.order_lines(files.read_table(spark, folder, "orders"))
    return parse.valid_orders(parse.parse_order_json(orders))


def range_index(spark: SparkSession, folder: str) -> RangeIndex:
    return build_index(lines.nation_ranges(files.read_table(spark, folder, "nation")))


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    return place_totals(valid_orders(spark, folder), range_index(spark, folder))


ORDER_TOTAL_SQL = f"""
SELECT '{TOTAL_LABEL}' AS type, CAST(sum({lines.ORDER_MONEY}) AS DECIMAL(20,2)) AS "totalMoney"
FROM orders WHERE {lines.ORDER_VALID}
"""


@register("order_total", ORDER_TOTAL_SQL)
def order_total(spark, folder):
    money = aggregate.total(valid_orders(spark, folder), "money", "totalMoney")
    return money.select(F.lit(TOTAL_LABEL).alias("type"), "totalMoney")


ORDER_BY_PROVINCE_SQL = f"""{lines.PLACED_ORDERS}
SELECT province AS type, CAST(sum(money) AS DECIMAL(20,2)) AS "totalMoney"
FROM placed GROUP BY province
"""


@register("order_by_region", ORDER_BY_PROVINCE_SQL)
def order_by_region(spark, folder):
    placed = _placed(spark, folder)
    totals = aggregate.total_by(placed, "province", "money", "totalMoney", as_type=TOTAL_TYPE)
    return totals.withColumnRenamed("province", "type")


@register("order_by_region_shuffled", ORDER_BY_PROVINCE_SQL)
def order_by_region_shuffled(spark, folder):
    """The same as it runs when the range table is too large to broadcast."""
    ranges = lines.nation_ranges(files.read_table(spark, folder, "nation"))
    placed = place_totals(valid_orders(spark, folder), build_index(ranges, broadcast_limit=0))
    totals = aggregate.total_by(placed, "province", "money", "totalMoney", as_type=TOTAL_TYPE)
    return totals.withColumnRenamed("province", "type")


@register(
    "order_by_city_subset",
    f"""{lines.PLACED_ORDERS}
SELECT city AS type, CAST(sum(money) AS DECIMAL(20,2)) AS "totalMoney"
FROM placed WHERE city IN (20, 30) GROUP BY city
""",
)
def order_by_city_subset(spark, folder):
    totals = aggregate.total_by_chosen(
        _placed(spark, folder), "city", CHOSEN_CITIES, "money", "totalMoney", as_type=TOTAL_TYPE
    )
    return totals.withColumnRenamed("city", "type")


@register(
    "order_by_city_sql",
    f"""{lines.PLACED_ORDERS}
SELECT city AS type, CAST(sum(money) AS DECIMAL(20,2)) AS "totalMoney"
FROM placed WHERE city IN (20, 30) GROUP BY city
""",
)
def order_by_city_sql(spark, folder):
    """The same in SQL, with a derived table."""
    return aggregate.query_view(
        _placed(spark, folder),
        "placed_orders",
        """
        SELECT city AS type, CAST(sum(money) AS DECIMAL(20,2)) AS totalMoney
        FROM (SELECT city, money FROM placed_orders WHERE city IN (20, 30)) chosen
        GROUP BY city
        """,
    )


@register(
    "order_regions",
    f"""{lines.PLACED_ORDERS}
SELECT region, province, city, count(*) AS orders, CAST(sum(money) AS DECIMAL(20,2)) AS money
FROM placed GROUP BY region, province, city
""",
)
def order_regions(spark, folder):
    placed = add_region(valid_orders(spark, folder), range_index(spark, folder))
    return placed.groupBy("region", "province", "city").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("money").alias("money")
    )


@register("order_regions_shuffled", f"""{lines.PLACED_ORDERS}
SELECT region, province, city, count(*) AS orders, CAST(sum(money) AS DECIMAL(20,2)) AS money
FROM placed GROUP BY region, province, city
""")
def order_regions_shuffled(spark, folder):
    """The lookup as it runs when the range table is too large to broadcast."""
    ranges = lines.nation_ranges(files.read_table(spark, folder, "nation"))
    placed = add_region(valid_orders(spark, folder), build_index(ranges, broadcast_limit=0))
    return placed.groupBy("region", "province", "city").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("money").cast(TOTAL_TYPE).alias("money")
    )


@register("order_by_region_udf", ORDER_BY_PROVINCE_SQL)
def order_by_region_udf(spark, folder):
    """Place from an array-valued Python function, over the ranges joined natively."""
    placed = _placed(spark, folder).withColumn("place", place_udf("province", "city"))
    placed = placed.select(F.get("place", F.lit(0)).alias("type"), "money")
    return placed.groupBy("type").agg(F.sum("money").cast(TOTAL_TYPE).alias("totalMoney"))


@register(
    "ip_functions",
    f"""
WITH c AS (SELECT c_custkey, c_nationkey AS k, {lines.ADDRESS_NUMBER} AS n FROM customer)
SELECT c_custkey, k NOT IN (0, 1, 2, 3, 4) AS valid,
  CASE WHEN k NOT IN (0, 1, 2, 4) THEN CAST(n AS BIGINT) END AS number,
  CASE WHEN k NOT IN (0, 1, 2, 4) THEN
    concat((n >> 24) & 255, '.', (n >> 16) & 255, '.', (n >> 8) & 255, '.', n & 255) END AS dotted
FROM c
""",
)
def ip_functions(spark, folder):
    addresses = lines.customer_addresses(files.read_table(spark, folder, "customer"))
    numbers = addresses.select(
        "c_custkey", is_ip("address").alias("valid"), ip_to_long("address").alias("number")
    )
    dotted = F.when(F.col("number").isNotNull(), long_to_ip("number"))
    return numbers.withColumn("dotted", dotted)
