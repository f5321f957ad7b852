import ipaddress
import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions.ip import ip_to_long, is_ip, long_to_ip, unsigned
from tidewell.functions.udfs import region_udf
from tidewell.operators import ip_region
from tidewell.operators.ip_region import DENSE_RANGES, add_region, build_index, place_totals
from tidewell.scratch import written


def test_address_text(lines_of):
    cases = {
        "1.2.3.4": 16909060,
        "0.0.0.0": 0,
        "255.255.255.255": (1 << 32) - 1,
        "001.02.3.4": 16909060,
        "16909060": 16909060,
        "4294967296": None,
        "256.1.1.1": None,
        "1.2.3": None,
        "1.2.3.4.5": None,
        "1.2.3.4\n": None,
        "1.2.3.x": None,
        "1234.1.1.1": None,
        "": None,
        None: None,
    }
    got = [r[0] for r in lines_of(*cases).select(ip_to_long("value")).collect()]
    assert got == list(cases.values())


def test_is_ip(lines_of):
    cases = {"1.2.3.4": True, "16909060": False, "1.2.3.4\n": False, "300.1.1.1": False, "...": False}
    got = [r[0] for r in lines_of(*cases).select(is_ip("value")).collect()]
    assert got == list(cases.values())


def test_number_to_text(spark):
    rng = random.Random(5)
    numbers = [rng.randrange(1 << 32) for _ in range(200)] + [0, (1 << 32) - 1]
    signed = [n - (1 << 32) if n >= 1 << 31 else n for n in numbers]
    frame = spark.createDataFrame(list(zip(numbers, signed)), "n long, s long")
    for row in frame.select("n", long_to_ip("n"), long_to_ip("s"), unsigned("s")).collect():
        want = str(ipaddress.ip_address(row[0]))
        assert tuple(row)[1:] == (want, want, row[0])


def random_ranges(rng):
    """Non-overlapping ranges: wide ones, single addresses and two crowded /16."""
    cuts = set()
    for _ in range(60):
        cuts.add(rng.randrange(1 << 32))
    for base in (10 << 24, (10 << 24) + 65536):
        for _ in range(3 * DENSE_RANGES):
            cuts.add(base + rng.randrange(65536))
    cuts = sorted(cuts)
    ranges = []
    for low, high in zip(cuts, cuts[1:]):
        kind = rng.random()
        if kind < 0.15:
            continue
        end = low if kind < 0.3 else high - 1
        ranges.append((low, end, f"r{low}", low % 9, low % 97))
    return ranges


def brute(ranges, number):
    for low, high, region, province, city in ranges:
        if number is not None and low <= number <= high:
            return region, province, city
    return "", None, None


@pytest.fixture(scope="module")
def lookup_case(spark):
    rng = random.Random(11)
    ranges = random_ranges(rng)
    numbers = []
    for low, high, *_ in ranges:
        numbers += [low, high, max(low - 1, 0), min(high + 1, (1 << 32) - 1)]
    numbers += [rng.randrange(1 << 32) for _ in range(300)]
    texts = [str(ipaddress.ip_address(n)) for n in numbers] + ["256.1.1.1", "1.2.3", None, ""]
    want = [(t, *brute(ranges, n)) for t, n in zip(texts, numbers + [None] * 4)]
    return (
        spark.createDataFrame(ranges, schemas.IP_RANGE),
        spark.createDataFrame([(t,) for t in texts], "ip string"),
        want,
    )


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_lookup_equals_brute_force(lookup_case, limit):
    ranges, facts, want = lookup_case
    index = build_index(ranges, broadcast_limit=limit)
    assert index.dense is not None
    assert index.fits_broadcast is bool(limit)
    found = add_region(facts.repartition(5), index, salts=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) is not bool(limit)
    got = tuples(found)
    assert in_order(got) == in_order(want)


def test_no_bucket_is_crowded(lookup_case):
    index = build_index(lookup_case[0])
    most = index.rows.groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert most <= 256
    assert index.rows.count() == index.row_count


def test_lookup_by_number_keeps_columns_and_rows(spark):
    ranges = spark.createDataFrame([(5, 5, "five", 1, 10)], schemas.IP_RANGE)
    facts = spark.createDataFrame([(1, 5), (1, 5), (2, 6), (3, None)], "id int, n long")
    got = tuples(add_region(facts, build_index(ranges), "n"))
    assert in_order(got) == in_order(
        [(1, 5, "five", 1, 10)] * 2 + [(2, 6, "", None, None), (3, None, "", None, None)]
    )


@pytest.mark.parametrize(
    "rows, message",
    [
        ([(1, 9, "a", 1, 1), (9, 12, "b", 1, 1)], "overlap"),
        ([(0, (1 << 32) - 1, "a", 1, 1), (70000, 70001, "b", 1, 1)], "overlap"),
        ([(1, 9, "a", 1, 1), (1, 9, "a", 1, 1)], "overlap"),
        ([(9, 1, "a", 1, 1)], "reversed"),
        ([(None, 1, "a", 1, 1)], "lack an end"),
        ([(1, 1 << 32, "a", 1, 1)], "out of bounds"),
    ],
)
def test_bad_ranges_are_refused(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        build_index(spark.createDataFrame(rows, schemas.IP_RANGE))


def test_empty_range_table(spark):
    index = build_index(spark.createDataFrame([], schemas.IP_RANGE))
    facts = spark.createDataFrame([("1.2.3.4",)], "ip string")
    assert tuples(add_region(facts, index)) == [("1.2.3.4", "", None, None)]


def test_place_totals_agree_on_both_paths(lookup_case, spark):
    ranges, facts, _ = lookup_case
    # A third of the rows share one address.
    hot = facts.limit(1).crossJoin(spark.range(facts.count() // 2)).select("ip")
    orders = facts.unionByName(hot).withColumn("money", F.lit("1.25").cast("decimal(10,2)"))

    def totals(limit):
        placed = place_totals(orders, build_index(ranges, broadcast_limit=limit))
        return in_order(tuples(placed.groupBy("province").agg(F.sum("money").cast("decimal(20,2)"))))

    assert totals(1 << 30) == totals(0)


@pytest.mark.parametrize("hot", ["one address", "one network"])
@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_a_heavy_network_stays_in_its_tasks(lookup_case, spark, monkeypatch, hot, limit):
    """A network with most of the rows, from one input partition, is not shuffled at all."""
    monkeypatch.setattr(ip_region, "HEAVY_ROWS", 1000)
    monkeypatch.setattr(ip_region, "HEAVY_BYTES", limit)
    ranges, facts, want = lookup_case
    low = next(r.ip_start for r in ranges.orderBy("ip_start").collect() if r.ip_end > r.ip_start + 200)
    numbers = [low + (i % 200 if hot == "one network" else 0) for i in range(3000)]
    texts = [str(ipaddress.ip_address(n)) for n in numbers]
    rows = spark.createDataFrame([(t,) for t in texts], "ip string").unionByName(facts)
    rows = written(rows.coalesce(1), "heavy-network")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        index = build_index(ranges, broadcast_limit=0)
        found = add_region(rows, index)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("Union" in plan) is bool(limit)
        sizes = found.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    if limit:
        # The heavy rows stay in the partition they came from; the others are dealt out.
        assert max(r["count"] for r in sizes) >= 3000 and len(sizes) > 2
    known = [tuple(r) for r in ranges.collect()]
    more = [(t, *brute(known, n)) for t, n in zip(texts, numbers, strict=True)]
    assert in_order(tuples(found)) == in_order(more + want)


def test_no_heavy_bucket_no_second_join(lookup_case):
    ranges, facts, _ = lookup_case
    found = add_region(facts, build_index(ranges, broadcast_limit=0))
    assert "Union" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["decimal(10,2)", "int", "double"])
def test_place_totals_has_one_type(lookup_case, kind):
    ranges, facts, _ = lookup_case
    orders = facts.withColumn("money", F.lit("2").cast(kind))
    schemas_ = {place_totals(orders, build_index(ranges, broadcast_limit=n)).schema.simpleString() for n in (0, 1 << 30)}
    total = {"decimal(10,2)": "decimal(20,2)", "int": "bigint", "double": "double"}[kind]
    assert schemas_ == {f"struct<province:int,city:int,money:{total}>"}


def test_region_udf(lookup_case, spark):
    ranges, facts, want = lookup_case
    lookup = region_udf([(r[0], r[1], r[3], r[4]) for r in ranges.collect()])
    got = tuples(facts.select("ip", lookup(ip_to_long("ip"))))
    pairs = [(w[0], None if w[2] is None else [w[2], w[3]]) for w in want]
    assert in_order(got) == in_order(pairs)
    with pytest.raises(ValueError, match="overlap"):
        region_udf([(1, 5, 1, 1), (5, 6, 1, 1)])
    with pytest.raises(ValueError, match="add_region"):
        region_udf([(0, 0, 1, 1)] * 50_001)
