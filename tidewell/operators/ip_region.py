"""Look up the region of an IPv4 address in a table of address ranges.

Ranges are cut at bucket borders, which turns the range condition into an
equi-join on the bucket with a residual comparison. A bucket is a /16 network,
or a /24 network inside a /16 that holds many ranges, so one address is compared
with at most ``DENSE_RANGES`` or 256 candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.ip import MAX_IPV4, ip_to_long
from tidewell.scratch import written

DENSE_RANGES = 64
BROADCAST_BYTES = 128 << 20
# Buckets with a larger share of the rows than one in so many are looked up without a shuffle, if
# they have so many rows at least and their ranges are no larger than that.
HEAVY_BUCKETS = 1024
HEAVY_ROWS = 100_000
HEAVY_BYTES = 32 << 20
# A joined row besides its region text: bucket, two ends, province, city, overhead.
_ROW_BYTES = 64
# /24 bucket numbers start above the /16 ones.
_FINE_BASE = 1 << 16
# Negative buckets of one input partition.
_SPREAD = 32


@dataclass(frozen=True)
class RangeIndex:
    """Ranges cut into buckets, with what is known about their size."""

    rows: DataFrame
    dense: DataFrame | None
    row_count: int
    byte_size: int
    broadcast_limit: int = BROADCAST_BYTES

    @property
    def fits_broadcast(self) -> bool:
        return self.byte_size <= self.broadcast_limit


def build_index(ranges: DataFrame, *, broadcast_limit: int = BROADCAST_BYTES) -> RangeIndex:
    """Check the ranges and cut them into buckets.

    ``ranges`` has the columns of ``schemas.IP_RANGE``; both ends belong to the
    range. Missing or reversed ends and overlapping ranges are refused. Runs two
    jobs on the range table; when some networks are crowded the index is written
    to the shared folder, as it would be worked out anew on every use.
    """
    ranges = ranges.select(
        F.col("ip_start").cast("bigint").alias("ip_start"),
        F.col("ip_end").cast("bigint").alias("ip_end"),
        F.coalesce("region", F.lit("")).alias("region"),
        F.col("province").cast("int").alias("province"),
        F.col("city").cast("int").alias("city"),
    )
    sound = (
        F.col("ip_start").between(0, MAX_IPV4)
        & F.col("ip_end").between(0, MAX_IPV4)
        & (F.col("ip_start") <= F.col("ip_end"))
    )
    unsound = ranges.agg(F.count_if(~F.coalesce(sound, F.lit(False)))).first()[0]
    if unsound:
        raise ValueError(f"{unsound} ranges lack an end or are reversed or out of bounds")
    networks = F.sequence(F.shiftright("ip_start", 16), F.shiftright("ip_end", 16))
    coarse = ranges.select("*", F.explode(F.when(sound, networks)).alias("_bucket"))
    before = (
        Window.partitionBy("_bucket")
        .orderBy("ip_start", "ip_end")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    per_bucket = (
        coarse.select(
            "_bucket",
            F.octet_length("region").alias("region_bytes"),
            (F.max("ip_end").over(before) >= F.col("ip_start")).alias("overlaps"),
        )
        .groupBy("_bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("region_bytes").alias("region_bytes"),
            F.count_if("overlaps").alias("overlaps"),
        )
    )
    facts = per_bucket.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("region_bytes"), F.lit(0)).alias("region_bytes"),
        F.coalesce(F.sum("overlaps"), F.lit(0)).alias("overlaps"),
        F.count_if(F.col("n") > DENSE_RANGES).alias("dense"),
    ).first()
    if facts.overlaps:
        raise ValueError(f"{facts.overlaps} ranges overlap an earlier one")

    if not facts.dense:
        size = facts.n * _ROW_BYTES + facts.region_bytes
        return RangeIndex(coarse, None, facts.n, size, broadcast_limit)

    # At most 65,536 numbers, whatever the size of the range table.
    dense = per_bucket.where(F.col("n") > DENSE_RANGES).select(F.col("_bucket").alias("_dense"))
    dense = written(dense, "dense-networks")
    tagged = coarse.join(F.broadcast(dense), F.col("_bucket") == F.col("_dense"), "left")
    low = F.greatest("ip_start", F.shiftleft("_bucket", 16))
    high = F.least("ip_end", F.shiftleft("_bucket", 16) + 0xFFFF)
    fine = F.explode(F.sequence(F.shiftright(low, 8), F.shiftright(high, 8)))
    columns = ["ip_start", "ip_end", "region", "province", "city"]
    rows = (
        tagged.where(F.col("_dense").isNull())
        .select(*columns, "_bucket")
        .unionByName(
            tagged.where(F.col("_dense").isNotNull())
            .select(*columns, fine.alias("_fine"))
            .select(*columns, (F.col("_fine") + _FINE_BASE).alias("_bucket"))
        )
    )
    rows = written(rows, "range-index")
    size = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("region")).alias("region_bytes")
    ).first()
    bytes_ = size.n * _ROW_BYTES + size.region_bytes
    return RangeIndex(rows, dense, size.n, bytes_, broadcast_limit)


def add_region(
    frame: DataFrame,
    index: RangeIndex,
    address: Column | str = "ip",
    *,
    split_heavy: bool = True,
    salts: int = 32,
) -> DataFrame:
    """Add ``region``, ``province`` and ``city`` of the address in ``address``.

    Text is read as a dotted quad; pass a number column for numbers. Unknown and
    invalid addresses get the region ``""`` and NULL province and city. The
    index is broadcast when its measured size allows; otherwise both sides are
    shuffled on the bucket. Before that the rows of each bucket are counted (the address is
    read once more), and the few buckets with a large share of all rows stay where they are
    and are looked up in a broadcast of their ranges only. ``split_heavy=False`` leaves
    the count out, where no bucket can be large. A stream cannot be counted: there ``salts``
    parts of every bucket are made, by input partition.
    """
    c = F.col(address) if isinstance(address, str) else address
    kept = frame.columns
    is_text = frame.select(c).schema[0].dataType.simpleString() == "string"
    left = frame.withColumn("_ip", ip_to_long(c) if is_text else c.cast("bigint"))
    left = left.withColumn("_bucket", F.shiftright("_ip", 16))
    if index.dense is not None:
        left = left.join(F.broadcast(index.dense), F.col("_bucket") == F.col("_dense"), "left")
        fine = F.shiftright("_ip", 8) + _FINE_BASE
        left = left.withColumn("_bucket", F.when(F.col("_dense").isNotNull(), fine)
                               .otherwise(F.col("_bucket")))
    right = index.rows.withColumnRenamed("_bucket", "_range_bucket")
    inside = F.col("_ip").between(F.col("ip_start"), F.col("ip_end"))
    same = F.col("_bucket") == F.col("_range_bucket")
    place = ["region", "province", "city"]
    if index.fits_broadcast:
        found = left.join(F.broadcast(right), same & inside, "left")
        return found.select(*kept, F.coalesce("region", F.lit("")).alias("region"), *place[1:])
    if frame.isStreaming:
        left = left.withColumn("_salt", F.spark_partition_id() % salts)
        every = F.array(*[F.lit(n) for n in range(salts)])
        right = right.withColumn("_range_salt", F.explode(every))
        same = same & (F.col("_salt") == F.col("_range_salt"))
    heavy = [] if frame.isStreaming or not split_heavy else _heavy_buckets(left, index)
    out = None
    if heavy:
        here = F.col("_bucket").isin(heavy)
        few = F.broadcast(right.where(F.col("_range_bucket").isin(heavy)))
        out = left.where(here).join(few, same & inside, "left").select(*kept, *place)
        left = left.where(~here | F.col("_bucket").isNull())
    # Rows without an address go to negative buckets. Their number depends on the row and its
    # partition only, so it stays the same when a task is redone.
    hashed = [F.col(n) for n, t in frame.dtypes if "map<" not in t and t != "variant"]
    spread = -1 - (F.spark_partition_id().cast("bigint") * _SPREAD + F.pmod(F.hash(*hashed), F.lit(_SPREAD)))
    left = left.withColumn("_bucket", F.coalesce("_bucket", spread))
    # The hint keeps the planner, which cannot foresee how far ranges
    # spread over buckets, from broadcasting what was measured as too large.
    found = left.join(right.hint("merge"), same & inside, "left").select(*kept, *place)
    found = found if out is None else found.unionByName(out)
    return found.select(*kept, F.coalesce("region", F.lit("")).alias("region"), *place[1:])


def _heavy_buckets(left: DataFrame, index: RangeIndex) -> list[int]:
    """Buckets with more than one in ``HEAVY_BUCKETS`` of all rows, fewer than that many, as far as
    their ranges fit a broadcast of ``HEAVY_BYTES``; the largest first."""
    counts = left.where("_bucket IS NOT NULL").groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "bucket-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(HEAVY_ROWS, total // HEAVY_BUCKETS)
    heavy = {r._bucket: r.n for r in counts.where(F.col("n") > least).collect()}
    if not heavy:
        return []
    ranges = index.rows.where(F.col("_bucket").isin(list(heavy)))
    size = F.count(F.lit(1)) * _ROW_BYTES + F.sum(F.octet_length("region"))
    sizes = {r[0]: r[1] for r in ranges.groupBy("_bucket").agg(size).collect()}
    out, held = [], 0
    for bucket in sorted(heavy, key=lambda b: (-heavy[b], b)):
        held += sizes.get(bucket, 0)
        if held > HEAVY_BYTES:
            break
        out.append(bucket)
    return out


def place_totals(
    orders: DataFrame, index: RangeIndex, *, address: str = "ip", value: str = "money"
) -> DataFrame:
    """Rows of (province, city, value) ready for summing by place.

    With a broadcast index this is a plain lookup. With a shuffled one values
    are summed per address first: a bucket then holds at most 65,536 rows,
    however many orders one address or network has. Either way ``value`` has the type of a sum.
    """
    sum_type = orders.agg(F.sum(value)).schema[0].dataType
    if not index.fits_broadcast and not orders.isStreaming:
        orders = orders.groupBy(address).agg(F.sum(value).alias(value))
    orders = orders.select(address, F.col(value).cast(sum_type).alias(value))
    return add_region(orders, index, address, split_heavy=False).select("province", "city", value)
