"""Socket and rate streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def socket_options(host: str, port: int, *, with_time: bool = False) -> dict[str, str]:
    options = {"host": host, "port": str(int(port))}
    if with_time:
        options["includeTimestamp"] = "true"
    return options


def socket_lines(
    spark: SparkSession, host: str, port: int, *, with_time: bool = False
) -> DataFrame:
    """Lines of a TCP server: ``value``, and ``timestamp`` when asked for.

    A socket cannot be replayed after a failure; use files or Kafka where rows
    must not be lost.
    """
    options = socket_options(host, port, with_time=with_time)
    return spark.readStream.format("socket").options(**options).load()


def rate_rows(
    spark: SparkSession, *, rows_per_second: int = 1, partitions: int | None = None
) -> DataFrame:
    """Generated ``timestamp``, ``value`` rows counting up from zero."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load()


def rate_batches(
    spark: SparkSession, *, rows_per_batch: int, partitions: int | None = None, start_ms: int = 0
) -> DataFrame:
    """Like ``rate_rows`` with the same rows on every run."""
    reader = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
    )
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load()
