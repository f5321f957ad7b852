"""Kafka topics, read and written. Needs the Kafka connector on the class path."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

SCRAM_LOGIN = "org.apache.kafka.common.security.scram.ScramLoginModule"
# Login module by mechanism.
LOGINS = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": SCRAM_LOGIN,
    "SCRAM-SHA-512": SCRAM_LOGIN,
}


@dataclass(frozen=True)
class KafkaTarget:
    """Brokers and, optionally, SASL credentials (always given by the caller)."""

    servers: str
    security_protocol: str | None = None
    sasl_mechanism: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        out = {"kafka.bootstrap.servers": self.servers}
        if self.security_protocol:
            out["kafka.security.protocol"] = self.security_protocol
        if self.sasl_mechanism:
            out["kafka.sasl.mechanism"] = self.sasl_mechanism
        if self.user is not None:
            out["kafka.sasl.jaas.config"] = (
                f"{self._login()} required username={_quoted(self.user)} "
                f"password={_quoted(self.password or '')};"
            )
        out.update(self.extra)
        return out

    def _login(self) -> str:
        mechanism = self.sasl_mechanism or "SCRAM-SHA-512"
        if mechanism not in LOGINS:
            raise ValueError(f"no login module known for {mechanism}; give sasl.jaas.config in extra")
        return LOGINS[mechanism]


def _quoted(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def read_options(
    target: KafkaTarget,
    topics: str,
    *,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of a subscription; ``max_offsets`` caps records per trigger.

    ``min_partitions`` splits large topic partitions over more tasks.
    """
    out = {**target.options(), "subscribe": topics}
    if max_offsets is not None:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        out["minPartitions"] = str(min_partitions)
    out.update({k: str(v) for k, v in more.items()})
    return out


def write_options(target: KafkaTarget, topic: str) -> dict[str, str]:
    return {**target.options(), "topic": topic}


def decode_value(records: DataFrame) -> DataFrame:
    """Keep the record value as text."""
    return records.select(F.col("value").cast("string").alias("value"))


def encode(rows: DataFrame, value: Column | str | None = None, key: Column | str | None = None):
    """Rows as ``key``, ``value`` text; the value defaults to the row as JSON.

    Without ``key`` an existing ``key`` column is used, else NULL.
    """
    if value is None:
        value = F.col("value") if "value" in rows.columns else F.to_json(F.struct("*"))
    elif isinstance(value, str):
        value = F.col(value)
    if key is None:
        key = F.col("key") if "key" in rows.columns else F.lit(None)
    elif isinstance(key, str):
        key = F.col(key)
    return rows.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def read_topic(spark: SparkSession, target: KafkaTarget, topics: str, **options) -> DataFrame:
    """Bounded read; pass ``startingOffsets`` / ``endingOffsets`` to narrow it."""
    return spark.read.format("kafka").options(**read_options(target, topics, **options)).load()


def stream_topic(spark: SparkSession, target: KafkaTarget, topics: str, **options) -> DataFrame:
    """Subscribe and return the ``value`` texts as a stream."""
    reader = spark.readStream.format("kafka").options(**read_options(target, topics, **options))
    return decode_value(reader.load())


def write_topic(rows: DataFrame, target: KafkaTarget, topic: str) -> None:
    encode(rows).write.format("kafka").options(**write_options(target, topic)).save()


def stream_to_topic(rows: DataFrame, target: KafkaTarget, topic: str) -> DataStreamWriter:
    """Writer for ``streaming.run.start``; that call adds name and checkpoint."""
    writer = encode(rows).writeStream.format("kafka")
    return writer.options(**write_options(target, topic))
