"""Session construction and per-job settings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

# State of a long stream outgrows the heap; RocksDB keeps it on executor disk and
# saves only what an epoch changed.
ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **STATE_SETTINGS,
}


def build_session(
    app_name: str,
    settings: Mapping[str, str] | Iterable[tuple[str, str]] | None = None,
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """Return a session for ``app_name``.

    ``settings`` is a mapping or a list of (key, value) pairs and wins over the
    defaults. ``shuffle_partitions`` also fixes the number of state partitions
    of every stream at its first start, so pick it for the full-size job.
    """
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({k: str(v) for k, v in dict(settings or {}).items()})
    builder = SparkSession.builder.appName(app_name).config(map=conf)
    if master is not None:
        builder = builder.master(master)
    return builder.getOrCreate()
