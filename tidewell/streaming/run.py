"""Start, wait for and stop streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewell.session import STATE_SETTINGS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
BUILTIN_STATE = (
    "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
)
MODES = ("append", "update", "complete")

BatchFunction = Callable[[DataFrame, int], None]


@contextmanager
def _disk_state(spark: SparkSession) -> Iterator[None]:
    """Keep state in RocksDB unless the session chose something else."""
    if spark.conf.get(PROVIDER, BUILTIN_STATE) != BUILTIN_STATE:
        yield
        return
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpoint_path(root: str, name: str) -> str:
    """The recovery folder of one query. Never share it between queries."""
    return f"{root.rstrip('/')}/{name}"


def start(
    stream: DataFrame | DataStreamWriter,
    name: str,
    checkpoint_root: str,
    *,
    mode: str = "append",
    each_batch: BatchFunction | None = None,
    each_row: object | None = None,
    every: str | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Start a named query with its own checkpoint.

    ``stream`` is a streaming frame or a writer that already has a sink. Give
    ``each_batch`` for ``foreachBatch`` or ``each_row`` for a ``foreach`` object.
    ``every`` is a processing-time trigger such as ``"5 seconds"``; ``drain``
    takes what is there now and stops.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    if drain and every is not None:
        raise ValueError("give every or drain, not both")
    writer = stream.writeStream if isinstance(stream, DataFrame) else stream
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    if isinstance(stream, DataFrame):
        spark = stream.sparkSession
    writer = (
        writer.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint_path(checkpoint_root, name))
    )
    if each_batch is not None:
        writer = writer.foreachBatch(each_batch)
    if each_row is not None:
        writer = writer.foreach(each_row)
    if drain:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    with _disk_state(spark):
        return writer.start()


def wait_for(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for the end of a query; with ``timeout`` stop it and raise when it takes longer."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"query {query.name} still ran after {timeout} s")
    return query


def wait_for_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Wait until one query of the session ends; False when time ran out.

    A query that ended before counts too, and its failure is raised, until
    ``spark.streams.resetTerminated()`` is called.
    """
    if timeout is None:
        spark.streams.awaitAnyTermination()
        return True
    return spark.streams.awaitAnyTermination(timeout)


def stop_all(spark: SparkSession, names: list[str] | None = None) -> list[str]:
    """Stop the running queries (or those named) and return their names."""
    stopped = []
    for query in spark.streams.active:
        if names is None or query.name in names:
            query.stop()
            stopped.append(query.name)
    return stopped


def drain(
    stream: DataFrame,
    name: str,
    checkpoint_root: str,
    *,
    timeout: float | None = None,
    **options,
) -> StreamingQuery:
    """Process everything available now, then return the finished query."""
    return wait_for(start(stream, name, checkpoint_root, drain=True, **options), timeout)
