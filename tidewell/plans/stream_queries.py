"""Streaming queries, run over everything there is and read back as tables.

Streams over a table read its files in place. Where several arrivals matter,
the events are landed as text in time slices and the checkpointed query is
restarted after each one, which also exercises recovery. Results are written by
the executors to shared folders; none of them passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidewell import schemas
from tidewell.operators import aggregate, parse
from tidewell.operators.ip_region import add_region
from tidewell.plans import lines
from tidewell.plans.order_queries import (
    CHOSEN_CITIES,
    ORDER_TOTAL_SQL,
    TOTAL_LABEL,
    range_index,
)
from tidewell.plans.registry import register
from tidewell.plans.text_queries import _words_sql
from tidewell.scratch import scratch_dir
from tidewell.sinks.epochs import EpochTable
from tidewell.sinks.foreach import BufferedWriter
from tidewell.sources import files
from tidewell.streaming import run
from tidewell.streaming.windows import window_counts

# Input of one micro-batch over a table, so a huge table is taken in steps.
BATCH_BYTES = 1 << 40
# Events landed at one time, by the size of their rows; at least so many arrivals are made, and no
# arrival is cut within a minute.
SLICE_BYTES = 64 << 30
LEAST_SLICES = 3

WORD_COUNT = StructType([StructField("word", StringType()), StructField("count", LongType())])
WINDOW_COUNT = StructType(
    [
        StructField("window_start", TimestampNTZType()),
        StructField("window_end", TimestampNTZType()),
        *WORD_COUNT.fields,
    ]
)


def _place(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, name)


def _run(
    stream: DataFrame, name: str, mode: str, table: EpochTable, write: str
) -> DataFrame:
    """Drain a stream into a table and read it."""
    run.drain(
        stream, name, f"{table.path}/checkpoints", mode=mode, each_batch=getattr(table, write)
    )
    return table.read(stream.sparkSession)


# -- arrivals ------------------------------------------------------------------------


# Four numbers and a time, and the texts.
ROW_BYTES = "32 + octet_length(event_type) + octet_length(props)"


def slice_starts(events: DataFrame) -> list[str]:
    """First minutes, as text, of the slices that cut ``events`` by time into arrivals.

    Bytes are added up per minute; a slice begins with the first minute that has a further
    ``SLICE_BYTES`` (or a third of all bytes, if less) before it. The running sum sees one row per
    minute of the table, the driver one per slice.
    """
    # As text, which no zone changes: 2024-03-10 02:02.
    minute = F.substring(F.col("ts").cast("timestamp_ntz").cast("string"), 1, 16)
    sizes = events.groupBy(minute.alias("minute")).agg(F.sum(F.expr(ROW_BYTES)).alias("bytes")).where("minute IS NOT NULL")
    all_rows = Window.orderBy("minute")
    before = F.sum("bytes").over(all_rows) - F.col("bytes")
    total = F.sum("bytes").over(all_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    limit = F.least(F.lit(SLICE_BYTES), F.floor((total + LEAST_SLICES - 1) / LEAST_SLICES))
    cut = sizes.select("minute", F.floor(before / limit).alias("slice"))
    starts = cut.groupBy("slice").agg(F.min("minute").alias("minute")).orderBy("slice")
    return [r.minute for r in starts.collect()]


# The events with the number of their slice.
SLICED_EVENTS = f"""(SELECT events.*, slice FROM events JOIN (
  SELECT minute, dense_rank() OVER (ORDER BY before // slice_bytes) - 1 AS slice
  FROM (SELECT minute, sum(bytes) OVER (ORDER BY minute) - bytes AS before,
      least({SLICE_BYTES}, (sum(bytes) OVER () + {LEAST_SLICES - 1}) // {LEAST_SLICES}) AS slice_bytes
    FROM (SELECT date_trunc('minute', ts) AS minute,
        sum(32 + strlen(event_type) + strlen(props))::BIGINT AS bytes FROM events GROUP BY 1)))
  ON date_trunc('minute', ts) = minute)"""


def _arrivals(
    spark: SparkSession,
    folder: str,
    to_lines: Callable[[DataFrame], DataFrame],
    start: Callable[[DataFrame], None],
    *,
    oldest_last: bool = False,
) -> None:
    """Land the events slice by slice, oldest first or at the very end; ``start`` runs after each."""
    events = files.read_table(spark, folder, "events")
    landing = scratch_dir(spark, "landing")
    edges = [*slice_starts(events), None]
    slices = list(zip(edges, edges[1:]))
    for low, high in slices[1:] + slices[:1] if oldest_last else slices:
        part = events.where(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        if high is not None:
            part = part.where(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        to_lines(part).write.mode("append").text(landing)
        start(files.stream_files(spark, landing))


# -- running counts and totals ------------------------------------------------------------


@register("stream_running_count", _words_sql("text"))
def stream_running_count(spark, folder):
    documents = files.stream_table(spark, folder, "documents", max_bytes=BATCH_BYTES)
    counts = aggregate.word_counts(lines.document_lines(documents))
    table = EpochTable(_place(spark, "running-count"), WORD_COUNT, keys=["word"])
    return _run(counts, "running-count", "update", table, "upsert")


@register("stream_wordcount_sql", _words_sql("trim(text)"))
def stream_wordcount_sql(spark, folder):
    documents = files.stream_table(spark, folder, "documents", max_bytes=BATCH_BYTES)
    counts = aggregate.word_counts_sql(lines.document_lines(documents), "word_stream")
    table = EpochTable(_place(spark, "wordcount-sql"), WORD_COUNT, keys=["word"])
    return _run(counts, "wordcount-sql", "update", table, "upsert")


def _order_stream(spark: SparkSession, folder: str) -> DataFrame:
    orders = files.stream_table(spark, folder, "orders", max_bytes=BATCH_BYTES)
    return parse.valid_orders(parse.parse_order_json(lines.order_lines(orders)))


TOTALS = StructType(
    [StructField("type", StringType()), StructField("totalMoney", DecimalType(20, 2))]
)


@register("stream_sql_total", ORDER_TOTAL_SQL)
def stream_sql_total(spark, folder):
    total = aggregate.query_view(
        _order_stream(spark, folder),
        "order_stream",
        f"SELECT '{TOTAL_LABEL}' AS type, sum(money) AS totalMoney FROM order_stream",
    )
    table = EpochTable(_place(spark, "sql-total"), TOTALS)
    return _run(total, "sql-total", "complete", table, "replace")


@register(
    "stream_multi_totals",
    f"""{lines.PLACED_ORDERS}
SELECT 'total' AS target, '{TOTAL_LABEL}' AS type, CAST(sum(money) AS DECIMAL(20,2)) AS "totalMoney"
FROM placed
UNION ALL
SELECT 'totalprovince', CAST(province AS VARCHAR), CAST(sum(money) AS DECIMAL(20,2))
FROM placed GROUP BY province
UNION ALL
SELECT 'totalcity', CAST(city AS VARCHAR), CAST(sum(money) AS DECIMAL(20,2))
FROM placed WHERE city IN (20, 30) GROUP BY city
""",
)
def stream_multi_totals(spark, folder):
    """Three result tables from one reading of the stream.

    The stream keeps totals per city; each epoch derives the three tables from
    those few rows, once they are safely written.
    """
    placed = add_region(_order_stream(spark, folder), range_index(spark, folder))
    by_city = placed.groupBy("province", "city").agg(F.sum("money").alias("money"))
    place = _place(spark, "multi-totals")
    fine = EpochTable(
        f"{place}/bycity",
        StructType(
            [
                StructField("province", IntegerType()),
                StructField("city", IntegerType()),
                StructField("money", DecimalType(20, 2)),
            ]
        ),
    )
    targets = {
        n: EpochTable(f"{place}/{n}", TOTALS) for n in ("total", "totalprovince", "totalcity")
    }

    def write(batch: DataFrame, epoch: int) -> None:
        fine.replace(batch, epoch)
        cities = fine.read(batch.sparkSession)
        total = aggregate.total(cities, "money", "totalMoney")
        targets["total"].replace(total.withColumn("type", F.lit(TOTAL_LABEL)), epoch)
        province = aggregate.total_by(cities, "province", "money", "totalMoney")
        targets["totalprovince"].replace(province.withColumnRenamed("province", "type"), epoch)
        chosen = aggregate.total_by_chosen(cities, "city", CHOSEN_CITIES, "money", "totalMoney")
        targets["totalcity"].replace(chosen.withColumnRenamed("city", "type"), epoch)

    run.drain(by_city, "multi-totals", f"{place}/checkpoints", mode="complete", each_batch=write)
    out = None
    for name, table in targets.items():
        rows = table.read(spark).select(F.lit(name).alias("target"), "type", "totalMoney")
        out = rows if out is None else out.unionByName(rows)
    return out


@register(
    "stream_three_queries",
    f"""
SELECT 'status' AS target, status AS key, count(*) AS count
FROM (SELECT {lines.ACCESS_STATUS} AS status FROM events WHERE {lines.GOOD_EVENT}) GROUP BY status
UNION ALL
SELECT 'method', method, count(*)
FROM (SELECT {lines.ACCESS_METHOD} AS method FROM events WHERE {lines.GOOD_EVENT}) GROUP BY method
UNION ALL
SELECT 'path', path, count(*)
FROM (SELECT {lines.ACCESS_PATH} AS path FROM events WHERE {lines.GOOD_EVENT}) GROUP BY path
""",
)
def stream_three_queries(spark, folder):
    """Three independent queries of one session, each with its own checkpoint."""
    log = lines.access_lines(files.stream_table(spark, folder, "events", max_bytes=BATCH_BYTES))
    records = parse.parse_access_log(log)
    place = _place(spark, "three-queries")
    schema = StructType([StructField("key", StringType()), StructField("count", LongType())])
    tables, started = {}, []
    for name in ("status", "method", "path"):
        tables[name] = EpochTable(f"{place}/{name}", schema, keys=["key"])
        counts = aggregate.count_by(records.select(F.col(name).alias("key")), "key")
        started.append(
            run.start(
                counts,
                f"log-{name}",
                f"{place}/checkpoints",
                mode="update",
                each_batch=tables[name].upsert,
                drain=True,
            )
        )
    for query in started:
        run.wait_for(query)
    out = None
    for name, table in tables.items():
        rows = table.read(spark).select(F.lit(name).alias("target"), "key", "count")
        out = rows if out is None else out.unionByName(rows)
    return out


# -- several arrivals -----------------------------------------------------------------------

_EVENT_WORDS = """(SELECT event_type AS word, ts FROM events
  UNION ALL SELECT concat('u', user_id), ts FROM events)"""
_SLICED_WORDS = f"""(SELECT event_type AS word, slice FROM {SLICED_EVENTS}
  UNION ALL SELECT concat('u', user_id), slice FROM {SLICED_EVENTS})"""


@register(
    "per_batch_count",
    f"""
SELECT slice AS batch_id, word, count(*) AS count FROM {_SLICED_WORDS} GROUP BY 1, 2
""",
)
def per_batch_count(spark, folder):
    """Words of every arrival counted on their own, without running state."""
    place = _place(spark, "per-batch")
    table = EpochTable(place, WORD_COUNT)

    def write(batch: DataFrame, epoch: int) -> None:
        table.append(aggregate.word_counts(batch, keep_empty=False), epoch)

    def start(stream: DataFrame) -> None:
        run.drain(stream, "per-batch", f"{place}/checkpoints", each_batch=write)

    _arrivals(spark, folder, lines.word_lines, start)
    counted = table.read_with_epoch(spark)
    return counted.select(F.col("epoch").alias("batch_id"), "word", "count")


_ALL_WORDS_SQL = f"SELECT word, count(*) AS count FROM {_EVENT_WORDS} GROUP BY word"


@register("upsert_counts", _ALL_WORDS_SQL)
def upsert_counts(spark, folder):
    """Running counts whose changed rows replace the old ones by key."""
    table = EpochTable(_place(spark, "upsert"), WORD_COUNT, keys=["word"], fold_every=2)

    def start(stream: DataFrame) -> None:
        counts = aggregate.word_counts(stream, keep_empty=False)
        _run(counts, "upsert", "update", table, "upsert")

    _arrivals(spark, folder, lines.word_lines, start)
    return table.read(spark)


@register("overwrite_counts", _ALL_WORDS_SQL)
def overwrite_counts(spark, folder):
    """Every arrival replaces the whole result."""
    table = EpochTable(_place(spark, "overwrite"), WORD_COUNT)

    def start(stream: DataFrame) -> None:
        counts = aggregate.word_counts(stream, keep_empty=False)
        _run(counts, "overwrite", "complete", table, "replace")

    _arrivals(spark, folder, lines.word_lines, start)
    return table.read(spark)


def json_files_writer(folder: str) -> BufferedWriter:
    """A ``foreach`` object writing JSON lines, one file per partition and epoch.

    A file is written under a hidden name of its task attempt and gets its own at the end; after
    an error it is deleted. A repeated partition replaces its file.
    """
    # Spark writes file:/path and s3a://, pyarrow wants a plain path and s3://.
    base = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "/", folder))

    def connect(partition: int, epoch: int) -> dict:
        task = TaskContext.get()
        name = f"part-{epoch:06d}-{partition:06d}.json"
        hidden = f"_{name}.{task.taskAttemptId() if task else 0}"
        return {"epoch": epoch, "name": name, "hidden": hidden, "out": None}

    def write(target: dict, rows: list) -> None:
        import json

        from pyarrow import fs

        if target["out"] is None:
            system, path = fs.FileSystem.from_uri(base)
            system.create_dir(path, recursive=True)
            target |= {"system": system, "path": path}
            target["out"] = system.open_output_stream(f"{path}/{target['hidden']}")
        for row in rows:
            record = {**row.asDict(), "epoch": target["epoch"]}
            target["out"].write((json.dumps(record) + "\n").encode())

    def finish(target: dict, error: BaseException | None) -> None:
        if target["out"] is None:
            return
        target["out"].close()
        hidden = f"{target['path']}/{target['hidden']}"
        if error is None:
            target["system"].move(hidden, f"{target['path']}/{target['name']}")
        else:
            target["system"].delete_file(hidden)

    return BufferedWriter(connect, write, finish)


@register("foreach_rows", _words_sql("text"))
def foreach_rows(spark, folder):
    """Word counts handed to a row-wise sink object on the executors."""
    place = _place(spark, "foreach")
    documents = files.stream_table(spark, folder, "documents", max_bytes=BATCH_BYTES)
    counts = aggregate.word_counts(lines.document_lines(documents))
    schema = StructType([*WORD_COUNT.fields, StructField("epoch", LongType())])
    # No rows, no files: the folder is there even so.
    spark.createDataFrame([], schema).write.json(f"{place}/rows")
    writer = json_files_writer(f"{place}/rows")
    run.drain(counts, "foreach", f"{place}/checkpoints", mode="update", each_row=writer)
    rows = spark.read.schema(schema).json(f"{place}/rows")
    return rows.groupBy("word").agg(F.max_by("count", "epoch").alias("count"))


# -- event time ------------------------------------------------------------------------------


def _window_sql(source: str, tail: str = "", late: str = "") -> str:
    return f"""
WITH e AS (SELECT unnest([0, 1]) AS o, * FROM {source}),
w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * o AS window_start, * FROM e)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, word, count(*) AS count
FROM w {late} GROUP BY window_start, word {tail}
"""


_TYPE_TIMES = "(SELECT event_type AS word, ts FROM events)"
_TIMED_WORDS = f"""(SELECT event_type AS word, ts FROM events WHERE {lines.GOOD_EVENT}
  UNION ALL SELECT concat('u', user_id), ts FROM events WHERE {lines.GOOD_EVENT})"""


@register("event_words", f"SELECT ts AS time, word FROM {_TIMED_WORDS}")
def event_words(spark, folder):
    events = files.read_table(spark, folder, "events")
    return parse.parse_timed_words(lines.timed_lines(events))


@register("window_counts", _window_sql(_TYPE_TIMES))
def window_counts_batch(spark, folder):
    events = files.read_table(spark, folder, "events").select(
        F.col("ts").alias("time"), F.col("event_type").alias("word")
    )
    return window_counts(events, width="10 minutes", slide="5 minutes")


@register("window_counts_stream", _window_sql(_TIMED_WORDS))
def window_counts_stream(spark, folder):
    """Complete mode, ordered by window; the table is read in that order."""
    events = files.stream_table(spark, folder, "events", max_bytes=BATCH_BYTES)
    timed = parse.parse_timed_words(lines.timed_lines(events))
    counts = window_counts(timed, width="10 minutes", slide="5 minutes", ordered=True)
    table = EpochTable(_place(spark, "windows"), WINDOW_COUNT, ordered=True)
    return _run(counts, "windows", "complete", table, "replace")


def _late_windows(stream: DataFrame) -> DataFrame:
    return window_counts(
        parse.parse_word_time(stream), width="10 minutes", slide="5 minutes", watermark="10 minutes"
    )


@register("window_watermark_stream", _window_sql(_TYPE_TIMES))
def window_watermark_stream(spark, folder):
    """Update mode with a watermark; each changed window replaces its old row."""
    table = EpochTable(
        _place(spark, "watermark"), WINDOW_COUNT, keys=["window_start", "window_end", "word"]
    )

    def start(stream: DataFrame) -> None:
        _run(_late_windows(stream), "watermark", "update", table, "upsert")

    _arrivals(spark, folder, lines.word_time_lines, start)
    return table.read(spark)


@register(
    "window_late_stream",
    _window_sql(
        f"(SELECT event_type AS word, ts, slice FROM {SLICED_EVENTS})",
        late="WHERE slice > 0 OR window_start + INTERVAL 10 MINUTE > "
        "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)",
    ),
)
def window_late_stream(spark, folder):
    """The oldest slice comes last: its rows count only in windows the watermark has not passed."""
    table = EpochTable(
        _place(spark, "late"), WINDOW_COUNT, keys=["window_start", "window_end", "word"]
    )

    def start(stream: DataFrame) -> None:
        _run(_late_windows(stream), "late", "update", table, "upsert")

    _arrivals(spark, folder, lines.word_time_lines, start, oldest_last=True)
    return table.read(spark)


@register(
    "window_closed_stream",
    _window_sql(
        _TYPE_TIMES,
        "HAVING window_start + INTERVAL 10 MINUTE <= "
        "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)",
    ),
)
def window_closed_stream(spark, folder):
    """Append mode: only windows the watermark has passed, each of them once."""
    table = EpochTable(_place(spark, "closed"), WINDOW_COUNT)

    def start(stream: DataFrame) -> None:
        _run(_late_windows(stream), "closed", "append", table, "append")

    _arrivals(spark, folder, lines.word_time_lines, start)
    return table.read(spark)


# -- without state --------------------------------------------------------------------------


@register(
    "stream_call_etl",
    f"""
SELECT concat_ws(',', concat('station_', user_id), concat('186', event_id),
  concat('189', user_id), 'success', strftime(ts, '%Y%m%d%H%M%S'),
  CAST(floor(value) AS BIGINT) * 1000) AS value
FROM events WHERE {lines.GOOD_EVENT} AND {lines.CALL_STATUS} = 'success'
""",
)
def stream_call_etl(spark, folder):
    """Filter call records and pass them on as they are."""
    events = files.stream_table(spark, folder, "events", max_bytes=BATCH_BYTES)
    calls = parse.successful_calls(lines.call_lines(events))
    table = EpochTable(_place(spark, "calls"), schemas.LINE)
    return _run(calls, "call-etl", "append", table, "append")


@register("stream_timed_words", f"SELECT word FROM {_EVENT_WORDS}")
def stream_timed_words(spark, folder):
    """Words with the time they were read; the time is left out of the result."""
    events = files.stream_table(spark, folder, "events", max_bytes=BATCH_BYTES)
    timed = files.with_ingest_time(lines.word_lines(events))
    found = aggregate.words(timed, keep_empty=False)
    schema = StructType([StructField("word", StringType()), StructField("timestamp", TimestampType())])
    table = EpochTable(_place(spark, "timed-words"), schema)
    return _run(found, "timed-words", "append", table, "append").select("word")


@register(
    "stream_score_board",
    f"""
SELECT {lines.SCORE} AS score, count(*) AS count
FROM customer WHERE c_nationkey * 2 < 30 AND c_mktsegment <> 'MACHINERY' GROUP BY 1
""",
)
def stream_score_board(spark, folder):
    customer = files.stream_table(spark, folder, "customer", max_bytes=BATCH_BYTES)
    people = parse.parse_word_score(lines.score_lines(customer))
    """Complete mode, ordered by score; the table is read in that order."""
    schema = StructType([StructField("score", IntegerType()), StructField("count", LongType())])
    table = EpochTable(_place(spark, "scores"), schema, ordered=True)
    return _run(aggregate.score_board(people), "scores", "complete", table, "replace")


def _word_values(stream: DataFrame) -> DataFrame:
    parts = stream.select(F.split("value", ",").alias("parts"))
    return parts.select(
        F.get("parts", F.lit(0)).alias("word"), F.get("parts", F.lit(1)).try_cast("double").alias("x")
    )


@register(
    "stream_group_mean",
    f"""
SELECT slice AS batch_id, event_type AS word, round(avg(value), 6) AS v
FROM {SLICED_EVENTS} GROUP BY 1, 2
""",
)
def stream_group_mean(spark, folder):
    """Pandas mean per key within each arrival; nothing is kept between arrivals."""
    place = _place(spark, "group-mean")
    schema = StructType([StructField("word", StringType()), StructField("v", DoubleType())])
    table = EpochTable(place, schema)

    def write(batch: DataFrame, epoch: int) -> None:
        table.append(aggregate.mean_by_pandas(_word_values(batch), "word", "x"), epoch)

    def start(stream: DataFrame) -> None:
        run.drain(stream, "group-mean", f"{place}/checkpoints", each_batch=write)

    _arrivals(spark, folder, lines.word_value_lines, start)
    means = table.read_with_epoch(spark)
    return means.select(F.col("epoch").alias("batch_id"), "word", F.round("v", 6).alias("v"))


@register(
    "stream_group_median",
    f"""
SELECT slice AS batch_id, event_type AS word, round(median(value), 6) AS v, count(value) AS n
FROM {SLICED_EVENTS} GROUP BY 1, 2
""",
)
def stream_group_median(spark, folder):
    """A caller's pandas function on the groups of every micro-batch: update mode, no state."""
    place = _place(spark, "group-median")
    schema = StructType([StructField("word", StringType()), StructField("v", DoubleType()),
                         StructField("n", LongType()), StructField("epoch", LongType())])
    spark.createDataFrame([], schema).write.json(f"{place}/rows")

    def start(stream: DataFrame) -> None:
        medians = aggregate.apply_groups(_word_values(stream), "word", aggregate.medians("x"), "v double, n long")
        writer = json_files_writer(f"{place}/rows")
        run.drain(medians, "group-median", f"{place}/checkpoints", mode="update", each_row=writer)

    _arrivals(spark, folder, lines.word_value_lines, start)
    rows = spark.read.schema(schema).json(f"{place}/rows")
    return rows.select(F.col("epoch").alias("batch_id"), "word", F.round("v", 6).alias("v"), "n")
