import uuid
from datetime import datetime

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tidewell.operators import aggregate, parse
from tidewell.plans import stream_queries
from tidewell.scratch import scratch_dir
from tidewell.sinks import output
from tidewell.sinks.epochs import EpochTable
from tidewell.sources import files, live
from tidewell.streaming import run
from tidewell.streaming.windows import local_times, window_counts

# Sample lines of the windowed word counts.
SLIDING = [
    "2019-10-12 09:00:02,cat dog",
    "2019-10-12 09:00:03,dog dog",
    "2019-10-12 09:00:07,owl cat",
    "2019-10-12 09:00:11,dog",
    "2019-10-12 09:00:13,owl",
]
LATE = [
    "dog,2019-10-10 12:00:06",
    "owl,2019-10-10 12:00:08\t",
    "dog,2019-10-10 12:00:14",
    "cat,2019-10-10 12:00:09",
    "cat,2019-10-10 12:00:15",
    "dog,2019-10-10 12:00:08",
    "owl,2019-10-10 12:00:13",
    "owl,2019-10-10 12:00:21\t",
    "owl,2019-10-10 12:00:17",
    "fox,2019-10-10 12:00:01",
]


class Landing:
    """A watched folder and a query over it."""

    def __init__(self, spark, path):
        self.spark, self.path, self.count = spark, path, 0
        path.mkdir()

    def add(self, *lines):
        # Hidden until complete, as a file stream expects.
        hidden = self.path / f".{self.count}.tmp"
        hidden.write_text("\n".join(lines) + "\n")
        hidden.rename(self.path / f"{self.count:03d}.txt")
        self.count += 1

    def stream(self, **options):
        return files.stream_files(self.spark, str(self.path), **options)


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path / "in")


@pytest.fixture
def place(spark):
    return scratch_dir(spark, "stream-test")


def clock(t):
    return t.strftime("%M:%S")


def test_sliding_windows_batch(spark, lines_of):
    counts = window_counts(parse.parse_timed_words(lines_of(*SLIDING)), ordered=True)
    got = [(r[0].strftime("%H:%M:%S"), r[1].strftime("%H:%M:%S"), r[2], r[3]) for r in counts.collect()]
    assert [g[0] for g in got] == sorted(g[0] for g in got)
    assert set(got) == {
        ("08:59:55", "09:00:05", "cat", 1),
        ("08:59:55", "09:00:05", "dog", 3),
        ("09:00:00", "09:00:10", "cat", 2),
        ("09:00:00", "09:00:10", "dog", 3),
        ("09:00:00", "09:00:10", "owl", 1),
        ("09:00:05", "09:00:15", "cat", 1),
        ("09:00:05", "09:00:15", "dog", 1),
        ("09:00:05", "09:00:15", "owl", 2),
        ("09:00:10", "09:00:20", "dog", 1),
        ("09:00:10", "09:00:20", "owl", 1),
    }


def test_sliding_windows_stream_complete(spark, landing, place, lines_of):
    for line in SLIDING:
        landing.add(line)
    counts = window_counts(parse.parse_timed_words(landing.stream(max_files=1)), ordered=True)
    table = EpochTable(f"{place}/out", stream_queries.WINDOW_COUNT)
    query = run.drain(counts, "sliding", place, mode="complete", each_batch=table.replace, timeout=120)
    assert query.lastProgress["batchId"] == 4
    want = window_counts(parse.parse_timed_words(lines_of(*SLIDING)))
    assert sorted(tuples(table.read(spark))) == sorted(tuples(want))


def test_watermark_update_mode(spark, landing, place):
    seen, dropped = [], 0

    def note(batch, epoch):
        rows = {(clock(r.window_start), r.word, r["count"]) for r in batch.collect()}
        if rows:
            seen.append(rows)

    for line in LATE:
        landing.add(line)
        counts = window_counts(parse.parse_word_time(landing.stream()), watermark="10 seconds")
        query = run.drain(counts, "late", place, mode="update", each_batch=note, timeout=120)
        dropped = sum(
            s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
        )
    assert seen == [
        {("00:05", "dog", 1), ("00:00", "dog", 1)},
        {("00:05", "owl", 1), ("00:00", "owl", 1)},
        {("00:05", "dog", 2), ("00:10", "dog", 1)},
        {("00:00", "cat", 1), ("00:05", "cat", 1)},
        {("00:10", "cat", 1), ("00:15", "cat", 1)},
        {("00:05", "dog", 3), ("00:00", "dog", 2)},
        {("00:10", "owl", 1), ("00:05", "owl", 2)},
        {("00:20", "owl", 1), ("00:15", "owl", 1)},
        {("00:15", "owl", 2), ("00:10", "owl", 2)},
    ]
    assert dropped == 2


def test_watermark_append_mode(spark, landing, place):
    table = EpochTable(f"{place}/out", stream_queries.WINDOW_COUNT)
    for line in LATE:
        landing.add(line)
        counts = window_counts(parse.parse_word_time(landing.stream()), watermark="10 seconds")
        run.drain(counts, "closed", place, mode="append", each_batch=table.append, timeout=120)
    got = {(clock(r.window_start), r.word, r["count"]) for r in table.read(spark).collect()}
    assert got == {("00:00", "cat", 1), ("00:00", "dog", 2), ("00:00", "owl", 1)}


def test_window_counts_accept_local_times(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:07:00' AS time, 'x' AS word")
    counts = local_times(
        window_counts(frame, width="10 minutes", slide="5 minutes"), "window_start", "window_end"
    )
    assert {r.window_start for r in counts.collect()} == {
        datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 5),
    }
    assert counts.dtypes[0][1] == "timestamp_ntz"


@pytest.mark.parametrize("mode, write", [("update", "upsert"), ("complete", "replace")])
def test_restart_gives_the_same_totals(spark, landing, place, lines_of, mode, write):
    texts = ["cat dog", "dog owl", "owl", "cat cat"]
    keys = ["word"] if write == "upsert" else []
    table = EpochTable(f"{place}/out", stream_queries.WORD_COUNT, keys=keys)
    for text in texts:
        landing.add(text)
        counts = aggregate.word_counts(landing.stream())
        run.drain(counts, "restart", place, mode=mode, each_batch=getattr(table, write), timeout=120)
    want = dict(tuples(aggregate.word_counts(lines_of(*texts))))
    assert dict(tuples(table.read(spark))) == want


def test_failed_batch_is_done_again(spark, landing, place):
    landing.add("cat dog")
    table = EpochTable(f"{place}/out", stream_queries.WORD_COUNT)
    fail = [True]

    def write(batch, epoch):
        table.append(aggregate.word_counts(batch), epoch)
        if fail[0]:
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        run.drain(landing.stream(), "again", place, each_batch=write, timeout=120)
    fail[0] = False
    run.drain(landing.stream(), "again", place, each_batch=write, timeout=120)
    assert dict(tuples(table.read(spark))) == {"cat": 1, "dog": 1}


def test_per_batch_counts_have_no_memory(spark, landing, place):
    table = EpochTable(f"{place}/out", stream_queries.WORD_COUNT)

    def write(batch, epoch):
        table.append(aggregate.word_counts(batch), epoch)

    landing.add("cat cat")
    landing.add("cat")
    run.drain(landing.stream(max_files=1), "alone", place, each_batch=write, timeout=120)
    assert sorted(tuples(table.read_with_epoch(spark))) == [("cat", 1, 1), ("cat", 2, 0)]


def test_running_query_lifecycle(spark, landing, place):
    seen = []
    landing.add("a")
    counts = aggregate.word_counts_sql(landing.stream(), f"v{uuid.uuid4().hex}")
    spark.streams.resetTerminated()
    query = run.start(
        counts, "lifecycle", place, mode="update", every="0 seconds",
        each_batch=lambda batch, epoch: seen.extend(tuples(batch)),
    )
    try:
        assert query.name == "lifecycle" and query.isActive
        query.processAllAvailable()
        landing.add("a b")
        query.processAllAvailable()
        assert sorted(seen) == [("a", 1), ("a", 2), ("b", 1)]
        assert run.wait_for_any(spark, 0.1) is False
        with pytest.raises(TimeoutError):
            run.wait_for(query, 0.1)
        assert not query.isActive
    finally:
        query.stop()
    assert run.stop_all(spark) == []
    assert run.checkpoint_path(place + "/", "lifecycle") == f"{place}/lifecycle"


def test_stop_by_name(spark, place):
    spark.streams.resetTerminated()
    rows = live.rate_rows(spark, rows_per_second=5, partitions=1)
    for name in ("one", "two"):
        run.start(rows, name, place, each_batch=lambda batch, epoch: None)
    try:
        assert run.stop_all(spark, ["one"]) == ["one"]
        assert [q.name for q in spark.streams.active] == ["two"]
    finally:
        run.stop_all(spark)
    assert run.wait_for_any(spark, 5)
    spark.streams.resetTerminated()


def test_start_checks_arguments(spark, landing, place):
    with pytest.raises(ValueError, match="mode"):
        run.start(landing.stream(), "x", place, mode="upsert")
    with pytest.raises(ValueError, match="not both"):
        run.start(landing.stream(), "x", place, every="1 second", drain=True)


def test_rate_rows_arrive_in_order(spark, place):
    values = []
    rows = live.rate_batches(spark, rows_per_batch=4, partitions=2)
    query = run.start(
        rows.select("value"), "rate", place,
        each_batch=lambda batch, epoch: values.extend(r[0] for r in batch.collect()),
    )
    try:
        while len(values) < 8 and query.isActive:
            query.awaitTermination(0.1)
    finally:
        query.stop()
    assert sorted(values)[:8] == list(range(8))


def test_console(spark, landing, place):
    landing.add("cat")
    writer = output.to_console(aggregate.word_counts(landing.stream()), rows=10, truncate=False)
    query = run.wait_for(run.start(writer, "console", place, mode="complete", drain=True), 120)
    assert query.exception() is None
    assert query.lastProgress["sink"]["description"].startswith("org.apache.spark")


def test_foreach_object(spark, landing, place, tmp_path):
    landing.add("cat dog", "cat")
    writer = stream_queries.json_files_writer(f"{tmp_path}/rows")
    run.drain(
        aggregate.word_counts(landing.stream()), "rows", place, mode="update", each_row=writer,
        timeout=120,
    )
    rows = spark.read.json(f"{tmp_path}/rows").select("word", "count", "epoch")
    assert sorted(tuples(rows)) == [("cat", 2, 0), ("dog", 1, 0)]


def test_ingest_time(spark, landing, place):
    landing.add("cat dog")
    timed = aggregate.words(files.with_ingest_time(landing.stream()))
    seen = []
    run.drain(timed, "timed", place, mode="update", timeout=120,
              each_batch=lambda batch, epoch: seen.extend(tuples(batch)))
    assert [s[0] for s in seen] == ["cat", "dog"]
    assert seen[0][1] == seen[1][1] is not None


def test_slices_begin_with_the_minute_after_a_third(spark):
    """Ten rows of equal size, two a minute: a third of them ends within the second minute."""
    events = spark.range(10).select(
        (F.lit("2024-03-10 01:58:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * 30)).alias("ts"),
        F.lit("a").alias("event_type"),
        F.lit("b").alias("props"),
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        cuts = stream_queries.slice_starts(events)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert cuts == ["2024-03-10 01:58", "2024-03-10 02:00", "2024-03-10 02:02"]
    assert stream_queries.slice_starts(events.where("false")) == []


def test_slices_are_bounded_by_bytes(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    events = files.read_table(spark, folder, "events")
    row_bytes = F.expr(stream_queries.ROW_BYTES)
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp_ntz"))
    most = events.groupBy(minute).agg(F.sum(row_bytes).alias("bytes")).agg(F.max("bytes")).first()[0]
    for limit in (5_000, 10**9):
        monkeypatch.setattr(stream_queries, "SLICE_BYTES", limit)
        landed = []

        def to_lines(part):
            landed.append(part.agg(F.sum(row_bytes), F.count("*"), F.min("ts"), F.max("ts")).first())
            return part.select(F.col("event_type").alias("value"))

        stream_queries._arrivals(spark, folder, to_lines, lambda stream: None)
        assert sum(x[1] for x in landed) == events.count()
        assert all(a[3] < b[2] for a, b in zip(landed, landed[1:]))
        assert len(landed) == 3 if limit > 5_000 else len(landed) > 5
        assert max(x[0] for x in landed) <= limit + most


def test_ordered_streams_are_read_in_order(spark):
    folder = "/root/testdata/sf0.01"
    scores = stream_queries.stream_score_board(spark, folder)
    windows = stream_queries.window_counts_stream(spark, folder)
    for frame, column in ((scores, "score"), (windows, "window_start")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Exchange" not in plan
        found = [r[column] for r in frame.collect()]
        assert len(found) > 20 and found == sorted(found)
