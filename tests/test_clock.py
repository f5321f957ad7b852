"""Wall-clock times in session zones with a clock change."""

from datetime import datetime, timedelta

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tidewell.functions.clock import instant_to_wall, to_wall_time, wall_to_instant
from tidewell.operators import parse
from tidewell.plans import stream_queries
from tidewell.scratch import scratch_dir
from tidewell.sinks.epochs import EpochTable
from tidewell.sources import files
from tidewell.streaming import run
from tidewell.streaming.windows import window_counts

# In New York 02:00 to 03:00 is missing on the first day and 01:00 to 02:00 comes twice on the second.
SPRING = [datetime(2024, 3, 10, 2, 2), datetime(2024, 3, 10, 3, 2)]
AUTUMN = [datetime(2024, 11, 3, 0, 58), datetime(2024, 11, 3, 1, 2), datetime(2024, 11, 3, 2, 2)]


@pytest.fixture(params=["America/New_York", "Asia/Kolkata", "UTC"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def windows_of(times):
    """Ten-minute windows, one every five minutes, that hold each time."""
    found = {}
    for t in times:
        start = t.replace(minute=t.minute // 5 * 5, second=0, microsecond=0)
        for s in (start, start - timedelta(minutes=5)):
            found[s] = found.get(s, 0) + 1
    return sorted((s, s + timedelta(minutes=10), "w", n) for s, n in found.items())


def test_codec_round_trip(spark, zone):
    texts = ["2024-03-10 02:30:00", "2024-11-03 01:30:00.123456", "1969-12-31 23:59:59.5", "0001-01-01 00:00:00",
             "9999-12-31 23:59:59.999999", None, "no time", "2024-13-01 00:00:00"]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    wall = to_wall_time("value")
    got = frame.select(wall.alias("w"), instant_to_wall(wall_to_instant(wall)).alias("back"),
                       F.unix_micros(wall_to_instant(wall)).alias("us"))
    assert dict(got.dtypes)["back"] == "timestamp_ntz"
    rows = tuples(got)
    for wall_time, back, micros in rows[:5]:
        assert back == wall_time
        assert micros == (wall_time - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    assert rows[5:] == [(None, None, None)] * 3


@pytest.mark.parametrize("times", [SPRING, AUTUMN])
@pytest.mark.parametrize("watermark", [None, "10 minutes"])
def test_batch_windows(spark, zone, lines_of, times, watermark):
    events = parse.parse_word_time(lines_of(*[f"w,{t}" for t in times]))
    assert sorted(r.time for r in events.collect()) == times
    counts = window_counts(events, width="10 minutes", slide="5 minutes", watermark=watermark)
    assert sorted(tuples(counts)) == windows_of(times)


@pytest.mark.parametrize("times", [SPRING, AUTUMN])
def test_stream_windows(spark, zone, tmp_path, times):
    folder = tmp_path / "in"
    folder.mkdir()
    place = scratch_dir(spark, "clock-test")
    table = EpochTable(f"{place}/out", stream_queries.WINDOW_COUNT, keys=["window_start", "window_end", "word"])
    for n, t in enumerate(times):
        (folder / f"{n}.txt").write_text(f"w,{t}\n")
        events = parse.parse_word_time(files.stream_files(spark, str(folder)))
        counts = window_counts(events, width="10 minutes", slide="5 minutes", watermark="10 minutes")
        run.drain(counts, "clock", place, mode="update", each_batch=table.upsert, timeout=120)
    assert sorted(tuples(table.read(spark))) == windows_of(times)


def test_late_rows_are_late_by_the_clock(spark, zone, tmp_path):
    """Nine minutes back is in time, an hour back is not, also over the missing hour."""
    folder = tmp_path / "in"
    folder.mkdir()
    place, dropped = scratch_dir(spark, "clock-late"), 0
    lines = ["w,2024-03-10 03:05:00", "w,2024-03-10 03:05:30", "w,2024-03-10 02:56:00", "w,2024-03-10 01:59:00"]
    for n, line in enumerate(lines):
        (folder / f"{n}.txt").write_text(line + "\n")
        events = parse.parse_word_time(files.stream_files(spark, str(folder)))
        counts = window_counts(events, width="5 minutes", slide="5 minutes", watermark="10 minutes")
        query = run.drain(counts, "late", place, mode="update", each_batch=lambda b, e: b.collect(), timeout=120)
        dropped += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_instants_keep_their_windows(spark):
    frame = spark.sql("SELECT TIMESTAMP'2024-01-01 00:07:00Z' AS time, 'x' AS word")
    for watermark in (None, "1 minute"):
        counts = window_counts(frame, width="10 minutes", slide="10 minutes", watermark=watermark)
        assert counts.dtypes[0][1] == "timestamp" and tuples(counts)[0][0] == datetime(2024, 1, 1)
