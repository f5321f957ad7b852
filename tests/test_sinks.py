import json
from pathlib import Path

import pytest
from conftest import tuples
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidewell.plans.stream_queries import WORD_COUNT, json_files_writer
from tidewell.scratch import scratch_dir
from tidewell.sinks import output
from tidewell.sinks.epochs import EpochTable
from tidewell.sinks.foreach import BufferedWriter
from tidewell.streaming import run


@pytest.fixture
def counts(spark):
    def make(**pairs):
        return spark.createDataFrame(list(pairs.items()), "word string, count long")

    return make


@pytest.fixture
def table(spark):
    def make(**options):
        return EpochTable(scratch_dir(spark, "table"), WORD_COUNT, **options)

    return make


def content(table, spark):
    return dict(tuples(table.read(spark)))


def test_empty_table(spark, table):
    assert table().read(spark).dtypes == [("word", "string"), ("count", "bigint")]
    assert content(table(keys=["word"]), spark) == {}
    assert table().read_with_epoch(spark).columns == ["word", "count", "epoch"]


def test_replace(spark, table, counts):
    t = table()
    t.replace(counts(a=1, b=1), 0)
    t.replace(counts(a=2), 1)
    assert content(t, spark) == {"a": 2}


def test_append_and_repeated_epoch(spark, table, counts):
    t = table()
    t.append(counts(a=1), 0)
    t.append(counts(b=2), 1)
    t.append(counts(b=2), 1)
    assert content(t, spark) == {"a": 1, "b": 2}
    assert sorted(tuples(t.read_with_epoch(spark))) == [("a", 1, 0), ("b", 2, 1)]


@pytest.mark.parametrize("fold_every", [1, 2, 3, 100])
def test_upsert_equals_a_dict(spark, table, counts, fold_every):
    t = table(keys=["word"], fold_every=fold_every)
    want = {}
    for epoch, batch in enumerate([{"a": 1, "b": 1}, {"b": 2}, {}, {"c": 1, "a": 5}, {"b": 3}]):
        frame = counts(**batch) if batch else counts(x=1).where("false")
        t.upsert(frame, epoch)
        want.update(batch)
        assert content(t, spark) == want
    # The last epoch is delivered again after a failure.
    t.upsert(counts(b=3), 4)
    assert content(t, spark) == want


def test_old_versions_are_deleted(spark, table, counts):
    replaced, folded = table(), table(keys=["word"], fold_every=2)
    for epoch in range(9):
        replaced.replace(counts(a=epoch), epoch)
        folded.upsert(counts(a=epoch), epoch)
    assert content(replaced, spark) == content(folded, spark) == {"a": 8}

    def epochs(t, part):
        return sorted(int(p.name.split("=")[1]) for p in (Path(t.path) / part).rglob("epoch=*"))

    assert epochs(replaced, "data") == [7, 8]
    assert len(epochs(folded, "data")) <= 5 and len(epochs(folded, "fold")) <= 2


def test_reopened_table_goes_on(spark, table, counts):
    first = table(keys=["word"], fold_every=2)
    for epoch in range(4):
        first.upsert(counts(**{f"w{epoch}": epoch}), epoch)
    second = EpochTable(first.path, WORD_COUNT, keys=["word"], fold_every=2)
    second.upsert(counts(w0=9), 4)
    assert content(second, spark) == {"w0": 9, "w1": 1, "w2": 2, "w3": 3}


def test_upsert_keeps_null_values_and_null_keys(spark, table):
    t = table(keys=["word"])
    t.upsert(spark.createDataFrame([(None, 1), ("a", 1)], WORD_COUNT), 0)
    t.upsert(spark.createDataFrame([("a", None)], WORD_COUNT), 1)
    assert content(t, spark) == {None: 1, "a": None}


def bucket_folders(t, part):
    return {str(p.relative_to(Path(t.path) / part / "generation=0")) for p in (Path(t.path) / part).rglob("bucket=*")}


def test_a_fold_rewrites_changed_buckets_only(spark, table):
    t = table(keys=["word"], fold_every=2, buckets=100)
    words = [f"w{n}" for n in range(2000)]
    t.upsert(spark.createDataFrame([(w, 0) for w in words], WORD_COUNT), 0)
    t.upsert(spark.createDataFrame([(w, 1) for w in words], WORD_COUNT), 1)
    assert len(bucket_folders(t, "fold")) == 100
    want = dict.fromkeys(words, 1)
    for epoch in range(2, 8):
        t.upsert(spark.createDataFrame([("w7", epoch)], WORD_COUNT), epoch)
        want["w7"] = epoch
        assert content(t, spark) == want
    # One hundredth of the buckets was written by each later fold.
    written = [f for f in bucket_folders(t, "fold") if not f.startswith("epoch=1/")]
    assert {len([f for f in written if f.startswith(f"epoch={e}/")]) for e in (5, 7)} == {1}
    assert not [f for f in written if f.startswith("epoch=3/")]


def test_buckets_without_changes_are_not_regrouped(spark, table):
    t = table(keys=["word"], fold_every=2, buckets=50)
    for epoch in range(2):
        t.upsert(spark.createDataFrame([(f"w{n}", n) for n in range(500)], WORD_COUNT), epoch)
    t.upsert(spark.createDataFrame([("w3", 9), (None, 1)], WORD_COUNT), 2)
    plan = t.read(spark)._jdf.queryExecution().optimizedPlan().toString()
    changed, rest = plan.split("\n+- ")
    assert "Aggregate" in changed and "Aggregate" not in rest and "Repartition" not in rest
    assert content(t, spark) == {f"w{n}": n for n in range(500)} | {"w3": 9, None: 1}


def test_reopened_table_keeps_its_buckets(spark, table, counts):
    first = table(keys=["word"], buckets=3, fold_every=2)
    first.upsert(counts(a=1, b=1, c=1), 0)
    second = EpochTable(first.path, WORD_COUNT, keys=["word"], buckets=50, fold_every=2)
    second.upsert(counts(a=2, d=1), 1)
    second.upsert(counts(b=3), 2)
    assert content(second, spark) == {"a": 2, "b": 3, "c": 1, "d": 1}
    assert {f.split("=")[-1] for f in bucket_folders(second, "data") | bucket_folders(second, "fold")} <= {"0", "1", "2"}


def test_upsert_takes_the_newest_of_one_key(spark, tmp_path):
    schema = "word string, at int, count long"
    rows = spark.createDataFrame([("a", 2, 1), ("a", 1, 9), ("b", 1, 1), ("b", None, 7)], schema)
    t = EpochTable(str(tmp_path / "t"), rows.schema, keys=["word"], newest="at")
    t.upsert(rows, 0)
    assert sorted(tuples(t.read(spark))) == [("a", 2, 1), ("b", 1, 1)]
    by_count = EpochTable(str(tmp_path / "u"), rows.schema, keys=["word"], newest="count")
    by_count.upsert(rows, 0)
    assert sorted(tuples(by_count.read(spark)), key=repr) == [("a", 1, 9), ("b", None, 7)]


def test_zero_keys_are_one_key(spark, tmp_path):
    rows = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "x double, n int")
    t = EpochTable(str(tmp_path / "t"), rows.schema, keys=["x"])
    t.upsert(rows, 0)
    assert tuples(t.read(spark)) == [(0.0, 2)]


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_ordered_table_is_read_in_order_without_a_sort(spark, tmp_path, n):
    t = EpochTable(str(tmp_path / "t"), WORD_COUNT, ordered=True)
    # The largest file is the last one, which a plain scan would read first.
    frame = spark.range(n).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("word"), "id")
    frame = frame.withColumnRenamed("id", "count").repartitionByRange(6, F.expr("cast(sqrt(count) as int)"), "word")
    for epoch in range(2):
        t.replace(frame.sortWithinPartitions("word"), epoch)
    read = t.read(spark)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    assert n < 5000 or plan.count("Scan parquet") == 6
    assert [r[1] for r in tuples(read)] == list(range(n))


def test_upsert_needs_keys(table, counts):
    with pytest.raises(ValueError):
        table().upsert(counts(a=1), 0)


def test_failed_epoch_is_not_visible(spark, table, counts, monkeypatch):
    t = table(keys=["word"])
    t.upsert(counts(a=1), 0)
    broken = table(keys=["word"])
    broken.path = t.path
    monkeypatch.setattr(broken, "_commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        broken.upsert(counts(a=9), 1)
    assert content(t, spark) == {"a": 1}
    t.upsert(counts(a=2, b=1), 1)
    assert content(t, spark) == {"a": 2, "b": 1}


@pytest.mark.parametrize("write", ["replace", "append", "upsert"])
def test_a_new_checkpoint_starts_the_table_anew(spark, table, counts, tmp_path, write):
    t = table(keys=["word"] if write == "upsert" else None)
    for generation in range(4):
        folder = str(tmp_path / f"in{generation}")
        for epoch in range(3 - generation % 3):
            counts(**{f"g{generation}e{epoch}": epoch}).coalesce(1).write.mode("append").parquet(folder)
        reader = spark.readStream.schema(WORD_COUNT).option("maxFilesPerTrigger", 1)
        stream = reader.parquet(folder)
        again = EpochTable(t.path, t.schema, keys=t.keys) if generation % 2 else t
        run.drain(stream, "anew", str(tmp_path / f"check{generation}"), each_batch=getattr(again, write))
        t = again
        want = {f"g{generation}e{epoch}" for epoch in range(3 - generation % 3)}
        got = set(content(t, spark))
        assert got == want if write != "replace" else len(got) == 1 and got <= want
    assert len(list((Path(t.path) / "data").glob("generation=*"))) == 2


def test_append_is_packed(spark, table, counts):
    t = table(fold_every=3)
    for epoch in range(11):
        t.append(counts(**{f"w{epoch}": epoch}), epoch)
        if epoch in (2, 5, 6):
            t.append(counts(**{f"w{epoch}": epoch}), epoch)
        assert sorted(tuples(t.read_with_epoch(spark))) == sorted((f"w{e}", e, e) for e in range(epoch + 1))
    assert content(t, spark) == {f"w{e}": e for e in range(11)}
    assert len(list((Path(t.path) / "pack").rglob("epoch=*"))) == 3
    assert len(list((Path(t.path) / "data").rglob("epoch=*"))) <= 6


def test_upsert_takes_the_greatest_of_one_key(spark, table):
    t = table(keys=["word"])
    t.upsert(spark.createDataFrame([("a", 3), ("a", 5), ("a", 4), ("b", None)], WORD_COUNT), 0)
    assert content(t, spark) == {"a": 5, "b": None}


def test_one_version_is_read_without_a_shuffle(spark, table, counts):
    t = table(keys=["word"], fold_every=1)
    t.upsert(counts(a=1), 0)
    t.upsert(counts(a=2), 1)
    assert "Exchange" not in t.read(spark)._jdf.queryExecution().executedPlan().toString()


def test_json_files_writer_leaves_nothing_after_an_error(tmp_path):
    writer = json_files_writer(f"{tmp_path}/rows")
    writer.chunk = 1
    writer.open(0, 0)
    writer.process(Row(word="a", count=1))
    writer.close(ValueError("x"))
    assert list((tmp_path / "rows").iterdir()) == []


def test_save_text(spark, counts, tmp_path):
    frame = counts(a=1, b=2)
    output.save_text(frame, str(tmp_path / "o"), F.format_string("%s: %d", "word", "count"), files=1)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "o")).collect()) == ["a: 1", "b: 2"]
    assert len(list((tmp_path / "o").glob("part-*"))) == 1


def test_show_and_print(counts, capsys):
    frame = counts(a=1, b=2).orderBy("word")
    output.show(frame, 1, schema=True)
    output.print_pairs(frame)
    text = capsys.readouterr().out
    assert "|-- word: string" in text and "only showing top 1 row" in text
    assert text.endswith("a: 1\nb: 2\n")


def writer_log(chunk, fail_at=None):
    log = []

    def write(target, rows):
        if fail_at is not None and len(log) >= fail_at:
            raise OSError("full")
        log.append([r[0] for r in rows])

    return log, BufferedWriter(
        lambda p, e: (p, e), write, lambda t, error: log.append((t, repr(error))), chunk=chunk
    )


def test_buffered_writer_chunks():
    log, writer = writer_log(2)
    assert writer.open(3, 7) is True
    for n in range(5):
        writer.process(Row(n))
    writer.close(None)
    assert log == [[0, 1], [2, 3], [4], ((3, 7), "None")]


def test_buffered_writer_does_not_write_after_an_error():
    log, writer = writer_log(10)
    writer.open(0, 0)
    writer.process(Row(1))
    writer.close(ValueError("x"))
    assert log == [((0, 0), "ValueError('x')")]


def test_buffered_writer_hands_on_its_own_failure():
    log, writer = writer_log(10, fail_at=0)
    writer.open(0, 0)
    writer.process(Row(1))
    with pytest.raises(OSError):
        writer.close(None)
    assert log == [((0, 0), "OSError('full')")]


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_json_files_writer(tmp_path, prefix):
    for _ in range(2):
        writer = json_files_writer(f"{prefix}{tmp_path}/rows")
        writer.open(1, 4)
        writer.process(Row(word="x\ny", count=2))
        writer.close(None)
    files = list((tmp_path / "rows").iterdir())
    assert [f.name for f in files] == ["part-000004-000001.json"]
    assert json.loads(files[0].read_text()) == {"word": "x\ny", "count": 2, "epoch": 4}
