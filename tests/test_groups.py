"""Pandas functions on whole groups, batch and streaming."""

import resource
import sys

import pandas as pd
import pytest
from conftest import tuples
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewell.operators import aggregate
from tidewell.scratch import scratch_dir
from tidewell.sources import files
from tidewell.streaming import run

# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sizes(key, batches):
    lengths = [len(b) for b in batches]
    yield pd.DataFrame({"rows": [sum(lengths)], "batches": [len(lengths)], "most": [max(lengths)]})


def test_function_sees_whole_groups_in_batches(spark):
    frame = spark.range(50_000).select((F.col("id") % 3).alias("k"), "id").repartition(7)
    got = aggregate.apply_groups(frame, "k", sizes, "rows long, batches long, most long")
    assert got.columns == ["k", "rows", "batches", "most"]
    for _, rows, batches, most in tuples(got):
        assert rows in (16_666, 16_667) and batches > 1 and most <= 10_000


def peak(key, batches):
    def memory():
        return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024

    rows, before = 0, None
    for batch in batches:
        before = memory() if before is None else before
        rows += len(batch)
    yield pd.DataFrame({"rows": [rows], "grown_mb": [memory() - before]})


def test_a_large_group_keeps_memory_flat(spark):
    rows = 10_000_000
    columns = [F.col("id"), *[F.rand(i).alias(f"x{i}") for i in range(4)]]
    frame = spark.range(0, rows, 1, 8).select(F.lit("hot").alias("k"), *columns)
    ((key, n, grown),) = tuples(aggregate.apply_groups(frame, "k", peak, "rows long, grown_mb double"))
    # The group has 400 MB of numbers.
    assert (key, n) == ("hot", rows) and grown < 60


def test_equals_pandas(spark):
    rows = [(i % 7, float(i * i % 31)) for i in range(500)] + [(3, None), (3, float("nan")), (9, None)]
    frame = spark.createDataFrame(rows, "id int, x double").repartition(6)
    got = {r[0]: r[1:] for r in tuples(aggregate.apply_groups(frame, "id", aggregate.medians("x"), "v double, n long"))}
    want = pd.DataFrame(rows, columns=["id", "x"]).groupby("id")["x"]
    assert got.pop(9) == (None, 0)
    assert {k: v[0] for k, v in got.items()} == want.median().drop(9).to_dict()
    assert {k: v[1] for k, v in got.items()} == want.count().drop(9).to_dict()


def named(key, batches):
    values = tuple(v.item() if hasattr(v, "item") else v for v in key)
    yield pd.DataFrame({"key": [repr(values)], "n": [sum(map(len, batches))]})


def test_null_keys_are_groups_of_their_own(spark):
    rows = [(None, None, 1), (None, float("nan"), 1), (1 << 60, 0.0, 1), (1 << 60, 0.0, 1), ((1 << 60) + 1, None, 1)]
    frame = spark.createDataFrame(rows, "a long, b double, x int")
    got = [(r[0], r[2], r[3]) for r in tuples(aggregate.apply_groups(frame, ["a", "b"], named, "key string, n long"))]
    want = [(None, "(None, None)", 1), (None, "(None, nan)", 1), (1 << 60, f"({1 << 60}, 0.0)", 2),
            ((1 << 60) + 1, f"({(1 << 60) + 1}, None)", 1)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_functions_may_return_any_number_of_rows(spark):
    def pairs(key, batches):
        for batch in batches:
            yield batch[batch["x"] > key[0]][["x"]]

    frame = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (5, 4)], "k int, x int")
    assert sorted(tuples(aggregate.apply_groups(frame, "k", pairs, "x int"))) == [(1, 2), (1, 3)]
    empty = aggregate.apply_groups(frame.where("false"), "k", pairs, "x int")
    assert tuples(empty) == [] and empty.dtypes == [("k", "int"), ("x", "int")]


def in_order(key, batches):
    last, right, n = -1, True, 0
    for batch in batches:
        values = batch["x"].tolist()
        right &= all(a <= b for a, b in zip([last, *values], values, strict=False))
        last, n = values[-1], n + len(values)
    yield pd.DataFrame({"right": [right], "n": [n]})


def test_ordered_groups_need_one_shuffle_and_one_sort(spark):
    frame = spark.range(60_000).select((F.col("id") % 2).alias("k"), F.pmod(F.hash("id"), F.lit(1 << 20)).alias("x"))
    found = aggregate.apply_groups(frame, "k", in_order, "right boolean, n long", order_by="x")
    assert sorted(tuples(found)) == [(0, True, 30_000), (1, True, 30_000)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_longest_pause_goes_over_batches(spark):
    frame = spark.range(30_000).select(
        F.lit("u").alias("u"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") + F.when(F.col("id") >= 10_000, 99).otherwise(0))).alias("t"),
    )
    one = frame.limit(1).withColumn("u", F.lit("one"))
    both = frame.unionByName(one)
    got = aggregate.apply_groups(both, "u", aggregate.longest_pause("t"), "pause_us long", order_by="t")
    assert sorted(tuples(got)) == [("one", None), ("u", 100_000_000)]


def test_result_must_not_repeat_a_key(spark):
    with pytest.raises(ValueError, match="repeats the keys k"):
        aggregate.apply_groups(spark.range(1).withColumn("k", F.lit(1)), "k", sizes, "k int")


def test_stream_groups_appear_once_a_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "0.txt").write_text("a\nb\na\n")
    (folder / "1.txt").write_text("a\n")
    seen = []
    lines = files.stream_files(spark, str(folder), max_files=1)
    counts = aggregate.apply_groups(lines.withColumn("x", F.lit(1)), "value", sizes, "rows long, batches long, most long")
    run.drain(counts, "groups", scratch_dir(spark, "groups"), mode="update", timeout=120,
              each_batch=lambda batch, epoch: seen.append(sorted((r[0], r[1]) for r in batch.collect())))
    assert sorted(seen) == [[("a", 1)], [("a", 2), ("b", 1)]]
    with pytest.raises(ValueError, match="stream"):
        aggregate.apply_groups(lines, "value", sizes, "rows long", order_by="value")
