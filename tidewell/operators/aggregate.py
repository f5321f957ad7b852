"""Counts, sums and top-k. Spark combines before every shuffle, so hot keys cost
one row per task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tidewell.functions.text import below, contains, not_empty, one_of, to_bigint, words_of
from tidewell.functions.udfs import predicate_udf


def count_lines_containing(lines: DataFrame, texts: Mapping[str, str]) -> DataFrame:
    """Lines containing each text, all counted in one pass; keys name the columns."""
    return lines.agg(
        *[F.count_if(contains("value", text)).alias(name) for name, text in texts.items()]
    )


def words(lines: DataFrame, *, strip: str = "none", keep_empty: bool = True) -> DataFrame:
    """One row per word in column ``word``; other columns than ``value`` stay."""
    others = [c for c in lines.columns if c != "value"]
    out = lines.select(F.explode(words_of("value", strip)).alias("word"), *others)
    return out if keep_empty else out.where(not_empty("word"))


def word_counts(lines: DataFrame, *, strip: str = "none", keep_empty: bool = True) -> DataFrame:
    return count_by(words(lines, strip=strip, keep_empty=keep_empty), "word")


def word_counts_where(lines: DataFrame, test) -> DataFrame:
    """Word counts kept by a Python predicate, which sees each distinct word once."""
    check = predicate_udf(test, after_aggregate=True)
    return word_counts(lines).where(check("word"))


WORD_COUNT_SQL = """
WITH words AS (
  SELECT word FROM {view} LATERAL VIEW explode(split(trim(value), ' ')) AS word
)
SELECT word, count(*) AS count FROM words GROUP BY word
"""


def query_view(frame: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``frame`` as ``view`` and run SQL on it; streams work as well."""
    frame.createOrReplaceTempView(view)
    return frame.sparkSession.sql(sql)


def word_counts_sql(lines: DataFrame, view: str = "word_counts") -> DataFrame:
    return query_view(lines, view, WORD_COUNT_SQL.format(view=view))


def count_by(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def top_counts(frame: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent keys; equal counts are taken in key order."""
    return count_by(frame, key).orderBy(F.desc("count"), key).limit(k)


def counts_descending(frame: DataFrame, key: str) -> DataFrame:
    return count_by(frame, key).orderBy(F.desc("count"), key)


def top_counts_each(frame: DataFrame, keys: Mapping[str, Column | str], k: int = 10) -> DataFrame:
    """Top ``k`` of several keys from a single scan: (metric, key, count).

    Keys are ranked in parts, dealt by hash, and the best ``k`` of each part once more:
    however many keys a metric has, the last ranking sees ``k`` for each part.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                (F.col(c) if isinstance(c, str) else c).cast("string").alias("key"),
            )
            for name, c in keys.items()
        ]
    )
    counts = count_by(frame.select(F.inline(pairs)), "metric", "key")
    best = counts.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    for group in (["metric", "part"], ["metric"]):
        order = Window.partitionBy(*group).orderBy(F.desc("count"), "key")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("metric", "key", "count")


def _sum(column: str, alias: str, as_type: str | None) -> Column:
    out = F.sum(column)
    return (out if as_type is None else out.cast(as_type)).alias(alias)


def total(frame: DataFrame, column: str, alias: str, *, as_type: str | None = None) -> DataFrame:
    """Sum over everything; ``as_type`` declares its type, whatever the input's."""
    return frame.agg(_sum(column, alias, as_type))


def total_bytes(records: DataFrame, column: str = "size", alias: str = "total_bytes") -> DataFrame:
    """Sum of a numeric text column; 0 for an empty input."""
    return records.agg(F.coalesce(F.sum(to_bigint(column)), F.lit(0)).alias(alias))


def total_by(
    frame: DataFrame, key: str, column: str, alias: str, *, as_type: str | None = None
) -> DataFrame:
    return frame.groupBy(key).agg(_sum(column, alias, as_type))


def total_by_chosen(
    frame: DataFrame, key: str, chosen: list, column: str, alias: str, *, as_type: str | None = None
) -> DataFrame:
    """Sum per key for the chosen keys only; the filter runs before grouping."""
    return total_by(frame.where(one_of(key, chosen)), key, column, alias, as_type=as_type)


def score_counts(people: DataFrame, max_age: int = 30) -> DataFrame:
    """How many people below ``max_age`` have each score."""
    return count_by(people.where(below("age", max_age)), "score")


def score_board(people: DataFrame, max_age: int = 30) -> DataFrame:
    """``score_counts`` in score order (streams: complete mode)."""
    return score_counts(people, max_age).orderBy("score")


def mean_by_pandas(
    frame: DataFrame, key: str, value: str, *, alias: str = "v", buckets: int | None = None
) -> DataFrame:
    """Mean of ``value`` per key, finished by a pandas function.

    Rows are reduced to one sum and count per key; pandas then takes Arrow batches of keys,
    without another shuffle (but for one if ``buckets`` asks for so many tasks), so neither a
    hot key nor many keys make a batch large. NULL and NaN values do not count; a key without
    values has a NULL mean. Batch frames only.
    """
    number = F.col(value).cast("double")
    number = F.when(~F.isnan(number), number)
    sums = frame.groupBy(key).agg(F.struct(F.sum(number).alias("total"), F.count(number).alias("n")).alias("sums"))
    if buckets is not None:
        sums = sums.repartition(buckets)

    @F.pandas_udf("double")
    def finish(sums: pd.DataFrame) -> pd.Series:
        n = sums["n"]
        return (sums["total"].astype("float64") / n).where(n > 0)

    return sums.select(key, finish("sums").alias(alias))


GroupFunction = Callable[[tuple, Iterator[pd.DataFrame]], Iterable[pd.DataFrame]]


def apply_groups(
    frame: DataFrame,
    keys: str | list[str],
    function: GroupFunction,
    schema: StructType | str,
    *,
    order_by: str | list[str | Column] | None = None,
) -> DataFrame:
    """Hand every group to a pandas function: (keys, columns of ``schema``).

    ``function(key, batches)`` gets the key as a tuple (None for NULL) and the other columns of
    the group as pandas frames, one Arrow batch after the other, and yields frames with the
    columns of ``schema``; NaN in them, and as a key, is NULL in the result. What it does not hold on to is gone with the batch, so a group may
    be larger than memory. With ``order_by`` the rows of a group come in that order, over all
    its batches; the same shuffle and sort serve both.

    The groups of one key stay in one task, since the function sees them whole: use sums and
    counts (``mean_by_pandas``) where partial results can be combined. On a stream every
    micro-batch has its own groups and nothing is remembered between them; ``order_by`` is for
    batch frames.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    result = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    clash = set(keys) & set(result.names)
    if clash:
        raise ValueError(f"the result repeats the keys {', '.join(sorted(clash))}")
    fields = [frame.schema[k] for k in keys]
    # pandas shows a missing float as NaN, which is a key of its own.
    floats = [k for k, f in zip(keys, fields, strict=True) if isinstance(f.dataType, DoubleType | FloatType)]
    flags = [f"_{k}_is_null" for k in floats]
    grouped = frame.withColumns({n: F.col(k).isNull() for n, k in zip(flags, floats, strict=True)})
    names = result.names

    def plain(key: tuple) -> tuple:
        missing = {k for k, flag in zip(floats, key[len(keys) :], strict=True) if flag}
        values = key[: len(keys)]
        return tuple(
            None if k in missing or (k not in floats and pd.isna(v)) else v
            for k, v in zip(keys, values, strict=True)
        )

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = plain(key)
        for out in function(key, (b.drop(columns=keys + flags) for b in batches)):
            parts = {k: [v] * len(out) for k, v in zip(keys, key, strict=True)}
            yield pd.DataFrame(parts | {n: out[n].array for n in names}, columns=keys + names)

    by = keys + flags
    if order_by is not None:
        if frame.isStreaming:
            raise ValueError("the rows of a stream cannot be ordered within groups")
        order = [order_by] if isinstance(order_by, str | Column) else list(order_by)
        grouped = grouped.repartition(*by).sortWithinPartitions(*by, *order)
    return grouped.groupBy(*by).applyInPandas(run, StructType([*fields, *result.fields]))


def medians(value: str) -> GroupFunction:
    """For ``apply_groups``: median ``v`` and number ``n`` of the values that are neither NULL nor NaN.

    Holds on to eight bytes a row.
    """

    def function(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values = np.concatenate([b[value].to_numpy("float64", na_value=np.nan) for b in batches])
        values = values[~np.isnan(values)]
        yield pd.DataFrame({"v": [np.median(values) if len(values) else None], "n": [len(values)]})

    return function


def longest_pause(time: str) -> GroupFunction:
    """For ``apply_groups`` ordered by ``time``: the longest time between neighbours, ``pause_us`` in
    microseconds (NULL for fewer than two). Holds on to the last time only."""

    def function(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, longest = None, None
        for batch in batches:
            times = batch[time].dropna().to_numpy("datetime64[us]").astype("int64")
            if last is not None:
                times = np.concatenate([[last], times])
            if len(times) > 1:
                pause = int(np.diff(times).max())
                longest = pause if longest is None else max(longest, pause)
            last = times[-1] if len(times) else last
        yield pd.DataFrame({"pause_us": pd.array([longest], "Int64")})

    return function
