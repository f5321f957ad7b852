"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a Python function holds as objects at one time; whole texts, so kept small.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % folds


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def arrow_batch(columns: Sequence[Sequence], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def free_name(base: str, taken: Iterable[str]) -> str:
    """``base``, with as many underscores as it takes to be no column yet (in any letter case)."""
    names = {n.lower() for n in taken}
    while base.lower() in names:
        base += "_"
    return base
