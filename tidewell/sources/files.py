"""Text and delimited files, batch and streaming, and in-memory rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell import schemas
from tidewell.functions.text import part, split_on

STREAM_FORMATS = ("text", "csv", "json", "orc", "parquet")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in column ``value``."""
    return spark.read.text(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv_inferred(spark: SparkSession, path: str, *, separator: str = ";") -> DataFrame:
    """CSV with a header row and inferred types.

    Inference reads the input once more; pass a schema (``read_csv_typed``)
    for large files.
    """
    return spark.read.csv(path, sep=separator, header=True, inferSchema=True)


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: StructType = schemas.PEOPLE_CSV,
    *,
    separator: str = ";",
    header: bool = False,
) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep=separator, header=header)


def positional(lines: DataFrame, names: str | list[str], *, separator: str = ",") -> DataFrame:
    """Split lines into string columns by position; missing fields are NULL.

    Quotes have no meaning. Only the columns a query uses are cut out.
    """
    schema = schemas.strings(names)
    cut = lines.select(split_on("value", separator).alias("parts"))
    return cut.select(*[part("parts", i).alias(f.name) for i, f in enumerate(schema)])


def read_positional(
    spark: SparkSession, path: str, names: str | list[str], *, separator: str = ","
) -> DataFrame:
    return positional(read_lines(spark, path), names, separator=separator)


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """A few rows written in code. String columns accept any value."""
    text = {i for i, f in enumerate(schema) if f.dataType.simpleString() == "string"}
    data = [
        tuple(str(v) if i in text and v is not None else v for i, v in enumerate(row))
        for row in rows
    ]
    return spark.createDataFrame(data, schema)


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    schema: StructType | None = None,
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
    **options,
) -> DataFrame:
    """Watch a folder (or glob) for new files.

    ``max_files`` / ``max_bytes`` bound one micro-batch.
    """
    if fmt not in STREAM_FORMATS:
        raise ValueError(f"format must be one of {', '.join(STREAM_FORMATS)}")
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt != "text":
        raise ValueError(f"a {fmt} stream needs a schema")
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def stream_table(spark: SparkSession, folder: str, name: str, **limits) -> DataFrame:
    """A parquet table as a stream, whether it is one file or a folder of files.

    The last letter is written as a glob class because a stream over the plain
    path of a single file is refused.
    """
    schema = read_table(spark, folder, name).schema
    return stream_files(spark, f"{folder}/{name}.parque[t]", "parquet", schema, **limits)


def with_ingest_time(lines: DataFrame, name: str = "timestamp") -> DataFrame:
    """Add the time of reading, as sockets do with ``includeTimestamp``."""
    return lines.withColumn(name, F.current_timestamp())
