"""Text files, console and printed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter


def save_text(
    frame: DataFrame, path: str, line: Column, *, mode: str = "error", files: int | None = None
) -> None:
    """Write one formatted line per row; ``files`` lowers the number of files."""
    out = frame.select(line.alias("value"))
    if files is not None:
        # Not coalesce, which would also cut the parallelism of the work before it.
        out = out.repartition(files)
    out.write.mode(mode).text(path)


def to_console(
    stream: DataFrame, *, rows: int | None = None, truncate: bool = True
) -> DataStreamWriter:
    """Writer that prints each micro-batch; hand it to ``streaming.run.start``."""
    writer = stream.writeStream.format("console").option("truncate", str(truncate).lower())
    if rows is not None:
        writer = writer.option("numRows", rows)
    return writer


def show(frame: DataFrame, rows: int = 20, *, truncate: bool = True, schema: bool = False) -> None:
    if schema:
        frame.printSchema()
    frame.show(rows, truncate=truncate)


def print_pairs(frame: DataFrame, rows: int | None = None) -> None:
    """Print the first two columns as ``key: value`` lines: all rows, a partition at a time.

    With ``rows`` only so many are printed, and a last line says when there are more.
    """
    for n, row in enumerate((frame if rows is None else frame.limit(rows + 1)).toLocalIterator()):
        if n == rows:
            print(f"... more than {rows} rows")
            return
        print(f"{row[0]}: {row[1]}")
