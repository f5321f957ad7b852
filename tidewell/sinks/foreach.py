"""Row-wise sink object for ``writeStream.foreach``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Row


class BufferedWriter:
    """Open a target per partition, pass rows on in chunks, close it.

    ``connect(partition, epoch)`` returns the target; ``write(target, rows)``
    takes a list of at most ``chunk`` rows; ``finish(target, error)`` ends it.
    After an error nothing more is written and ``finish`` gets the error, so it
    can roll back. All three run on executors and must be picklable.
    """

    def __init__(
        self,
        connect: Callable[[int, int], object],
        write: Callable[[object, list[Row]], None],
        finish: Callable[[object, BaseException | None], None],
        *,
        chunk: int = 1000,
    ):
        self.connect = connect
        self.write = write
        self.finish = finish
        self.chunk = chunk

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.target = self.connect(partition_id, epoch_id)
        self.rows: list[Row] = []
        return True

    def process(self, row: Row) -> None:
        self.rows.append(row)
        if len(self.rows) >= self.chunk:
            self._flush()

    def close(self, error: BaseException | None) -> None:
        try:
            if error is None:
                self._flush()
        except BaseException as failure:
            error = failure
            raise
        finally:
            self.finish(self.target, error)

    def _flush(self) -> None:
        if self.rows:
            self.write(self.target, self.rows)
            self.rows = []
