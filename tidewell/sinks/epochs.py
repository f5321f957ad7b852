"""A folder that receives the micro-batches of a stream and reads as one table.

Every epoch is written to a folder of its own and becomes visible by a commit
record written afterwards, so a reader never sees half an epoch and a repeated
epoch replaces itself. A stream with a new checkpoint counts its epochs from
zero again; it starts a new generation of the table.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidewell.scratch import file_names, remove_folder

_COMMIT = StructType(
    [
        StructField("base", LongType()),
        StructField("mode", StringType()),
        StructField("query", StringType()),
        StructField("folds", ArrayType(LongType())),
        StructField("stale", ArrayType(StringType())),
        StructField("generation", LongType()),
        StructField("epoch", LongType()),
    ]
)
# Commit records kept behind the last one.
_COMMITS_KEPT = 100
# Set by Spark on the thread of a streaming query; stays the same as long as its checkpoint.
_QUERY_ID = "sql.streaming.queryId"
_PARTS = ("data", "fold", "pack", "commits")
# Fixed by Spark's file writers: number of the task, and of its file.
_FILE_NAME = re.compile(r"part-(\d+)-.*?(?:-c(\d+))?(?:\.|$)")


class _State(NamedTuple):
    """A commit: ``base`` is the epoch of the last fold or pack, -1 before the first; ``folds`` the
    epoch of each bucket's fold; ``stale`` the bucket folders the last fold replaced."""

    generation: int = -1
    epoch: int = -1
    base: int = -1
    mode: str = ""
    query: str = ""
    folds: tuple[int, ...] = ()
    stale: tuple[str, ...] = ()


class EpochTable:
    """Parquet result of a stream.

    ``replace``, ``append`` and ``upsert`` are ``foreachBatch`` functions; use
    one of them per table, and one query at a time. Replaced content is deleted two versions
    later, so a frame that was read before stays readable for a while. When another query
    (a new checkpoint) writes, the content so far no longer counts; it is
    deleted when a third one begins.

    ``upsert`` needs ``keys``. Rows are dealt to ``buckets`` by hash of their key (a number that
    stays as it was at the first write) and only the changed rows of each epoch are written. Every
    ``fold_every`` epochs the buckets that changed are folded, each into a new copy of its own;
    the others stay as they are. Readers merge the buckets with changes and take the rest as it is.
    Of several rows of a key in one batch the one with the greatest ``newest`` column
    counts, then the greatest by the other columns in their order.

    ``append`` packs ``fold_every`` epochs into one folder. With ``ordered`` the rows of
    ``replace`` are read in the order they were written in: a sorted batch needs no second sort.
    """

    def __init__(
        self,
        path: str,
        schema: StructType,
        *,
        keys: list[str] | None = None,
        fold_every: int = 20,
        buckets: int = 16,
        newest: str | None = None,
        ordered: bool = False,
    ):
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys or [])
        self.fold_every = fold_every
        self.buckets = buckets
        self.newest = newest
        self.ordered = ordered
        self._values = [f.name for f in schema if f.name not in self.keys]
        self._committed: _State | None = None

    # -- writing ----------------------------------------------------------------

    def replace(self, batch: DataFrame, epoch: int) -> None:
        """The batch is the whole new content."""
        spark = batch.sparkSession
        generation = self._before(spark, epoch).generation
        self._write(self._typed(batch), generation, "data", epoch)
        self._commit(spark, generation, epoch, epoch, "replace")
        self._forget(spark, generation, "data", epoch - 2)

    def append(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        last = self._before(spark, epoch)
        self._write(self._typed(batch), last.generation, "data", epoch)
        base = last.base
        if epoch - base >= self.fold_every:
            rows = self._epochs(spark, last.generation, "data", base + 1, epoch)
            rows = rows.withColumnRenamed("epoch", "_came_in")
            self._write(rows, last.generation, "pack", epoch)
            base = epoch
        self._commit(spark, last.generation, epoch, base, "append")
        if base == epoch:
            self._forget_folded(spark, last)

    def upsert(self, batch: DataFrame, epoch: int) -> None:
        """Insert or replace rows by key."""
        if not self.keys:
            raise ValueError("upsert needs keys")
        spark = batch.sparkSession
        last = self._before(spark, epoch)
        folds = list(last.folds) or [-1] * self.buckets
        rows = self._one_per_key(self._typed(batch), len(folds))
        self._write(rows, last.generation, "data", epoch, "bucket")
        if epoch - last.base < self.fold_every:
            self._commit(spark, last.generation, epoch, last.base, "upsert", tuple(folds), last.stale)
            return
        now = last._replace(epoch=epoch, folds=tuple(folds))
        changes = self._changes(spark, now)
        changed = self._buckets_in(changes)
        merged = self._merged(changes, self._folded(spark, now, changed))
        self._write(merged, last.generation, "fold", epoch, "bucket")
        stale = tuple(f"epoch={folds[b]}/bucket={b}" for b in changed if folds[b] >= 0)
        for b in changed:
            folds[b] = epoch
        self._commit(spark, last.generation, epoch, epoch, "upsert", tuple(folds), stale)
        self._forget_folded(spark, last)
        # Folders that no bucket lies in any more, else single buckets of them.
        in_use = {f"epoch={e}" for e in folds} | {folder.split("/")[0] for folder in stale}
        gone = {f if f.split("/")[0] in in_use else f.split("/")[0] for f in last.stale}
        for folder in gone:
            remove_folder(spark, f"{self._folder(last.generation, 'fold')}/{folder}")

    def _typed(self, frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def _one_per_key(self, frame: DataFrame, buckets: int) -> DataFrame:
        """One row per key, with its ``bucket``; the shuffle by bucket serves the grouping as well."""
        floats = {f.name for f in self.schema if isinstance(f.dataType, DoubleType | FloatType)}
        # Grouping takes -0.0 and 0.0 as one key.
        hashed = [F.col(k) + F.lit(0.0) if k in floats else F.col(k) for k in self.keys]
        bucket = F.pmod(F.xxhash64(*hashed), F.lit(buckets)).cast("int")
        frame = frame.withColumn("bucket", bucket).repartition("bucket")
        if not self._values:
            return frame.dropDuplicates(["bucket", *self.keys])
        first = [self.newest] if self.newest else []
        greatest = F.max(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(first)], *self._values))
        return self._unpacked(frame.groupBy("bucket", *self.keys).agg(greatest.alias("newest")))

    def _unpacked(self, frame: DataFrame) -> DataFrame:
        values = [F.col(f"newest.{v}").alias(v) for v in self._values]
        return frame.select("bucket", *self.keys, *values).select("bucket", *self.schema.names)

    def _folder(self, generation: int, part: str, epoch: int | None = None) -> str:
        folder = f"{self.path}/{part}/generation={generation}"
        return folder if epoch is None else f"{folder}/epoch={epoch}"

    def _write(self, frame: DataFrame, generation: int, part: str, epoch: int, *by: str) -> None:
        frame.write.mode("overwrite").partitionBy(*by).parquet(self._folder(generation, part, epoch))

    def _commit(
        self,
        spark: SparkSession,
        generation: int,
        epoch: int,
        base: int,
        mode: str,
        folds: tuple[int, ...] = (),
        stale: tuple[str, ...] = (),
    ) -> None:
        state = _State(generation, epoch, base, mode, self._query(spark), folds, stale)
        record = spark.range(0, 1, 1, 1).select(
            F.lit(base).cast("bigint").alias("base"),
            F.lit(mode).alias("mode"),
            F.lit(state.query).alias("query"),
            F.split(F.lit(",".join(map(str, folds))), ",").alias("folds")
            if folds
            else F.array().cast("array<string>").alias("folds"),
            F.array(*map(F.lit, stale)).cast("array<string>").alias("stale"),
        )
        record = record.withColumn("folds", F.col("folds").cast("array<bigint>"))
        self._write(record, generation, "commits", epoch)
        began = self._committed is None or self._committed.generation != generation
        self._committed = state
        self._forget(spark, generation, "commits", epoch - _COMMITS_KEPT)
        if began and generation >= 2:
            for part in _PARTS:
                remove_folder(spark, self._folder(generation - 2, part))

    def _forget(self, spark: SparkSession, generation: int, part: str, epoch: int) -> None:
        if epoch >= 0:
            remove_folder(spark, self._folder(generation, part, epoch))

    def _forget_folded(self, spark: SparkSession, last: _State) -> None:
        for old in range(last.base - self.fold_every + 1, last.base + 1):
            self._forget(spark, last.generation, "data", old)

    @staticmethod
    def _query(spark: SparkSession) -> str:
        return spark.sparkContext.getLocalProperty(_QUERY_ID) or ""

    def _before(self, spark: SparkSession, epoch: int) -> _State:
        """What the epoch builds on; an empty state in a new generation for another query."""
        last, query = self._committed or self._state(spark), self._query(spark)
        if last.generation < 0 or last.query != query:
            return _State(generation=last.generation + 1)
        if last.epoch < epoch:
            return last
        return self._state(spark, last.generation, epoch)

    # -- reading ----------------------------------------------------------------

    def read(self, spark: SparkSession) -> DataFrame:
        """The committed content; without a row order, unless the table is ``ordered``."""
        state = self._state(spark)
        if state.epoch < 0:
            return spark.createDataFrame([], self.schema)
        if state.mode == "upsert":
            return self._latest(spark, state)
        if state.mode == "replace" and self.ordered:
            return self._in_order(spark, self._folder(state.generation, "data", state.epoch))
        return self._appended(spark, state).select(*self.schema.names)

    def read_with_epoch(self, spark: SparkSession) -> DataFrame:
        """Appended content with the ``epoch`` each row came in."""
        state = self._state(spark)
        if state.epoch < 0:
            return spark.createDataFrame([], self._with_epoch())
        return self._appended(spark, state)

    def _state(
        self, spark: SparkSession, generation: int | None = None, before: int | None = None
    ) -> _State:
        """The last commit, or the last one before an epoch of a generation."""
        nothing = _State() if generation is None else _State(generation)
        try:
            commits = spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return nothing
            raise
        if generation is not None:
            commits = commits.where((F.col("generation") == generation) & (F.col("epoch") < before))
        last = commits.agg(F.max(F.struct(*_State._fields)).alias("last")).first().last
        if last is None:
            return nothing
        return _State(*last)._replace(folds=tuple(last.folds or ()), stale=tuple(last.stale or ()))

    def _with_epoch(self) -> StructType:
        return StructType([*self.schema.fields, StructField("epoch", LongType())])

    def _epochs(
        self, spark: SparkSession, generation: int, part: str, first: int, last: int
    ) -> DataFrame:
        frame = spark.read.schema(self._with_epoch()).parquet(self._folder(generation, part))
        return frame.where(F.col("epoch").between(first, last))

    def _appended(self, spark: SparkSession, state: _State) -> DataFrame:
        if state.mode == "replace":
            return self._epochs(spark, state.generation, "data", state.epoch, state.epoch)
        rows = []
        if state.base >= 0:
            schema = StructType([*self.schema.fields, StructField("_came_in", LongType()),
                                 StructField("epoch", LongType())])
            packs = spark.read.schema(schema).parquet(self._folder(state.generation, "pack"))
            packs = packs.where(F.col("epoch") <= state.base).drop("epoch")
            rows.append(packs.withColumnRenamed("_came_in", "epoch"))
        if state.base < state.epoch:
            rows.append(self._epochs(spark, state.generation, "data", state.base + 1, state.epoch))
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])

    def _in_order(self, spark: SparkSession, folder: str) -> DataFrame:
        """Files in the order of the tasks that wrote them. A scan of several files would take the
        largest first, so each has a scan of its own."""
        out = None
        for name in sorted(file_names(spark, folder), key=_file_place):
            rows = spark.read.schema(self.schema).parquet(f"{folder}/{name}")
            out = rows if out is None else out.union(rows)
        return spark.createDataFrame([], self.schema) if out is None else out

    def _bucketed(self, spark: SparkSession, generation: int, part: str) -> DataFrame:
        schema = StructType([*self._with_epoch().fields, StructField("bucket", IntegerType())])
        return spark.read.schema(schema).parquet(self._folder(generation, part))

    def _changes(self, spark: SparkSession, state: _State) -> DataFrame:
        """Rows that came in after the last fold."""
        rows = self._bucketed(spark, state.generation, "data")
        return rows.where(F.col("epoch").between(state.base + 1, state.epoch))

    @staticmethod
    def _buckets_in(frame: DataFrame) -> list[int]:
        return sorted(r.bucket for r in frame.select("bucket").distinct().collect())

    def _folded(self, spark: SparkSession, state: _State, buckets: list[int]) -> DataFrame | None:
        """Folded rows of some buckets; only their folders are read."""
        by_epoch: dict[int, list[int]] = {}
        for b in buckets:
            if state.folds[b] >= 0:
                by_epoch.setdefault(state.folds[b], []).append(b)
        if not by_epoch:
            return None
        chosen = F.lit(False)
        for epoch, own in by_epoch.items():
            chosen = chosen | ((F.col("epoch") == epoch) & F.col("bucket").isin(own))
        return self._bucketed(spark, state.generation, "fold").where(chosen)

    def _merged(self, changes: DataFrame, folded: DataFrame | None) -> DataFrame:
        """The newest row of each key."""
        rows = changes if folded is None else changes.unionByName(folded)
        rows = rows.repartition("bucket")
        if not self._values:
            return rows.select("bucket", *self.keys).distinct()
        newest = F.max_by(F.struct(*self._values), "epoch").alias("newest")
        return self._unpacked(rows.groupBy("bucket", *self.keys).agg(newest))

    def _latest(self, spark: SparkSession, state: _State) -> DataFrame:
        names = self.schema.names
        buckets = list(range(len(state.folds)))
        if state.base == state.epoch:
            rows = self._folded(spark, state, buckets)
            return spark.createDataFrame([], self.schema) if rows is None else rows.select(*names)
        changes = self._changes(spark, state)
        # A single version holds each key once and is read as it is.
        if state.base < 0 and state.epoch == 0:
            return changes.select(*names)
        changed = self._buckets_in(changes)
        merged = self._merged(changes, self._folded(spark, state, changed)).select(*names)
        rest = self._folded(spark, state, [b for b in buckets if b not in changed])
        return merged if rest is None else merged.unionByName(rest.select(*names))


def _file_place(name: str) -> tuple[int, int]:
    found = _FILE_NAME.match(name)
    return int(found[1]), int(found[2] or 0)
