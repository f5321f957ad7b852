"""Ranked lexical search over posting lists cut into geometric blocks.

Every document is a vector of term contributions. Documents are dealt by similarity (the
nearest of a few pivots, by 64-bit sign sketches) into shards of about ``SHARD_DOCS``; inside a
shard the posting list of each term is clustered by the similarity of its documents and cut
into blocks of at most ``BLOCK_DOCS``. A block keeps its documents and a summary: for each
coordinate the largest contribution among them. A query times a summary bounds every score in the
block, in exact integers, so a block (and a list, and a shard) is skipped only if its bound is
below the k-th best score known. A first pass over the index scores one promising block of a
few lists in each shard and so finds that threshold; the second pass scores what may reach it.
Results equal those of scoring every document.

One row of the index is one shard, so an index of any size is searched without a shuffle but
for the best ``k`` of each shard. Dealing follows quantiles of (pivot, sketch, hash), so many
equal documents fill several shards instead of one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, slices, table
from tidewell.scratch import scratch_dir, written

SHARD_DOCS = 1024
#: A shard also ends after its vectors hold so many coordinates.
SHARD_ENTRIES = 1 << 17
#: Shards in a row group of the index.
SHARDS_AT_ONCE = 2
BLOCK_DOCS = 128
#: Blocks of so many documents have no summary and are always scored.
FEW_DOCS = 16
#: Documents whose sketches serve as pivots, a bounded sample chosen by hash.
PIVOTS = 64
#: Characters of queries searched for at one time; more take further passes.
QUERY_CHARS = 1 << 20
#: Lists of each shard in which the first pass scores the best block.
FIRST_LISTS = 2
BEST = 20

# Letters, digits and everything beyond ASCII, whose UTF-8 bytes are 128 and above; A-Z to a-z.
_LOWERED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes | str | None) -> list[bytes]:
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_LOWERED).split(b" ")


def counted(text: bytes | str | None) -> Counter:
    found = Counter(terms_of(text))
    found.pop(b"", None)
    return found


class Index(NamedTuple):
    """``rows``: one per shard. ``n_docs`` documents with a term hold ``n_terms`` terms."""

    rows: DataFrame
    n_docs: int
    n_terms: int


# -- building -------------------------------------------------------------------------------

VECTOR = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())),
     ("tfs", pa.list_(pa.int64())), ("sketch", pa.int64())]
)
VECTOR_DDL = "doc_id long, n long, terms array<string>, tfs array<long>, sketch long"


def _signs(terms: list[bytes]) -> np.ndarray:
    """A row of 64 signs for each term, from its hash."""
    digests = np.frombuffer(b"".join([xxhash.xxh64_digest(t) for t in terms]), np.uint8)
    return np.unpackbits(digests.reshape(-1, 8), axis=1).astype(np.int8) * 2 - 1


def _sketch(terms: list[bytes], tfs: list[int]) -> int:
    if not terms:
        return 0
    sums = np.log1p(np.array(tfs, float)) @ _signs(terms)
    return int(np.packbits(sums > 0).view(">i8")[0])


def _vectors(wanted: frozenset[bytes] | None):
    def run(batches):
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = counted(text)
                n = found.total()
                if wanted is not None:
                    found = {t: c for t, c in found.items() if t in wanted}
                terms, tfs = list(found), list(found.values())
                rows.append((doc_id, n, [t.decode() for t in terms], tfs, _sketch(terms, tfs)))
            yield arrow_batch(list(zip(*rows, strict=True)), VECTOR)

    return run


INTS, LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
SHARD = pa.schema(
    [("doc_ids", LONGS), ("terms", pa.list_(pa.string())), ("list_len", INTS), ("row_ptr", INTS), ("cols", INTS),
     ("vals", INTS), ("list_ptr", INTS), ("block_ptr", INTS), ("block_docs", INTS), ("sum_ptr", INTS),
     ("sum_cols", INTS), ("sum_vals", INTS)]
)
#: A row of the index: the terms, the lengths of their lists, and the shard as a compressed Arrow stream.
ROW = pa.schema([("terms", pa.list_(pa.string())), ("list_len", INTS), ("shard", pa.binary())])
ROW_DDL = "terms array<string>, list_len array<int>, shard binary"


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def _clustered(docs: np.ndarray, sketches: np.ndarray) -> list[np.ndarray]:
    """The documents of a list in blocks of similar ones, at most ``BLOCK_DOCS`` each."""
    k = -(-len(docs) // BLOCK_DOCS)
    if k == 1:
        return [docs]
    own = sketches[docs]
    nearest = np.argmax(own @ own[:: len(docs) // k][:k].T, axis=1)
    blocks = []
    for cluster in range(k):
        members = docs[nearest == cluster]
        blocks += [members[i : i + BLOCK_DOCS] for i in range(0, len(members), BLOCK_DOCS)]
    return blocks


def packed(docs: pa.Table, n_docs: int, n_terms: int) -> tuple:
    """A shard of rows of ``VECTOR``: vectors, blocks and summaries as flat arrays."""
    docs = docs.combine_chunks()
    terms = docs.column("terms").combine_chunks()
    coded = terms.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
    row_ptr = _starts(lengths)
    cols = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tfs = docs.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    m = 75 + 25 * docs.column("n").to_numpy() * n_docs // n_terms
    vals = 1_000_000_000 * tfs // (1000 * tfs + 12 * np.repeat(m, lengths))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    # Unit vectors of signed sums, for clustering only.
    sketches = np.zeros((len(lengths), 64), np.float32)
    if words:
        signs = _signs([t.encode() for t in words]).astype(np.float32)
        for start in range(0, len(lengths), 32):
            stop = min(start + 32, len(lengths))
            a, b = row_ptr[start], row_ptr[stop]
            busy = lengths[start:stop] > 0
            sums = np.add.reduceat(signs[cols[a:b]] * vals[a:b, None].astype(np.float32), row_ptr[start:stop][busy] - a, axis=0)
            sketches[start:stop][busy] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    by_term = np.argsort(cols, kind="stable")
    list_len = np.bincount(cols, minlength=len(words))
    lists = np.split(rows[by_term], np.cumsum(list_len)[:-1]) if words else []
    list_ptr, blocks, summaries, most = [0], [], [], np.zeros(len(words), np.int64)
    for docs_of_term in lists:
        for block in _clustered(docs_of_term, sketches):
            blocks.append(block)
            # A few documents are scored as quickly as bounded.
            few = len(block) <= FEW_DOCS
            summaries.append((cols[:0], vals[:0]) if few else _summary(block, row_ptr, cols, vals, most))
        list_ptr.append(len(blocks))
    none = [np.zeros(0, np.int32)]
    return (
        docs.column("doc_id").combine_chunks(), words, list_len, row_ptr, cols, vals, list_ptr,
        _starts([len(b) for b in blocks]), np.concatenate(blocks or none),
        _starts([len(s[0]) for s in summaries]),
        np.concatenate([s[0] for s in summaries] or none), np.concatenate([s[1] for s in summaries] or none),
    )


def _entries(docs: np.ndarray, row_ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the coordinates of documents, and where each document starts among them."""
    lengths = row_ptr[docs + 1] - row_ptr[docs]
    starts = _starts(lengths)
    return np.repeat(row_ptr[docs] - starts[:-1], lengths) + np.arange(starts[-1]), starts[:-1]


def _summary(docs: np.ndarray, row_ptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, most: np.ndarray):
    """The largest value of each coordinate among the documents; ``most`` is a zeroed buffer."""
    at, _ = _entries(docs, row_ptr)
    np.maximum.at(most, cols[at], vals[at])
    own = np.flatnonzero(most) if len(at) > len(most) // 8 else np.unique(cols[at])
    values = most[own]
    most[own] = 0
    return own.astype(np.int32), values.astype(np.int32)


def _shards(n_docs: int, n_terms: int):
    def pack(held):
        return shard_batch(packed(pa.Table.from_batches(held), n_docs, n_terms))

    def run(batches):
        held, docs, entries = [], 0, 0
        for batch in slices(batches, SHARD_DOCS // 16):
            held.append(batch)
            docs += batch.num_rows
            entries += len(batch.column("terms").flatten())
            if docs >= SHARD_DOCS or entries >= SHARD_ENTRIES:
                yield pack(held)
                held, docs, entries = [], 0, 0
        if held:
            yield pack(held)

    return run


def shard_batch(shard: tuple) -> pa.RecordBatch:
    """A row of the index."""
    columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, type=f.type.value_type))
               for x, f in zip(shard, SHARD, strict=True)]
    stream = pa.BufferOutputStream()
    with pa.ipc.new_stream(stream, SHARD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=SHARD))
    named = dict(zip(SHARD.names, columns, strict=True))
    packed_ = pa.array([stream.getvalue().to_pybytes()], pa.binary())
    return pa.RecordBatch.from_arrays([named["terms"], named["list_len"], packed_], schema=ROW)


def build_index(
    docs: DataFrame, wanted: Iterable[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> Index:
    """Index every document. With ``wanted`` only these terms become coordinates, which is all
    that queries made of them can use; lengths and counts still cover every term.

    Documents without a term count for nothing and are never found (null and empty texts, too).
    Texts are read whole. Rows with the same or no id are documents of their own. The table is
    read once; what is shuffled are the vectors, about their coordinates.
    """
    spark = docs.sparkSession
    wanted = None if wanted is None else frozenset(wanted)
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    vectors = written(narrow.mapInArrow(_vectors(wanted), VECTOR_DDL).where("n > 0"), "ranking-vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return Index(spark.createDataFrame([], ROW_DDL), 0, 0)
    filled = vectors.where(F.size("terms") > 0)
    chosen = filled.select("sketch", F.xxhash64("sketch").alias("h")).distinct().orderBy("h").limit(PIVOTS)
    pivots = [r.sketch for r in chosen.collect()]
    near = [F.struct(F.bit_count(F.col("sketch").bitwiseXOR(F.lit(p))).alias("far"), F.lit(i).alias("pivot"))
            for i, p in enumerate(pivots)]
    if not near:
        return Index(spark.createDataFrame([], ROW_DDL), n_docs, n_terms)
    place = F.least(*near) if len(near) > 1 else near[0]
    keyed = filled.select(
        "doc_id", "n", "terms", "tfs", place["pivot"].alias("pivot"), "sketch", F.xxhash64("doc_id", "n").alias("h")
    )
    keys = ["pivot", "sketch", "h"]
    dealt = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
    # A reader takes a row group of a file at one time, and a row is a whole shard.
    path = scratch_dir(spark, "ranking-index")
    shards = dealt.mapInArrow(_shards(n_docs, n_terms), ROW_DDL)
    shards.write.option("parquet.block.row.count.limit", SHARDS_AT_ONCE).parquet(path)
    return Index(spark.read.schema(ROW_DDL).parquet(path), n_docs, n_terms)


# -- searching ------------------------------------------------------------------------------


class Shard:
    """One row of the index."""

    def __init__(self, packed_: bytes):
        batch, at, flat = pa.ipc.open_stream(packed_).read_next_batch(), 0, {}
        for i, field in enumerate(SHARD):
            values = batch.column(i)[at].values
            if field.name not in ("doc_ids", "terms"):
                flat[field.name] = values.to_numpy()
        self.__dict__ |= flat
        self.doc_ids = batch.column(0)[at].values
        self.number = {t: i for i, t in enumerate(batch.column(1)[at].values.to_pylist())}
        self.most = np.zeros(len(self.number), np.int64)
        np.maximum.at(self.most, self.cols, self.vals.astype(np.int64))

    def blocks_of(self, term: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the blocks of a list and the bounds of their scores."""
        numbers = np.arange(self.list_ptr[term], self.list_ptr[term + 1])
        starts, ends = self.sum_ptr[numbers], self.sum_ptr[numbers + 1]
        bounds = np.full(len(numbers), np.iinfo(np.int64).max)
        full = starts < ends
        if full.any():
            a, b = starts[0], ends[-1]
            products = weights[self.sum_cols[a:b]] * self.sum_vals[a:b]
            bounds[full] = np.add.reduceat(products, starts[full] - a)
        return numbers, bounds

    def docs_in(self, blocks: np.ndarray) -> np.ndarray:
        parts = [self.block_docs[self.block_ptr[b] : self.block_ptr[b + 1]] for b in blocks]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at, starts = _entries(docs, self.row_ptr)
        return np.add.reduceat(weights[self.cols[at]] * self.vals[at], starts)

    def query(self, weighed: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of all terms; the query's terms here, the largest possible share first; the shares."""
        here = np.array([self.number[t] for t in weighed if t in self.number], np.int64)
        weights = np.zeros(len(self.number), np.int64)
        weights[here] = [w for t, w in weighed.items() if t in self.number]
        shares = weights[here] * self.most[here]
        order = np.argsort(-shares, kind="stable")
        return weights, here[order], shares[order]

    def first(self, weighed: dict[str, int], k: int) -> np.ndarray:
        """The best scores in the most promising block of the lists that may count most."""
        weights, here, shares = self.query(weighed)
        chosen = []
        for term in here[shares > 0][:FIRST_LISTS]:
            numbers, bounds = self.blocks_of(term, weights)
            chosen.append(numbers[np.argmax(bounds)])
        docs = self.docs_in(chosen)
        return np.sort(self.scores(docs, weights))[::-1][:k] if len(docs) else docs

    def best(self, weighed: dict[str, int], k: int, least: int) -> list[tuple[int | None, int]]:
        """(doc_id, score) of the best ``k`` with ``least`` or more; skips what cannot reach it."""
        weights, here, shares = self.query(weighed)
        # What only the lists from here on hold scores less than asked for.
        rest = np.cumsum(shares[::-1])[::-1]
        chosen = []
        for term in here[(rest >= least) & (rest > 0)]:
            numbers, bounds = self.blocks_of(term, weights)
            chosen.append(numbers[bounds >= least])
        docs = self.docs_in(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)
        if not len(docs):
            return []
        scores = self.scores(docs, weights)
        if len(scores) > k:
            least = max(least, np.partition(scores, -k)[-k])
        keep = scores >= max(least, 1)
        ids = self.doc_ids.take(pa.array(docs[keep])).to_pylist()
        found = sorted(zip(ids, scores[keep].tolist(), strict=True), key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        return found[:k]


def _first(queries: list[tuple[int, dict[str, int]]], k: int):
    schema = pa.schema([("query", pa.int32()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for packed_ in batch.column("shard"):
                shard = Shard(packed_.as_py())
                rows = [(q, s) for q, weighed in queries for s in shard.first(weighed, k).tolist()]
                if rows:
                    yield arrow_batch(list(zip(*rows, strict=True)), schema)

    return run


def _best(queries: list[tuple[int, dict[str, int]]], k: int, least: dict[int, int]):
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for packed_ in batch.column("shard"):
                shard = Shard(packed_.as_py())
                rows = [(q, *hit) for q, weighed in queries for hit in shard.best(weighed, k, least.get(q, 0))]
                if rows:
                    yield arrow_batch(list(zip(*rows, strict=True)), schema)

    return run


def _weights(index: Index, terms: set[str]) -> dict[str, int]:
    """Weight of each query term, from the lengths of its lists."""
    spark = index.rows.sparkSession
    asked = spark.createDataFrame([(t,) for t in terms], "term string")
    lists = index.rows.select(F.inline(F.arrays_zip("terms", "list_len")))
    lengths = lists.join(F.broadcast(asked), lists["terms"] == asked["term"], "left_semi")
    df = {r[0]: r[1] for r in lengths.groupBy("terms").agg(F.sum("list_len")).collect()}
    n = index.n_docs
    return {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}


def search(index: Index, queries: list[str | None], k: int = BEST) -> DataFrame:
    """(query, rank, doc_id, score): the best ``k`` documents of each query, a list position.

    Equal scores rank by ascending doc_id, null last. The queries are held by every task: pass
    bounded blocks of them, as ``ranked`` does.
    """
    spark = index.rows.sparkSession
    counts = [{t.decode(): c for t, c in counted(q).items()} for q in queries]
    terms = {t for c in counts for t in c}
    weights = _weights(index, terms) if terms and index.n_docs else {}
    asked = [(q, {t: c * weights[t] for t, c in terms.items() if t in weights}) for q, terms in enumerate(counts)]
    asked = [(q, weighed) for q, weighed in asked if weighed]
    if not asked:
        return spark.createDataFrame([], "query int, rank int, doc_id long, score long")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    first = index.rows.select("shard").mapInArrow(_first(asked, k), "query int, score long")
    kth = first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).groupBy("query")
    least = {r.query: r.score for r in kth.agg(F.min("score").alias("score"), F.count("*").alias("n")).collect() if r.n == k}
    found = index.rows.select("shard").mapInArrow(_best(asked, k, least), "query int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked_ = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked_.select("query", "rank", "doc_id", "score")


def _query_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of about ``QUERY_CHARS``; the driver holds one block at a time."""
    held, chars = [], 0
    for row in items.toLocalIterator():
        held.append((row.item_id, row.text))
        chars += len(row.text)
        if chars >= QUERY_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``k`` documents for the text of each item.

    Each block of items has an index of its terms only and a pass over ``docs``. Items without
    text or without a term that occurs have no rows. Repeated items count once; different texts
    of one item_id are ranked apart. Equal scores rank by ascending doc_id, null last.
    """
    spark = docs.sparkSession
    items = items.select(
        items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text")
    ).where("text is not null")
    out = None
    for block in _query_blocks(items.distinct().orderBy("item_id", "text")):
        index = build_index(docs, {t for _, text in block for t in terms_of(text)} - {b""})
        keys = spark.createDataFrame([(q, item_id) for q, (item_id, _) in enumerate(block)], "query int, item_id long")
        found = search(index, [text for _, text in block], k).join(F.broadcast(keys), "query")
        found = found.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op11_search(spark, folder):
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_TERMS_SQL = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL.format("text")} AS terms FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, s GROUP BY term, n_docs),
q AS (SELECT item_id, text, term, count(*) AS times
  FROM (SELECT DISTINCT item_id, text, unnest({_TERMS_SQL.format("text")}) AS term, generate_subscripts({_TERMS_SQL.format("text")}, 1)
        FROM benchmark) GROUP BY ALL),
scored AS (SELECT item_id, text, doc_id, r,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN df USING (term) JOIN tf USING (term), s GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM best WHERE rank <= {BEST}
"""
