"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased letter and digit runs (tokens). Shared windows of ``LEAST_TILE``
tokens are the seeds that bring a document and a benchmark item together. Tiles are then
marked, longest first: Karp-Rabin hashes of the still unmarked windows find all matches of
a length, the longest non-overlapping ones are marked in both texts, and the length falls
until no match of ``LEAST_TILE`` tokens is left. The share of an item's tokens under tiles
is its coverage, whatever the order of the passages.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ROWS_AT_ONCE, arrow_batch, slices, table

LEAST_TILE, LEAST_COVERAGE = 5, 0.8
#: Characters of benchmark text that travel to the tasks at once; a larger benchmark is
#: handled in blocks of items, each block against all documents.
BLOCK_CHARS = 1 << 20
TOKEN = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, item_id long, coverage double, n_tiles long, longest_tile long"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int64()),
     ("longest_tile", pa.int64())]
)
BASE, MOD = 1_000_003, (1 << 61) - 1


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def _windows(codes: list[int], free: list[bool], length: int):
    """(start, Karp-Rabin hash) of every window of ``length`` unmarked tokens."""
    top, value, run = pow(BASE, length, MOD), 0, 0
    for i, code in enumerate(codes):
        if not free[i]:
            value = run = 0
            continue
        value, run = (value * BASE + code) % MOD, run + 1
        if run > length:
            value = (value - codes[i - length] * top) % MOD
        if run >= length:
            yield i - length + 1, value


def tiles(item: list[int], doc: list[int], least: int = LEAST_TILE) -> list[tuple[int, int, int]]:
    """(place in item, place in document, length) of the tiles. Codes below 1 match nothing."""
    free_item, free_doc = [c > 0 for c in item], [c > 0 for c in doc]
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 32))
    while True:
        starts = defaultdict(list)
        for i, h in _windows(item, free_item, length):
            starts[h].append(i)
        found = []
        for j, h in _windows(doc, free_doc, length):
            for i in starts.get(h, ()):
                if i and j and free_item[i - 1] and free_doc[j - 1] and item[i - 1] == doc[j - 1]:
                    continue  # part of a match that starts earlier
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                    and free_item[i + n] and free_doc[j + n]
                ):
                    n += 1
                if n >= length:
                    found.append((-n, i, j))
        if not found and length == least:
            return out
        if not found:
            length = max(least, length // 2)
        # The longest match is always free; what a tile takes off another one is found again.
        for n, i, j in sorted(found):
            if all(free_item[i : i - n]) and all(free_doc[j : j - n]):
                free_item[i : i - n] = free_doc[j : j - n] = [False] * -n
                out.append((i, j, -n))


def _coded(items: list[tuple[int, str]], least: int):
    """Token codes of the items, their words, and the items by seed window."""
    words: dict[str, int] = {}
    coded, seeds = [], defaultdict(list)
    for item_id, text in items:
        codes = [words.setdefault(t, len(words) + 1) for t in tokens(text)]
        coded.append((item_id, codes))
        for window in {tuple(codes[i : i + least]) for i in range(len(codes) - least + 1)}:
            seeds[window].append(len(coded) - 1)
    return coded, words, dict(seeds)


def _near_seeds(codes: list[int], seeds: dict, least: int) -> dict[int, list[int]]:
    """For each item that shares a seed: the document's tokens under seeds of it, gaps as 0."""
    hits = defaultdict(set)
    run = 0
    for i, code in enumerate(codes):
        run = run + 1 if code else 0
        if run >= least:
            for item in seeds.get(tuple(codes[i - least + 1 : i + 1]), ()):
                hits[item].update(range(i - least + 1, i + 1))
    out = {}
    for item, places in hits.items():
        part, last = [], None
        for i in sorted(places):
            if last is not None and i != last + 1:
                part.append(0)
            part.append(codes[i])
            last = i
        out[item] = part
    return out


def _hits(text: str | None, block, least: int, least_coverage: float):
    """(item_id, coverage, tiles, longest tile) of the items of a block that a text holds."""
    coded, words, seeds = block
    codes = [words.get(t, 0) for t in tokens(text)]
    for at, part in _near_seeds(codes, seeds, least).items():
        item_id, item = coded[at]
        if len(part) < least_coverage * len(item):
            continue  # fewer tokens than the coverage takes
        found = tiles(item, part, least)
        share = sum(n for _, _, n in found) / len(item)
        if share >= least_coverage:
            yield item_id, share, len(found), max(n for _, _, n in found)


def _tile_block(shared, least: int, least_coverage: float):
    def run(batches):
        for batch in slices(batches):
            rows = [
                (doc_id, *hit)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for hit in _hits(text, shared.value, least, least_coverage)
            ]
            if rows:
                yield arrow_batch(list(zip(*rows, strict=True)), ARROW)

    return run


def _blocks(benchmark: DataFrame, least: int):
    """Broadcast blocks of the benchmark, each of about ``BLOCK_CHARS`` characters."""
    items = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text")
    ).where("text is not null")
    blocks = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield items.sparkSession.sparkContext.broadcast(_coded([tuple(r) for r in block.collect()], least))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least_tile: int = LEAST_TILE, least_coverage: float = LEAST_COVERAGE
) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest_tile) of documents holding an item.

    Items with fewer than ``least_tile`` tokens (null and empty ones too) are never found.
    Null texts hold nothing; a null id is reported as null; repeated rows are reported each.
    A document holding several items has a row for each. No shuffle: documents are read once
    for each block of items.
    """
    spark = docs.sparkSession
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    out = spark.createDataFrame([], SCHEMA)
    for k, shared in enumerate(_blocks(benchmark, least_tile)):
        found = narrow.mapInArrow(_tile_block(shared, least_tile, least_coverage), SCHEMA)
        out = found if not k else out.unionByName(found)
    return out


def op2_decontaminate(spark, folder):
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _holds_item(shared):
    """Column function: whether a text holds an item of the block."""

    @F.arrow_udf("boolean")
    def held(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = []
            for start in range(0, len(column), ROWS_AT_ONCE):
                few = column.slice(start, ROWS_AT_ONCE).to_pylist()
                found += [next(_hits(t, shared.value, LEAST_TILE, LEAST_COVERAGE), None) is not None for t in few]
            yield pa.array(found, pa.bool_())

    return held


def clean(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the rows that hold no benchmark item, each judged by its own text.

    Only texts go to Python and only answers come back; nothing is shuffled. Null texts hold
    nothing and stay; the columns of ``docs`` stay as they are, whatever their names.
    """
    for shared in _blocks(table(spark, folder, "benchmark"), LEAST_TILE):
        docs = docs.where(~_holds_item(shared)(docs["text"]))
    return docs
