"""Line dedup by winnowing over line hashes.

A text is its sequence of lines; blank lines (only spaces) take no part and are never
deleted. The window starting at a line is the shortest run of lines from it that holds
``WINDOW_WORDS`` words. Of each window the line with the least hash is selected, and the window's
hash is its fingerprint: two texts that share a run of lines with that many words share a window
in it, hence a selected line and its fingerprint. Fingerprints are joined with their first place
(least doc_id, then line), matches are extended from the selected lines both ways, line by line, and
the later run is deleted if it holds ``WINDOW_WORDS`` words. A line goes only where an equal one
comes earlier, so every line stays somewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, free_name, slices, table
from tidewell.scratch import written

WINDOW_WORDS = 5
SPACES = " \t\n\r\x0b\x0c"


def line_hashes(text: str) -> tuple[list[int], list[int], list[int]]:
    """Line numbers, signed hashes and word counts of the lines that are not blank."""
    at, hashes, words = [], [], []
    for i, line in enumerate(text.split("\n")):
        line = line.strip(SPACES)
        if line:
            h = xxhash.xxh64_intdigest(line)
            at.append(i), hashes.append(h - (1 << 64) if h >> 63 else h), words.append(len(line.split()))
    return at, hashes, words


def windows(hashes: list[int], words: list[int], window: int = WINDOW_WORDS) -> list[tuple[int, int, int]]:
    """(start, end, place of the least hash) of every window, the last place of equal ones."""
    out: list[tuple[int, int, int]] = []
    end, held, head = 0, 0, 0
    queue: list[int] = []  # places with rising hashes, the first from ``head`` is the minimum
    for start in range(len(hashes)):
        while end < len(hashes) and held < window:
            while len(queue) > head and hashes[queue[-1]] >= hashes[end]:
                queue.pop()
            queue.append(end)
            held += words[end]
            end += 1
        if held < window:
            break
        out.append((start, end, queue[head]))
        held -= words[start]
        if queue[head] == start:
            head += 1
    return out


def fingerprints(hashes: list[int], words: list[int]) -> list[tuple[int, int]]:
    """(selected place, signed hash of its window and where it lies in it) of every window."""
    data = np.array(hashes, np.int64).tobytes()
    out = []
    for start, end, place in windows(hashes, words):
        h = xxhash.xxh64_intdigest(data[8 * start : 8 * end], seed=place - start)
        out.append((place, h - (1 << 64) if h >> 63 else h))
    return out


def _sequences(batches):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("at", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64())),
         ("words", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())), ("prints", pa.list_(pa.int64()))]
    )
    for batch in slices(batches):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at, hashes, words = line_hashes(text or "")
            marks = fingerprints(hashes, words)
            rows.append((doc_id, at, hashes, words, [p for p, _ in marks], [h for _, h in marks]))
        yield arrow_batch(list(zip(*rows, strict=True)), schema)


def extended(
    later: np.ndarray, earlier: np.ndarray, words: np.ndarray, anchors: list[tuple[int, int]], least: int = WINDOW_WORDS
) -> set[int]:
    """Places of the later text in the runs around the anchors (place, earlier place) that hold
    ``least`` words.

    Both may be one text: the places keep their distance, so a run lies after what it repeats.
    """
    out: set[int] = set()
    reached: dict[int, int] = {}  # end of the last run, by distance
    for place, first in sorted(anchors):
        shift = place - first
        if place < reached.get(shift, 0):
            continue
        a, b = place, place + 1
        while a > 0 and a - 1 - shift >= 0 and later[a - 1] == earlier[a - 1 - shift]:
            a -= 1
        while b < len(later) and b - shift < len(earlier) and later[b] == earlier[b - shift]:
            b += 1
        reached[shift] = b
        if words[a:b].sum() >= least:
            out.update(range(a, b))
    return out


def _extend(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("gone", pa.list_(pa.int32()))])
    for batch in slices(batches):
        ids, gone = [], []
        for row in batch.to_pylist():
            later = np.asarray(row["hashes"])
            earlier = later if row["doc_id"] == row["first_id"] else np.asarray(row["first_hashes"])
            anchors = [(x["place"], x["first_place"]) for x in row["anchors"]]
            found = extended(later, earlier, np.asarray(row["words"]), anchors)
            ids.append(row["doc_id"]), gone.append([row["at"][i] for i in sorted(found)])
        yield arrow_batch([ids, gone], schema)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, gone): numbers of the lines (from 0) that repeat an earlier run.

    One row per document that loses lines. Null ids and null texts lose none. Rows with the
    same id count as one text: the greatest. Texts of any length are read whole; time and memory
    grow with their lines. Other columns are not read.
    """
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    fields = ["hashes", "at", "words", "places", "prints"]
    sequences = written(
        narrow.where("doc_id is not null and text is not null").mapInArrow(
            _sequences,
            "doc_id long, at array<int>, hashes array<long>, words array<int>, places array<int>, prints array<long>",
        ),
        "line-sequences",
    )
    # Text order of equal ids is lost here; their line sequences are compared instead.
    sequences = sequences.groupBy("doc_id").agg(F.max(F.struct(*fields)).alias("s")).select("doc_id", "s.*")
    sequences = written(sequences, "line-texts")
    # Windows of all texts take part, so the first place is the first in the whole table.
    marks = sequences.select("doc_id", F.inline(F.arrays_zip("places", "prints"))).withColumnsRenamed(
        {"places": "place", "prints": "print"}
    )
    repeats = written(
        marks.groupBy("print")
        .agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("print", F.col("first.doc_id").alias("first_id"), F.col("first.place").alias("first_place")),
        "line-first-places",
    )
    met = written(
        marks.join(repeats, "print")
        .where("doc_id != first_id or place != first_place")
        .select("doc_id", "place", "first_id", "first_place"),
        "line-anchors",
    )
    anchors = met.groupBy("doc_id", "first_id").agg(
        F.collect_set(F.struct("place", "first_place")).alias("anchors")
    )
    own = written(anchors.join(sequences.drop("places", "prints"), "doc_id"), "line-own")
    first = sequences.select(F.col("doc_id").alias("first_id"), F.col("hashes").alias("first_hashes"))
    runs = own.join(first, "first_id").mapInArrow(_extend, "doc_id long, gone array<int>").where(F.size("gone") > 0)
    return runs.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def without_lines(docs: DataFrame, gone: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` (doc_id, text, any other columns) with the shortened text, and the name of a further
    column that no other has: the numbers of the lines that went, null where none did."""
    key, lost = free_name("gone_id", docs.columns), free_name("gone", docs.columns)
    gone = gone.select(F.col("doc_id").alias(key), F.col("gone").alias(lost))
    lines = F.split("text", "\n", -1)
    rest = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(lost, i)), "\n")
    # Shuffled at every size: whether the deletions fit a broadcast depends on the data.
    joined = docs.join(gone.hint("merge"), docs["doc_id"] == gone[key], "left").drop(key)
    loses = F.col(lost).isNotNull() & F.col("text").isNotNull()
    return joined.withColumns(
        {"text": F.when(loses, rest).otherwise(F.col("text")), lost: F.when(loses, F.col(lost))}
    ), lost


def op7_lines(spark, folder):
    """(doc_id, n_gone, gone, text): every document, its deleted lines and what is left."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    gone = written(repeated_lines(docs), "line-gone")
    kept, lost = without_lines(docs, gone)
    return kept.select(
        "doc_id",
        F.coalesce(F.array_size(lost), F.lit(0)).cast("long").alias("n_gone"),
        F.coalesce(F.array_join(F.col(lost).cast("array<string>"), ","), F.lit("")).alias("gone"),
        "text",
    )


def deduplicated(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: texts without later repeats of lines; a text left blank by it goes.

    The columns of ``docs`` stay as they are, whatever their names; ``n_chars`` follows the text.
    """
    gone = written(repeated_lines(docs), "line-gone")
    kept, lost = without_lines(docs, gone)
    blank = F.regexp_replace("text", r"[ \t\n\r\x0B\f]+", "") == ""
    kept = kept.where(F.col(lost).isNull() | ~blank)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col(lost).isNotNull(), length).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)
