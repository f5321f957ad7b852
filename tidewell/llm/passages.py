"""Substring dedup by compact windows.

A text is the sequence of its shingles of five words. For a hash function, the Cartesian
tree over the shingles' hashes splits it into compact windows: all passages inside [l, r]
that hold place c have the hash at c as their minimum. Only windows of at least
``LEAST_SHINGLES`` are kept, about two for each such length of text. Two passages with the
same signature in a hash function lie in windows with equal signature; windows are joined
by signature, pairs of texts that share a window in some hash function are candidates, and
their passages are verified on the words.

A group of equal signature is linked to its first window only. What that leaves uncovered
(windows whose shared shingle stands in unrelated surroundings) is grouped anew by signature
and surroundings: a passage of 46 shingles reaches 22 to one side of c at least, and the
least hash some way off on that side is the same in both texts.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, slices, table
from tidewell.scratch import remove_folder, scratch_dir, shuffles_removed, written

WORDS, LEAST_WORDS = 5, 50
LEAST_SHINGLES = LEAST_WORDS - WORDS + 1
#: Two passages agree in a hash function with a chance equal to their similarity, so at 0.8 they
#: agree in none of four functions with a chance of 0.2 ** 4. One is enough: each pair is verified.
FUNCTIONS, LEAST_SIMILARITY = 4, 0.8
#: One in so many shingles of a passage may be missing in the other text.
SHARE = round(1 / (1 - LEAST_SIMILARITY))
#: Windows of a group that all others are compared with in the first later round; twice as many
#: in each round after it, so that the rounds grow with the logarithm of the largest group.
PIVOTS = 8
#: Shingles without a partner that a passage may run across: two edits close together.
GAP = 2 * WORDS
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
#: Places from c whose least hash stands for the surroundings of one side.
NEAR, FAR = WORDS + 1, (LEAST_SHINGLES - 1) // 2
WINDOWS = "signature long, function int, doc_id long, c int, left int, right int"
WINDOWS_ARROW = pa.schema(
    [("signature", pa.int64()), ("function", pa.int32()), ("doc_id", pa.int64()), ("c", pa.int32()),
     ("left", pa.int32()), ("right", pa.int32())]
)
PACKED = "doc_id long, text binary, sketch binary, sample binary"
PACKED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.binary()), ("sketch", pa.binary()), ("sample", pa.binary())]
)
#: Of the later text of a pair, each place of so many is looked at before the texts are read.
STEP = 2
PAIRS = "doc_id long, first_id long, anchors array<struct<c:int,first_c:int>>"


def ordered(hashes: np.ndarray, function: int) -> np.ndarray:
    """The hashes under one of the hash functions (a bijection, so equal means equal)."""
    x = hashes + np.uint64(int(MULTIPLIER) * (function + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A number for each byte value, spread by the rule of ``ordered``.
BYTES = ordered(np.arange(256, dtype=np.uint64), 0)
#: Words hashed at once.
BLOCK = 1 << 12


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word: its bytes' numbers, weighed by powers for their places.

    The powers run on over a block of words; what a word's start adds to them is divided out again.
    """
    out, powers, inverses = [], *(np.full(1, x) for x in (MULTIPLIER, np.uint64(1)))
    for k in range(0, len(words), BLOCK):
        raw = np.frombuffer((" ".join(words[k : k + BLOCK]) + " ").encode(), np.uint8)
        if len(raw) > len(powers):
            powers, inverses = (np.cumprod(np.full(len(raw) * 9 // 8, x)) for x in (MULTIPLIER, INVERSE))
            inverses *= MULTIPLIER  # the first place has no power to divide out
        starts = np.append(0, np.flatnonzero(raw == 32)[:-1] + 1)
        numbers = BYTES[raw]
        numbers *= powers[: len(raw)]
        out.append(np.add.reduceat(numbers, starts) * inverses[starts])
    return np.concatenate(out)


def shingled(texts: Iterable[str | None]) -> list[np.ndarray]:
    """A 64-bit hash for each run of five lower-cased words, text by text."""
    split = [(text or "").lower().split() for text in texts]
    words = list(chain.from_iterable(split))
    if len(words) < WORDS:
        return [np.empty(0, np.uint64) for _ in split]
    words = word_hashes(words)
    out = words[: len(words) - WORDS + 1].copy()
    for k in range(1, WORDS):
        out ^= out >> np.uint64(29)
        out *= MULTIPLIER
        out += words[k : len(words) - WORDS + 1 + k]
    ends = accumulate(len(s) for s in split)
    return [out[end - len(s) : max(end - WORDS + 1, end - len(s))] for s, end in zip(split, ends, strict=True)]


def shingles(text: str | None) -> np.ndarray:
    return shingled([text])[0]


def least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by the place of the first."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out, have = np.minimum(out[:-step], out[step:]), have + step
    return out


def compact_windows(
    values: np.ndarray, starts: Sequence[int] = (0,), least: int = LEAST_SHINGLES
) -> list[tuple[int, int, int]]:
    """(c, l, r) of the Cartesian trees' nodes that span ``least`` values or more, r inclusive;
    one tree for each text, the texts begin at ``starts``.

    Equal minima of a range are one node, with c at the first: text that repeats itself
    gives no more windows than other text. The trees are grown on a stack over those places
    only that are the least of half a window to one side. What ends such a place's range
    is such a place itself, so the ranges are exact.
    """
    side = least // 2 + 1
    ahead = least_ahead(values, side)
    low = np.zeros(len(values), bool)
    low[: len(ahead)] |= values[: len(ahead)] == ahead
    low[len(values) - len(ahead) :] |= values[len(values) - len(ahead) :] == ahead
    places = np.flatnonzero(low)
    bounds = np.append(np.asarray(starts, np.int64), len(values))
    firsts = np.searchsorted(places, bounds).tolist()
    at, found, bounds = places.tolist(), values[places].tolist(), bounds.tolist()
    out = []
    for k in range(len(bounds) - 1):
        stack: list[list[int]] = []  # value, first place, left end, last place
        for i, value in zip(at[firsts[k] : firsts[k + 1]], found[firsts[k] : firsts[k + 1]], strict=True):
            while stack and stack[-1][0] > value:
                _, c, left, _ = stack.pop()
                if i - left >= least:
                    out.append((c, left, i - 1))
            if stack and stack[-1][0] == value:
                stack[-1][3] = i
            else:
                stack.append([value, i, stack[-1][3] + 1 if stack else bounds[k], i])
        end = bounds[k + 1]
        out += [(c, left, end - 1) for _, c, left, _ in stack if end - left >= least]
    return out


def surroundings(marks: np.ndarray, at: np.ndarray, whole: np.ndarray) -> pa.Array:
    """A 32-bit signature of the range that starts at each place; null where the text ends."""
    if not len(marks):
        return pa.nulls(len(at), pa.int32())
    least = marks[np.minimum(np.maximum(at, 0), len(marks) - 1)]
    return pa.array((least >> np.uint64(33)).astype(np.int32), mask=~whole)


def _windows(batches):
    for batch in slices(batches):
        ids, texts = [], []
        both = batch.column(0).to_pylist(), shingled(batch.column(1).to_pylist())
        for doc_id, hashes in zip(*both, strict=True):
            if len(hashes) >= LEAST_SHINGLES:
                ids.append(doc_id), texts.append(hashes)
        if not ids:
            continue
        hashes = np.concatenate(texts)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        marks, ids = least_ahead(hashes, FAR - NEAR + 1), np.array(ids, np.int64)
        for f in range(FUNCTIONS):
            values = ordered(hashes, f)
            c = np.array([c for c, _, _ in compact_windows(values, starts)], np.int64)
            text = np.searchsorted(starts, c, "right") - 1
            start, end = starts[text], ends[text]
            columns = [values[c].view(np.int64), np.full(len(c), f, np.int32), ids[text]]
            columns.append((c - start).astype(np.int32))
            columns += [
                surroundings(marks, c - FAR, c - FAR >= start),
                surroundings(marks, c + NEAR, c + FAR < end),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=WINDOWS_ARROW)


def placed(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles, and all places by shingle, then place: one search finds the
    occurrence next to a place."""
    values, rank = np.unique(hashes, return_inverse=True)
    return values, np.sort(rank * len(hashes) + np.arange(len(hashes)))


def alike_parts(run: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int]]:
    """The least number of parts of a run (indices, end exclusive) that cover all its parts of
    ``LEAST_SHINGLES`` or more with the least similarity, counted by place.

    From index i to j, ``j - i + 1`` places are shared out of the places of both sides, so the
    similarity is reached where a score at j is not below that at i by more than a constant.
    Each exact stretch of ``LEAST_SHINGLES`` lies inside one of the parts.
    """
    score = (1 + LEAST_SIMILARITY) * np.arange(len(run)) - LEAST_SIMILARITY * (run + firsts)
    tail = np.maximum.accumulate(score[::-1])
    last = len(run) - 1 - np.searchsorted(tail, score - (1 - LEAST_SIMILARITY) - 1e-6)
    widest = np.maximum.accumulate(np.append(-1, last[:-1]))  # parts inside another are left out
    begins = np.flatnonzero((run[last] + 1 - run >= LEAST_SHINGLES) & (last > widest))
    out: list[tuple[int, int]] = []
    for k, i in enumerate(begins.tolist()):
        following = int(begins[k + 1]) if k + 1 < len(begins) else len(run)
        if not out or following > out[-1][1]:  # without this part its shingles would be left out
            out.append((i, int(last[i]) + 1))
    for i, j in exact_parts(run, firsts):
        if not any(a <= i and j <= b for a, b in out):
            k = begins[np.searchsorted(begins, i, "right") - 1] if len(begins) and begins[0] <= i else i
            out.append((int(k), int(last[k]) + 1) if last[k] + 1 >= j else (i, j))
    return sorted(set(out))


def exact_parts(run: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of a run (indices, end exclusive) without a gap on either side."""
    cuts = np.flatnonzero((np.diff(run) != 1) | (np.diff(firsts) != 1)) + 1
    begins, ends = np.append(0, cuts), np.append(cuts, len(run))
    return [(i, j) for i, j in zip(begins.tolist(), ends.tolist(), strict=True) if j - i >= LEAST_SHINGLES]


def different(values: np.ndarray) -> np.ndarray:
    """The different values in order."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])]


def _compared(later, earlier, places: np.ndarray, firsts: np.ndarray) -> tuple[int, int, int, int, float]:
    """The passage from the first to the last of the places, with its similarity."""
    start, end, f_start, f_end = int(places[0]), int(places[-1]) + 1, int(firsts.min()), int(firsts.max()) + 1
    a, b = later[start:end], earlier[f_start:f_end]
    if np.array_equal(a, b):
        return start, end, f_start, f_end, 1.0
    a, b = different(a), different(b)
    either = len(different(np.concatenate([a, b])))
    return start, end, f_start, f_end, (len(a) + len(b) - either) / either


def passages(
    later: np.ndarray, earlier: np.ndarray, index: tuple[np.ndarray, np.ndarray], shifts: Iterable[int]
) -> list[tuple[int, int, int, int, float]]:
    """(start, end, first_start, first_end, similarity), in shingles, of the passages of ``later``
    that are in ``earlier``. A passage is a run of shared shingles along one of the shifts
    (place minus earlier place, give or take ``GAP``), with gaps of at most ``GAP``, of at
    least ``LEAST_SHINGLES`` and with the least similarity (Jaccard, as sets). Of a run below
    that, the parts that reach it are taken; where shingles repeat so that a part falls below as
    a set, its exact stretches. A run that adds little to those already found is left out."""
    if not len(earlier) or not len(later):
        return []
    values, by_rank = index
    at = np.minimum(np.searchsorted(values, later), len(values) - 1)
    places = np.flatnonzero(values[at] == later)
    lows = at[places] * len(earlier)
    out, covered = [], np.zeros(len(later), bool)
    apart: list[int] = []  # shifts close to another find the same runs
    for shift in sorted(shifts):
        if not apart or shift - apart[-1] > GAP // 2:
            apart.append(shift)
    for shift in apart:
        if len(places) - np.count_nonzero(covered[places]) < LEAST_SHINGLES * LEAST_SIMILARITY:
            break
        want = places - shift
        right = np.searchsorted(by_rank, lows + np.minimum(np.maximum(want, 0), len(earlier) - 1))
        best = np.full(len(places), -(1 << 40))
        for k in (right - 1, right):
            place = by_rank[np.minimum(np.maximum(k, 0), len(by_rank) - 1)] - lows
            own = (place >= 0) & (place < len(earlier))
            nearer = own & (np.abs(place - want) < np.abs(best - want))
            best[nearer] = place[nearer]
        near = np.abs(best - want) <= GAP
        run = places[near]
        firsts = best[near]
        if not len(run):
            continue
        cuts = np.flatnonzero(np.diff(run) > GAP) + 1
        begins, ends = np.append(0, cuts), np.append(cuts, len(run))
        for k in np.flatnonzero(run[ends - 1] + 1 - run[begins] >= LEAST_SHINGLES).tolist():
            start, end = int(run[begins[k]]), int(run[ends[k] - 1]) + 1
            if end - start - np.count_nonzero(covered[start:end]) < LEAST_SHINGLES * LEAST_SIMILARITY:
                continue
            own, first = run[begins[k] : ends[k]], firsts[begins[k] : ends[k]]
            whole = [(0, len(own))]
            for parts in (whole, None):
                below = []
                for i, j in parts or alike_parts(own, first):  # only of a run below the similarity
                    passage = _compared(later, earlier, own[i:j], first[i:j])
                    if passage[4] < LEAST_SIMILARITY:
                        below.append((i, j))
                    elif parts is whole or not covered[passage[0] : passage[1]].all():
                        covered[passage[0] : passage[1]] = True
                        out.append(passage)
                if not below:
                    break
            else:
                for i, j in below:
                    for a, b in exact_parts(own[i:j], first[i:j]):
                        passage = _compared(later, earlier, own[i + a : i + b], first[i + a : i + b])
                        if not covered[passage[0] : passage[1]].all():
                            covered[passage[0] : passage[1]] = True
                            out.append(passage)
    return out


def sketched(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16 bits of each shingle, and those of every ``STEP``-th place, with 0 for a shingle that the
    text repeats: it counts as shared."""
    sketch = (hashes >> np.uint64(48)).astype(np.uint16)
    sketch[sketch == 0] = 1
    in_order, sample = np.sort(hashes), sketch[::STEP].copy()
    repeated = in_order[1:][in_order[1:] == in_order[:-1]]
    if len(repeated):
        at = np.minimum(np.searchsorted(repeated, hashes[::STEP]), len(repeated) - 1)
        sample[repeated[at] == hashes[::STEP]] = 0
    return sketch, sample


def may_share(sample: np.ndarray, there: np.ndarray) -> bool:
    """Whether a text of this sample may hold a passage of the one whose sketch is marked in ``there``
    (0 is marked too). Never false if it does: of the shingles of a passage at most a part of
    ``1 - LEAST_SIMILARITY`` is not in the other text, so there are places i and j, ``LEAST_SHINGLES``
    or more apart, with at most that part of ``j - i`` missing in the sample between them."""
    score = np.ones(len(sample) * STEP, np.int64)
    score[::STEP] -= SHARE * ~there[sample]
    score = np.append(0, np.cumsum(score))
    return bool((score[LEAST_SHINGLES:] >= np.minimum.accumulate(score)[:-LEAST_SHINGLES]).any())


def _packed(batches):
    """The texts compressed, a text is moved once for each pair that may share a passage; their sketches."""
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        packed = [zlib.compress(t.encode(), 1) for t in texts]
        sketches = ([x.tobytes() for x in sketched(hashes)] for hashes in shingled(texts))
        yield arrow_batch([batch.column(0).to_pylist(), packed, *zip(*sketches, strict=True)], PACKED_ARROW)


def _may_share(batches):
    """The pairs whose sketches do not rule out a passage."""
    last_id, there = None, np.zeros(1 << 16, bool)
    for batch in batches:
        kept = []
        samples, sketches = batch.column("sample"), batch.column("first_sketch")
        for i, first_id in enumerate(batch.column("first_id").to_pylist()):
            if first_id != last_id:  # rows come in the order of first_id
                last_id = first_id
                there[:] = False
                there[np.frombuffer(sketches[i].as_py(), np.uint16)] = there[0] = True
            kept.append(may_share(np.frombuffer(samples[i].as_py(), np.uint16), there))
        yield batch.select(["doc_id", "first_id", "anchors"]).filter(pa.array(kept, pa.bool_()))


def _verify(batches):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("first_id", pa.int64()),
         ("first_start", pa.int64()), ("first_end", pa.int64()), ("similarity", pa.float64())]
    )
    read_id = last_id = earlier = index = None
    for batch in slices(batches, 32):
        rows = []
        lists = batch.column("anchors")
        ends, fields = lists.offsets.to_pylist(), lists.values.type
        flat = {fields.field(i).name: lists.values.field(i).to_numpy() for i in range(fields.num_fields)}
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "first_id", "text", "first_text"))
        pairs, unread = [], []
        for i, (doc_id, first_id, packed, first_packed) in enumerate(zip(*columns, strict=True)):
            text = zlib.decompress(packed).decode()
            if packed == first_packed:
                n = len(text.split())
                rows.append((doc_id, 0, n, first_id, 0, n, 1.0))
                continue
            if first_id != read_id:  # rows come in the order of first_id
                read_id = first_id
                unread.append(zlib.decompress(first_packed).decode())
            unread.append(text)
            pairs.append((i, doc_id, first_id))
        read = iter(shingled(unread))
        for i, doc_id, first_id in pairs:
            anchors = {name: x[ends[i] : ends[i + 1]] for name, x in flat.items()}
            if first_id != last_id:
                last_id, earlier = first_id, next(read).copy()
                index = placed(earlier)
            shifts = set((anchors["c"] - anchors["first_c"]).tolist())
            for start, end, f_start, f_end, similarity in passages(next(read), earlier, index, shifts):
                rows.append((doc_id, start, end + WORDS - 1, first_id, f_start, f_end + WORDS - 1, similarity))
        if rows:
            yield arrow_batch(list(zip(*rows, strict=True)), schema)


PLACE = ("doc_id", "c")


class _Tables:
    """Tables in the shared folder that are deleted together."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def written(self, frame: DataFrame, label: str) -> DataFrame:
        self.paths.append(scratch_dir(self.spark, label))
        frame.write.parquet(self.paths[-1])
        return self.spark.read.parquet(self.paths[-1])

    def clean(self) -> None:
        for path in self.paths:
            remove_folder(self.spark, path)


def _groups(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the groups that hold windows of two documents: most windows have their key for themselves."""
    ids = windows.groupBy(*keys).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return ids.where("first < last").select(*keys)


def _met(windows: DataFrame, keys: list[str], pivots: int, tables: _Tables) -> tuple[DataFrame, DataFrame]:
    """Windows with the pivots of their group, and the pivots: the first windows of its
    documents, dealt by hash to ``pivots`` parts. The earlier document of a pair is ``first``."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(pivots)).alias("part")
    first = (
        windows.groupBy(*keys, part)
        .agg(F.min(F.struct(*PLACE)).alias("first"), F.max("doc_id").alias("last"))
        .select(*keys, *(F.col(f"first.{k}").alias(f"first_{k}") for k in PLACE), "last")
    )
    if pivots == 1:
        first = first.where("first_doc_id < last")
    first = tables.written(first.drop("last"), "passage-pivots")
    pairs = windows.join(first, keys).where("doc_id != first_doc_id")
    later = F.col("doc_id") > F.col("first_doc_id")
    ordered = [F.when(later, F.col(k)).otherwise(F.col(f"first_{k}")).alias(k) for k in PLACE]
    ordered += [F.when(later, F.col(f"first_{k}")).otherwise(F.col(k)).alias(f"first_{k}") for k in PLACE]
    others = [k for k in windows.columns if k not in PLACE]
    pairs = pairs.select(*others, *ordered).withColumnRenamed("first_doc_id", "first_id")
    return tables.written(pairs, "passage-met"), first


def _bucketed(texts: DataFrame, name: str, path: str) -> DataFrame:
    """A table by doc_id in the shared folder, so that the joins of every round leave it in place.
    ``texts`` come grouped by doc_id, so each task writes the buckets it has. The name is for this run only."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts.write.bucketBy(parts, "doc_id").sortBy("doc_id").option("path", path).saveAsTable(name)
    return texts.sparkSession.table(name)


def _with_both(pairs: DataFrame, texts: DataFrame, own: str, other: str, tables: _Tables) -> DataFrame:
    """Pairs with a column of their later and one of their first text.

    The few texts that many others are compared with are written by themselves: that join is
    shuffled on both sides, so Spark can split the rows of a frequent first text."""
    first = texts.join(pairs.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id")
    first = tables.written(first.select(F.col("doc_id").alias("first_id"), F.col(other).alias(f"first_{other}")), "passage-first")
    return pairs.join(texts.select("doc_id", own), "doc_id").join(first, "first_id")


RESULT = "doc_id long, start_word long, end_word long, first_id long, first_start long, first_end long, similarity double"


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of 50 words or more that repeat one of an earlier document (Jaccard of shingles
    of five words 0.8 or more): (doc_id, start_word, end_word, first_id, first_start,
    first_end, similarity), end exclusive.

    A group of windows with one signature is linked to its first window, so copies and
    shared passages give one link each, not all pairs. Windows that no verified passage
    covers are then linked anew among themselves by surroundings, to some pivots of each
    group in a round, a pair of documents once at most, until each has met all others of its
    group, also after rounds that find nothing. Null ids,
    null texts and texts under 50 words take no part. Rows with one id are one document:
    the greatest text stands for it. What a round wrote is deleted with it, shuffle files with the
    query that wrote them; only the passages stay.
    """
    with shuffles_removed(docs.sparkSession):
        return _repeated(docs, id_col, text_col)


def _repeated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    narrow = narrow.where("doc_id is not null and text is not null")
    path = scratch_dir(spark, "passage-windows")
    narrow.mapInArrow(_windows, WINDOWS).write.parquet(path)
    windows = spark.read.parquet(path)
    keys = ["signature", "function"]
    tables = _Tables(spark)  # of the round that goes on
    grouped = _Tables(spark)  # of the first meeting only
    shared = grouped.written(windows.join(_groups(windows, keys).hint("shuffle_hash"), keys, "left_semi"), "passage-shared")
    remove_folder(spark, path)
    met, _ = _met(shared, keys, 1, tables)
    grouped.clean()
    asked = met.select("doc_id").union(met.select("first_id")).distinct()
    name, texts_path = f"passage_texts_{uuid.uuid4().hex}", scratch_dir(spark, "passage-texts")
    texts = narrow.join(asked, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    texts = _bucketed(texts.mapInArrow(_packed, PACKED), name, texts_path)
    rest, out, tested, pivots_now = None, None, None, PIVOTS
    while True:
        anchors = F.collect_list(F.struct("c", "first_c"))
        pairs = met.groupBy("doc_id", "first_id").agg(anchors.alias("anchors"))
        if tested is not None:
            pairs = pairs.join(tested, ["doc_id", "first_id"], "left_anti")
        own = tables.written(pairs, "passage-pairs")
        # Most pairs share little more than a shingle: sketches rule those out, and only the others move texts.
        sketches = _with_both(own, texts, "sample", "sketch", tables)
        alike = tables.written(sketches.mapInArrow(_may_share, PAIRS), "passage-alike")
        found = written(_with_both(alike, texts, "text", "text", tables).mapInArrow(_verify, RESULT), "passage-found")
        out = found if out is None else out.unionByName(found)
        compared = written(own.select("doc_id", "first_id"), "passage-compared")
        tested = compared if tested is None else tested.unionByName(compared)
        if rest is None:  # the pivots of the first round are not in met as ``doc_id``
            sides = F.posexplode(F.array("left", "right")).alias("side", "context")
            rest = met
        else:
            pivots = pivots.select(*keys, F.col("first_doc_id").alias("doc_id"), F.col("first_c").alias("c"))
            rest = rest.join(pivots, [*keys, "doc_id", "c"], "left_anti")
        spans = found.select(F.col("doc_id").alias("in_id"), "start_word", "end_word")
        covered = (F.col("c") >= F.col("start_word")) & (F.col("c") < F.col("end_word"))
        following = _Tables(spark)
        rest = rest.join(spans, (rest["doc_id"] == spans["in_id"]) & covered, "left_anti")
        if "side" not in keys:
            rest = rest.select(*keys, *PLACE, sides).where("context is not null")
            keys += ["side", "context"]
        rest = following.written(rest, "passage-rest")
        met, pivots = _met(rest, keys, pivots_now, following)
        tables.clean()
        tables = following
        if met.isEmpty():  # no group holds windows of two documents that have not met
            break
        pivots_now *= 2
    tables.clean()
    spark.sql(f"DROP TABLE {name}")
    remove_folder(spark, texts_path)
    return out


def op10_passages(spark, folder):
    return repeated_passages(table(spark, folder, "documents"))
