"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean embedding of its letter n-grams (2 to 4 letters, word borders
included), found by hashing. Embeddings and output layer are trained together by stochastic
gradient descent in numpy, on a bounded sample of labelled rows. A part of the sample is
set apart to fit a temperature, so that a score is the chance of being right; texts whose
score falls below ``REJECT_BELOW`` are rejected by the pipeline.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, fold_of, slices, table

BUCKETS, DIM, SIZES = 1 << 13, 16, (2, 3, 4)
#: Bound of the training sample: expected labelled rows taken for each language.
ROWS_PER_LANGUAGE = 400
EPOCHS, RATE, BATCH = 40, 0.5, 16
FOLDS, HELD_OUT = 4, 2
REJECT_BELOW = 0.5
UNKNOWN = "und"
ARROW = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # logits of each bucket, embeddings times output layer
    bias: np.ndarray
    temperature: float


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None, letters: np.ndarray) -> np.ndarray | None:
    """Buckets of the text's n-grams; None without a letter."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    known = letters[codes]
    if not known.any():
        return None
    codes = np.where(known, codes, np.uint32(32))
    out, mixed, inner = [], codes * np.uint32(0x9E3779B1), np.ones(len(codes), bool)
    for n in range(2, max(SIZES) + 1):
        rest = codes[n - 1 :]
        mixed = (mixed[: len(rest)] ^ rest) * np.uint32(0x85EBCA6B)
        # No border inside a gram: the characters between its ends are letters.
        inner = inner[: len(rest)] & known[n - 2 : n - 2 + len(rest)] if n > 2 else inner[: len(rest)]
        if n in SIZES:
            some = inner & (known[: len(rest)] | known[n - 1 :])
            out.append(mixed[some] >> np.uint32(19))
        mixed = mixed ^ (mixed >> np.uint32(15))
    return np.concatenate(out)


def _bags(batches):
    """(lang, place, buckets, counts) of the training rows."""
    letters = letter_table()
    schema = pa.schema(
        [("lang", pa.string()), ("place", pa.int64()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]
    )
    for batch in slices(batches):
        rows = []
        for lang, text, place in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found = grams(text, letters)
            if found is not None:
                at, n = np.unique(found, return_counts=True)
                rows.append((lang, place, at.astype(np.int32), n.astype(np.int32)))
        if rows:
            yield arrow_batch(list(zip(*rows, strict=True)), schema)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, n_classes: int, seed: int = 7):
    """Embeddings x output layer, by stochastic gradient descent over mini-batches of rows, each the
    buckets of a text and their shares."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, n_classes)).astype(np.float32)
    bias = np.zeros(n_classes, np.float32)
    goal = np.eye(n_classes, dtype=np.float32)[target]
    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            used = np.unique(np.concatenate([bags[r][0] for r in rows]))
            x = np.zeros((len(rows), len(used)), np.float32)
            for i, r in enumerate(rows):
                x[i, np.searchsorted(used, bags[r][0])] = bags[r][1]
            hidden = x @ embed[used]
            error = (_softmax(hidden @ out + bias) - goal[rows]) / len(rows)
            back = error @ out.T
            out -= rate * (hidden.T @ error)
            bias -= rate * error.sum(axis=0)
            # A mean over many grams gives each a tiny step; the count of grams undoes that.
            embed[used] -= rate * 20 * (x.T @ back)
    return embed @ out, bias


def _temperature(z: np.ndarray, target: np.ndarray) -> float:
    if not len(z):
        return 1.0
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(z)), target] + 1e-12).mean()
    return float(min(np.geomspace(0.25, 8, 41), key=loss))


def train(docs: DataFrame, id_col="doc_id", text_col="text", label_col="lang", rows=ROWS_PER_LANGUAGE) -> LanguageModel:
    """A model from the labelled rows of ``docs``; the sample depends on ids only."""
    labelled = docs.where(docs[label_col].isNotNull() & docs[text_col].isNotNull())
    counts = dict(labelled.groupBy(label_col).count().collect())
    names = sorted(counts)
    if not names:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0)
    chance = F.create_map(*(F.lit(x) for k in names for x in (k, min(1.0, rows / counts[k]))))
    drawn = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) / float(1 << 20)
    # Hash of the id and the text: the same order whatever the partitions, up to equal rows.
    place = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    sample = labelled.where(drawn < chance[F.col(label_col)]).select(label_col, text_col, place)
    found = sample.mapInArrow(_bags, "lang string, place long, at array<int>, n array<int>").toArrow().sort_by(
        [("lang", "ascending"), ("place", "ascending")]
    )
    bags = [
        (np.asarray(at), np.asarray(n, np.float32) / np.float32(sum(n)))
        for at, n in zip(found["at"].to_pylist(), found["n"].to_pylist(), strict=True)
    ]
    target = np.array([names.index(x) for x in found["lang"].to_pylist()], int)
    apart = np.arange(len(target)) % 5 == 4
    weights, bias = fit([b for b, a in zip(bags, apart, strict=True) if not a], target[~apart], len(names))
    scores = [share @ weights[at] + bias for (at, share), a in zip(bags, apart, strict=True) if a]
    temperature = _temperature(np.array(scores).reshape(-1, len(names)), target[apart])
    return LanguageModel(names, weights.astype(np.float32), bias, temperature)


def _predict(model: LanguageModel):
    def run(batches):
        letters = letter_table()
        for batch in slices(batches):
            ids, names, scores = batch.column(0).to_pylist(), [], []
            for text in batch.column(1).to_pylist():
                found = grams(text, letters)
                if found is None or not model.languages:
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                share = np.bincount(found, minlength=BUCKETS).astype(np.float32) / len(found)
                p = _softmax(((share @ model.table + model.bias) / model.temperature)[None, :])[0]
                best = int(p.argmax())
                names.append(model.languages[best]), scores.append(min(1.0, float(p[best])))
            yield arrow_batch([ids, names, scores], ARROW)

    return run


def predict(docs: DataFrame, model: LanguageModel, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, lang_pred, score) per row; ``und`` with score 0 for null or letterless texts."""
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs`` (doc_id, text, lang).

    Learns from rows with a language whose crc32(doc_id) mod 4 is not 2. Null ids are in no
    fold: they teach nothing and ``held_out`` is null. Without any labelled row everything
    is ``und``. Repeated rows give repeated rows, other columns are ignored.
    """
    held_out = fold_of("doc_id", FOLDS) == HELD_OUT
    model = train(docs.where(~held_out))
    found = predict(docs, model)
    return found.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")


def op6_language(spark, folder):
    return identify(table(spark, folder, "documents"))


def accepted(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the rows whose language is found with a score of at least one half.

    Rows are judged one by one, so a repeated row and a row without id are judged too. Only
    texts go to Python and only answers come back; the columns of ``docs`` stay as they are,
    whatever their names.
    """
    model = train(docs.where(fold_of("doc_id", FOLDS) != HELD_OUT))

    @F.arrow_udf("boolean")
    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _predict(model)
        for column in texts:
            asked = pa.RecordBatch.from_arrays([pa.nulls(len(column), pa.int64()), column], names=["doc_id", "text"])
            scores = [s for out in judge([asked]) for s in out.column(2).to_pylist()]
            yield pa.array([s >= REJECT_BELOW for s in scores], pa.bool_())

    return docs.where(known(docs["text"]))
