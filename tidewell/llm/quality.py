"""Quality score: regularised quadratic discriminant over document statistics.

Each class is a normal density over transformed statistics of a text. Its covariance is
shrunk towards the pooled one and a multiple of the identity, and factored once (Cholesky).
A score is the logistic of the log-density difference, made of the Mahalanobis distances.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, fold_of, slices, table
from tidewell.scratch import written

STATISTICS = (
    "log_words", "log_word_length", "log_line_words", "upper", "digit", "mark", "symbol", "bar",
    "bang", "other", "distinct_words", "same_as_next", "distinct_lines", "ended_lines",
)
D = len(STATISTICS)
TO_POOLED, TO_IDENTITY = 0.2, 0.02
#: Log odds are divided by this before the logistic: the densities are only roughly normal.
SOFTNESS = 4.0
FOLDS, HELD_OUT, GOOD_FROM = 5, 0, 0.3
ARROW = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])


def character_classes() -> np.ndarray:
    """0 space, 1 lower or caseless letter, 2 upper, 3 digit, 4 mark, 5 symbol, 6 bar, 7 bang, 8 other."""
    kinds = np.full(0x110000, 8, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        kinds[i] = 0 if c.isspace() else 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 8
    kinds[0x3000:] = 1
    for marks, kind in ((".,;:?'\"()-", 4), ("#$%&*@^~+=<>/\\_{}[]", 5), ("|", 6), ("!", 7)):
        kinds[[ord(c) for c in marks]] = kind
    return kinds


def statistics(text: str | None, kinds: np.ndarray) -> list[float]:
    """The transformed statistics; shares go through a logarithm that opens up small ones."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    count = np.bincount(kinds[codes], minlength=9)
    shown = max(1, int(count[1:].sum()))
    share = lambda x, of: float(np.log1p(100 * x / of))
    same = sum(map(str.__eq__, words, words[1:]))
    return [
        float(np.log1p(len(words))), float(np.log1p(shown / n)), float(np.log1p(len(words) / max(1, len(lines)))),
        *(share(int(count[k]), shown) for k in (2, 3, 4, 5, 6, 7, 8)),
        float(np.log(len(set(words)) + 1) - 0.85 * np.log(n + 1)), share(same, n),
        len(set(lines)) / max(1, len(lines)), sum(x.rstrip()[-1] in ".!?" for x in lines) / max(1, len(lines)),
    ]


def _statistics(batches):
    kinds = character_classes()
    for batch in slices(batches):
        found = [statistics(t, kinds) for t in batch.column(1).to_pylist()]
        yield arrow_batch([batch.column(0).to_pylist(), found], ARROW)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log-density constants of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = [
            c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1)
            for m, f, c in zip(self.means, self.factors, self.constants, strict=True)
        ]
        return 1 / (1 + np.exp(-np.clip((logs[1] - logs[0]) / SOFTNESS, -500, 500)))


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant | float:
    """From (rows, sum, sum of outer products) by class; a class without rows makes it a constant."""
    total = sum(n for n, _, _ in moments.values())
    if len(moments) < 2:
        return 0.5 if not total else float(max(moments))
    means = {k: s / n for k, (n, s, _) in moments.items()}
    scatter = {k: o - n * np.outer(means[k], means[k]) for k, (n, _, o) in moments.items()}
    pooled = sum(scatter.values()) / total
    level = max(np.trace(pooled) / D, 1e-6)
    factors, constants = [], []
    for k in (0, 1):
        n = moments[k][0]
        cov = (1 - TO_POOLED) * scatter[k] / n + TO_POOLED * pooled
        cov = (1 - TO_IDENTITY) * cov + TO_IDENTITY * level * np.eye(D)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(n / total) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array([means[0], means[1]]), np.array(factors), np.array(constants))


def _moments(batches):
    """Partial sums of a task: rows (class, place, value), places in the order n, sum, products."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        y = np.asarray(batch.column(0).to_pylist(), int)
        x = np.asarray(batch.column(1).to_pylist(), float).reshape(len(y), D)
        for k in np.unique(y):
            own = x[y == k]
            part = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
            sums[int(k)] = sums.get(int(k), 0) + part
    schema = pa.schema([("class", pa.int64()), ("place", pa.int64()), ("value", pa.float64())])
    for k, part in sums.items():
        yield arrow_batch([[k] * len(part), range(len(part)), part], schema)


def train(stats: DataFrame, labels: DataFrame) -> Discriminant | float:
    """From all labelled rows outside the held-out fold; only sums reach the driver."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("y"))
    rows = stats.join(known.where("y in (0, 1)"), "doc_id").where(fold_of("doc_id", FOLDS) != HELD_OUT)
    parts = rows.select("y", "x").mapInArrow(_moments, "class long, place long, value double")
    found = parts.groupBy("class", "place").agg(F.sum("value").alias("value")).collect()
    flat: dict[int, np.ndarray] = {}
    for k, place, value in found:
        flat.setdefault(k, np.zeros(1 + D + D * D))[place] = value
    return fit({k: (v[0], v[1 : 1 + D], v[1 + D :].reshape(D, D)) for k, v in flat.items()})


def _scores(model):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column(1).to_pylist(), float).reshape(batch.num_rows, D)
            score = np.full(len(x), model) if isinstance(model, float) else model.score(x)
            # Nine digits: the order in which partial sums meet must not show.
            yield arrow_batch([batch.column(0).to_pylist(), np.round(score, 9)], schema)

    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Null and empty texts have statistics too and get a score. Labels other than 0 and 1 and
    labels of unknown documents teach nothing; repeated labels count each time. A null id
    is in no fold (``held_out`` null). Without labels of both classes the score is constant.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    stats = written(narrow.mapInArrow(_statistics, "doc_id long, x array<double>"), "quality-statistics")
    model = train(stats, labels)
    return stats.mapInArrow(_scores(model), "doc_id long, score double").select(
        "doc_id",
        (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


def op4_quality(spark, folder):
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
