"""Ranked search against scoring every document, with many small blocks and odd tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm import ranking
from tidewell.llm.queries import QUERIES

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=20):
    counts = [(doc_id, Counter(terms(t))) for doc_id, t in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in {i for i in items if i[1] is not None}:
        found = []
        for doc_id, c in counts:
            m = 75 + 25 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                found.append((doc_id, score))
        found.sort(key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out += [(item_id, r, *hit) for r, hit in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def corpus(rng, n):
    words = [f"w{i}" for i in range(200)] + ["Äpfel", "the", "The", "x9", "日本", "naïve"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = []
    for i in range(n):
        text = " ".join(rng.choices(words, weights, k=rng.randrange(1, 40)))
        docs.append((i, docs[rng.randrange(i)][1] if i and rng.random() < 0.3 else text + rng.choice([".", "-a_b", ""])))
    return docs


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"SHARD_DOCS": 50, "BLOCK_DOCS": 5, "FEW_DOCS": 1, "PIVOTS": 4, "QUERY_CHARS": 700}.items():
        monkeypatch.setattr(ranking, name, value)


@pytest.mark.parametrize("k", [1, 20])
def test_equals_plain_scores(spark, small_blocks, k):
    rng = random.Random(k)
    docs = corpus(rng, 400)
    items = [(i, " ".join(rng.choices(docs, k=2)[0][1].split()[:12])) for i in range(25)]
    items += [(3, "w1 w1 w1 w2"), (3, "w1 w1 w1 w2"), (None, "w5"), (77, "..."), (78, None), (79, "nowhere")]
    got = ranking.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items, k)


def test_query_equals_plain(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op11_search"](spark, folder)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items)


def test_summaries_bound_every_score_and_skip_blocks(monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", 8)
    monkeypatch.setattr(ranking, "FEW_DOCS", 1)
    rng = random.Random(4)
    docs = corpus(rng, 300)
    counts = [ranking.counted(t) for _, t in docs]
    columns = [[i for i, _ in docs], [c.total() for c in counts], [[t.decode() for t in c] for c in counts],
               [list(c.values()) for c in counts], [0] * len(docs)]
    rows = ranking.pa.Table.from_batches([ranking.arrow_batch(columns, ranking.VECTOR)])
    batch = ranking.shard_batch(ranking.packed(rows, len(docs), sum(columns[1])))
    shard = ranking.Shard(batch.column("shard")[0].as_py())
    weighed = {t: 10 + len(t) for t in ("w0", "w1", "w7", "w30", "the")}
    weights, here, _ = shard.query(weighed)
    every = shard.scores(np.arange(len(docs)), weights)
    for term in here:
        for block, bound in zip(*shard.blocks_of(term, weights), strict=True):
            assert every[shard.docs_in([block])].max() <= bound
    scored = []
    scores = shard.scores
    monkeypatch.setattr(shard, "scores", lambda docs, weights: scored.append(len(docs)) or scores(docs, weights))
    least = int(np.sort(every)[-5])
    best = shard.best(weighed, 5, least)
    assert [s for _, s in best] == np.sort(every)[::-1][:5].tolist()
    assert scored[0] < len(docs) // 2


def test_index_of_all_terms_serves_any_query(spark, small_blocks):
    docs = corpus(random.Random(9), 120)
    index = ranking.build_index(spark.createDataFrame(docs, DOCS))
    queries = ["the Äpfel w3", "日本 w1 w1", "zzz", None]
    got = sorted(tuple(r) for r in ranking.search(index, queries, 7).collect())
    assert got == sorted((i, *row[1:]) for i, q in enumerate(queries) for row in plain(docs, [(i, q)], 7))


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,"), (4, "long " * 300_000 + "end"), (5, "End LONG"), (5, "End LONG"), (None, "end")]
    items = [(1, "end long"), (2, None), (2, "")]
    names = {c: F.lit("x") for c in ("terms", "n", "rank", "query", "score", "sketch")}
    got = ranking.ranked(spark.createDataFrame(docs, DOCS).withColumns(names), spark.createDataFrame(items, ITEMS).withColumns(names))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items)
    none = spark.createDataFrame([], DOCS)
    assert ranking.ranked(none, spark.createDataFrame(items, ITEMS)).count() == 0
    assert ranking.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == 0
    assert ranking.ranked(spark.createDataFrame(docs[:3], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
