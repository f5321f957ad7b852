"""The check finding of the third round (CPU): texts are hashed together, windows alone in their group go early."""

import random

import numpy as np
import pytest

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm import passages

DOCS = "doc_id long, text string"


def plain_shingles(text):
    """The hashes by their definition, in whole numbers."""
    whole, multiplier = (1 << 64) - 1, int(passages.MULTIPLIER)
    words = []
    for word in (text or "").lower().split():
        raw = (word + " ").encode()
        words.append(sum(int(passages.BYTES[b]) * pow(multiplier, k + 1, whole + 1) for k, b in enumerate(raw)) & whole)
    out = []
    for i in range(len(words) - passages.WORDS + 1):
        x = words[i]
        for k in range(1, passages.WORDS):
            x = ((x ^ (x >> 29)) * multiplier + words[i + k]) & whole
        out.append(x)
    return out


@pytest.mark.parametrize("block", [1, 3, 1 << 12])
def test_texts_hashed_together(monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK", block)
    texts = ["A b C d e f", None, "", "a b c d", "a b\tc d\n e", "ü " * 9, "x" * 5000 + " y z v w", "a", "q r s t u"]
    for some in (texts, texts[1:4], [None], []):
        assert [x.tolist() for x in passages.shingled(some)] == [plain_shingles(t) for t in some]
        assert all(x.dtype == np.uint64 for x in passages.shingled(some))


def test_similarity_is_that_of_the_sets():
    rng = random.Random(3)
    for _ in range(200):
        a, b = (np.array([rng.randrange(30) for _ in range(rng.randrange(1, 40))], np.uint64) for _ in range(2))
        for x, y in ((a, b), (a, a.copy())):
            places, firsts = np.array([0, len(x) - 1]), np.array([0, len(y) - 1])
            got = passages._compared(x, y, places, firsts)
            p, q = set(x.tolist()), set(y.tolist())
            assert got == (0, len(x), 0, len(y), len(p & q) / len(p | q))


def test_parts_are_sought_only_below_the_similarity(monkeypatch):
    a = np.arange(100, dtype=np.uint64)
    monkeypatch.setattr(passages, "alike_parts", None)
    assert passages.passages(a, a.copy(), passages.placed(a), [0]) == [(0, 100, 0, 100, 1.0)]


def test_only_windows_of_two_documents_are_kept(spark, monkeypatch):
    kept, seen = passages._Tables.written, {}

    def counted(self, frame, label):
        out = kept(self, frame, label)
        seen.setdefault(label, out.toPandas())
        return out

    monkeypatch.setattr(passages._Tables, "written", counted)
    rng = random.Random(8)
    line = lambda n: [f"w{rng.randrange(90000)}" for _ in range(n)]
    shared = line(60)
    texts = [line(300) for _ in range(20)] + [[*line(9), *shared, *line(9)] for _ in range(3)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(0, " ".join(texts[0])), (None, " ".join(shared)), (40, None)]
    got = {(r.doc_id, r.start_word, r.first_id) for r in passages.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(21, 9, 20), (22, 9, 20)}
    assert set(seen["passage-shared"].doc_id) <= {20, 21, 22}
    assert not {"l", "r"} & set(seen["passage-shared"].columns)
