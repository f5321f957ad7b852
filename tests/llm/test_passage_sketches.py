"""The check finding of the third round: only pairs that may share a passage move texts, and shuffles go with their queries."""

import random

import numpy as np
import pytest

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm import passages
from tidewell.scratch import CLEANUP, shuffles_removed

DOCS = "doc_id long, text string"


def may_share(later, earlier):
    there = np.zeros(1 << 16, bool)
    there[passages.sketched(earlier)[0]] = there[0] = True
    return passages.may_share(passages.sketched(later)[1], there)


@pytest.mark.parametrize("vocabulary", [9000, 12, 3])  # with 3 words texts repeat most of their shingles
def test_sketches_never_rule_out_a_passage(vocabulary):
    rng = random.Random(vocabulary)
    line = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    found = ruled_out = 0
    for k in range(400):
        shared = line(rng.randrange(20, 120))
        edited = [w if rng.random() > k % 5 / 60 else "x" for w in shared]
        if k % 7 == 0:
            edited = edited[len(edited) // 2 :] + edited[: len(edited) // 2]
        ahead, before = rng.randrange(60), rng.randrange(60)
        later, earlier = line(ahead) + edited + line(rng.randrange(60)), line(before) + shared + line(rng.randrange(60))
        later, earlier = (passages.shingles(" ".join(x)) for x in (later, earlier))
        shifts = [ahead - before, rng.randrange(-30, 30)]
        got = passages.passages(later, earlier, passages.placed(earlier), shifts)
        possible = may_share(later, earlier)
        assert possible or not got
        found += bool(got)
        ruled_out += not possible
    assert found > 30
    assert vocabulary < 9000 or ruled_out > 30


def test_short_sketches():
    there = np.ones(1 << 16, bool)
    for n in (0, 1, passages.LEAST_SHINGLES - 2, passages.LEAST_SHINGLES, passages.LEAST_SHINGLES + 1):
        sample = passages.sketched(np.arange(n, dtype=np.uint64) << np.uint64(48))[1]
        assert len(sample) == -(-n // passages.STEP)
        assert passages.may_share(sample, there) == (n >= passages.LEAST_SHINGLES)


def test_texts_of_unrelated_pairs_are_not_moved(spark, monkeypatch):
    counts, settings, kept = {}, set(), passages._Tables.written

    def counted(self, frame, label):
        out = kept(self, frame, label)
        settings.add(spark.conf.get(CLEANUP))
        counts.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(passages._Tables, "written", counted)
    rng = random.Random(5)
    line = lambda n: [f"w{rng.randrange(90000)}" for _ in range(n)]
    phrase, shared = line(14), line(60)  # too short for a passage, long enough to give windows in common
    texts = [[*line(25), *phrase, *line(25)] for _ in range(60)] + [[*line(9), *shared, *line(9)] for _ in range(3)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], DOCS)
    before = spark.conf.get(CLEANUP, None)
    got = {(r.doc_id, r.start_word, r.end_word, r.first_id) for r in passages.repeated_passages(docs).collect()}
    assert got == {(61, 9, 69, 60), (62, 9, 69, 60)}
    assert sum(counts["passage-pairs"]) > 20 and sum(counts["passage-alike"]) == 2
    assert settings == {"true"} and spark.conf.get(CLEANUP, None) == before


def test_the_setting_comes_back(spark):
    try:
        for value in ("true", "false"):
            spark.conf.set(CLEANUP, value)
            with pytest.raises(ValueError), shuffles_removed(spark):
                assert spark.conf.get(CLEANUP) == "true"
                raise ValueError
            assert spark.conf.get(CLEANUP) == value
    finally:
        spark.conf.unset(CLEANUP)
