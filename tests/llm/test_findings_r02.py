"""Cases of the second review: parts of the job that were left out before."""

import base64
import gzip
import random

import numpy as np
import pytest

from tidewell.llm import passages, secrets


def words_of(rng, n):
    return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]


def alike(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b)


def found_in(later, earlier):
    later, earlier = (passages.shingles(" ".join(x)) for x in (later, earlier))
    return later, earlier, passages.passages(later, earlier, passages.placed(earlier), [0])


def test_exact_words_before_edited_ones():
    text = words_of(random.Random(1), 400)
    later = [w if i < 68 or i % 8 else f"edit{i}" for i, w in enumerate(text)]
    _, _, found = found_in(later, text)
    assert found and found[0][0] == 0 and found[0][1] >= 64
    assert all(p[4] >= passages.LEAST_SIMILARITY for p in found)


@pytest.mark.parametrize("seed", range(8))
def test_parts_of_a_run_cover_brute_force(seed):
    rng = random.Random(seed)
    text = words_of(rng, 240)
    later, every = list(text), 0
    for i in range(len(text)):
        if i % 60 == 0:
            every = rng.choice([0, 7, 9, 20, 40]) if i else 0
        if every and i % every == 0:
            later[i] = f"edit{i}"
    a, b, found = found_in(later, text)
    assert all(alike(a[p[0] : p[1]], b[p[2] : p[3]]) == p[4] >= passages.LEAST_SIMILARITY for p in found)
    covered = np.zeros(len(a), bool)
    for p in found:
        covered[p[0] : p[1]] = True
    same = a == b
    wanted = np.zeros(len(a), bool)
    for s in np.flatnonzero(same).tolist():
        for e in (np.flatnonzero(same) + 1).tolist():
            if e - s >= passages.LEAST_SHINGLES and alike(a[s:e], b[s:e]) >= passages.LEAST_SIMILARITY:
                wanted[s:e] = True
    assert wanted.any() and not (wanted & ~covered).any()
    for s in range(len(a) - passages.LEAST_SHINGLES + 1):
        e = s + passages.LEAST_SHINGLES
        assert not same[s:e].all() or any(p[0] <= s and e <= p[1] for p in found)


def test_recall_at_the_least_similarity(spark):
    """Passages of 50 words with one of them edited: 41 of 51 shingles shared."""
    rng = random.Random(7)
    texts = []
    for _ in range(80):
        passage = words_of(rng, 50)
        edited = list(passage)
        edited[rng.randint(5, 44)] = "changed"
        texts += [" ".join(words_of(rng, 40) + x + words_of(rng, 40)) for x in (passage, edited)]
    rows = list(enumerate(texts))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["first_id"]) for r in got}
    wanted = {(i + 1, i) for i in range(0, len(texts), 2)}
    assert found <= wanted and len(found) >= 79


SECRET = "password = abcdef0123XYZ9876"


def secret_spans(text):
    return {s for s in secrets.all_spans(text, secrets.finds(text))[0] if s[1] == 0}


@pytest.mark.parametrize("mark", ["\u00a0", "\u3000", "\ufeff", "\u200b", "\u2028", "\f", "\0"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_secret_in_a_layer_with_unusual_characters(mark, pack):
    data = f"some prose{mark}here {SECRET} and more".encode()
    assert secret_spans(f"a note {base64.b64encode(pack(data)).decode()} .")


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize("around", [("", ""), ("-----BEGIN DATA-----\n", "-----END DATA-----"), ("text\n", "Other words follow")])
@pytest.mark.parametrize("filler", [40, 50, 61, 333])
def test_secret_in_wrapped_base64(pack, around, filler):
    data = "".join(random.Random(3).choice("bcdfg ") for _ in range(filler)) + SECRET + " and the rest of it" * 5
    packed = base64.encodebytes(pack(data.encode())).decode()
    text = around[0] + packed + around[1]
    spans = secret_spans(text)
    assert spans
    if pack is bytes:  # as exact as base64 allows
        whole = text.replace("\n", "")
        assert any(text[s:e].replace("\n", "") in whole and e - s < 2 * len(SECRET) for s, _, e in spans)


def test_valid_parts_of_escape_runs():
    run = "".join(f"%{b:02X}" for b in SECRET.encode())
    assert secret_spans("x %FF" + run) == {(5, 0, 5 + len(run))}
    units = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    assert secret_spans("x \\ud800" + units) == {(8, 0, 8 + len(units))}


def test_passages_behind_unrelated_first_windows(spark):
    """The first document of each group shares its least shingle and no more: a round that
    verifies nothing is not the last."""
    rng = random.Random(11)

    def least(words):
        hashes = passages.shingles(" ".join(words))
        return [int(hashes[passages.ordered(hashes, f).argmin()]) for f in range(passages.FUNCTIONS)]

    def places(words):
        hashes = passages.shingles(" ".join(words))
        return [int(passages.ordered(hashes, f).argmin()) for f in range(passages.FUNCTIONS)]

    while True:  # no other window of the text is long enough
        shared = words_of(rng, 52)
        if all(6 <= c <= 40 for c in places(shared)):
            break
    keep = {i for c in places(shared) for i in range(c, c + passages.WORDS)}
    while True:
        decoy = [w if i in keep else f"d{rng.randint(0, 10**6)}" for i, w in enumerate(shared)]
        if least(decoy) == least(shared):
            break
    while True:
        copies = [shared + words_of(rng, 1) for _ in range(2)]
        if all(least(c) == least(shared) for c in copies):
            break
    rows = list(enumerate(" ".join(words) for words in (decoy, *copies)))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["first_id"]) for r in got] == [(2, 1)]
