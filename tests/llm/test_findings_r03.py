"""Findings of the third review: fingerprints of repeated or missing ids, strings of hosts in any number of parts,
texts of pairs that are not written."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm import pages, passages, simhash

DOCS = "doc_id long, text string"


def plain_components(ids, prints):
    """For each row the least id of those it reaches over fingerprints within two bits; None without one."""
    todo, out = set(range(len(ids))), [None] * len(ids)
    while todo:
        group, new = [], [todo.pop()]
        while new:
            i = new.pop()
            group.append(i)
            near = {j for j in todo if (prints[i] ^ prints[j]).bit_count() <= 2}
            todo -= near
            new += near
        least = min((ids[i] for i in group if ids[i] is not None), default=None)
        for i in group:
            out[i] = least
    return out


@pytest.mark.parametrize("pairwise", [24, 2])
def test_ids_are_no_links_between_fingerprints(spark, monkeypatch, pairwise):
    """Bits are given: 5 and 9 repeat an id with other texts, rows without id bridge two others or stand alone."""
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    near, far, wide, alone = 0b11, 0xFF00, 0xFF0000, 0xFF000000
    rows = [
        (9, near), (3, near ^ 0b100), (9, far), (5, far ^ 0x100), (9, far ^ 0x200),
        (8, wide), (None, wide ^ 0x30000), (7, wide ^ 0xF0000), (None, wide ^ 0x1000000000),
        (None, alone), (None, alone ^ 1), (-4, 1 << 63), (2, (1 << 63) ^ 3), (2, 0x0F0F0F0F00000000),
    ]
    rng = random.Random(5)
    rows += [(rng.choice([None, *range(100, 120)]), sum(1 << b for b in rng.sample(range(36, 44), 3))) for _ in range(60)]
    docs = spark.createDataFrame([(i, str(p)) for i, p in rows], DOCS)
    own = _with_given_prints(monkeypatch, docs)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in own.collect()), key=repr)
    ids, prints = zip(*rows, strict=True)
    want = zip(ids, [f"{p:016x}" for p in prints], plain_components(ids, prints), strict=True)
    assert got == sorted(want, key=repr)


def _with_given_prints(monkeypatch, docs):
    """The operator's result with the numbers in ``text`` as fingerprints."""

    def given(batches):
        for batch in batches:
            found = [int(t) for t in batch.column(1).to_pylist()]
            signed = [x - (1 << 64) if x >> 63 else x for x in found]
            yield simhash.arrow_batch([batch.column(0).to_pylist(), signed], simhash.ARROW)

    monkeypatch.setattr(simhash, "_fingerprints", given)
    return simhash.simhash_components(docs)


def test_rows_without_id_link_nothing_in_the_pipeline(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (None, text), (4, text), (None, "x y z")], DOCS)
    kept = simhash.first_of_each(spark, docs.withColumn("more", F.lit(1)), "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == [(1, text), (None, text), (None, "x y z")]


def plain_extraction(rows):
    """Texts by page, with strings counted plainly over all pages of a host."""
    by_host = {}
    for page_id, url, html in rows:
        level, blocks = pages.blocks_of(html)
        by_host.setdefault(pages.host_of(url), []).append((page_id, level > pages.ANY, blocks))
    out = {}
    for own in by_host.values():
        streams = [[t for b in blocks for t in b.split(" ")] for _, _, blocks in own]
        seen = Counter(s for tokens in streams for s in {tuple(tokens[i : i + 8]) for i in range(len(tokens) - 7)})
        most = max(8, math.ceil(0.6 * len(own)))
        for (page_id, named, blocks), tokens in zip(own, streams, strict=True):
            on = np.array([seen[tuple(tokens[i : i + 8])] for i in range(len(tokens))])
            covered, at, kept = pages._covered(on, most if named else 3, most, 8).tolist(), 0, []
            for block in blocks:
                n = len(block.split(" "))
                kept += [block] if sum(covered[at : at + n]) < 0.7 * n else []
                at += n
            out[page_id] = "\n\n".join(kept)
    return out


@pytest.mark.parametrize("part_chars", [4 << 20, 9_000, 1_500])
@pytest.mark.parametrize("split_hosts", [1 << 16, 1])
def test_main_text_is_the_same_for_any_parts_of_a_host(spark, monkeypatch, part_chars, split_hosts):
    """Strings on 2, 3 or more pages, or on just most pages, of a host count the same however it is dealt."""
    monkeypatch.setattr(pages, "PART_CHARS", part_chars)
    monkeypatch.setattr(pages, "SPLIT_HOSTS", split_hosts)
    rng = random.Random(11)
    line = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    rare = [line(12) for _ in range(12)]
    share = [line(15) for _ in range(4)]
    rows = []
    for i in range(90):
        host, k = divmod(i, 45)
        own = [line(rng.randrange(20, 50)) for _ in range(4)]
        notes = [rare[k % 24 // 2]] if k < 30 else []  # on two or three pages of a host
        notes += [s for s, most in zip(share, (26, 27, 30, 9), strict=True) if k * 7 % 45 < most]
        body = "".join(f"<p>{b}</p>" for b in [own[0], *notes, *own[1:]])
        body = f"<article>{body}</article>" if host or k % 4 == 0 else f"<div>{body}</div>"
        rows.append((i, f"http://h{host}.example.org/{i}", body))
    got = pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = plain_extraction(rows)
    assert {r.page_id: r.text for r in got} == want
    every = {i: "\n\n".join(pages.blocks_of(html)[1]) for i, _, html in rows}
    assert sum(want[i] != every[i] for i in want if i < 45) > 30 and any(want[i] != every[i] for i in range(45, 90))


def test_hashes_of_strings_and_their_packing():
    rng = random.Random(2)
    texts = [[rng.choice("abcd") for _ in range(rng.randrange(60))] for _ in range(40)]
    hashes, counts = pages.string_counts(texts)
    other, _ = pages.string_counts(texts[::-1])
    plain = Counter(s for t in texts for s in {tuple(t[i : i + 8]) for i in range(len(t) - 7)})
    assert hashes.tolist() == other.tolist() and sorted(counts.tolist()) == sorted(plain.values())
    again = pages.unpacked(pages.packed(hashes, counts))
    assert again[0].tolist() == hashes.tolist() and again[1].tolist() == counts.tolist()
    on, places = pages.repeated_on(texts)
    assert pages.host_counts(texts, again)[0].tolist() == on.tolist() and len(places) == 40
    assert [len(x) for x in pages.unpacked(pages.packed(hashes[:0], counts[:0]))] == [0, 0]
    for short in ([], [[]], [["x"]], [["x"] * 7], [["x"] * 3, ["y"] * 3], [["x"] * 8]):
        hashes, counts = pages.string_counts(short)
        assert len(hashes) == len(counts) == any(len(t) == 8 for t in short)
        assert pages.host_counts(short, again)[0].tolist() == [0] * sum(len(t) + 1 for t in short)


def test_no_text_is_written_once_for_each_pair(spark, monkeypatch):
    """Pairs are written without their texts; texts, one row for each document, are compressed. Nothing is lost."""
    columns, kept = {}, passages._Tables.written
    monkeypatch.setattr(
        passages._Tables, "written", lambda self, f, label: columns.setdefault(label, set(f.columns)) and kept(self, f, label)
    )
    rng = random.Random(4)
    line = lambda n: [f"é{rng.randrange(9000)}" for _ in range(n)]
    shared = line(70)
    texts = [[*line(30), *shared, *line(10 * i)] for i in range(6)]
    texts.append(texts[0])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], DOCS)
    got = {(r.doc_id, r.start_word, r.end_word, r.first_id, r.first_start) for r in passages.repeated_passages(docs).collect()}
    assert {(i, 30, 100, 0, 30) for i in range(1, 6)} | {(6, 0, 100, 0, 0)} <= got
    assert not columns["passage-pairs"] & {"text", "first_text"}
    assert dict(spark.createDataFrame([(1, "a")], DOCS).mapInArrow(passages._packed, passages.PACKED).dtypes)["text"] == "binary"
