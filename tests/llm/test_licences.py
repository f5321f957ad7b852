"""Licence scan: notices on one line and wrapped ones, against a plain version of the score."""

import random
import re
import textwrap

import numpy as np
import pytest

import corpus_pipeline  # noqa: F401  (registers the package with the workers)
from tidewell.llm import licences

GPL3 = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version."
)
GPL2 = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License version 2 as published by the Free Software Foundation."
)
APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
MIT = licences.BODIES["mit"][0]
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
PROSE = "the river ran over stones\nand nobody looked at it all day"


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def scanned(spark, model, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return licences.scan_licences(docs, model=model).collect()


@pytest.mark.parametrize("width", [60, 70, 80, 1000])
@pytest.mark.parametrize(
    ("family", "text"),
    [("gpl-3.0", GPL3), ("gpl-2.0", GPL2), ("apache-2.0", APACHE), ("mit", MIT), ("bsd", BSD)],
)
def test_wrapped_notices_are_confirmed_in_their_family(spark, model, family, text, width):
    body = "\n".join(textwrap.wrap(text, width))
    found = [r for r in scanned(spark, model, f"{PROSE}\n\n{body}\n \n{PROSE}") if r.confirmed]
    lines = body.count("\n") + 1
    assert {r.family for r in found} == {family}
    # The first line of the Apache notice is a notice by itself, so lines are listed.
    assert found[0].line == 3 and (family == "apache-2.0" or found[-1].last_line == 2 + lines)


def test_a_line_in_a_paragraph_is_reported_as_a_line(spark, model):
    (row,) = [r for r in scanned(spark, model, f"{PROSE}\nReleased under the MIT License.\n{PROSE}") if r.confirmed]
    assert (row.line, row.last_line, row.family, row.template_similarity) == (2, 2, "mit", 1.0)


def test_prose_is_not_confirmed(spark, model):
    assert not [r for r in scanned(spark, model, PROSE, "permission\n\nwarranty of joy", None, "", "\n\n \n") if r.confirmed]


def plain_units(text, signals):
    lines, out, at = text.split("\n"), [], 0
    while at < len(lines):
        if not lines[at].strip(" \t\r\x0b\x0c"):
            at += 1
            continue
        end = at
        while end + 1 < len(lines) and lines[end + 1].strip(" \t\r\x0b\x0c"):
            end += 1
        if signals & set(licences.words(" ".join(lines[at : end + 1]))):
            own = [(i, i) for i in range(at, end + 1)]
            out.append([(a, b) for a, b in ([(at, end)] if end > at else []) + own
                        if signals & set(licences.words(" ".join(lines[a : b + 1])))])
        at = end + 1
    return lines, out


def plain_scan(model, text):
    """(line, last line, family, score, similarity, confirmed) by Python and numpy."""
    lines, paragraphs = plain_units(text, set(model.signals))
    at, out = {g: i for i, g in enumerate(model.grams)}, []
    for units in paragraphs:
        rows = []
        for a, b in units:
            tokens = licences.words(" ".join(lines[a : b + 1]))
            known = [at[g] for g in licences.grams(tokens) if g in at]
            if not known:
                continue
            z = (model.weights[known].astype(float).sum(axis=0) + model.bias) / model.temperature
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            if p[0] >= licences.CERTAIN:
                continue
            best = int(p[1:].argmax())
            pairs = {f"{x} {y}" for x, y in zip(tokens, tokens[1:], strict=False)} or set(tokens)
            alike = [max(len(pairs & (q := licences.template_pairs(t))) / len(q) for t in ts) for ts in licences.TEMPLATES.values()]
            sure = p[1:][best] >= licences.CERTAIN
            confirmed = bool(sure and alike[best] >= licences.LEAST_ALIKE and round(alike[best], 9) >= round(max(alike), 9))
            family = list(licences.TEMPLATES)[best] if sure else licences.UNKNOWN
            rows.append((a, b, family, round(float(p[1:][best]), 6), round(alike[best], 6), confirmed))
        in_line = max((r[4] for r in rows if r[0] == r[1] and r[5]), default=-1)
        whole = [r for r in rows if r[1] > r[0] and r[5] and r[4] > in_line]
        out += whole or [r for r in rows if r[0] == r[1]]
    return out


def test_equals_plain_version(spark, model):
    rng = random.Random(3)
    pool = [t for ts in licences.TEMPLATES.values() for t in ts] + [GPL3, PROSE, "", " \t", "version 2", "a copy of the license"]
    texts = []
    for _ in range(60):
        parts = [textwrap.fill(t, rng.choice([40, 70, 500])) for t in rng.sample(pool, rng.randint(1, 5))]
        words = rng.choice(["\n", "\n\n", "\n \n"]).join(parts).split(" ")
        texts.append(" ".join(w for w in words if rng.random() > 0.08))
    got = {}
    for r in scanned(spark, model, *texts):
        row = (r.line, r.last_line, r.family, round(r.score, 6), round(r.template_similarity, 6), r.confirmed)
        got.setdefault(r.doc_id, []).append(row)
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(w) for i, t in enumerate(texts) if (w := plain_scan(model, t))}


def test_no_python_on_the_executors(spark, model):
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    plan = licences.scan_licences(docs, model=model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
