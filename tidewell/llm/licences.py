"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a run of lines that are not blank; its lines are classified by themselves as well,
since a notice may stand on one line of a paragraph or be wrapped over several. Features are the word
n-grams (1 to 3 words) shared with the licence templates; single words count only as
signal words: words of the notices, and long words of the licence bodies, that the background sample of
the corpus does not use. A multinomial logistic regression with an unknown class
is trained on the templates, on shortened variants of them and on the background sample;
a part set apart fits the temperature. A paragraph without a signal word is unknown. Everything that
touches the corpus is DataFrame functions: n-grams are joined with a table of weights, word pairs
with a table of the templates' pairs, both as small as the templates, and summed.
"""

from __future__ import annotations

import random
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import table
from tidewell.scratch import written

# Usual notices of each licence family.
NOTICES = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPL version 3.",
    ],
    "gpl-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Licensed under the GNU General Public License, version 2.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "isc": ["Licensed under the ISC license.", "SPDX-License-Identifier: ISC"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved."],
}
# Paragraphs of the licence texts.
BODIES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "apache-2.0": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "bsd": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "mpl-2.0": [
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
}
TEMPLATES = {family: notices + BODIES.get(family, []) for family, notices in NOTICES.items()}
UNKNOWN = "unknown"
#: Bound of the background sample: documents whose lines are looked at.
BACKGROUND_ROWS = 200
#: Texts longer than this give no background lines.
BACKGROUND_CHARS = 20_000
GRAMS, LEAST_LETTERS, LONG_LETTERS = 3, 3, 10
CERTAIN, LEAST_ALIKE = 0.5, 0.6
SPLIT = "[^a-z0-9]+"


def words(text: str) -> list[str]:
    """Lower-cased runs of a-z and 0-9: the driver's twin of :func:`_words`."""
    cleaned = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return cleaned.split()


def grams(tokens: list[str]) -> set[str]:
    return {" ".join(tokens[i : i + n]) for n in range(1, GRAMS + 1) for i in range(len(tokens) - n + 1)}


def variants(text: str, rng: random.Random) -> list[list[str]]:
    """Training forms of a template: whole, without a word or two, inside other words."""
    tokens = words(text)
    out = [tokens]
    for _ in range(12):
        kept = [t for t in tokens if rng.random() > 0.12]
        out.append(kept or tokens)
    return out


class Model:
    """Signal words, weights by n-gram and class, and the calibration."""

    def __init__(self, background: list[str], seed: int = 3):
        rng = random.Random(seed)
        known = {w for line in background for w in words(line)}
        self.classes = [UNKNOWN, *TEMPLATES]
        tokens = {w for lines in TEMPLATES.values() for t in lines for w in words(t)}
        telling = {w for lines in NOTICES.values() for t in lines for w in words(t) if len(w) >= LEAST_LETTERS}
        telling |= {w for lines in BODIES.values() for t in lines for w in words(t) if len(w) >= LONG_LETTERS}
        self.signals = sorted(w for w in telling - known if w.isalpha())
        signal = set(self.signals)
        held = {g for lines in TEMPLATES.values() for t in lines for g in grams(words(t))}
        self.grams = sorted(g for g in held if " " in g or g in signal)
        at = {g: i for i, g in enumerate(self.grams)}
        rows = [(v, k) for k, (_, lines) in enumerate(TEMPLATES.items(), 1) for t in lines for v in variants(t, rng)]
        # Unknown: background lines, and templates' words out of order or by themselves.
        rows += [(words(line), 0) for line in background]
        loose = sorted(tokens)
        rows += [(rng.sample(loose, rng.randint(1, 4)), 0) for _ in range(300)]
        x = np.zeros((len(rows), len(self.grams)), np.float32)
        for i, (row, _) in enumerate(rows):
            for g in grams(row):
                if g in at:
                    x[i, at[g]] = 1
        y = np.array([k for _, k in rows])
        apart = np.arange(len(rows)) % 5 == 4
        self.weights, self.bias = self._fit(x[~apart], y[~apart])
        self.temperature = self._calibrate(x[apart] @ self.weights + self.bias, y[apart])

    def _fit(self, x, y, rounds: int = 300, rate: float = 1.0, decay: float = 1e-4):
        w, b = np.zeros((x.shape[1], len(self.classes)), np.float32), np.zeros(len(self.classes), np.float32)
        goal = np.eye(len(self.classes), dtype=np.float32)[y]
        # Each class counts alike, however many rows stand for it.
        share = 1 / np.bincount(y, minlength=len(self.classes)).clip(1)[y]
        share = (share / share.sum())[:, None].astype(np.float32)
        vw, vb = np.zeros_like(w), np.zeros_like(b)
        for _ in range(rounds):
            z = x @ w + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            error = share * (p / p.sum(axis=1, keepdims=True) - goal)
            vw, vb = 0.9 * vw - rate * (x.T @ error + decay * w), 0.9 * vb - rate * error.sum(axis=0)
            w, b = w + vw, b + vb
        # Weights of no account go: the model stays sparse.
        return np.where(np.abs(w) < 1e-3, 0.0, w), b

    @staticmethod
    def _calibrate(z, y) -> float:
        def loss(t):
            s = z / t
            top = s.max(axis=1, keepdims=True)
            return float((np.log(np.exp(s - top).sum(axis=1)) + top[:, 0] - s[np.arange(len(y)), y]).mean())

        return float(min(np.geomspace(0.2, 5, 41), key=loss))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Learns from the templates and from lines of at most ``BACKGROUND_ROWS`` texts
    that hold no licence word; the least hashes of the text choose them, each text once. The driver
    sees hashes, and then those texts, each of ``BACKGROUND_CHARS`` at most."""
    text = docs[text_col].cast("string")
    stop = F.lower(text).rlike("licen[sc]|copyright|rights reserved|spdx|permission|creative commons|redistribut")
    plain = docs.where(text.isNotNull() & (F.length(text) < BACKGROUND_CHARS) & ~stop)
    plain = plain.select(text.alias("text"), F.xxhash64(text).alias("hash"))
    chosen = [r.hash for r in plain.select("hash").distinct().orderBy("hash").limit(BACKGROUND_ROWS).collect()]
    sample = plain.where(F.col("hash").isin(chosen)).groupBy("hash").agg(F.max("text").alias("text"))
    lines = [line for row in sample.collect() for line in row["text"].split("\n")] if chosen else []
    return Model(sorted(set(lines)))


def _runs(n: int):
    starts = F.slice("w", 1, F.greatest(F.size("w") - (n - 1), F.lit(0)))
    return F.transform(starts, lambda _, i: F.array_join(F.slice("w", i + 1, n), " "))


def _words(text):
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def _paragraphs(text):
    """Runs of lines that are not blank: (start, end, lines) each, from 0, end inclusive."""

    def marked(lines):
        blank = F.transform(lines, lambda x: F.trim(F.translate(x, "\t\r\x0b\x0c", "    ")) == "")
        return F.struct(lines.alias("lines"), blank.alias("blank"))

    def cut(h):
        n, at = F.size(h["lines"]), F.sequence(F.lit(0), F.size(h["lines"]) - 1)
        off = lambda i: (i < 0) | (i >= n) | F.coalesce(F.get(h["blank"], i), F.lit(True))
        starts = F.filter(at, lambda i: ~off(i) & off(i - 1))
        ends = F.filter(at, lambda i: ~off(i) & off(i + 1))
        return F.zip_with(
            starts,
            ends,
            lambda a, b: F.struct(a.alias("start"), b.alias("end"), F.slice(h["lines"], a + 1, b - a + 1).alias("lines")),
        )

    # As an array's element the lines are made once.
    return F.flatten(F.transform(F.transform(F.array(F.split(text, "\n", -1)), marked), cut))


def _units(narrow: DataFrame, model: Model) -> DataFrame:
    """Paragraphs of several lines (``k`` is -1) and lines (``k`` from 0 in their paragraph ``pid``)
    that hold a signal word, written: (pid, k, doc_id, line, last_line, w)."""
    signals = F.array(*map(F.lit, model.signals))
    # The lower-cased text is an array's element, so that it is made once for all stems.
    stems = _stems(model.signals)
    some = F.exists(F.array(F.lower("text")), lambda low: reduce(or_, (F.contains(low, F.lit(s)) for s in stems)))
    found = narrow.where("text is not null").where(some).select("doc_id", F.explode(_paragraphs(F.col("text"))).alias("p"))
    found = found.select("doc_id", "p.*", _words(F.array_join("p.lines", " ")).alias("w")).where(F.arrays_overlap("w", signals))
    # The number of a paragraph is fixed by writing it: equal rows stay apart.
    found = written(found.withColumn("pid", F.monotonically_increasing_id()), "licence-paragraphs")
    several = found.where("end > start").select(
        "pid", F.lit(-1).alias("k"), "doc_id", F.col("start").alias("line"), F.col("end").alias("last_line"), "w"
    )
    lines = found.select("pid", "doc_id", "start", F.posexplode("lines").alias("k", "text")).select(
        "pid", "k", "doc_id", (F.col("start") + F.col("k")).alias("line"), (F.col("start") + F.col("k")).alias("last_line"),
        _words(F.col("text")).alias("w"),
    ).where(F.arrays_overlap("w", signals))
    return written(several.unionByName(lines), "licence-units")


def _scores(units: DataFrame, model: Model) -> DataFrame:
    """(pid, k, p): chances of the classes, unknown first, of units that share an n-gram with a template."""
    spark, names = units.sparkSession, [f"w{i}" for i in range(len(model.classes))]
    rows = [(g, *map(float, row)) for g, row in zip(model.grams, model.weights, strict=True)]
    weights = spark.createDataFrame(rows, "gram string, " + ", ".join(f"{n} double" for n in names))
    runs = F.array_distinct(F.flatten(F.array(*(_runs(n) for n in range(1, GRAMS + 1)))))
    shared = units.select("pid", "k", F.explode(runs).alias("gram")).join(F.broadcast(weights), "gram")
    sums = shared.groupBy("pid", "k").agg(*(F.sum(n).alias(n) for n in names))
    z = F.array(*((F.col(n) + float(b)) / model.temperature for n, b in zip(names, model.bias, strict=True)))
    e = sums.select("pid", "k", z.alias("z")).withColumn("e", F.transform("z", lambda z: F.exp(z - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, b: a + b)
    return e.select("pid", "k", F.transform("e", lambda x: x / total).alias("p"))


def _similarities(units: DataFrame) -> DataFrame:
    """(pid, k, alike): for each family the largest share of a template's word pairs in the unit."""
    spark, families = units.sparkSession, list(TEMPLATES)
    rows = []
    for family, texts in TEMPLATES.items():
        for t, template in enumerate(texts):
            pairs = template_pairs(template)
            rows += [(families.index(family), t, pair, 1.0 / len(pairs)) for pair in sorted(pairs)]
    known = spark.createDataFrame(rows, "family int, template int, pair string, share double")
    met = units.select("pid", "k", F.explode(_pairs(F.col("w"))).alias("pair")).join(F.broadcast(known), "pair")
    shares = met.groupBy("pid", "k", "family", "template").agg(F.sum("share").alias("share"))
    best = [F.max(F.when(F.col("family") == i, F.col("share"))) for i in range(len(families))]
    return shares.groupBy("pid", "k").agg(F.array(*(F.coalesce(b, F.lit(0.0)) for b in best)).alias("alike"))


SCHEMA = (
    "doc_id long, line int, last_line int, family string, score double, template_similarity double, confirmed boolean"
)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, line, last_line, family, score, template_similarity, confirmed) of the licence lines
    and paragraphs.

    Lines count from 0, ``last_line`` is inclusive. A line is listed when its chance of being unknown is under one
    half; its family is ``unknown`` when no family reaches one half. ``confirmed``: some
    template of the family shares ``LEAST_ALIKE`` of its word pairs with it, no template of another
    family more, and the family is not unknown. A paragraph of several lines is listed instead of
    its lines when it is confirmed with a larger share than any of them. Null and empty texts have
    no lines to list, a null id is reported as null, repeated rows are listed each; texts are
    read whole, a long one is one row until its paragraphs are cut; other columns are not read.
    """
    model = model or train(docs, text_col)
    text = docs[text_col].cast("string")
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    if not model.signals:
        return narrow.sparkSession.createDataFrame([], SCHEMA)
    units = _units(narrow, model)
    named = units.drop("w").join(_scores(units, model), ["pid", "k"]).join(_similarities(units), ["pid", "k"], "left")
    named = named.where(F.get("p", F.lit(0)) < CERTAIN)
    chances = F.slice("p", 2, len(model.classes))
    named = named.withColumn("score", F.array_max(chances))
    named = named.withColumn("place", (F.array_position(chances, F.col("score")) - 1).cast("int"))
    similarity = F.coalesce(F.get("alike", F.col("place")), F.lit(0.0))
    most = F.coalesce(F.array_max("alike"), F.lit(0.0))
    named = named.withColumn("similarity", F.round(similarity, 9))
    sure = (F.col("similarity") >= LEAST_ALIKE) & (F.col("similarity") >= F.round(most, 9)) & (F.col("score") >= CERTAIN)
    named = named.withColumn("confirmed", sure)
    here, whole = Window.partitionBy("pid"), F.col("k") < 0
    shares = {
        name: F.coalesce(F.max(F.when(F.col("confirmed") & of, F.col("similarity"))).over(here), F.lit(-1.0))
        for name, of in (("in_whole", whole), ("in_line", ~whole))
    }
    wins = F.col("in_whole") > F.col("in_line")
    listed = named.withColumns(shares).where((whole & wins & F.col("confirmed")) | (~whole & ~wins))
    family = F.when(F.col("score") >= CERTAIN, F.get(F.array(*map(F.lit, model.classes[1:])), F.col("place")))
    return listed.select(
        "doc_id",
        F.col("line").cast("int").alias("line"),
        F.col("last_line").cast("int").alias("last_line"),
        F.coalesce(family, F.lit(UNKNOWN)).alias("family"),
        F.round("score", 9).alias("score"),
        F.col("similarity").alias("template_similarity"),
        "confirmed",
    )


def _pairs(w):
    """Two neighbouring words each; a single word stands for itself."""
    pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.when(F.size(w) > 1, pairs).otherwise(w))


def template_pairs(template: str) -> set[str]:
    """The driver's twin of :func:`_pairs`."""
    tokens = words(template)
    return {f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False)} or set(tokens)


def _stems(signals: list[str]) -> list[str]:
    """Signal words that hold no other signal word: a text has one of these or none at all."""
    return [w for w in signals if not any(v != w and v in w for v in signals)]


def op9_licences(spark, folder):
    return scan_licences(table(spark, folder, "documents"))
