"""Licence scans: a trained paragraph classifier, applied with DataFrame functions only.

A paragraph is a line that holds licence words (``CUES``) with the short lines around it
(one before it, three after it, none across a blank line), and what such lines join to,
so a notice that is wrapped over lines is judged as a whole.  The other lines are scanned
too: each run of short ones and each long one is a paragraph, so no part of a text goes
unjudged for want of licence words in one line; since the model's threshold comes from
paragraphs with licence words, such a paragraph counts if it is confirmed.  Its features are the word unigrams and bigrams that the templates
hold.  A softmax regression over licence families and the class ``unknown`` is trained
on the templates, with words left out, against statements of other licences, ordinary
sentences and paragraphs of the corpus.  Its probabilities are calibrated (temperature,
and the least probability at which held-out ordinary paragraphs are taken for a licence
one time in a thousand).  A prediction is confirmed by comparison with the family's
templates: enough of a template's word pairs must be there, and wording that only this
family has.

Training works on a bounded sample on the driver; of the corpus' paragraphs only the
templates' features come there.  Scanning is built-in functions only and scores each
paragraph in its row: no shuffle, nothing written between.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts

#: How the licences are commonly stated, and wording that is one family's own.
TEMPLATES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "agpl": (("Licensed under the GNU Affero General Public License, version 3.",
              "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
              "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
              "SPDX-License-Identifier: AGPL-3.0-or-later"), ("affero general public license", "identifier agpl", "gnu agpl")),
    "apache-2.0": (("Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004",
                    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                    "compliance with the License. You may obtain a copy of the License at",
                    "SPDX-License-Identifier: Apache-2.0"), ("apache license", "identifier apache")),
    "boost": (("Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"),
              ("boost software license", "identifier bsl")),
    "bsd": (("Released under the BSD 3-Clause License.", "Licensed under the BSD license.",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met", "SPDX-License-Identifier: BSD-3-Clause"),
            ("bsd license", "bsd 3 clause", "bsd 2 clause", "identifier bsd", "redistribution and use in source and binary forms")),
    "cc-by": (("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
               "SPDX-License-Identifier: CC-BY-4.0"),
              ("cc by 4", "cc by 3", "creative commons attribution 4", "creative commons attribution 3")),
    "cc-by-nc": (("Licensed under CC BY-NC 4.0.",
                  "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                  "SPDX-License-Identifier: CC-BY-NC-4.0"), ("cc by nc", "attribution noncommercial")),
    "cc-by-sa": (("Licensed under CC BY-SA 4.0.",
                  "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                  "SPDX-License-Identifier: CC-BY-SA-4.0"), ("cc by sa", "attribution sharealike")),
    "cc0": (("Released into the public domain under CC0 1.0.", "No rights reserved under CC0 1.0 Universal.",
             "SPDX-License-Identifier: CC0-1.0"), ("cc0", "cc0 1")),
    "epl": (("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
             "Licensed under the Eclipse Public License, version 2.0.", "SPDX-License-Identifier: EPL-2.0"),
            ("eclipse public license", "identifier epl")),
    "gpl": (("This work is licensed under the GNU General Public License, version 3.",
             "Licensed under the GNU GPL, version 2 or later.",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
             "SPDX-License-Identifier: GPL-3.0-only"), ("gnu general public license", "identifier gpl", "gnu gpl")),
    "isc": (("Released under the ISC License.", "SPDX-License-Identifier: ISC",
             "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
            ("isc license", "identifier isc", "for any purpose with or without fee is hereby granted")),
    "lgpl": (("Licensed under the GNU Lesser General Public License, version 2.1.",
              "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
              "Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
              "SPDX-License-Identifier: LGPL-2.1-or-later"), ("lesser general public license", "identifier lgpl", "gnu lgpl")),
    "mit": (("Released under the MIT License.", "Licensed under the MIT license.", "MIT License", "The MIT License (MIT)",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files, to deal in the Software without restriction",
             "SPDX-License-Identifier: MIT"),
            ("mit license", "identifier mit", "free of charge to any person obtaining a copy of this software")),
    "mpl": (("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
             "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
            ("mozilla public license", "identifier mpl")),
    "odbl": (("This database is made available under the Open Database License.", "SPDX-License-Identifier: ODbL-1.0"),
             ("open database license", "identifier odbl")),
    "reserved": (("All rights reserved.", "Copyright 2020 the authors. All rights reserved."), ("all rights reserved",)),
    "unlicense": (("This is free and unencumbered software released into the public domain.", "Released under the Unlicense.",
                   "SPDX-License-Identifier: Unlicense"),
                  ("free and unencumbered software released into the public domain", "the unlicense", "identifier unlicense")),
    "wtfpl": (("Licensed under the WTFPL, version 2.", "SPDX-License-Identifier: WTFPL"), ("wtfpl",)),
    "zlib": (("Released under the zlib license.", "SPDX-License-Identifier: Zlib",
              "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
              "liable for any damages arising from the use of this software."),
             ("zlib license", "identifier zlib", "in no event will the authors be held liable for any damages")),
}
#: Statements of no family here, and ordinary sentences that share words with licences.
ORDINARY = ("SPDX-License-Identifier: Foo-1.0", "SPDX-License-Identifier: LicenseRef-Acme", "Licensed under the Acme License.",
            "Licensed under the terms of the Acme license, version 2.0.", "Released under the Foo License.", "the license",
            "see the license file for the terms", "this license", "a copy of the license", "licensed software",
            "the driver was licensed to carry goods", "a work of this version is in the public library",
            "he had permission to use the source", "the general public was free to copy the list", "her driving license was old",
            "under the terms of the contract", "the commons and the creative arts", "this file is a copy of the software",
            "with or without the authors", "she reserved all the seats and the rights", "an apache leader of that version",
            "copyright law", "the copyright of the book", "a warranty of two years", "the redistribution of land",
            "permission is granted to enter", "published in the public domain")
#: Words or word parts of which every licence statement has one (any case).
CUES = ("licen[sc]e", "licensing", "copyright", "spdx", "redistribution and use", "permission is hereby", "permission to use",
        "public domain", "rights reserved", r"\bcc0\b", r"\bcc by\b", r"\bwtfpl\b", "express or implied", r"\bgnu\b", r"\bgpl\b")
#: Lines of at most this many characters may be parts of a wrapped notice; how many of them
#: may follow a line with a licence word.
WRAPPED, AFTER = 100, 3
#: Kinds of lines: parts of no paragraph, of one with licence words, other short lines and long ones.
BLANK, NOTICE, PLAIN, LONG = range(4)
CUE = "(?i)" + "|".join(CUES)
UNKNOWN = "unknown"
#: Documents whose paragraphs the unknown class learns from (about as many are drawn), share of a template's
#: word pairs that confirms, share of ordinary paragraphs that may pass.
SAMPLE, CONFIRM, PASS, SEED = 20_000, 0.6, 0.001, 3
#: Weights below this are left out of the model; training steps, rate and penalty.
LEAST_WEIGHT, STEPS, RATE, PENALTY = 0.02, 400, 10.0, 1e-4


class Model(NamedTuple):
    """Families (``unknown`` last), weights of each feature, bias, temperature, threshold."""

    families: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    threshold: float


#: What stands between words: everything but ASCII letters, digits and signs beyond ASCII.
BETWEEN = r"[^a-z0-9\x80-\uffff]+"


def words_of(line: str) -> list[str]:
    """The same words as ``paragraph_words``."""
    return [w for w in re.split(BETWEEN, line.lower()) if w]


def paragraph_words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), BETWEEN), lambda w: w != "")


def pairs_of(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def _features(words: list[str]) -> set[str]:
    return {*words, *pairs_of(words)}


def _pairs(words: Column) -> Column:
    following = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    return F.filter(F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b)), lambda p: p.isNotNull())


def vocabulary() -> list[str]:
    """Features of the templates."""
    return sorted({f for statements, _ in TEMPLATES.values() for s in statements for f in _features(words_of(s))})


def likeness_of(words: list[str], family: str) -> float:
    """Greatest share of a template's word pairs that the words hold in order."""
    have = set(pairs_of(words))
    wanted = [set(pairs_of(words_of(s))) for s in TEMPLATES[family][0]]
    return max((len(p & have) / len(p) for p in wanted if p), default=0.0)


def has_wording(line: Column) -> Column:
    """Whether a line, or a text of lines, holds the own wording of any family."""
    phrases = sorted({k for _, own in TEMPLATES.values() for k in own})
    longest = sorted({max(k.split(), key=len) for k in phrases})
    wording = " (?:" + "|".join(re.escape(k) for k in phrases) + ") "

    def holds(low: Column) -> Column:  # plain substrings first, of each wording its longest word
        plain = F.concat(F.lit(" "), F.regexp_replace(low, BETWEEN, " "), F.lit(" "))
        return reduce(or_, [F.contains(low, F.lit(w)) for w in longest]) & plain.rlike(wording)

    # an array of one: the optimizer would put a column's expression in the place of each of its uses
    return F.exists(F.array(F.lower(line)), holds)


def train(paragraphs: list[set[str]]) -> Model:
    """Softmax regression on the templates (whole, with each word left out, and in halves)
    against ``paragraphs`` (sets of the vocabulary's features) and ORDINARY; calibrated
    on every fourth one."""
    families, vocab = [*sorted(TEMPLATES), UNKNOWN], vocabulary()
    rows, target, part = [], [], []
    for k, family in enumerate(families[:-1]):
        for statement in TEMPLATES[family][0]:
            w = words_of(statement)
            own = [w] + [w[:j] + w[j + 1:] for j in range(len(w)) if len(w) > 4]
            for i, x in enumerate(own + ([w[:len(w) // 2], w[len(w) // 2:]] if len(w) > 16 else [])):
                rows.append(_features(x))
                target.append(k)
                part.append(i % 4 == 3)
    pairs = [set(pairs_of(words_of(s))) for statements, _ in TEMPLATES.values() for s in statements]
    plain = [p for p in paragraphs if max(len(s & p) / len(s) for s in pairs) < CONFIRM / 2]
    for i, x in enumerate([_features(words_of(s)) for s in ORDINARY] * 5 + plain):
        rows.append(x)
        target.append(len(families) - 1)
        part.append(i >= 5 * len(ORDINARY) and i % 4 == 3)
    place = {f: i for i, f in enumerate(vocab)}
    x = np.zeros((len(rows), len(vocab)), np.float32)
    for i, r in enumerate(rows):
        x[i, [place[f] for f in r if f in place]] = 1
    y, held = np.array(target), np.array(part)
    weight = 1.0 / np.bincount(y, minlength=len(families))[y]
    keep = ~held
    w, b = np.zeros((len(vocab), len(families))), np.zeros(len(families))
    onehot = np.eye(len(families))
    for _ in range(STEPS):
        z = x[keep] @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        g = (p / p.sum(1, keepdims=True) - onehot[y[keep]]) * weight[keep, None] / len(families)
        w -= RATE * (x[keep].T @ g + PENALTY * w)
        b -= RATE * g.sum(0)
    w = np.round(w - w[:, -1:], 4)  # relative to unknown
    b = np.round(b - b[-1], 4)
    w[np.abs(w).max(1) < LEAST_WEIGHT] = 0
    z = x[held] @ w + b
    best = (np.inf, 1.0)
    for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8):
        q = z / t
        q = q - q.max(1, keepdims=True)
        loss = -(weight[held] * (q[np.arange(len(q)), y[held]] - np.log(np.exp(q).sum(1)))).sum()
        best = min(best, (loss, t))
    q = np.exp(z / best[1] - (z / best[1]).max(1, keepdims=True))
    q /= q.sum(1, keepdims=True)
    plain_top = q[y[held] == len(families) - 1][:, :-1].max(1) if (y[held] == len(families) - 1).any() else np.zeros(1)
    threshold = float(max(0.5, np.quantile(plain_top, 1 - PASS)))
    used = np.flatnonzero(np.abs(w).max(1) > 0)
    return Model(families, {vocab[i]: w[i].tolist() for i in used}, b.tolist(), best[1], round(threshold, 4))


def paragraphs(docs: DataFrame, every: bool = False) -> DataFrame:
    """``doc_id``, ``paragraph`` (number of its first line), ``line`` (its lines, joined by blanks) and
    ``cued`` (true) of every paragraph with licence words; with ``every`` also of what is left of the text:
    runs of short lines, and each long line (``cued`` is false), so each line that is not blank is in one paragraph."""
    some = texts(docs).withColumn("has", F.col("text").rlike(CUE))
    some = (some if every else some.filter("has")).withColumn("lines", F.split("text", "\r?\n"))
    some = some.withColumn("marks", F.transform("lines", lambda x: F.struct(
        F.when(F.col("has"), x.rlike(CUE)).otherwise(False).alias("cue"), (F.trim(x) != "").alias("full"),
        ((F.trim(x) != "") & (F.length(x) <= WRAPPED)).alias("short"))))

    def mark(i: Column, name: str) -> Column:
        return F.when(i >= 0, F.coalesce(F.get(F.col("marks"), i)[name], F.lit(False))).otherwise(False)

    def kind(m: Column, i: Column) -> Column:
        near, through = mark(i + 1, "cue") & mark(i + 1, "short"), F.lit(True)
        for k in range(1, AFTER + 1):
            through = through & mark(i - k, "short")
            near = near | (through & mark(i - k, "cue"))
        belongs = m["cue"] | (F.col("has") & m["short"] & near)
        rest = F.when(m["short"], F.lit(PLAIN)).when(m["full"], F.lit(LONG)).otherwise(F.lit(BLANK)) if every else F.lit(BLANK)
        return F.when(belongs, F.lit(NOTICE)).otherwise(rest)

    def first(k: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(F.col("kinds"), i - 1)).otherwise(F.lit(BLANK))
        return F.when((k != before) | (k == LONG), F.struct(i.alias("start"), k.alias("kind")))

    some = some.withColumn("kinds", F.transform("marks", kind))
    some = some.withColumn("firsts", F.filter(F.transform("kinds", first), lambda x: x.isNotNull()))
    ends = F.transform("firsts", lambda x, j: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), F.coalesce(
        F.get(F.col("firsts"), j + 1)["start"], F.size("lines")).alias("end")))
    runs = some.select("doc_id", "lines", F.explode(F.filter(ends, lambda x: x["kind"] != BLANK)).alias("run"))
    return runs.select("doc_id", F.col("run.start").alias("paragraph"), (F.col("run.kind") == NOTICE).alias("cued"), F.array_join(
        F.slice("lines", F.col("run.start") + 1, F.col("run.end") - F.col("run.start")), " ").alias("line"))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def fit(docs: DataFrame) -> Model:
    """Train with the paragraphs of about SAMPLE documents, drawn row by row."""
    n = docs.count()
    drawn = docs.filter(F.rand(SEED) < F.lit(SAMPLE / max(n, 1)))
    words = paragraphs(drawn).withColumn("words", paragraph_words(F.col("line")))
    own = words.select(F.array_intersect(F.concat("words", _pairs(F.col("words"))), _strings(vocabulary())).alias("f")).collect()
    return train(sorted((set(r["f"]) for r in own), key=sorted))


def scan_licenses(docs: DataFrame, model: Model) -> DataFrame:
    """Licence statements in ``docs``: one row per paragraph that states one; all paragraphs are judged.

    ``doc_id``, ``paragraph`` (number of its first line, from 0), ``family``, ``probability``
    (calibrated), ``likeness`` (greatest share of a template's word pairs that stand in
    it), ``confirmed`` (likeness at least 0.6, and wording of this family alone) and ``line``
    (the paragraph).  Paragraphs of class unknown, by themselves or by the threshold,
    give no row, nor do unconfirmed ones without licence words in a line; so do null and empty texts.  Rows with repeated or null ids are scanned
    like any other; extra columns are ignored.  A document is one row of one task.
    """
    families = model.families
    features = sorted(model.weights)
    weights = F.map_from_arrays(_strings(features), F.array(*[F.array(*[F.lit(x) for x in model.weights[f]]) for f in features]))
    named = families[:-1]
    templates = F.map_from_arrays(_strings(named), F.array(*[
        F.array(*[_strings(dict.fromkeys(pairs_of(words_of(s)))) for s in TEMPLATES[f][0] if len(words_of(s)) > 1]) for f in named]))
    keys = F.map_from_arrays(_strings(named), F.array(*[_strings(TEMPLATES[f][1]) for f in named]))
    # without licence words only a confirmed paragraph counts, and none is without a family's wording: nor is then its text
    some = texts(docs).filter(F.col("text").rlike(CUE) | has_wording(F.col("text")))
    rows = paragraphs(some, every=True).filter(F.col("cued") | has_wording(F.col("line")))
    rows = rows.withColumn("words", paragraph_words(F.col("line"))).withColumn("pairs", _pairs(F.col("words")))
    said = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))

    def holds(k: Column) -> Column:
        return F.contains(said, F.concat(F.lit(" "), k, F.lit(" ")))

    known = F.array_intersect(F.concat("words", "pairs"), _strings(features))
    logits = F.aggregate(known, F.array(*[F.lit(float(b)) for b in model.bias]),
                         lambda acc, f: F.zip_with(acc, F.element_at(weights, f), lambda a, b: a + b))
    rows = rows.withColumn("z", F.transform(logits, lambda z: F.exp(z / F.lit(float(model.temperature)))))
    top = F.array_max(F.zip_with("z", _strings(families), lambda z, f: F.struct(z.alias("z"), f.alias("family"))))
    rows = rows.withColumn("top", top).withColumn("total", F.aggregate("z", F.lit(0.0), lambda a, z: a + z))
    rows = rows.select("doc_id", "paragraph", "cued", "line", "words", "pairs", F.col("top.family").alias("family"),
                       F.round(F.col("top.z") / F.col("total"), 6).alias("probability"))
    rows = rows.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))
    share = F.array_max(F.transform(F.element_at(templates, F.col("family")),
                                    lambda t: F.size(F.array_intersect(t, F.col("pairs"))) / F.size(t)))
    rows = rows.withColumn("likeness", F.round(share, 6)).withColumn("own", F.exists(F.element_at(keys, F.col("family")), holds))
    rows = rows.withColumn("confirmed", (F.col("likeness") >= CONFIRM) & F.col("own")).filter(F.col("cued") | F.col("confirmed"))
    return rows.select("doc_id", "paragraph", "family", "probability", "likeness", "confirmed", "line")


def op7(spark, docs: DataFrame) -> DataFrame:
    """``scan_licenses`` over all documents."""
    return scan_licenses(docs, fit(docs))
