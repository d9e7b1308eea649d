"""op1, op5 and op7: held-out accuracy and edge cases."""

import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import lang_id, licenses
from tidemark.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lang_id.op1(spark, docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(got) == docs.count() and (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_of_odd_texts(spark, make):
    docs = make([(1, None), (2, ""), (3, "12 $ 3"), (None, "the of and"), (4, "that it " * 20000), (5, "\x00é")])
    net = lang_id.train(*lang_id.to_windows(np.frombuffer(b"the of and der die das", np.uint8), np.array([0, 10, 22]))[:1],
                        np.array([0, 1]), ["en", "de"])
    got = {x.doc_id: x for x in lang_id.language_id(docs, net).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3))
    assert got[4].lang_pred in ("en", "de") and len(got) == 6
    assert {x.lang_pred for x in lang_id.language_id(docs, None).collect()} == {"und"}
    assert lang_id.language_id(make([]), net).collect() == []
    assert lang_id.fit(make([(1, "a")]).withColumn("lang", F.lit(None).cast("string"))) is None


def test_every_language_is_learned(spark):
    """More languages than any fixed number of classes, each with words of its own."""
    r = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in r.integers(0, 26, 4)) for _ in range(130)]
    rows = [(k * 100 + i, " ".join([w] * 12), f"l{k:03d}") for k, w in enumerate(words) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = lang_id.fit(docs)
    assert len(net.langs) == 130
    got = lang_id.language_id(docs, net).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert got.lang_pred.nunique() > 110 and (got.lang_pred == got.lang).mean() > 0.8


def test_a_corpus_without_labels_stays(spark, make):
    docs = make([(1, "some text"), (2, None), (3, "")]).withColumn("lang", F.lit(None).cast("string"))
    net = lang_id.fit(docs)
    assert net is None and sorted(x.doc_id for x in lang_id.known_language(docs, net, "text", "lang").collect()) == [1, 2, 3]


def test_quality_on_held_out_rows(spark):
    got = q.op5(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_quality_edges(spark, make):
    docs = make([(1, None), (2, ""), (None, "x"), (1, "a b c d e f")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {x.score for x in q.quality(docs, q.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    assert {x.predicted for x in q.quality(docs, q.fit(docs, one)).collect()} == {1}
    assert q.quality(make([]), 0.5).collect() == []


def test_indicators_stay_within_texts():
    a, b = b"abcabc xyz", b"word word word word two"
    both = np.frombuffer(a + b, np.uint8)
    got = [x.tolist() for x in q.indicators(both, np.array([0, len(a), len(a) + len(b), len(a) + len(b)]))]
    alone = [next(q.indicators(np.frombuffer(x, np.uint8), np.array([0, len(x)]))).tolist() for x in (a, b)]
    assert got == [*alone, []]
    assert {p - (1 << q.BITS) for p in alone[1] if p >= 1 << q.BITS} == {0, 1, 2}


def brute_paragraphs(text):
    lines, cue, runs = re.split("\r?\n", text or ""), re.compile(licenses.CUE), []
    cues = [bool(cue.search(x)) for x in lines]
    short = [x.strip(" ") != "" and len(x) <= licenses.WRAPPED for x in lines]
    take = set()
    for c, is_cue in enumerate(cues):
        if not is_cue:
            continue
        take.add(c)
        if short[c]:
            for i in range(c + 1, min(c + 1 + licenses.AFTER, len(lines))):
                if not short[i]:
                    break
                take.add(i)
            if c and short[c - 1]:
                take.add(c - 1)
    for i in sorted(take):
        if runs and i - runs[-1][1] == 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return [(a, " ".join(lines[a:b + 1])) for a, b in runs]


def brute_scan(docs, model):
    out = []
    for doc, text in docs:
        for k, line in brute_paragraphs(text):
            words = licenses.words_of(line)
            z = np.array(model.bias)
            for f in licenses._features(words):
                z = z + np.array(model.weights.get(f, [0.0] * len(z)))
            p = np.exp(z / model.temperature)
            p /= p.sum()
            family = model.families[int(p.argmax())]
            if family != licenses.UNKNOWN and p.max() >= model.threshold:
                like = licenses.likeness_of(words, family)
                own = any(f" {key} " in f" {' '.join(words)} " for key in licenses.TEMPLATES[family][1])
                out.append((str(doc), k, family, round(float(p.max()), 4), round(like, 4), like >= licenses.CONFIRM and own))
    return sorted(out)


def test_licence_scan_equals_brute_force(spark, make, small):
    model = licenses.fit(small)
    docs = [tuple(x) for x in small.collect()] + [
        (9001, None), (9002, ""), (None, "Released under the MIT License"), (9003, "no\n\nCopyright 1999 X. All rights reserved.\n"),
        (9003, "the version of this file is licensed and permitted for the public"), (9004, "the license " * 30000),
        (9005, "MIT License\nx\nMIT License\n \nMIT License\r\n\r\nlicense\na\nb\nlicense")]
    docs += [(9100 + i, s) for i, s in enumerate(s for v, _ in licenses.TEMPLATES.values() for s in v)]
    got = licenses.scan_licenses(make(docs), model).collect()
    assert sorted((str(x.doc_id), x.paragraph, x.family, round(x.probability, 4), round(x.likeness, 4), x.confirmed)
                  for x in got) == brute_scan(docs, model)
    assert licenses.scan_licenses(make([]), model).collect() == []
    plan = licenses.scan_licenses(small, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_licence_scan_judges_lines_without_licence_words(make, small):
    """No line of the first two holds licence words as a whole."""
    docs = [(1, "Title\n\nRedistribution and\nuse in source and binary forms, with or without\nmodification, are permitted provided that the\n"
                "following conditions are met\n\nend"),
            (2, "x\n\nPermission is\nhereby granted, free of charge, to any person obtaining a copy of\nthis software and associated "
                "documentation files, to deal in the\nSoftware without restriction"),
            (3, "plain words\n\nand more")]
    every = {(r.doc_id, r.paragraph) for r in licenses.paragraphs(make(docs), every=True).collect()}
    assert every == {(1, 0), (1, 2), (1, 7), (2, 0), (2, 2), (3, 0), (3, 2)}
    rows = licenses.scan_licenses(make(docs), licenses.fit(small)).collect()
    assert {(r.doc_id, r.paragraph, r.family, r.confirmed) for r in rows} == {(1, 2, "bsd", True), (2, 2, "mit", True)}


def test_licence_wording_is_tested_once_a_text_and_line(make, small):
    """A text without licence words is left out only if no line of it can be confirmed; no line is built for every word."""
    docs = [(1, "a\n\nRedistribution -\r\nAND use in source\n\nand binary forms."), (2, "all (rights\nreserved"), (3, "É gnu/GPL"),
            (4, "overall rights reserved, the software of the authors"), (5, "mit licenses"), (6, ""), (7, None)]
    got = make(docs).select("doc_id", licenses.has_wording(F.col("text")).alias("has")).collect()
    assert {r.doc_id: r.has for r in got} == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: None}
    plan = licenses.scan_licenses(make(docs), licenses.fit(small))._jdf.queryExecution().executedPlan().toString()
    assert "Contains(lower(" not in plan


#: Notices in other words or line breaks than the templates', and texts of no family here.
NOTICES = [
    ("mit", "Copyright (c) 2019 Jane Doe\n\nPermission is hereby granted, free of charge, to any person\nobtaining a copy of this "
            "software and associated documentation\nfiles (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "MIT License"), ("mit", "The code is released under the MIT License."), ("mit", "// SPDX-License-Identifier: MIT"),
    ("gpl", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public "
            "License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 2."), ("gpl", "# SPDX-License-Identifier: GPL-2.0-or-later"),
    ("lgpl", "This library is free software; you can redistribute it under the terms of the\nGNU Lesser General Public License as "
             "published by the Free Software Foundation"), ("lgpl", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3"), ("agpl", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance "
                   "with the License.\nYou may obtain a copy of the License at"), ("apache-2.0", "/* SPDX-License-Identifier: Apache-2.0 */"),
    ("bsd", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
            "following conditions\nare met:"), ("bsd", "SPDX-License-Identifier: BSD-2-Clause"), ("isc", "SPDX-License-Identifier: ISC"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted"),
    ("zlib", "SPDX-License-Identifier: Zlib"), ("epl", "SPDX-License-Identifier: EPL-2.0"),
    ("epl", "made available under the terms of the Eclipse Public License 2.0"), ("mpl", "SPDX-License-Identifier: MPL-2.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed"),
    ("unlicense", "This is free and unencumbered software released into the public domain."), ("unlicense", "SPDX-License-Identifier: Unlicense"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."), ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."), ("cc0", "SPDX-License-Identifier: CC0-1.0"), ("boost", "SPDX-License-Identifier: BSL-1.0"),
    ("odbl", "made available under the Open Database License"), ("wtfpl", "SPDX-License-Identifier: WTFPL"),
    ("reserved", "Copyright 2024 Some Company. All rights reserved."),
    (None, "SPDX-License-Identifier: Python-2.0"), (None, "SPDX-License-Identifier: OFL-1.1"), (None, "Licensed under the Artistic License 2.0"),
    (None, "She has a driving licence for lorries."), (None, "The copyright of the song belongs to the band."),
    (None, "He had the licence to fish and the permission to use the boat."), (None, "A wildebeest is also called a gnu."),
]


def test_notices_are_found_once_and_none_is_taken_for_another(spark, make, small):
    model = licenses.fit(small)
    rows = licenses.scan_licenses(make([(i, t) for i, (_, t) in enumerate(NOTICES)]), model).filter("confirmed").collect()
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r.family)
    wrong = [(NOTICES[i], f) for i, f in found.items() if f != [NOTICES[i][0]]]
    assert wrong == []
    missed = [t for i, (f, t) in enumerate(NOTICES) if f and i not in found]
    assert len(missed) <= 0.1 * sum(f is not None for f, _ in NOTICES), missed


def test_every_template_holds_a_cue():
    assert all(re.search(licenses.CUE, s) for statements, _ in licenses.TEMPLATES.values() for s in statements)
