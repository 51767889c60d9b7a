import random
import re
import zlib

import numpy as np
import pytest

from kwpulse.llm import licenses, toxicity
from kwpulse.llm import queries as Q

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(np.concatenate([s[y == 1], s[y == 0]]), kind="stable")
    _ = order
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in Q.op8_toxicity(spark, SF).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    lab = [(got[r[0]], r[1]) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect()]
    y = np.array([t for r, t in lab if r["held_out"]])
    s = np.array([r["score"] for r, _ in lab if r["held_out"]])
    assert auc(y, s) > 0.94
    assert ((s >= 0.7) == (y == 1)).mean() > 0.97


def small_model():
    rnd = random.Random(1)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    texts, labels = [], []
    for i in range(400):
        s = [" ".join(rnd.choices(words, k=8)) for _ in range(6)]
        if i % 4 == 0:
            s[rnd.randrange(6)] += " vile"
        texts.append(". ".join(s))
        labels.append(int(i % 4 == 0))
    return toxicity.fit(texts, labels)


def plain_sentences(text, vocabulary):
    """The features of each sentence that holds one, word by word."""
    out = []
    for part in re.split(r"[.!?\n]+", text):
        f = set()
        for w in re.findall(r"[^\W\d_]+", part.lower()):
            f |= {vocabulary[x] for x in [w, *[w[:n] + "*" for n in (4, 5, 6, 7, 8) if len(w) > n]] if x in vocabulary}
        if f:
            out.append(f)
    return out


def plain_clean(sentences, w, b):
    """The chance that no sentence is toxic."""
    chance = 1.0
    for f in sentences:
        chance *= 1 - 1 / (1 + np.exp(-(b + sum(w[x] for x in f))))
    return chance


def test_fit_follows_the_noisy_or_likelihood(monkeypatch):
    """Some rounds of the fit equal the same rounds with the likelihood written out and differentiated by differences."""
    rounds = 6
    monkeypatch.setattr(toxicity, "ROUNDS", rounds)
    rnd = random.Random(7)
    texts, labels = [], []
    for i in range(80):
        s = [" ".join(rnd.choices(["alpha", "beta", "gamma", "delta"], k=3)) for _ in range(rnd.randint(1, 5))]
        if i % 3 == 0:
            s[rnd.randrange(len(s))] += rnd.choice([" vile", " nastily", " nasty vile"])
        texts.append(rnd.choice([". ", "! ", "\n"]).join(s) + (" nasty" if i % 17 == 1 else ""))
        labels.append(int(i % 3 == 0))
    m = toxicity.fit(texts, labels)
    voc = m.known.vocabulary
    docs = [plain_sentences(t, voc) for t in texts]
    share = {v: len(labels) / (2 * labels.count(v)) / len(labels) for v in (0, 1)}

    def loss(x):
        total = 0.5e-4 * float(x[:-1] @ x[:-1])
        for d, y in zip(docs, labels, strict=True):
            if d:  # without a feature a document says nothing of the weights
                clean = plain_clean(d, x[:-1], x[-1])
                total -= share[y] * np.log(1 - clean if y else clean)
        return total

    x = np.append(np.zeros(len(voc)), -3.0)
    a, q = np.zeros(len(x)), np.zeros(len(x))
    for step in range(1, rounds + 1):
        grad = np.array([(loss(x + e) - loss(x - e)) / 2e-5 for e in np.eye(len(x)) * 1e-5])
        a, q = 0.9 * a + 0.1 * grad, 0.999 * q + 0.001 * grad**2
        x = x - 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    assert len(voc) >= 3 and np.allclose(m.weights, x[:-1], atol=1e-4) and abs(m.bias - x[-1]) < 1e-4
    for t, d in zip(texts, docs, strict=True):
        assert abs(m.score(t) - (1 - plain_clean(d, m.weights, m.bias))) < 1e-9


def test_sentences_are_located():
    m = small_model()
    text = "waa wab wac. wba vile wbb. wca\nwda"
    spans = [(s, e) for s, e, p in m.sentences(text) if p >= 0.7]
    assert [text[s:e].strip() for s, e in spans] == ["wba vile wbb"]
    assert m.score(text) >= 0.7 > m.score("waa wab. wac") and 0 <= m.score("") < 0.1


def test_scoring_edges(spark):
    m = small_model()
    rows = [(1, None), (2, ""), (3, "vile"), (3, "vile"), (None, "vile. vile"), (4, "waa. " * 200_000 + "vile")]
    df = spark.createDataFrame([(*r, 5.0) for r in rows], "doc_id long, text string, score double")
    got = toxicity.score_documents(df, m, with_sentences=True).collect()
    assert [(r["doc_id"], r["predicted"]) for r in got] == [(1, 0), (2, 0), (3, 1), (3, 1), (None, 1), (4, 1)]
    assert got[4]["sentences"][1]["start"] == 5
    kept = toxicity.drop_toxic(df, m)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert toxicity.score_documents(df.limit(0), m).count() == 0


def test_training_edges(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(9)] + [(3, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(docs, none).score("x") == 0.0
    odd = spark.createDataFrame([(0, None), (3, 7), (None, 1), (0, 1), (0, 1)], "doc_id long, toxic int")
    assert toxicity.train(docs, odd).score("x") == 1.0


APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.example.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""


def test_licences(spark):
    rows = [(1, APACHE, "Apache-2.0"), (2, GPL, "GPL-3.0-or-later"), (3, None, ""), (4, "", ""),
            (5, "x. Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "MIT,CC-BY-NC-4.0"),
            (6, "Apache License\nMore", "unknown"), (7, "We discuss the MIT license here.", ""),
            (8, "MIT License\n\nPermission to sing", "unknown"),
            (9, "word. " * 300_000 + "All rights reserved.", "all-rights-reserved"),
            (5, "Licensed under  the APACHE License, Version 2.0", "Apache-2.0"),
            (None, "l***\nThis work is licensed under the GNU General Public License, version 3.\nOf", "GPL-3.0")]
    df = spark.createDataFrame([(a, b, "c") for a, b, _ in rows], "doc_id long, text string, licenses string")
    got = licenses.scan(df).collect()
    assert [(r["doc_id"], r["licenses"]) for r in got] == [(a, c) for a, _, c in rows]
    assert licenses.scan(df.limit(0)).count() == 0
    assert {r["licenses"] for r in licenses.scan(df, {}, ()).collect()} == {""}


def test_rule_order(spark):
    known = {"A": "alpha", "B": "beta", "C": "gamma"}
    rules = (("both", "A B "), ("a", "A "), ("c", "C "))
    df = spark.createDataFrame([(1, "alpha. beta."), (2, "alpha. gamma. beta."), (3, "beta. alpha")], "doc_id long, text string")
    got = [r["licenses"] for r in licenses.scan(df, known, rules).orderBy("doc_id").collect()]
    assert got == ["both", "a,c,unknown", "a,unknown"]


BSD = """Copyright (c) 2020, {holder}
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
THIRD = """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
NAME = """
3. The name of {} may not be used to endorse or promote products derived
   from this software without specific prior written permission.
"""


def test_bsd_texts(spark):
    holders = ["the copyright holder", "Someone Inc.", "Someone", "the University of X, Y & Co."]
    rows = [(i, BSD.format(holder=h, third=t.format(h)), "BSD-3-Clause") for i, (h, t) in enumerate((h, t) for h in holders for t in (THIRD, NAME))]
    rows += [(100, BSD.format(holder="Someone", third=""), "BSD-2-Clause"), (101, "All rights reserved.\nOther.", "all-rights-reserved")]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert sorted((r["doc_id"], r["licenses"]) for r in licenses.scan(df).collect()) == sorted((i, x) for i, _, x in rows)


def plain_scan(text, known=licenses.SENTENCES, rules=licenses.RULES):
    """The same by plain Python: sentences one by one, identifiers by position."""
    def cut(t):
        x = re.sub(licenses._ENDS, "\x01", t or "", flags=re.ASCII).lower()
        return [s.strip(" ") for s in re.sub("[^a-z0-9\x01]+", " ", x).split("\x01") if s.strip(" ")]

    forms = {k: [s.replace("zslotz", "{}") for s in cut(v.replace("{}", " zslotz "))] for k, v in known.items()}
    found, seq, i = cut(text), [], 0
    fits = lambda form, s: re.fullmatch(".+".join(form.split("{}")), s) is not None
    while i < len(found):
        for k, form in sorted(forms.items(), key=lambda kv: (-len(kv[1]), kv[0])):
            if len(form) <= len(found) - i and all(map(fits, form, found[i:])):
                seq.append(k)
                i += len(form)
                break
        else:
            i += 1
    left, names = "".join(x + " " for x in seq), []
    for name, rule in rules:
        new = re.sub(f"(?:^|(?<= ))(?:{rule})", "| ", left)
        if new != left and name not in names:
            names.append(name)
        left = new
    return len(found), " ".join(seq), ",".join(names + ["unknown"] * bool(re.search("[A-Za-z0-9]", left)))


def test_licences_whole_table_against_plain_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = sorted((r["doc_id"], *plain_scan(r["text"])) for r in df.collect())
    got = sorted(tuple(r) for r in licenses.scan(df).collect())
    assert got == want and len({x for _, _, _, x in got}) > 5


def test_known_entries_of_several_sentences_and_faulty_ones(spark):
    known = {"A": "One thing. Two things", "B": "two things", "C": "one thing", "D": "By {} and {} only", "E": "One thing. Two things. Three"}
    rules = (("a", "A "), ("b", "B "), ("e", "E "))
    texts = ["One thing! Two things.", "Two things. One thing.", "one thing. x. two things", "by me and you only. two things",
             "one thing. two things. three. two things", "one thing. one thing. two things"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in licenses.scan(df, known, rules).collect())
    assert got == [(i, *plain_scan(t, known, rules)) for i, t in enumerate(texts)]
    assert [x[2] for x in got] == ["A", "B C", "C B", "D B", "E B", "C A"]
    for bad in ({"A": "x", "B": " X."}, {"A": "..."}):
        with pytest.raises(ValueError):
            licenses.scan(df, bad, ())
