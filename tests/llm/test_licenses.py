"""License scans: base phrases by definition, suppression, every rule gated, edges."""

import random
import re

from ledgerspark.llm import licenses

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]


def run(spark, texts):
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, base string, found int").drop("base", "found")
    return {r.doc_id: r for r in licenses.scan(rows).collect()}


def test_base(spark):
    rng = random.Random(5)
    bits = ["Under the MIT License", "under-the mit", "license", "CC BY-NC 4.0", "cc", "by nc", "Apache License, Version 2.0", "apache license version 2", "é", "x", "under the MIT licenseé", "\n", "2"]
    texts = [" ".join(rng.choices(bits, k=rng.randrange(1, 9))) for _ in range(150)] + ["", None, "under the mit license " * 300]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        w = words_of(t)
        assert got[i].n_words == len(w)
        want = sorted((p, n) for n, phrase in licenses.BASE.items() for p in places(w, phrase))
        assert sorted((b["at"], b["label"]) for b in got[i].base) == want


def test_suppression(spark):
    got = run(spark, ["Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: BSD-3-Clause",
                      "All rights reserved.", "Distributed freely under the terms of the Mozilla Public License 2.0 and under the MIT license", "nothing here"])
    labels = [sorted({d.label for d in got[i].found}) for i in range(6)]
    assert labels == [["cc-by-nc"], ["gpl-3"], ["bsd-3"], ["proprietary"], ["mit", "mpl-2"], []]


def test_rules_are_many_and_gated(spark):
    rules = licenses.rules()
    assert len(rules) > 200 and len({p for _, p, _, _, _ in rules}) == len(rules)
    gate = re.compile(licenses.GATE)
    for label, name in (("mit", "mit"), ("bsd-2", "bsd 2 clause"), ("cc-by", "cc by")):
        for template, keyword, _ in licenses.TEMPLATES:
            sentence = re.sub(r"\(\?:[^()]*(?:\([^()]*\)\?)?[^()]*\)(?:\?|\{\{.*?\}\})", "", template).format(n=name)
            sentence = re.sub(r"\(\?:(\w+)[^)]*\)", r"\1", sentence).replace("[sc]es?", "ce")
            assert keyword in sentence and gate.search(sentence), sentence
    for _, sentence, keyword, _ in licenses.SENTENCES:
        assert gate.search(sentence)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
