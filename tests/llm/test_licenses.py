"""License rules on chosen notices, suppression, and the fixed phrases by brute force."""

import re

import pytest

from emberwall.llm.licenses import FAMILIES, GATE, op7_license_scan, rules, scan


def phrases(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(found)


def labels(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.licenses for r in scan(df).collect()}
    return [[d.label for d in out[i].detections] for i in range(len(texts))]


def test_every_rule_is_a_pattern_behind_the_gate():
    all_rules = rules()
    assert len(all_rules) > 200 and len({p for _, p, _, _ in all_rules}) > 200
    for keyword, pattern, _, _ in all_rules:
        re.compile(pattern)
        assert keyword == keyword.lower()
    assert all(w == w.lower() for w in GATE) and len({f[0] for f in FAMILIES}) == len(FAMILIES)


def test_notices(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
             "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
             "// SPDX-License-Identifier: BSD-3-Clause", "see https://www.mozilla.org/MPL/2.0/ (license)",
             "Permission is hereby granted, free of charge, to any person obtaining a copy",
             "Creative Commons Attribution-ShareAlike 3.0", "dedicated to the public domain", "All rights reserved.",
             "She has a driving licence and the permission of her mother.", "the mit admits apache hikers"]
    assert labels(spark, texts) == [["apache-2.0"], ["mit"], ["cc-by-nc"], ["gpl-3.0"], ["bsd-3-clause"], ["mpl-2.0"],
                                    ["mit"], ["cc-by-sa"], ["public-domain"], ["all-rights-reserved"], [], []]


def test_suppression_and_intervals(spark):
    text = "é\nReleased under the MIT License. Copyright 2020 X. MIT license! spdx-license-identifier: mit or gpl-2.0"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = scan(df).first().licenses.detections
    assert [d.start for d in found] == sorted(d.start for d in found)
    for d in found:
        assert not any(d is not e and e.start <= d.start and d.end <= e.end for e in found)
    assert text[found[0].start:found[0].end] == "Released under the MIT License"
    assert {d.label for d in found} >= {"mit", "gpl-2.0", "copyright"}


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "p"), (1, None, "p"), (None, "", "q"), (2, "mit\nLICENSE Mit-license" + " x" * 100_000, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    out = scan(df)
    assert out.columns == ["doc_id", "text", "base", "licenses"]
    for r in out.collect():
        n, base = phrases(r.text)
        assert r.licenses.n_words == n and [(b.start, b.label) for b in r.licenses.base] == base
    assert out.count() == 4 and scan(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    df = op7_license_scan(spark, sf)
    assert df.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, base = phrases(texts[r.doc_id])
        starts, names = [s for s, _ in base], {x for _, x in base}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            n, len(base), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(names)) and names <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


@pytest.mark.parametrize("label", ["gpl-2.0", "lgpl-3.0", "zlib", "isc", "epl-2.0", "unlicense"])
def test_grants_by_name(spark, label):
    name = {"gpl-2.0": "GPL v2", "lgpl-3.0": "GNU Lesser General Public License version 3", "zlib": "zlib license",
            "isc": "ISC license", "epl-2.0": "Eclipse Public License 2.0", "unlicense": "Unlicense"}[label]
    assert labels(spark, [f"It is distributed under the terms of the {name}."]) == [[label]]
