"""Bootstrapping over more than one generation, and seeds that always count."""

import pytest

from emberwall.llm.pii import find, pattern_scores

SCHEMA = "pattern string, value string, seed boolean"


def test_discovered_values_raise_new_patterns(spark):
    links = [("p", f"v{i}", True) for i in range(30)] + [("p", f"n{i}", False) for i in range(3)]
    links += [("q", f"n{i}", False) for i in range(3)]  # no seed of its own
    links += [("r", f"v{i}", True) for i in range(3)] + [("r", f"x{i}", False) for i in range(5)]  # not to raise itself
    patterns, values = pattern_scores(spark.createDataFrame(links, SCHEMA), own=False)
    p, v = dict(patterns.collect()), dict(values.collect())
    assert set(p) == {"p", "q", "r"} and p["p"] > 0.9 and p["q"] > 0.8
    assert p["r"] == pytest.approx(3 / 8) and v["x0"] == pytest.approx(3 / 8)


def test_values_after_seed_words_always_count(spark):
    texts = ['my password = "0a1b2c3d4e"', "iban: DE89370400440532013000", "nothing 1a2b3c4d5e here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.context] for r in find(df).collect()}
    assert out[0] == ["0a1b2c3d4e"] and out[2] == []
