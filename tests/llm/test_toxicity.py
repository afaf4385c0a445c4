"""Toxicity: held-out accuracy, noisy-or by hand, located sentences and odd rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from emberwall.llm.toxicity import fit, labelled_sample, op6_toxicity, score, without_toxic


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    rows = []
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=8)) for _ in range(rng.randrange(1, 12))]
        bad = rng.random() < 0.3
        if bad:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["vile", "vileness", "rotten", "rottenly"])
        rows.append((i, ". ".join(sentences) + ".", int(bad)))
    return rows


MODEL = fit([t for _, t, _ in corpus(1500)], np.array([y for _, _, y in corpus(1500)]))


def test_finds_the_sentence_and_is_a_noisy_or(spark):
    rows = corpus(300, seed=2)
    df = spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(3)
    out = {r.doc_id: r for r in score(df, MODEL).collect()}
    right = 0
    for i, text, bad in rows:
        r = out[i]
        right += (r.score >= 0.5) == bool(bad)
        for s in r.sentences:
            part = text[s.start:s.end]
            assert "." not in part and s.score >= 0.5
            assert not bad or any(w in part for w in ("vile", "rotten"))
            alone = score(spark.createDataFrame([(1, part)], "doc_id long, text string"), MODEL).first() if i < 12 else None
            assert alone is None or abs(alone.score - s.score) < 1e-9
    assert right >= 290


def test_noisy_or_of_its_sentences(spark):
    parts = ["ban fin gon. den", "some vile mis", "é 日本 🙂 rotten kos"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate([*parts, "! ".join(parts)])], "doc_id long, text string")
    s = {r.doc_id: r for r in score(df, MODEL).collect()}
    assert abs(s[3].score - (1 - np.prod([1 - s[i].score for i in range(3)]))) < 1e-9
    text = "! ".join(parts)
    assert [text[x.start:x.end] for x in s[3].sentences] == parts[1:]


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, " .!?\n"), (3, "vile " * 100_000), (4, "ban " * 50_000)]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "doc_id long, text string, sentences string, start int")
    out = score(df, MODEL).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert all(r.score == 0 for r in out if r.doc_id in (1, 2, None))
    kept = without_toxic(df, MODEL)
    assert kept.schema == df.schema and kept.count() == 5
    assert score(df.limit(0), MODEL).count() == 0
    for texts, labels, share in (([], [], 0.0), (["a"], [1], 1.0), (["a", "b"], [0, 0], 0.0)):
        assert score(df, fit(texts, np.array(labels))).first().score == share


def test_labels_held_out_are_never_learnt(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    marks = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    marks = marks.union(spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, toxic int"))
    got = labelled_sample(docs, marks).collect()
    want = {i for i in range(100) if zlib.crc32(str(i).encode()) % 5}
    assert {int(r.text.split()[1]) for r in got} == want and len(got) == len(want)
    assert labelled_sample(docs, marks, rows=10).count() == 10
    assert labelled_sample(docs, marks, chars=6).count() < len(want)


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    df = op6_toxicity(spark, sf)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in df.collect()}
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect())
    assert len(rows) == 1000
    held = [(rows[d], y) for d, y in labels.items() if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(r.held_out and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r, _ in held)
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.95
