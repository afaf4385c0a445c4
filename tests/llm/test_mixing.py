"""Mixing: targets against a plain water-filling, and defined results for odd rows."""

import random

import pytest
from pyspark.sql import Row

from emberwall.llm import mixing
from emberwall.llm.mixing import mix, op4_mix_sources, repeat_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA)


def water_fill(sizes, weights=(1, 2, 3), cap=3.0):
    """sizes: source -> words. One source after another is clamped, in plain Python."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while len(done) < len(names):
        free = [s for s in names if s not in done]
        level = (total - sum(done.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] >= cap * sizes[s]]
        if not over:
            return done | {s: level * w[s] for s in free}
        done |= {s: cap * sizes[s] for s in over}
    return done


def test_targets_and_words_taken(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{i * i % 5}") for i in range(600)]
    rows += [(1000 + i, "ä b " * 3, None) for i in range(4)] + [(2000, "x " * 2, "S")]
    got = mix(docs(spark, rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want, taken = water_fill(sizes), {}
    for r in got:
        assert r.mix["size"] == len(r.text.split()) and r.mix.source_size == sizes[r.source]
        assert r.mix.target == pytest.approx(want[r.source])
        assert 0 <= r.mix.reps <= 3
        taken[r.source] = taken.get(r.source, 0) + r.mix.reps * r.mix["size"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(8, 0.02 * t), s
    assert len(got) == len(rows)


def test_reruns_agree_whatever_the_partitions(spark):
    d = docs(spark, [(i, "w " * (i % 30), f"s{i % 3}") for i in range(300)])
    one = sorted((r.doc_id, r.mix.reps) for r in mix(d.repartition(1)).collect())
    assert one == sorted((r.doc_id, r.mix.reps) for r in mix(d.repartition(7)).collect())


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, "", "a"), (None, "x y", "b"), (None, "x y", "b"), (5, "long " * 50_000, None)]
    got = mix(docs(spark, rows))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix"]
    by = {(r.doc_id, r.source): r.mix for r in got.collect()}
    assert by[1, "a"].asDict() == {"size": 0, "source_size": 0, "target": 0.0, "reps": 1}
    assert by[None, "b"].reps <= 3 and by[5, None]["size"] == 50_000
    assert mix(docs(spark, [])).count() == 0


def test_clashing_columns_stay(spark):
    d = spark.createDataFrame([(1, "a b", "s", 7, "p")], "doc_id long, text string, source string, size int, cut string")
    r = mix(d).first()
    assert (r["size"], r.cut, r.mix["size"], r.mix.reps) == (7, "p", 2, 1)


def test_repeat_rows(spark):
    d = docs(spark, [(1, "a b c d", "s")] + [(2 + i, "a", "t") for i in range(3)])
    mixed = mix(d)
    out = repeat_rows(mixed, d.columns)
    assert out.columns == d.columns
    assert out.count() == sum(r.mix.reps for r in mixed.collect())


def test_query(spark):
    df = op4_mix_sources(spark, "/root/testdata/sf0.01")
    assert df.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    rows = df.collect()
    assert len(rows) == 1000 and all(r.taken <= 3 * r["size"] for r in rows)
    sums = {}
    for r in rows:
        t = sums.setdefault(r.source_size, [r.target, 0])
        t[1] += r.taken
    assert all(abs(k - t) < 0.05 * t for t, k in sums.values())


def test_small_sources_come_near_their_targets(spark):
    """Ten documents to a source, of 2 to 2,770 words; long ones that do not fit are passed over."""
    df = op4_mix_sources(spark, "/root/testdata/sf0.001")
    source = {r.doc_id: r.source for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    sums = {}
    for r in df.collect():
        t = sums.setdefault(source[r.doc_id], [r.target, 0, r.source_size])
        t[1] += r.taken
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    off = [abs(k - t) / t for t, k, _ in sums.values()]
    assert len(off) == 20 and max(off) < 0.03 and sum(x < 0.02 for x in off) >= 18


def test_fills_pass_over_long_documents(spark):
    """More documents than are drawn in several orders: one long one stands in the way of a thousand short ones."""
    rows = [(i, "w " * (1 + i % 3), "s") for i in range(1500)] + [(5000 + i, "x " * 900, "s") for i in range(4)]
    rows += [(9000 + i, "y " * 10, "t") for i in range(400)]
    taken, target = {}, {}
    for r in mix(docs(spark, rows)).collect():
        taken[r.source] = taken.get(r.source, 0) + r.mix.reps * r.mix["size"]
        target[r.source] = r.mix.target
    assert all(abs(taken[s] - target[s]) <= max(10, 0.002 * target[s]) for s in target)


def test_running_words_of_each_source(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "b", None]), rng.randrange(-(1 << 63), 1 << 63), rng.randrange(1, 9)) for _ in range(500)]
    rows += [("c", d, 1) for d in (-(1 << 63), -1, 0, (1 << 63) - 1)]
    got = sorted(map(str, mixing._with_run(spark.createDataFrame(rows, "source string, draw long, words long").repartition(3))
                     .select("source", "draw", "run").collect()))
    want = []
    for source in ("a", "b", "c", None):
        total = 0
        for _, draw, words in sorted((r for r in rows if r[0] == source), key=lambda r: r[1]):
            total += words
            want.append(str(Row(source=source, draw=draw, run=total)))
    assert got == sorted(want)
