"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import emberwall.llm.hardneg as h

SCHEMA = "vec_id long, label int, embedding array<double>, row string, place long"


def brute(rows, scale=256):
    good = [(math.inf if i is None else i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows
            if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for n, (i, lab, v) in enumerate(good):
        if i == math.inf or i % 3:
            continue
        every = sorted(((-score(v, w), j, k) for m, (j, k, w) in enumerate(good) if m != n))
        for p, j, _ in [e for e in every if e[2] == lab][:5]:
            hard = [e for e in every if e[2] != lab and 30 * -p <= 100 * -e[0] <= 90 * -p][:10]
            out += [(i, None if j == math.inf else j, r + 1, None if e[1] == math.inf else e[1], -p, -e[0]) for r, e in enumerate(hard)]
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    out = h.hard_negatives(df, F.col("vec_id") % 3 == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def vectors(n, width, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    return [(i, rng.randrange(3), [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    for name, value in {"LEAF": 4, "FANOUT": 2, "BLOCK": 32, "CHUNK": 8}.items():
        monkeypatch.setattr(h, name, value)


def test_many_blocks_and_odd_rows(spark, small):
    rows = vectors(150, 5, 1)
    rows += [(i, i % 2, [1.0, 0.5, 0.0, 0.0, 0.25]) for i in range(200, 240)]  # one vector for many rows
    rows += [(300, None, [1.0] * 5), (303, 1, None), (306, 1, [1.0, None, 0.0, 0.0, 0.0]), (309, 1, [float("nan")] * 5),
             (312, 1, [float("inf")] * 5), (None, 1, [1.0, 0.5, 0.0, 0.0, 0.3]), (None, 0, [1.0] * 5), (315, 1, []),
             (318, 2, [0.7, 0.9]), (3, 1, [0.1] * 5), (3, 1, [0.1] * 5), (321, 0, [0.0] * 5)]
    assert got(spark, rows) == brute(rows)


def test_production_sizes(spark):
    rows = vectors(400, 16, 2)
    assert got(spark, rows) == brute(rows)


def test_empty_and_lonely(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, 1, [1.0])]) == []


def test_scores_beyond_a_double_are_exact():
    a = np.array([[3_000_000_019, 1], [1 << 30, 7]], np.int64)
    b = np.array([[3_000_000_021, -1], [5, 1 << 33]], np.int64)
    assert h._dot(a, b).tolist() == (a.astype(object) @ b.T.astype(object)).tolist()
    assert h._dot(np.array([[1 << 62]]), np.array([[1 << 62]])).tolist() == [[h._LAST]]


def test_boxes_are_pruned():
    """A cluster far from the anchor is never scored."""
    v = np.vstack([np.full((h.LEAF, 4), 9), np.full((h.LEAF * 3, 4), -9)]).astype(np.int64)
    tree = h.PackedTree(v, np.arange(len(v)))
    anchor, scored = np.ones((1, 4), np.int64), []

    def leaf(node):
        scored.append(node)
        return anchor @ v[node * h.LEAF: (node + 1) * h.LEAF].T

    (scores, rows), = h.best_first(tree, tree.bounds(anchor), 0, leaf, np.ones(len(v), bool), *(
        np.array([x]) for x in (-h._LAST, h._LAST, -h._LAST)), 3)
    assert scored == [0] and rows.tolist() == [0, 1, 2] and scores.tolist() == [36] * 3
