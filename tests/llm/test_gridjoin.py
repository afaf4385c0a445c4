"""Epsilon grid order join against all pairs in double precision."""

import numpy as np
import pytest

import emberwall.llm.gridjoin as g

SCHEMA = "vec_id long, embedding array<double>, n_links int"


def brute(rows, cosine=0.9):
    good = [i for i, (_, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    top, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in good:
        for j in good:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                x, y = (np.asarray(rows[k][1], float) / np.abs(rows[k][1]).max() for k in (i, j))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    top[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return sorted(((d, links[i], least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def got(spark, rows):
    df = g.near_vectors(spark.createDataFrame([(d, v, 0) for d, v in rows], SCHEMA).repartition(4))
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    out = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str)


@pytest.mark.parametrize("width", [3, 24])
def test_many_blocks_and_leaves(spark, monkeypatch, width):
    monkeypatch.setattr(g, "BLOCK", 40)
    monkeypatch.setattr(g, "LEAF", 8)
    monkeypatch.setattr(g, "FANOUT", 3)
    rng = np.random.default_rng(width)
    centres = rng.normal(size=(30, width))
    rows = [(i, (centres[i % 30] + rng.normal(size=width) * rng.choice([0.05, 0.2, 0.5])).tolist()) for i in range(260)]
    rows += [(1000 + i, rows[3][1]) for i in range(50)]
    assert got(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [1e300, 0.0]), (9, [1e-300, 1e-310]), (10, [1.0, 0.0, 0.0]), (10, [2.0, 0.0, 0.0]),
            (None, [0.0, 1.0]), (11, [0.0, 5.0]), (12, [-1.0, 0.0])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(1, None)]) == [(1, 0, 1)]
