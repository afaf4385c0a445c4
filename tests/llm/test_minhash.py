"""MinHash near-duplicates against a brute-force comparison of full shingle sets."""

import random

import numpy as np

from emberwall.llm.minhash import COORDINATES, MATCHES, near_duplicates, signature_rows
from emberwall.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, component_id int"


def brute(rows, percent=85):
    sets = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                top[root(i)] = root(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        r = root(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _, _), s) in enumerate(zip(rows, sets))), key=str)


def got(spark, rows):
    df = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    out = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)


def test_matches_brute_force_on_chains_copies_and_passages(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    common = rng.choices(words, k=40)
    rows, n = [], 0
    for _ in range(12):
        base = rng.choices(words, k=rng.randrange(30, 160))
        for _ in range(rng.randrange(1, 9)):  # a chain: each an edit of the one before
            base = list(base)
            base[rng.randrange(len(base))] = rng.choice(words)
            n += 1
            rows.append((1000 - n, " ".join(base).title() + rng.choice(["", "  ", "\n"]), 1))
    rows += [(2000 + i, " ".join(common + rng.choices(words, k=60)), 2) for i in range(40)]
    rows += [(3000 + i, "the very same text in every copy of it", 3) for i in range(60)]
    assert got(spark, rows) == brute(rows)


def test_long_lists_in_blocks(spark, monkeypatch):
    """One large group of near copies, some too far from all others: compared in several small blocks."""
    import emberwall.llm.minhash as m

    monkeypatch.setattr(m, "BLOCK_NODES", 20)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    base, rows = rng.choices(words, k=150), []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 6, 9])):
            copy[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(copy), 0))
    want = brute(rows)
    assert len({c for _, _, c in want}) > 3 and got(spark, rows) == want


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n\t", 0), (4, "Two words", 0), (5, "two\x0bwords", 0), (6, "two", 0),
            (7, "a b c d e", 0), (7, "a b c d e", 0), (8, "x y z u v w", 0), (8, "quite another text under one id", 0),
            (9, "long " * 60_000 + "end", 0), (10, "long " * 60_000 + "end", 0)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_null_ids(spark):
    rows = [(None, "a b c d e f", 0), (3, "a b c d e f", 0), (None, "", 0)]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == [
        ("3", "3", True), ("None", "3", False), ("None", "None", True)]


def test_signatures_agree_as_the_sets_do():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 63, 40_000).astype(np.uint64))
    b = np.concatenate([a[:36_000], np.unique(rng.integers(0, 1 << 63, 2_000).astype(np.uint64))])
    small = a[:3]
    rows = signature_rows([a, b, small, a], COORDINATES)
    assert (rows[0] == rows[3]).all() and (rows[0] == rows[1]).sum() >= MATCHES
    assert (rows[2] == signature_rows([small])[0]).all() and (rows[0] == rows[2]).sum() < 10


def test_shingles_of_many_texts_in_one_block():
    texts = ["A b  c\td e f", None, "", "one", "a B c d e f", "é b c d e f"]
    sets = list(shingle_sets(iter(texts)))
    assert [len(s) for s in sets] == [2, 0, 0, 1, 2, 2]
    assert (sets[0] == sets[4]).all() and set(sets[0]) & set(sets[5]) == {x for x in sets[0] if x in sets[5]}
    assert len(set(sets[0]) & set(sets[5])) == 1
