"""Masked pseudo-likelihood: by hand, by numerical slopes, on held-out grammar, and odd rows."""

import random

import numpy as np
import pytest

from emberwall.llm import pll
from emberwall.llm.pll import Network, Trainer, _sequence, document_scores, new_network, op3_masked_pll, score, token_ids, train

RULES = {"the": ["cat", "dog", "old"], "old": ["cat", "dog"], "cat": ["sees", "eats"], "dog": ["sees", "eats"],
         "sees": ["the"], "eats": ["the", "fish"], "fish": ["while"], "while": ["the"]}


def sentence(rng, n):
    word, out = "the", []
    for _ in range(n):
        out.append(word)
        word = rng.choice(RULES[word])
    return " ".join(out)


def ids_of(text):
    return next(token_ids(iter([text])))[0]


def by_hand(net, text):
    """Sum over tokens of log P(class | two neighbours on each side) + log P(token | class)."""
    ids, total = ids_of(text).tolist(), 0.0
    for t, target in enumerate(ids):
        h = net.shift.astype(float).copy()
        for m, o in zip(net.mix, (-2, -1, 1, 2)):
            if 0 <= t + o < len(ids):
                h += net.embed[ids[t + o]].astype(float) @ m
        logits = net.out.astype(float) @ np.tanh(h) + net.bias
        p = np.exp(logits - logits.max())
        p /= p.sum()
        total += np.log(p[net.class_of[target]]) + net.within[target]
    return total


def test_scores_by_hand_across_window_borders(monkeypatch):
    monkeypatch.setattr(pll, "BATCH", 7)
    rng = random.Random(1)
    texts = [sentence(rng, n) for n in (1, 2, 3, 20, 7, 50)] + ["", None, " \n"]
    counts = np.bincount(np.concatenate([ids_of(t) for t in texts if t and t.strip()]), minlength=pll.VOCABULARY)
    net = new_network(counts)
    for (n, got), text in zip(document_scores(iter(texts), net), texts, strict=True):
        assert n == len((text or "").split()) and got == pytest.approx(by_hand(net, text) if n else 0.0, abs=1e-3)


def test_probabilities_sum_to_one():
    net = new_network(np.arange(pll.VOCABULARY) % 7)
    assert np.allclose(np.bincount(net.class_of, np.exp(net.within)), 1, atol=1e-4)


def test_slopes_are_those_of_the_loss():
    rng = random.Random(2)
    ids = _sequence([ids_of(sentence(rng, 30))])
    net = new_network(np.bincount(ids[ids < pll.VOCABULARY], minlength=pll.VOCABULARY))
    for k in ("embed", "mix", "shift", "out", "bias"):
        setattr(net, k, getattr(net, k).astype(float))
    slopes = {}
    trainer = Trainer(Network(**vars(net)))
    trainer._step = lambda name, slope, rows=None: slopes.__setitem__(name, (slope, rows))
    trainer.learn(ids)

    def loss():
        inner = ids[2:-2] < pll.VOCABULARY
        return -net.log_probabilities(ids)[inner].mean()

    word = slopes["embed"][1][0]
    for name, at, slope in (("out", (3, 2), slopes["out"][0][3, 2]), ("mix", (1, 4, 5), slopes["mix"][0][1, 4, 5]),
                            ("shift", (6,), slopes["shift"][0][6]), ("bias", (0,), slopes["bias"][0][0]),
                            ("embed", (word, 1), slopes["embed"][0][0, 1])):
        value = getattr(net, name)
        old = value[at]
        value[at] = old + 1e-4
        up = loss()
        value[at] = old - 1e-4
        down = loss()
        value[at] = old
        assert slope == pytest.approx((up - down) / 2e-4, abs=1e-3), name


def test_held_out_grammar_beats_shuffled_words(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, sentence(rng, 60)) for i in range(800)], "doc_id long, text string").repartition(4)
    net = train(df)
    right = [sentence(rng, 40) for _ in range(60)]
    wrong = [" ".join(rng.sample(t.split(), 40)) for t in right]
    a, b = ([x / n for n, x in document_scores(iter(t), net)] for t in (right, wrong))
    assert sum(x > y for x, y in zip(a, b)) >= 57 and np.mean(a) > np.mean(b) + 0.2


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, " ", 3), (4, "Long words " * 40_000, 4), (5, "one", 5), (5, "one", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pll int")
    net = train(df)
    out = score(df, net).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in out) == [
        ("1", 0), ("2", 0), ("4", 80_000), ("5", 1), ("5", 1), ("None", 0)]
    assert all((r.pll, r.mean_pll) == (0, None) if not r.n_tokens else r.pll <= 0 for r in out)
    assert score(df.limit(0), train(df.limit(0))).count() == 0


def test_query(spark):
    df = op3_masked_pll(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "n_tokens", "pll", "mean_pll"]
    rows = df.collect()
    assert len(rows) == 200 and all(r.mean_pll == pytest.approx(r.pll / r.n_tokens) for r in rows if r.n_tokens)


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("frequent", [pll.FREQUENT, 5])
def test_scores_of_all_documents_by_hand(spark, monkeypatch, frequent):
    """Every score of the table from real word counts, whether the words are sent to the tasks or joined."""
    import re
    from collections import Counter

    monkeypatch.setattr(pll, "FREQUENT", frequent)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if len(r.text) < 3000]
    rows += [(-1, None), (-2, " "), (-3, rows[0][1]), (None, "Only HERE only")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = pll.word_counts(df)
    net = train(df, words=words)
    counts = Counter(w for _, t in rows for w in re.findall(r"[^ \t-\r]+", _lower(t or "")))
    assert words.count() == len(counts) and sorted(r.n for r in words.collect()) == sorted(counts.values())
    id_of = {w: int(ids_of(w)[0]) for w in counts}
    whole = Counter()
    for w, n in counts.items():
        whole[int(net.class_of[id_of[w]])] += n + 1
    got = {r.doc_id: r for r in score(df, net, words=words).collect()}
    for doc_id, text in rows:
        tokens = re.findall(r"[^ \t-\r]+", _lower(text or ""))
        want = sum(np.log((counts[w] + 1) / (whole[int(net.class_of[id_of[w]])] + 1)) for w in tokens)
        if tokens:
            bare = Network(**{**vars(net), "within": np.zeros(pll.VOCABULARY)})
            want += by_hand(bare, text)
        assert got[doc_id].n_tokens == len(tokens) and got[doc_id].pll == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_shares_of_a_class_sum_to_one(spark):
    """Those of its counted words and that of a word not counted."""
    df = spark.createDataFrame([(1, "a b a b a c " + " ".join(f"w{i}" for i in range(500)))], "doc_id long, text string")
    words = pll.word_counts(df)
    net = train(df, words=words)
    known = pll.frequent_words(words, net)
    share = np.bincount(net.class_of[(known.known >> np.uint64(49)).astype(int)], np.exp(known.logs), pll.SINGLE + pll.BANDS)
    assert np.allclose((share + 1) / np.exp(known.whole), 1)
