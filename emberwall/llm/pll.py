"""Masked pseudo-likelihood: a small bidirectional window network scores documents.

Every token is predicted from its neighbours on both sides, itself masked. A
token is a word (ASCII white space apart, A-Z lower-cased). The network knows
words by one of ``VOCABULARY`` ids and gives the probability of the token's
class, a fixed set of ids. Which word of its class it is, the corpus tells:
every word of every document is counted by itself, in a table that grows with
the corpus, so no two words share a count (but for equal 64-bit hashes). A
document's score is the sum of the logarithms, natural, of its tokens'
conditional probabilities.

Training is data-parallel over the whole corpus: in each round every task
trains the broadcast network on its share of the documents in numpy, and the
results are averaged by Spark, each row by how often its task has used it.
Each document is trained on in one round. The network has a fixed size; the
``FREQUENT`` most frequent words go with it to the tasks, so that only others,
none of which is in more than one of ``FREQUENT`` tokens, are joined to the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut_lineage, table, prepare_workers
from .shingles import blocks, word_hashes

VOCABULARY, WIDTH, SIDE = 1 << 15, 8, 2
#: Words whose counts are sent to the tasks that score; words that a task counts before it hands on their counts.
FREQUENT, HELD = 1 << 16, 1 << 20
#: Classes: so many of the most frequent tokens alone, and so many bands of the others, by frequency, of like mass.
SINGLE, BANDS = 32, 32
BATCH, RATE = 4096, 0.1
#: Of eight parts of the documents, those trained on in each round.
ROUNDS = ((0,), (1, 2, 3, 4, 5, 6, 7))
_OFFSETS = tuple(o for o in range(-SIDE, SIDE + 1) if o)
_MASKED = VOCABULARY  # stands outside texts and between them; its vector is zero


@dataclass
class Network:
    embed: np.ndarray  # (VOCABULARY + 1, WIDTH)
    mix: np.ndarray  # (neighbours, WIDTH, WIDTH)
    shift: np.ndarray  # (WIDTH,)
    out: np.ndarray  # (classes, WIDTH)
    bias: np.ndarray  # (classes,)
    class_of: np.ndarray  # class of each token id
    within: np.ndarray  # log probability of each token id in its class

    def hidden(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of ids, and hidden states from the neighbours of each but SIDE at either end."""
        x = self.embed[ids]
        n = len(ids) - 2 * SIDE
        h = np.tile(self.shift, (n, 1))
        for m, o in zip(self.mix, _OFFSETS, strict=True):
            h += x[SIDE + o: SIDE + o + n] @ m
        return x, np.tanh(h, out=h)

    def log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        """Log probability of each id but SIDE at either end, given its neighbours."""
        target = np.minimum(ids[SIDE: len(ids) - SIDE], VOCABULARY - 1)
        return self.class_log_probabilities(ids) + self.within[target]

    def class_log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        """Log probability of the class of each id but SIDE at either end, given its neighbours."""
        _, h = self.hidden(ids)
        logits = h @ self.out.T
        logits += self.bias
        target = np.minimum(ids[SIDE: len(ids) - SIDE], VOCABULARY - 1)
        chosen = logits[np.arange(len(h)), self.class_of[target]]
        top = logits.max(1)
        logits -= top[:, None]
        return chosen - top - np.log(np.exp(logits, out=logits).sum(1))


def new_network(counts: np.ndarray) -> Network:
    """An untrained network with the classes and the within-class probabilities of corpus counts."""
    rng = np.random.default_rng(11)
    smooth = counts + 1.0
    order = np.argsort(-smooth, kind="stable")
    class_of = np.empty(VOCABULARY, np.int64)
    class_of[order[:SINGLE]] = np.arange(SINGLE)
    mass = np.cumsum(smooth[order[SINGLE:]])
    class_of[order[SINGLE:]] = SINGLE + np.minimum((mass / mass[-1] * BANDS).astype(int), BANDS - 1)
    total = np.bincount(class_of, smooth, SINGLE + BANDS)
    embed = rng.normal(scale=0.3, size=(VOCABULARY + 1, WIDTH)).astype(np.float32)
    embed[_MASKED] = 0
    share = np.maximum(total, 1e-9) / smooth.sum()
    return Network(embed, rng.normal(scale=0.4, size=(len(_OFFSETS), WIDTH, WIDTH)).astype(np.float32),
                   np.zeros(WIDTH, np.float32), rng.normal(scale=0.1, size=(SINGLE + BANDS, WIDTH)).astype(np.float32),
                   np.log(share).astype(np.float32), class_of, np.log(smooth / total[class_of]).astype(np.float32))


_SHIFT = 64 - 15


def token_words(texts: Iterator[str | None]) -> Iterator[list[np.ndarray]]:
    """64-bit hashes of the words of texts, a block of texts at a time."""
    for block in blocks(texts):
        start, hashes = word_hashes(np.frombuffer(b"\n".join(block), np.uint8))
        ends = np.searchsorted(start, np.cumsum([len(x) + 1 for x in block]) - 1)
        yield np.split(hashes, ends[:-1])


def _id(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(_SHIFT)).astype(np.int64)


def token_ids(texts: Iterator[str | None]) -> Iterator[list[np.ndarray]]:
    """Token ids of texts, a block of texts at a time."""
    for block in token_words(texts):
        yield [_id(x) for x in block]


def _sequence(docs: list[np.ndarray]) -> np.ndarray:
    """Ids of several texts, masked ids around each."""
    gap = np.full(SIDE, _MASKED)
    return np.concatenate([gap, *[x for d in docs for x in (d, gap)]])


def _windows(ids: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a sequence whose inner ids cover it once."""
    for at in range(0, max(len(ids) - 2 * SIDE, 0), BATCH):
        yield ids[at: at + BATCH + 2 * SIDE]


class Trainer:
    """Adagrad over windows of token ids."""

    def __init__(self, net: Network):
        self.net = net
        self.parts = {k: getattr(net, k).copy() for k in ("embed", "mix", "shift", "out", "bias")}
        for k, v in self.parts.items():
            setattr(net, k, v)
        self.squares = {k: np.full_like(v, 1e-4) for k, v in self.parts.items()}
        self.uses = np.zeros(VOCABULARY, np.int64)
        self.tokens = 0

    def _step(self, name: str, slope: np.ndarray, rows=slice(None)) -> None:
        self.squares[name][rows] += slope * slope
        self.parts[name][rows] -= RATE * slope / np.sqrt(self.squares[name][rows])

    def learn(self, ids: np.ndarray) -> None:
        net, target = self.net, ids[SIDE: len(ids) - SIDE]
        x, h = net.hidden(ids)
        real = target < VOCABULARY
        n = int(real.sum())
        if not n:
            return
        p = h @ net.out.T
        p += net.bias
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(p)), net.class_of[np.minimum(target, VOCABULARY - 1)]] -= 1
        p[~real] = 0
        p /= n
        dh = (p @ net.out) * (1 - h * h)
        dx = np.zeros_like(x)
        dmix = np.empty_like(net.mix)
        for i, o in enumerate(_OFFSETS):
            dmix[i] = x[SIDE + o: SIDE + o + len(h)].T @ dh
            dx[SIDE + o: SIDE + o + len(h)] += dh @ net.mix[i].T
        used, place = np.unique(ids, return_inverse=True)
        slope = np.stack([np.bincount(place, dx[:, d], len(used)) for d in range(WIDTH)], 1).astype(np.float32)
        inner = used < VOCABULARY
        self.uses[used[inner]] += np.bincount(place, minlength=len(used))[inner]
        self.tokens += n
        self._step("out", p.T @ h)
        self._step("bias", p.sum(0))
        self._step("mix", dmix)
        self._step("shift", dh.sum(0))
        self._step("embed", slope[inner], used[inner])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The network as rows of WIDTH numbers: their places, how often each was used, and the numbers."""
        used = np.flatnonzero(self.uses)
        dense = np.concatenate([self.parts[k].reshape(-1, WIDTH) for k in ("mix", "shift", "out", "bias")])
        return (np.concatenate([used, VOCABULARY + np.arange(len(dense))]),
                np.concatenate([self.uses[used], np.full(len(dense), self.tokens)]),
                np.concatenate([self.parts["embed"][used], dense]).astype(float))


def _merged(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    some, place = np.unique(np.concatenate(words), return_inverse=True)
    return some, np.bincount(place, np.concatenate(counts), len(some)).astype(np.int64)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each word, by its 64-bit hash, occurs in all documents; a table, with a row for each word."""

    def each(batches):
        words, counts, held = [], [], 0
        for batch in batches:
            for block in token_words(x.as_py() for x in batch.column(0)):
                some, n = np.unique(np.concatenate(block), return_counts=True)
                words.append(some), counts.append(n)
                held += len(some)
                if held > HELD:
                    some, n = _merged(words, counts)
                    words, counts, held = [some], [n], len(some)
                    if held > HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(n)], names=["word", "n"])
                        words, counts, held = [], [], 0
        if words:
            some, n = _merged(words, counts)
            yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(n)], names=["word", "n"])

    prepare_workers(docs.sparkSession)
    each_task = docs.select(docs[text].alias("text")).mapInArrow(each, "word long, n long")
    return cut_lineage(each_task.groupBy("word").agg(F.sum("n").alias("n")))


def id_counts(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each id."""
    out = np.zeros((2, VOCABULARY), np.int64)
    found = words.groupBy(F.shiftrightunsigned("word", _SHIFT).alias("id")).agg(
        F.sum("n").alias("n"), F.count("*").alias("v")).toArrow()  # at most VOCABULARY rows
    out[:, found.column("id").to_numpy()] = [found.column(c).to_numpy() for c in ("n", "v")]
    return out[0], out[1]


def corpus_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each token id occurs in all documents."""
    return id_counts(word_counts(docs, text))[0]


def train(docs: DataFrame, text: str = "text", rounds=ROUNDS, words: DataFrame | None = None) -> Network:
    """A network trained on all documents, whose ``words`` may have been counted already."""
    net = new_network(corpus_counts(docs, text) if words is None else id_counts(words)[0])
    body = docs.select(docs[text].alias("text"))
    names = [f"v{d}" for d in range(WIDTH)]
    for parts in rounds:
        held = docs.sparkSession.sparkContext.broadcast(net)  # a fixed size, about one MB

        def each(batches, held=held):
            trainer = Trainer(Network(**vars(held.value)))
            for batch in batches:
                for block in token_ids(x.as_py() for x in batch.column(0)):
                    for window in _windows(_sequence(block)):
                        trainer.learn(window)
            if trainer.tokens:
                at, uses, values = trainer.rows()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(uses), *(pa.array(values[:, d] * uses) for d in range(WIDTH))],
                    names=["at", "uses", *names])

        share = body.where(F.pmod(F.xxhash64("text"), F.lit(8)).isin(*parts))
        trained = share.mapInArrow(each, "at long, uses long, " + ", ".join(f"{c} double" for c in names))
        mean = trained.groupBy("at").agg(F.sum("uses").alias("uses"), *[F.sum(c).alias(c) for c in names])
        got = mean.select("at", *[(F.col(c) / F.col("uses")).cast("float").alias(c) for c in names]).toArrow()
        if got.num_rows:
            whole = np.concatenate([net.embed[:-1], *[getattr(net, k).reshape(-1, WIDTH) for k in ("mix", "shift", "out", "bias")]])
            whole[got.column("at").to_numpy()] = np.stack([got.column(c).to_numpy() for c in names], 1)
            embed, rest = np.vstack([whole[:VOCABULARY], np.zeros((1, WIDTH), np.float32)]), whole[VOCABULARY:]
            sizes = np.cumsum([len(_OFFSETS) * WIDTH, 1, SINGLE + BANDS])
            mix, shift, out, bias = np.split(rest, sizes)
            net = Network(embed, mix.reshape(net.mix.shape), shift[0], out, bias.ravel(), net.class_of, net.within)
    return net


def document_scores(texts: Iterator[str | None], net: Network) -> Iterator[tuple[int, float]]:
    """(tokens, sum of log probabilities) of each text."""
    for block in token_ids(texts):
        ids = _sequence(block)
        logs = [net.log_probabilities(w) for w in _windows(ids)]
        sums = np.concatenate([[0.0], np.cumsum(np.concatenate(logs), dtype=float)]) if logs else np.zeros(1)
        at = 0
        for doc in block:
            yield len(doc), float(sums[at + len(doc)] - sums[at])
            at += len(doc) + SIDE


@dataclass
class Words:
    """What the tasks need to know of the words: the frequent ones (sorted) with the logarithms of their counts and one
    more, and for each class that of its tokens, its words and one more."""

    known: np.ndarray
    logs: np.ndarray
    whole: np.ndarray


def frequent_words(words: DataFrame, net: Network) -> Words:
    top = words.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    known, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(known)
    whole = sum(np.bincount(net.class_of, x, SINGLE + BANDS) for x in id_counts(words)) + 1
    return Words(known[order], np.log(n[order] + 1.0), np.log(whole))


def word_scores(texts: Iterator[str | None], net: Network, words: Words) -> Iterator[tuple[int, float, np.ndarray]]:
    """(tokens, sum of log probabilities, words not known) of each text; the logarithms of the latter's counts and one
    more are still to be added."""
    for block in token_words(texts):
        ids = [_id(x) for x in block]
        logs = [net.class_log_probabilities(w) for w in _windows(_sequence(ids))]
        sums = np.concatenate([[0.0], np.cumsum(np.concatenate(logs), dtype=float)]) if logs else np.zeros(1)
        every, ends = np.concatenate(block), np.cumsum([len(x) for x in block])
        at = np.minimum(np.searchsorted(words.known, every), max(0, len(words.known) - 1))
        hit = words.known[at] == every if len(words.known) else np.zeros(len(every), bool)
        within = np.where(hit, words.logs[at], 0.0) if len(words.known) else np.zeros(len(every))
        within -= words.whole[net.class_of[np.concatenate(ids)]]
        inner = np.concatenate([[0.0], np.cumsum(within)])
        begin = 0
        for n, (doc, end) in enumerate(zip(block, ends.tolist(), strict=True)):
            first = begin + n * SIDE
            yield len(doc), float(sums[first + len(doc)] - sums[first] + inner[end] - inner[begin]), doc[~hit[begin:end]]
            begin = end


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text: str = "text",
          words: DataFrame | None = None) -> DataFrame:
    """(id, n_tokens, pll, mean_pll) of every document; ``mean_pll`` is the score to compare documents by.

    With ``words`` (``word_counts`` of the corpus) a word's share of its class
    is its count and one, of those of the class's words and one for words not
    counted; without, that of its id. A null, empty or wordless text has no
    tokens, pll 0 and a null mean. Rows are neither added nor lost, equal texts
    have equal scores up to rounding, and columns other than the id are not
    returned.
    """
    prepare_workers(docs.sparkSession)
    if words is not None:
        return _score_words(docs, net, id_col, text, words)
    held = docs.sparkSession.sparkContext.broadcast(net)

    def each(batches):
        for batch in batches:
            found = list(document_scores((x.as_py() for x in batch.column(1)), held.value))
            n, pll = [x for x, _ in found], [x for _, x in found]
            mean = [x / k if k else None for k, x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(pll, pa.float64()), pa.array(mean, pa.float64())],
                names=[id_col, "n_tokens", "pll", "mean_pll"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text].alias("text")).mapInArrow(
        each, f"`{id_col}` {kind}, n_tokens long, pll double, mean_pll double")


def _score_words(docs: DataFrame, net: Network, id_col: str, text: str, words: DataFrame) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast((net, frequent_words(words, net)))  # fixed sizes, about two MB

    def each(batches):
        for batch in batches:
            found = list(word_scores((x.as_py() for x in batch.column(1)), *held.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.float64()),
                 pa.array([x[2].view(np.int64) for x in found], pa.list_(pa.int64()))], names=["id", "n_tokens", "part", "rare"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = cut_lineage(docs.select(docs[id_col], docs[text].alias("text")).mapInArrow(
        each, f"id {kind}, n_tokens long, part double, rare array<long>").withColumn("uid", F.monotonically_increasing_id()))
    # words that were not counted add log(1)
    rare = scored.select("uid", F.explode("rare").alias("word")).join(words, "word").groupBy("uid").agg(
        F.sum(F.log(F.col("n") + 1.0)).alias("more"))
    pll = F.col("part") + F.coalesce("more", F.lit(0.0))
    return scored.drop("rare").join(rare, "uid", "left").select(
        F.col("id").alias(id_col), "n_tokens", pll.alias("pll"),
        F.when(F.col("n_tokens") > 0, pll / F.col("n_tokens")).alias("mean_pll"))


def op3_masked_pll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of all documents under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = word_counts(docs)
    return score(docs, train(docs, words=words), words=words)


QUERIES = {"op3_masked_pll": op3_masked_pll}
ORACLE = {}
