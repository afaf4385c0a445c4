"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's probability is a logistic function of the words and word
beginnings in it; a document's is the noisy-or of its sentences, so one
sentence is enough and many harmless ones do no harm. Training maximises the
likelihood of document labels; the sentence scores it yields say where the
offence is. Only the text is looked at.

The fit uses a bounded sample of labelled rows: at most ``SAMPLE_ROWS`` texts
of at most ``SAMPLE_CHARS`` characters, picked by a hash of their ids.
Everything else covers whole texts of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table, prepare_workers
from .shingles import Runs, blocks

SAMPLE_ROWS = 8_000
SAMPLE_CHARS = 20_000
#: Word beginnings used beside whole words, in bytes.
BEGINNINGS = (3, 4, 5, 6)
#: Features kept: those most tied to toxic documents, in at least so many of them.
FEATURES, LEAST_DOCS = 4096, 3
ROUNDS, RATE, DECAY = 400, 0.1, 1e-5
_BITS = 20

_GAPS = np.ones(256, bool)
_GAPS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Sentences:
    """Sentences of a block of texts and the feature hashes of their words."""

    of_word: np.ndarray  # sentence of each word
    of_doc: np.ndarray  # text of each sentence
    start: np.ndarray  # byte of the block where each begins and ends
    end: np.ndarray
    features: list[np.ndarray]  # for whole words and each kind of beginning; 0 where a word is too short


def sentences(raw: np.ndarray, lengths: list[int]) -> Sentences:
    """Sentences: parts with a word in them between full stops, exclamation and question marks and newlines."""
    words = Runs(raw, _GAPS)
    begun = np.cumsum(_ENDS[raw])[words.start] if len(words.start) else words.start
    first = np.flatnonzero(np.diff(begun, prepend=-1))
    of_word = np.cumsum(np.diff(begun, prepend=-1) != 0) - 1
    last = np.append(first[1:], len(begun))[: len(first)] - 1
    start = words.start[first]
    # texts stand one newline apart
    of_doc = np.searchsorted(np.cumsum(np.asarray(lengths) + 1), start, "right")
    features = [words.hashes(words.start, words.end)]
    for n in BEGINNINGS:
        stop = words.start + n
        long = np.flatnonzero(stop < words.end)
        found = np.zeros(len(stop), np.uint64)
        found[long] = words.hashes(words.start[long], stop[long]) + np.uint64(n)
        features.append(found)
    return Sentences(of_word, of_doc, start, words.end[last], features)


@dataclass
class Model:
    """Weights by feature hash (sorted), and the logit of a sentence without any of them."""

    known: np.ndarray
    weights: np.ndarray
    base: float
    constant: float | None = None  # the score of every text, where there was nothing to learn from

    def __post_init__(self):
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.known >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are known, and their places among the known."""
        some = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, hashes[some]), max(0, len(self.known) - 1))
        hit = self.known[at] == hashes[some] if len(self.known) else np.zeros(0, bool)
        return some[hit], at[hit]

    def pairs(self, s: Sentences) -> np.ndarray:
        """sentence * (number of features) + feature, once for each feature of a sentence."""
        where, what = (np.concatenate(x) for x in zip(*(self.found(f) for f in s.features), strict=True))
        return np.unique(s.of_word[where] * len(self.known) + what) if len(where) else np.zeros(0, np.int64)

    def logits(self, s: Sentences) -> np.ndarray:
        """Logit of each sentence."""
        out = np.full(len(s.start), self.base)
        pairs = self.pairs(s)
        if len(pairs):
            np.add.at(out, pairs // len(self.known), self.weights[pairs % len(self.known)])
        return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _in_blocks(texts: list[str]) -> Iterator[tuple[list[bytes], Sentences]]:
    for block in blocks(iter(texts)):
        yield block, sentences(np.frombuffer(b"\n".join(block), np.uint8), [len(x) for x in block])


def _once_a_document(s: Sentences) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each kind of feature: hashes and texts of the block, once for each pair."""
    for f in s.features:
        doc = s.of_doc[s.of_word]
        order = np.lexsort((f, doc))
        f, doc = f[order], doc[order]
        new = (f != 0) & ((np.diff(f, prepend=~f[:1]) != 0) | (np.diff(doc, prepend=-1) != 0))
        yield f[new], doc[new]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Noisy-or model from document labels (0 or 1), in numpy."""
    toxic = np.asarray(toxic, bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, float(toxic.mean()) if len(toxic) else 0.0)
    # first the features that tell, each counted once a document; only those whose hash range is in enough toxic
    # documents are counted one by one, block after block
    in_toxic = np.zeros(1 << _BITS, np.int64)
    done = 0
    for block, s in _in_blocks(texts):
        for f, doc in _once_a_document(s):
            in_toxic += np.bincount((f[toxic[doc + done]] >> np.uint64(64 - _BITS)).astype(np.int64), minlength=1 << _BITS)
        done += len(block)
    known, n, n_bad, done = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0
    for block, s in _in_blocks(texts):
        for f, doc in _once_a_document(s):
            some = in_toxic[(f >> np.uint64(64 - _BITS)).astype(np.int64)] >= LEAST_DOCS
            f, doc = f[some], doc[some]
            known, place = np.unique(np.concatenate([known, f]), return_inverse=True)
            n = np.bincount(place, np.concatenate([n, np.ones(len(f))]), len(known))
            n_bad = np.bincount(place, np.concatenate([n_bad, toxic[doc + done]]), len(known))
        done += len(block)
    # how far the share of toxic documents is above the usual, in standard errors
    share = toxic.mean()
    tied = np.where(n_bad >= LEAST_DOCS, (n_bad - n * share) / np.sqrt(n * share * (1 - share)), -np.inf)
    best = np.argsort(-tied, kind="stable")[:FEATURES]
    known = np.sort(known[best[tied[best] > 2]])
    # then the sentences they stand in
    finder = Model(known, np.zeros(len(known)), 0.0)
    pairs, doc_of, done, n_sentences = [], [], 0, 0
    for block, s in _in_blocks(texts):
        pairs.append(finder.pairs(s) + n_sentences * max(1, len(known)))
        doc_of.append(s.of_doc + done)
        done, n_sentences = done + len(block), n_sentences + len(s.start)
    pairs, doc_of = np.concatenate(pairs), np.concatenate(doc_of)
    rows, columns, best = pairs // max(1, len(known)), pairs % max(1, len(known)), known
    named, rows = np.unique(rows, return_inverse=True)  # sentences with a chosen feature; the others are alike
    doc = doc_of[named]
    plain = np.bincount(doc_of, minlength=len(texts)) - np.bincount(doc, minlength=len(texts))
    theta = np.concatenate([np.zeros(len(best)), [-6.0]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        p = _sigmoid(np.bincount(rows, theta[columns], minlength=len(named)) + theta[-1])
        p0 = _sigmoid(theta[-1])
        clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(texts)) + plain * np.log1p(-p0)
        whole = -np.expm1(clean)
        # d loss / d log(1 - p) of each document, and that is -p for a sentence's logit
        pull = np.where(toxic, np.exp(clean) / np.maximum(whole, 1e-9), -1.0) / len(texts)
        by_sentence = -pull[doc] * p
        slope = np.append(np.bincount(columns, by_sentence[rows], minlength=len(best)),
                          by_sentence.sum() - (pull * plain).sum() * p0)
        slope[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        theta -= RATE * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(known, theta[:-1], float(theta[-1]))


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                    label: str = "toxic", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents that are not held out, in the order of a hash of their ids."""
    marks = (labels.select(labels[id_col].alias("id"), labels[label].alias("toxic"))
             .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.lit(29), F.col("id"))
    picked = marks.orderBy(order, "id").limit(rows)
    return (docs.select(docs[id_col].alias("id"), docs[text].alias("text")).where(F.length("text") <= chars)
            .join(F.broadcast(picked), "id").orderBy(order, "id", "text").limit(rows).select("text", "toxic"))


def train(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    """The model of a bounded sample of labelled documents, fitted in a task; only its weights reach the driver."""
    prepare_workers(docs.sparkSession)

    def each(batches):
        sample = pa.Table.from_batches(batches, pa.schema([("text", pa.string()), ("toxic", pa.int32())]))
        model = fit(sample.column("text").to_pylist(), sample.column("toxic").to_numpy())
        yield pa.RecordBatch.from_pydict(
            {"known": [model.known.tobytes()], "weights": [model.weights.tobytes()], "base": [model.base],
             "constant": [model.constant]}, schema=pa.schema([("known", pa.binary()), ("weights", pa.binary()),
                                                              ("base", pa.float64()), ("constant", pa.float64())]))

    sample = labelled_sample(docs, labels, **columns).select(F.col("text").cast("string"), F.col("toxic").cast("int"))
    row = sample.coalesce(1).mapInArrow(each, "known binary, weights binary, base double, constant double").first()
    if row is None:  # nothing at all to learn from
        return fit([], np.zeros(0))
    return Model(np.frombuffer(row.known, np.uint64), np.frombuffer(row.weights), row.base, row.constant)


def _scored(texts: Iterator[str | None], model: Model) -> Iterator[tuple[float, list[dict]]]:
    """Score and offending sentences (code points, end exclusive) of each text."""
    for block in blocks(texts):
        raw = np.frombuffer(b"\n".join(block), np.uint8)
        s = sentences(raw, [len(x) for x in block])
        p = _sigmoid(model.logits(s))
        clean = np.bincount(s.of_doc, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(block))
        score = -np.expm1(clean) if model.constant is None else np.full(len(block), model.constant)
        spans: list[list[dict]] = [[] for _ in block]
        at = np.cumsum([0] + [len(x) + 1 for x in block])
        for i in np.flatnonzero(p >= 0.5) if model.constant is None else ():
            d = int(s.of_doc[i])
            begin, end = s.start[i], s.end[i]
            points = (raw[at[d]:end] & 0xC0) != 0x80  # bytes that begin a code point
            before = int(points[: begin - at[d]].sum())
            spans[d].append({"start": before, "end": before + int(points[begin - at[d]:].sum()), "score": float(p[i])})
        yield from zip(score.tolist(), spans, strict=True)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, sentences) of every document.

    ``score`` is in 0 to 1, ``sentences`` are those of probability 0.5 or more
    as (start, end, score) in code points. A null, empty or wordless text has
    no sentence and scores 0; without both labels to learn from, every text
    scores the share of toxic ones. Rows are neither added nor lost; columns
    other than the id are not returned.
    """
    prepare_workers(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights and a fixed bit table

    def each(batches):
        for batch in batches:
            found = list(_scored((x.as_py() for x in batch.column(1)), held.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.float64()),
                 pa.array([x for _, x in found], _SPANS)], names=[id_col, "score", "sentences"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col], docs[text].alias("text")).mapInArrow(
        each, f"`{id_col}` {kind}, score double, sentences array<struct<start:int,end:int,score:double>>")


def without_toxic(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents whose score stays below ``limit``, their columns as they are."""
    prepare_workers(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def each(batches):
        for batch in batches:
            keep = [x < limit for x, _ in _scored((x.as_py() for x in batch.column(at)), held.value)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(each, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "sentences")


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLE = {}
