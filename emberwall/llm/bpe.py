"""BPE encoding and decoding by a traversal of the trie of distinct words.

The encoding of a word's prefix is known from its last token alone: the rest is
the encoding of what stands before that token. Distinct words are visited in
sorted order, which is the depth-first order of their trie; a stack holds the
last token of every prefix on the current path, so a prefix that many words
share is worked out once. The last token of a longer prefix is the one token at
its end that byte-pair merging would leave next to the token before it.

Spark splits the rows; every Python worker keeps a bounded table of the words
it has seen. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from .common import table, prepare_workers

#: Words a worker remembers before it starts anew, and characters of text worked on at a time.
WORDS_KEPT = 200_000
BLOCK_CHARS = 1 << 20

_CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d|"
_BLANK = r"\t-\r \x85\xa0  -     　"
_ASCII_PIECES = re.compile(_CONTRACTION + r"[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class TrieBpe:
    """A byte-pair vocabulary with word ends, made from the text of a tokenizer file."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}  # when a token is made; the letters at once
        self.parts: dict[int, tuple[int, int]] = {}
        for n, (a, b) in enumerate(model["merges"]):
            whole = self.ids[a + b]
            self.merged[self.ids[a], self.ids[b]] = whole
            self.rank[whole], self.parts[whole] = n, (self.ids[a], self.ids[b])
        self.longest = max(len(t) - len(self.end) * t.endswith(self.end) for t in self.ids)
        self.letters = {chr(b): c for b, c in enumerate(byte_characters())}
        self.length = {i: len(t) - len(self.end) * t.endswith(self.end) for t, i in self.ids.items()}
        self.neighbours: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self._pieces = None
        self._special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    # -- from text to words ------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """Normalised pieces of a text without special tokens.

        Letters and numbers are those of the installed Unicode tables; code points
        that other versions assign otherwise may be cut elsewhere.
        """
        if text.isascii():
            return _ASCII_PIECES.findall(text.lower())
        if self._pieces is None:
            import regex

            self._pieces = regex.compile(_CONTRACTION + rf"[\p{{L}}]+|[\p{{N}}]|[^{_BLANK}\p{{L}}\p{{N}}]+")
        text = unicodedata.normalize("NFC", text)
        # letter by letter: a sigma at a word's end is an ordinary one here
        text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        return self._pieces.findall(text)

    # -- the trie ----------------------------------------------------------------------------------------------

    def stays(self, a: int, b: int) -> bool:
        """Whether merging the letters of tokens a and b leaves just these two side by side.

        Goes back in time from the finished tokens, undoing the later of the two
        merges next to their border; a merge across it must not have been due.
        """
        key = a << 20 | b
        if (known := self.neighbours.get(key)) is not None:
            return known
        never = len(self.rank) + 1
        gone_a = gone_b = never  # when the token at the border is merged further
        result = True
        while True:
            across = self.merged.get((a, b))
            if across is not None and self.rank[across] < gone_a and self.rank[across] <= gone_b:
                result = False
                break
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                gone_a, a = ra, self.parts[a][1]
            elif rb > ra:
                gone_b, b = rb, self.parts[b][0]
            else:  # one rule makes both: from the left, so the right one is undone first
                gone_b, b = rb, self.parts[b][0]
        if len(self.neighbours) > 200_000:
            self.neighbours.clear()
        self.neighbours[key] = result
        return result

    def _last(self, path: str, suffix: str, tokens: list[int]) -> int:
        """The last token of ``path`` (+ suffix), given those of its shorter prefixes."""
        n = len(path)
        for size in range(min(n, self.longest), 0, -1):
            token = self.ids.get(path[n - size:] + suffix)
            if token is not None and (size == n or self.stays(tokens[n - size], token)):
                return token
        raise ValueError(f"no token ends {path!r}")

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Token ids of distinct words, in sorted order: each trie node is entered once."""
        tokens, before = [-1], ""  # tokens[n]: last token of the current path's first n letters
        for word in sorted(words):
            raw = word.encode("utf-8", "surrogatepass").decode("latin-1")
            path = "".join(map(self.letters.__getitem__, raw))
            shared = 0
            for x, y in zip(path, before):
                if x != y:
                    break
                shared += 1
            del tokens[shared + 1:]
            for n in range(len(tokens), len(path)):
                tokens.append(self._last(path[:n], "", tokens))
            before = path
            n, out = len(path), [self._last(path, self.end, tokens)]
            n -= self.length[out[0]]
            while n:
                out.append(tokens[n])
                n -= self.length[tokens[n]]
            yield word, out[::-1]

    # -- whole texts -------------------------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids (little-endian unsigned 32-bit) of each text; a null text is empty."""
        parts = []
        for text in texts:
            pieces = self._special_at.split(text or "") if self._special_at else [text or ""]
            parts.append([(x, None) if i % 2 else (None, self.words(x)) for i, x in enumerate(pieces)])
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        new = set()
        for row in parts:
            for _, words in row:
                new.update(words or ())
        for word, ids in self.encode_words(new.difference(self.known)):
            self.known[word] = np.array(ids, "<u4").tobytes()
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(b"".join(map(known, words)) if name is None
                                       else self.special[name].to_bytes(4, "little") for name, words in row), "<u4")
                for row in parts]

    def decode(self, ids: Iterable[int]) -> str:
        """Token texts with blanks between, as this kind of vocabulary has no decoder of its own."""
        return " ".join(map(self.names.__getitem__, ids))


_loaded: dict[int, TrieBpe] = {}


def _vocabulary(definition) -> TrieBpe:
    """This worker's vocabulary, made once from the broadcast definition."""
    if definition.id not in _loaded:
        _loaded.clear()
        _loaded[definition.id] = TrieBpe(definition.value)
    return _loaded[definition.id]


class _Definition:
    """A broadcast with its identity; a tokenizer file has a fixed size of a few MB."""

    def __init__(self, spark: SparkSession, path: str | None):
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        with open(path, encoding="utf-8") as f:
            text = f.read()
        prepare_workers(spark)
        self.id = hashlib.sha256(text.encode()).hexdigest()
        self.held = spark.sparkContext.broadcast(text)

    @property
    def value(self) -> str:
        return self.held.value


def _encoded(texts: pa.Array, bpe: TrieBpe) -> Iterator[np.ndarray]:
    """Ids of each text, a block of texts at a time."""
    held, size = [], 0
    for text in texts:
        text = text.as_py()
        held.append(text)
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield from bpe.encode(held)
            held, size = [], 0
    yield from bpe.encode(held)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", into: str = "token_ids") -> DataFrame:
    """``docs`` with an array of token ids (replacing a column of that name).

    A null or empty text has an empty array; rows are neither added nor lost,
    so repeated rows repeat and an empty table stays empty. ``path`` names a
    tokenizer file, read on the driver and sent to the workers once.
    """
    definition = _Definition(docs.sparkSession, path)
    kept = [c for c in docs.columns if c not in (into, text)]
    schema = docs.select(*kept, text).schema.add("ids", T.ArrayType(T.IntegerType()))
    schema.fields[-1].name = into

    def each(batches):
        bpe = _vocabulary(definition)
        for batch in batches:
            ids = [x.view("<i4") for x in _encoded(batch.column(len(kept)), bpe)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, into])

    if into == text:
        raise ValueError("the ids need a column of their own")
    return docs.select(*kept, text).mapInArrow(each, schema).select(*[c for c in docs.columns if c != into], into)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its token ids (replacing a column of that name); null ids give a null text."""
    definition = _Definition(encoded.sparkSession, path)
    kept = [c for c in encoded.columns if c not in (into, ids)]
    schema = encoded.select(*kept, ids).schema.add("text", "string")
    schema.fields[-1].name = into

    def each(batches):
        bpe = _vocabulary(definition)
        for batch in batches:
            texts = [bpe.decode(x.values.to_pylist()) if x.is_valid else None for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, into])

    if into == ids:
        raise ValueError("the text needs a column of its own")
    return encoded.select(*kept, ids).mapInArrow(each, schema).select(*[c for c in encoded.columns if c != into], into)


def digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every text encoded, its ids decoded, both hashed in one pass."""
    definition = _Definition(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]

    def each(batches):
        bpe = _vocabulary(definition)
        for batch in batches:
            counts, ids, texts = [], [], []
            for x in _encoded(batch.column(1), bpe):
                counts.append(len(x))
                ids.append(hashlib.sha256(x.tobytes()).hexdigest())
                texts.append(hashlib.sha256(bpe.decode(x.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=names)

    return docs.select(docs[id_col], docs[text].alias("text")).mapInArrow(
        each, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded with the word vocabulary and decoded again."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op8_bpe": op8_bpe}
ORACLE = {}
