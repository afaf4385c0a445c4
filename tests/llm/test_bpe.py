"""Trie byte-pair encoding against the tokenizers library, id by id."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from emberwall.llm.bpe import TrieBpe, byte_characters, decode, digests, encode, op8_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    OURS = TrieBpe(f.read())


def same(text):
    ids = OURS.encode([text])[0].tolist()
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids == want and OURS.decode(ids) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cs", "Cn")), max_size=60))
def test_any_text(text):
    assert same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abnointrs' ", max_size=60))
def test_merge_order(text):
    assert same(text)


@pytest.mark.parametrize("text", [
    "", " ", "\n\t\x0b", "a", "aaaaaaaaaaaaaaaaa", "It's WE'LL don't", "ΣΊΣΥΦΟΣ ΣΑΣ Σ", "İstanbul", "é ẛ̣",
    "<|endoftext|>", "x<|startoftext|> Y<|endoftext|><|endoftext|>", "<|ENDOFTEXT|>", "1234 ½ Ⅷ ٣", "👍🏽 日本語 한글",
    "a\x85b\xa0c　d\x1ce", "=" * 500, "antidisestablishmentarianism" * 40])
def test_chosen_texts(text):
    assert same(text)


def test_tokens_are_their_own_encoding():
    rng = random.Random(3)
    back = {c: b for b, c in enumerate(byte_characters())}
    for token in rng.sample(sorted(OURS.ids), 4000):
        if token.endswith("</w>"):
            raw = bytes(back[c] for c in token[:-4])
            try:
                assert same(raw.decode())
            except UnicodeDecodeError:
                pass


def test_spark_columns_and_odd_rows(spark):
    rows = [(1, "Hello world", "x", 5), (1, "Hello world", "x", 5), (2, None, "y", 6), (3, "", "z", 7),
            (None, "tail " * 40_000, "z", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, n_tokens int")
    out = encode(docs)
    assert out.columns == [*docs.columns, "token_ids"]
    got = decode(out, into="back").collect()
    assert {r.n_tokens for r in got} == {5, 6, 7, 8}
    for r in got:
        want = LIBRARY.encode(r.text or "", add_special_tokens=False)
        assert r.token_ids == want.ids and r.back == LIBRARY.decode(want.ids, skip_special_tokens=False)
    assert len(got) == 5 and encode(docs.limit(0)).count() == 0 == digests(docs.limit(0)).count()
    with pytest.raises(ValueError):
        encode(docs, into="text")


def test_query_digests(spark):
    df = op8_bpe(spark, "/root/testdata/sf0.01")
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect())
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in want)
        text = LIBRARY.decode(want, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(want), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
