"""Each stage of the pipeline against a plain version of it, on its own input."""

import public_tokenizers
from test_linededup import brute as lines_gone
from test_minhash import brute as near
from test_mixing import water_fill
from tokenizers import Tokenizer

import corpus_pipeline as p
from emberwall.llm.common import table
from emberwall.llm.toxicity import score, train

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_turn(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in p.STAGES] == ["toxicity", "line_dedup", "minhash_neardup", "mix_sources", "bpe"]
    rows = {r.doc_id: r for r in docs.collect()}

    clean = p.drop_toxic(spark, docs, SF)
    scores = {r.doc_id: r.score for r in score(docs, train(docs, table(spark, SF, "labels"))).collect()}
    assert clean.columns == docs.columns
    kept = {r.doc_id: r for r in clean.collect()}
    assert set(kept) == {d for d in rows if scores[d] < 0.5} and all(kept[d] == rows[d] for d in kept)
    toxic = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    assert sum(toxic.get(d) == 0 for d in set(rows) - set(kept)) == 0

    cut = {r.doc_id: r for r in p.dedup_lines(spark, clean, SF).collect()}
    pairs = [(d, r.text) for d, r in kept.items()]
    for (d, text), gone in zip(pairs, lines_gone(pairs, 10), strict=True):
        lines = (text or "").split("\n")
        left = "\n".join(x for i, x in enumerate(lines) if i not in set(gone))
        assert (d in cut) == (len(gone) < len(lines))
        if d in cut:
            assert cut[d].text == left and cut[d].n_chars == len(left)

    unique = p.dedup_near(spark, spark.createDataFrame(list(cut.values()), docs.schema), SF)
    groups = {d: c for d, _, c in near([(d, r.text, 0) for d, r in cut.items()])}
    alone = {r.doc_id: r for r in unique.collect()}
    assert unique.count() == len(alone) and set(alone) == {d for d, c in groups.items() if d == c}

    mixed = p.mix_sources(spark, unique, SF)
    assert mixed.columns == docs.columns
    sizes, taken = {}, {}
    for r in alone.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.encode().split())
    many = mixed.collect()
    for r in many:
        assert r == alone[r.doc_id]
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    assert sum(abs(taken.get(s, 0) - t) for s, t in water_fill(sizes).items()) < 0.1 * sum(sizes.values())

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = p.encode_text(spark, mixed, SF).collect()
    assert len(coded) == len(many)
    assert all(r.token_ids == library.encode(r.text, add_special_tokens=False).ids for r in coded[::7])


def test_odd_rows(spark):
    rows = [(1, None, "en", None, 0), (2, "", "en", "s", 0), (3, "a b c", None, "s", 5), (3, "a b c", None, "s", 5),
            (None, "some words that stay here", "x", "t", None), (4, "w " * 30_000, "en", "t", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in p.STAGES[:-1]:
        docs = p.cut_lineage(stage(spark, docs, SF))
        assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")] and docs.count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in p.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_one_row_of_each_group(spark):
    same = "one two three four five six"
    rows = [(3, same, "a", "s", 1), (3, same, "b", "s", 1), (2, same + " ", "c", "s", 1), (None, same, "d", "s", 1),
            (7, None, "e", "s", 1), (7, "", "f", "s", 1), (8, "other words", "g", "s", 1), (8, "yet more", "h", "s", 1)]
    out = p.dedup_near(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert sorted(r.lang for r in out) == ["c", "e", "f", "g", "h"]


def test_run(spark):
    out = p.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"] and out.count() > 50
