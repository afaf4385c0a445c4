"""Keywords and gate of the license rules: one example per alternative, and the table, against rules without either."""

import re
from itertools import zip_longest
from re import _parser

from emberwall.llm.licenses import GATE, needed, rules, scan


def examples(parsed):
    """Strings of a parsed pattern, every alternative in one of them."""
    out = [""]
    for op, value in parsed:
        parts = [""]
        if op is _parser.LITERAL:
            parts = [chr(value)]
        elif op is _parser.IN:
            parts = [" " if o is _parser.CATEGORY and v is _parser.CATEGORY_SPACE else "4" if o is _parser.CATEGORY
                     else chr(v if o is _parser.LITERAL else v[0]) for o, v in value]
        elif op is _parser.ANY:
            parts = ["x"]
        elif op is _parser.SUBPATTERN:
            parts = examples(value[-1])
        elif op is _parser.BRANCH:
            parts = [x for p in value[1] for x in examples(p)]
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT):
            parts = [x * max(1, value[0]) for x in examples(value[2])] + [""] * (value[0] == 0)
        out = [a + b for a, b in zip_longest(out, parts, fillvalue=None) if a is not None and b is not None] + [
            out[0] + b for b in parts[len(out):]] + [a + parts[0] for a in out[len(parts):]]
    return out


def detections(low):
    """All rules on a lower-cased text, without keywords and gate."""
    found = [(m.start(), m.end(), label, rank, n) for n, (_, p, label, rank) in enumerate(COMPILED)
             for m in p.finditer(low)]

    def beaten(d):
        for e in found:
            over, under = e[0] <= d[0] and e[1] >= d[1], e[0] >= d[0] and e[1] <= d[1]
            if e[4] != d[4] and ((over or under) and e[3] < d[3] or over and e[3] == d[3] and (not under or e[4] < d[4])):
                return True
        return False

    return sorted(d for d in found if not beaten(d))


COMPILED = [(k, re.compile(p, re.ASCII), label, rank) for k, p, label, rank in rules()]
SAMPLES = sorted({x for _, p, _, _ in rules() for x in examples(_parser.parse(p)) if re.search(p, x, re.ASCII)})


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def got(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    return {r.doc_id: [tuple(d) for d in r.licenses.detections] for r in scan(df).collect()}


def test_every_example_has_keyword_and_gate():
    assert len(SAMPLES) > 1000
    for keywords, p, _, _ in COMPILED:
        hits = [x for x in SAMPLES if p.search(x)]
        assert hits, p.pattern
        for x in hits:
            part = p.search(x)[0]
            assert any(w in part for w in keywords.split("|")) and any(w in part for w in GATE), (part, p.pattern)
            assert all(any(w in part for w in c) for c in needed(p.pattern)), (part, p.pattern)


def test_examples_as_without_keywords(spark):
    out = got(spark, SAMPLES)
    for i, x in enumerate(SAMPLES):
        assert out[i] == detections(lower(x)), x


def test_table_as_without_keywords(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    out = got(spark, texts)
    for i, x in enumerate(texts):
        assert out[i] == detections(lower(x))
    assert any(out.values())


def test_alternatives_that_were_lost(spark):
    lost = {"CC-BY-SA 4.0": "cc-by-sa", "published under Apache 2.0": "apache-2.0", "distributed with MPL 2.0": "mpl-2.0",
            "see eclipse.org/legal/epl-2.0": "epl-2.0", "trade secrets of X": "proprietary", "scripts.sil.org/OFL": "ofl-1.1",
            "covered  by the BSD": "bsd", "for academic purposes only": "research-only",
            "for noncommercial use only": "non-commercial", "End-User Licence Agreement": "commercial",
            "commercial licence agreement": "commercial", "dual licensed": "dual", "Expat license": "mit",
            "Berkeley license": "bsd", "ASL 2.0 license": "apache-2.0", "University of Illinois license": "ncsa",
            "published under the free\ndocumentation licence": "gfdl"}
    out = got(spark, list(lost))
    assert {x: [d[2] for d in out[i]] for i, x in enumerate(lost)} == {x: [label] for x, label in lost.items()}
