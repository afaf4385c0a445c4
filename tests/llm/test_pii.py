"""Personal data: the fixed kinds by a plain version, contexts on a small corpus, odd rows."""

import hashlib
import re


from emberwall.llm.pii import KINDS, find, op5_pii, pattern_scores

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def plain(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(PLAIN[k], text or "") if holds(k, m[0])]


def joined(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


TEXTS = [None, "", "no digits here", "mail é.x@ab.cd.ef_g@h.i, a@b a@b.c.", "🙂 10.0.0.255 1.2.3.256 1.2.3.4.5.6.7.8 0001.02.3.004",
         "4111 1111 1111 1111 and 4111-1111-1111-1112 or 4111111111111111", "+1 (988) 555-2485 +12 +1234567890123456 +44 20 7946 0958.",
         "1" * 30_000 + " x@y.z", "1 2 3 4 5 6 7 8 9 0 " * 20_000, "9.9.9.9" * 3000, "+" * 50 + "1()()()2", "00000000000000 5-5 5- 5",
         "a+b%c@d-e.f-g " * 4000, "1.1.1.99999999999999999999999999999999999999999"]


def test_fixed_kinds(spark):
    rows = [(i, t, 0) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 0), (None, TEXTS[4], 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, email int").repartition(3)
    out = find(df).collect()
    assert len(out) == len(rows)
    for r in out:
        text = TEXTS[4 if r.doc_id is None else r.doc_id]
        assert [(k, s.start, s.end) for k in KINDS for s in r[k]] == plain(text)
    assert find(df.limit(0)).count() == 0


def test_contexts_add_what_the_patterns_miss(spark):
    texts = [f"write to mailbox user{i}@mail.example.com please" for i in range(8)]
    texts += ["write to mailbox user77@localhost please", "password=b7db7aa4a5fcc7", "password=7602ad27cf55", "password=531ccd051a92",
              'my password = "0a1b2c3d4e"', "PASSWORD=99aa88bb77", "version 1a2b3c4d5e of it", "the year 20202020 was long"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.context] for r in find(df).collect()}
    assert found[9] == ["b7db7aa4a5fcc7"] and found[13] == ["99aa88bb77"]
    assert found[14] == found[15] == [] and all(found[i] == [] for i in range(8))


def test_scores_of_the_graph(spark):
    links = [("p", f"v{i}", True) for i in range(4)] + [("p", "new", False), ("q", "new", False), ("q", "other", False),
                                                          ("r", "v0", True), ("r", "v1", True)]
    patterns, values = pattern_scores(spark.createDataFrame(links, "pattern string, value string, seed boolean"), rounds=2)
    p, v = dict(patterns.collect()), dict(values.collect())
    assert set(p) == {"p"} and abs(p["p"] - (4 + 0.8) / 5) < 1e-9  # after one round the new value has 0.8
    assert v["v0"] == 1 and abs(v["new"] - p["p"]) < 1e-9 and "other" not in v


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    df = op5_pii(spark, sf)
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = df.collect()
    assert len(rows) == len(texts) and any("context:" in r.spans for r in rows)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in base) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        parts = r.spans.split(",") if r.spans else []
        assert [x for x in parts if not x.startswith("context")] == joined(base).split(",") * bool(base)


def _timed(df):
    import time

    began = time.monotonic()
    row = df.collect()[0]
    return row, time.monotonic() - began


def test_many_matches_and_long_runs_take_seconds(spark):
    """Twenty thousand addresses, and runs of 200,000 digits or letters, in one text each."""
    mails = " ".join(f"user{i}@mail.example.org" for i in range(20_000))
    row, took = _timed(find(spark.createDataFrame([(1, mails)], "doc_id long, text string")))
    assert len(row.email) == 20_000 and not row.context and took < 30
    assert mails[row.email[-1].start: row.email[-1].end] == "user19999@mail.example.org"
    for long in ("7" * 200_000, "a" * 200_000, "1.2." * 50_000, "+1" + "(" * 200_000, "key = " * 30_000):
        row, took = _timed(find(spark.createDataFrame([(1, long)], "doc_id long, text string")))
        assert not row.email and not row.card and took < 30


def test_a_match_may_start_where_the_last_one_ends(spark):
    text = "a@b.co_x@d.org 1.2.3.4.5.6.7.8 x@y_z@w.com"
    row = find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [text[s.start: s.end] for s in row.email] == ["a@b.co", "_x@d.org", "y_z@w.com"]
    assert [text[s.start: s.end] for s in row.ip] == ["1.2.3.4", "5.6.7.8"]
