"""SimHash against a bit-by-bit version, edited texts, and the block tables against all pairs."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from emberwall.llm.simhash import RADIUS, fingerprint_report, op9_simhash, within_radius


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    pairs = list(zip(w, w[1:])) if len(w) > 1 else [(x, None) for x in w]
    votes = [0] * 64
    for a, b in pairs:
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        h = h if b is None else xxhash.xxh64_intdigest(b.encode(), h)
        n = len(a) + len(b or "")
        x = 1 if n < 6 else 2 if n < 12 else 3
        for i in range(64):
            votes[i] += x if h >> i & 1 else -x
    return f"{sum(1 << i for i in range(64) if votes[i] > 0):016x}"


def expected(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (d, t) in enumerate(rows):
        t, following = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), plain(t), plain(edited), plain(following))
    return out


def check(rows, out):
    want = expected(rows)
    assert len(out) == len(rows)
    for r in out:
        n, sha, own, edit, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, own, edit)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (own == edit) and (r.near_next == 1) == (own == following)


def test_matches_bit_by_bit_version(spark):
    rng = random.Random(4)
    words = ["a", "été", "日本", "longer", "words", "x" * 20, "🙂", "the", "of"]
    rows = [(i * 7 % 1009, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(120)]
    rows += [(2000, None), (2001, ""), (2002, "one"), (2003, " \n"), (2004, "go " * 30_000), (2005, "go " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(rows, fingerprint_report(df).collect())


def test_repeated_rows_single_rows_and_clashing_columns(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (1, "x y z")]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, place string, k1 int")
    out = fingerprint_report(df, query=F.col("id") >= 0).collect()
    assert len(out) == 3 and len({r.fingerprint for r in out if r.doc_id == 3}) == 1
    assert {r.n_near for r in out if r.doc_id == 3} == {1} and {r.n_near for r in out if r.doc_id == 1} == {0}
    one = fingerprint_report(df.limit(1)).first()
    assert one.near_next == 1 and fingerprint_report(df.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c"), (5, "d e f")], "doc_id long, text string")
    assert fingerprint_report(nulls).count() == 2


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for b in base:
        for n in range(1, 7):
            x = b
            for i in rng.sample(range(64), n):
                x ^= 1 << i
            prints.add(x)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    counts = spark.createDataFrame([(s, i % 3 + 1) for i, s in enumerate(signed.values())], "fingerprint long, n long")
    many = dict(counts.collect())
    got = dict(within_radius(counts.select("fingerprint"), counts).collect())
    for p, s in signed.items():
        assert got[s] == sum(many[signed[q]] for q in prints if bin(p ^ q).count("1") <= RADIUS)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = op9_simhash(spark, sf).collect()
    check(rows, out)
    assert all((r.n_near is not None) == (r.doc_id % 50 == 0) for r in out)
    edited, following = (sum(r[c] for r in out) / len(out) for c in ("near_edited", "near_next"))
    assert edited > following + 0.3
