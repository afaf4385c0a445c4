"""URL rules: parts of URLs, written rules, and mined rules against counting all combinations."""

import itertools
import random
from collections import Counter

import pytest

from emberwall.llm import urlrules as U

SCHEMA = "page_id long, url string, host string, tokens string"


def parts(url):
    if url is None or "://" not in url:
        return "", "", []
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    host, tail = lower(rest[:cut]), rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    path = tail[:end]
    query = lower(rest.split("#")[0].split("?", 1)[1]) if "?" in rest.split("#")[0] else ""

    def shape(s):
        out = ""
        for digit, run in itertools.groupby(s, lambda c: c in "0123456789"):
            run = "".join(run)
            out += run[0] + "#" * (len(run) > 1) if digit else run
        return out

    tokens = {f"h:{shape(x)}" for x in host.split(".") if x}
    tokens |= {f"p{i}:{shape(x)}" for i, x in enumerate(x for x in lower(path).split("/") if x)}
    tokens |= {f"q:{shape(k)}" for k in (x.split("=")[0] for x in query.split("&")) if k}
    return host, path, sorted(tokens)


def listed(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(urls):
    rows = [(*parts(u), *listed(*parts(u)[:2])) for u in urls]
    known = [(t, v) for _, _, t, _, v in rows if v]
    n, least = len(known), max(2, -(-len(known) // U.SUPPORT))
    blocked = sum(v == "block" for _, v in known)
    count, block = Counter(x for t, _ in known for x in t), Counter(x for t, v in known if v == "block" for x in t)
    total, hits = Counter(), Counter()
    for t, v in known:
        told = sorted((x for x in t if count[x] >= least), key=lambda x: (-abs(block[x] * n - count[x] * blocked), x))[:U.TELLING]
        for k in range(1, U.ITEMS + 1):
            for items in itertools.combinations(sorted(told), k):
                total[items] += 1
                hits[items, v] += 1
    rules = [(-c / total[i], -c, len(i), i, v) for (i, v), c in hits.items() if c >= least and c * 100 >= total[i] * U.CONFIDENCE]
    out = []
    for host, path, t, rule, verdict in rows:
        best = min((r for r in rules if set(r[3]) <= set(t)), default=None)
        out.append((host, path, rule, verdict or (best[4] if best else "allow")))
    return out


def got(spark, urls):
    df = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(urls)], SCHEMA).repartition(3)
    out = U.judge(df)
    assert out.columns == [*df.columns, "url_filter"]
    rows = out.orderBy("page_id").select("page_id", "url_filter.*").collect()
    assert [r.page_id for r in rows] == list(range(len(urls)))
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


ODD = [None, "", "no address", "://", "http://", "http://ORG/", "http://x.org", "http://xorg/", "http://a.Example.ORG/es/1",
       "ftp://example.org/en/1", "example.org/en/1://a.net/b", "http://example.org/en/15?x=1", "http://com/fr/?q://x.org/",
       "http://a.com/de/#x", "http://a.com?/de/", "http://a.b.com/fr", "HTTP://É.net/É/99?A=1&&b", "http://x.net/" + "a/9" * 5000,
       "http://u@x.org:80/", "http://x.net/a\nb/c?d\ne#f"]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_combinations(spark, seed):
    rng = random.Random(seed)
    urls = [f"https://{rng.choice(['www', 'm', 'spam'])}.{rng.choice(['a1', 'b22', 'c'])}.example.{rng.choice(['com', 'net', 'org'])}"
            f"/{rng.choice(['de', 'en', 'es', 'fr'])}/{rng.randrange(300)}{rng.choice(['', '?page=2&ref=x', '#top', '.html'])}"
            for _ in range(400)] + ODD + ["http://one.example.net/de/1?ref=y"] * 30
    assert got(spark, urls) == brute(urls)


def test_urls_of_many_tokens_are_mined_whole(spark, monkeypatch):
    """Tokens past the ten most telling of a URL count as well, in rules of one and of more."""
    rng = random.Random(3)
    many = lambda: "&".join(sorted(rng.sample([f"k{chr(97 + i)}" for i in range(12)], 9)) + ["z"])
    urls = [f"http://x.com/de/a?{many()}" for _ in range(20)] + [f"http://y.com/fr/b?{many()[:-1]}y" for _ in range(20)] + [
        "http://w.net/?z", "http://w.net/?y", "http://w.net/?ka&kb", *[f"http://w.net/?{many()}" for _ in range(5)]]
    got_ = got(spark, urls)
    monkeypatch.setattr(U, "TELLING", None)  # of the count of all combinations, which then takes all tokens
    assert got_ == brute(urls)
    assert got_[40][3] == "block" and got_[41][3] == "allow"


def test_without_labels_all_is_allowed(spark):
    urls = ["http://a.net/x", None, "http://b.net/de/1"]
    assert got(spark, urls) == [("a.net", "/x", None, "allow"), ("", "", None, "allow"), ("b.net", "/de/1", None, "allow")]


def test_empty_table(spark):
    assert got(spark, []) == []


def test_pruned_rules_lose_nothing(spark):
    """A rule is left out only for a shorter one at least as sure."""
    urls = [f"http://x.com/{p}/{i % 3}" for p in ("de", "fr") for i in range(40)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    h, p = U.host(df.url), U.path(df.url)
    keyed = df.select(U.tokens(df.url, h, p).alias("tokens"), U.listed_rule(h, p, U.LISTED)[1].alias("listed"))
    rules = {(tuple(r["items"]), r.verdict) for r in U.mined_rules(U.token_sets(keyed)).collect()}
    assert rules == {(("p0:de",), "block"), (("p0:fr",), "allow")}


def test_main_path_has_no_python(spark):
    df = U.op11_url_rules(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
