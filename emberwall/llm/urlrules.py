"""URL filters by association rules.

A short list of written rules (host, path) gives verdicts to the URLs that it
covers. Those are the labels: Spark's FP-growth mines the combinations of URL
tokens that go with a verdict, and combinations of enough support and
confidence become rules for the URLs that the list does not cover. A mined
rule is posted under its rarest token, so a URL meets only rules that share a
token with it. Only DataFrame functions and Spark's own FP-growth are used.

URLs with the same tokens are one set with counts throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ascii_lower, broadcast_if_small, cut_lineage, table

ALLOW, BLOCK = "allow", "block"
#: Written rules: verdict, host (with all its subdomains), beginning of the path.
LISTED = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
#: A rule's tokens and verdict stand together in one in so many labelled URLs at least (and twice), its verdict holds
#: for so many hundredths of the URLs with its tokens; a rule has few tokens. FP-growth lists every subset of what it is
#: given, so it mines where no labelled URL has more frequent tokens than TELLING; else PrefixSpan does, which can be
#: held to the length of a rule, over all tokens.
SUPPORT, CONFIDENCE, TELLING, ITEMS = 200, 80, 10, 3
#: Equal URLs that one row stands for when they are dealt out to FP-growth.
PART = 10_000
#: Verdict of a URL that no rule of either kind fits: blocking takes evidence.
DEFAULT = ALLOW


def _rest(url: Column) -> Column:
    """What follows the first ``://``; nothing for a null or other URL."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*+", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*+([^?#]*+)", 1)


def listed_rule(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest written rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:])):
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host_col: Column, path_col: Column) -> Column:
    """Distinct tokens of a URL, sorted: labels of the host, path segments with their place, keys of the query.

    A run of digits counts as its first digit and whether more follow.
    """
    query = ascii_lower(F.regexp_extract(_rest(url), r"^[^?#]*+\?([^#]*+)", 1))
    some = lambda parts: F.filter(parts, lambda x: x != "")
    shape = lambda x: F.regexp_replace(x, "([0-9])[0-9]+", "$1#")
    labels = F.transform(some(F.split(host_col, r"\.")), lambda x: F.concat(F.lit("h:"), shape(x)))
    segments = F.transform(some(F.split(ascii_lower(path_col), "/")),
                           lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), shape(x)))
    keys = F.transform(some(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
                       lambda x: F.concat(F.lit("q:"), shape(x)))
    return F.array_sort(F.array_distinct(F.concat(labels, segments, keys)))


def token_sets(urls: DataFrame) -> DataFrame:
    """(k1, k2, tokens, n_allow, n_block): the distinct token sets of ``urls`` (tokens, listed) and their labels."""
    count = lambda what: F.count_if(F.col("listed") == what)
    return urls.groupBy(F.xxhash64("tokens").alias("k1"), F.xxhash64(F.lit(1), "tokens").alias("k2")).agg(
        F.first("tokens").alias("tokens"), count(ALLOW).alias("n_allow"), count(BLOCK).alias("n_block"))


def mined_rules(sets: DataFrame, support: int = SUPPORT, confidence: int = CONFIDENCE) -> DataFrame | None:
    """(items, verdict, hits, total, post): association rules of the labelled token sets, each posted under its
    rarest token; None without labels.

    A rule whose proper subset is a rule of the same verdict and at least its confidence is left out.
    """
    labelled = sets.where(F.col("n_allow") + F.col("n_block") > 0)
    n, n_block = labelled.agg(F.sum(F.col("n_allow") + F.col("n_block")), F.sum("n_block")).first()
    if not n:
        return None
    least = max(2, -(-n // support))
    each = labelled.select("k1", "k2", "n_allow", "n_block", F.explode("tokens").alias("token"))
    vocabulary = each.groupBy("token").agg(F.sum(F.col("n_allow") + F.col("n_block")).alias("n"), F.sum("n_block").alias("b"))
    # at most `support` times the mean number of tokens of a labelled URL pass
    vocabulary = broadcast_if_small(cut_lineage(vocabulary.where(F.col("n") >= least)))
    tells = F.abs(F.col("b").cast("double") * n - F.col("n").cast("double") * n_block)
    kept = each.join(vocabulary.select("token", (-tells).alias("t")), "token").groupBy("k1", "k2", "n_allow", "n_block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("t", "token"))), lambda x: x.token).alias("tokens"))
    # FP-growth has no weights: a set stands as often as its URLs do, dealt out in parts
    labels = kept.select("tokens", F.inline(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(c).alias("count"))
                                                      for v, c in ((ALLOW, "n_allow"), (BLOCK, "n_block"))]))).where("count > 0")
    parts = labels.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(PART).cast("long"))))
    urls = parts.repartition("tokens", "verdict", "at").select(
        F.concat("tokens", F.array("verdict")).alias("items"),
        F.explode(F.array_repeat(F.lit(0), F.least(F.lit(PART), F.col("count") - F.col("at")).cast("int")))).select("items")
    widest = kept.agg(F.max(F.size("tokens"))).first()[0] or 0
    if widest <= TELLING:
        found = FPGrowth(minSupport=(least - 0.5) / n, minConfidence=1.0).fit(urls).freqItemsets
    else:  # of sorted items, one after the other, the patterns are the itemsets
        spans = PrefixSpan(minSupport=(least - 0.5) / n, maxPatternLength=ITEMS + 1)
        found = spans.findFrequentSequentialPatterns(urls.select(F.transform(F.array_sort("items"), lambda x: F.array(x)).alias("sequence")))
        found = found.select(F.flatten("sequence").alias("items"), "freq").where(F.col("freq") >= least)
    verdict = F.get(F.filter("items", lambda x: x.isin(ALLOW, BLOCK)), F.lit(0))
    frequent = found.where(F.size("items") <= ITEMS + 1).select(
        F.array_sort(F.array_except("items", F.array(F.lit(ALLOW), F.lit(BLOCK)))).alias("items"), verdict.alias("verdict"), "freq")
    frequent = cut_lineage(frequent.where(F.size("items").between(1, ITEMS)))
    totals = frequent.where("verdict is null").select("items", F.col("freq").alias("total"))
    rules = frequent.where("verdict is not null").withColumnRenamed("freq", "hits").join(totals, "items").where(
        F.col("hits") * 100 >= F.col("total") * confidence)
    rules = cut_lineage(rules)
    smaller = rules.select(F.col("items").alias("sub"), F.col("verdict").alias("v"), (F.col("hits") / F.col("total")).alias("c"))
    place = F.sequence(F.lit(1), F.lit((1 << ITEMS) - 2))
    parts = rules.where(F.size("items") > 1).select("items", "verdict", (F.col("hits") / F.col("total")).alias("c0"), F.explode(
        F.array_distinct(F.transform(place, lambda m: F.filter("items", lambda x, i: F.call_function("shiftright", m, i).bitwiseAND(1) == 1)))).alias("sub"))
    covered = parts.where((F.size("sub") > 0) & (F.size("sub") < F.size("items"))).join(smaller, "sub").where(
        (F.col("verdict") == F.col("v")) & (F.col("c") >= F.col("c0"))).select("items", "verdict").distinct()
    pruned = cut_lineage(rules.join(covered, ["items", "verdict"], "left_anti").withColumn("rule", F.monotonically_increasing_id()))
    rarest = pruned.select("rule", F.explode("items").alias("token")).join(vocabulary.select("token", "n"), "token").groupBy(
        "rule").agg(F.min_by("token", F.struct("n", "token")).alias("post"))
    return cut_lineage(pruned.join(rarest, "rule").select("items", "verdict", "hits", "total", "post"))


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(k1, k2, verdict, mined, confidence) of the token sets that a rule fits: the surest rule, then the one of most
    URLs, of fewest tokens, of the first tokens."""
    posted = sets.select("k1", "k2", "tokens", F.explode("tokens").alias("post")).join(broadcast_if_small(rules), "post")
    fits = posted.where(F.forall("items", lambda x: F.array_contains("tokens", x)))
    best = F.min(F.struct((-F.col("hits") / F.col("total")).alias("c"), (-F.col("hits")).alias("h"), F.size("items").alias("n"),
                          "items", "verdict")).alias("best")
    return fits.groupBy("k1", "k2").agg(best).select(
        "k1", "k2", F.col("best.verdict").alias("mined_verdict"), F.array_join("best.items", " ").alias("mined"),
        (-F.col("best.c")).alias("confidence"))


def judge(urls: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = LISTED, support: int = SUPPORT,
          confidence: int = CONFIDENCE) -> DataFrame:
    """``urls`` with a struct ``url_filter``: host, path, rule, verdict, mined, confidence.

    ``rule`` is the longest written rule that fits (null if none) and decides;
    otherwise the surest mined rule does (``mined``: its tokens, ``confidence``:
    its share of labelled URLs), and without one a URL is allowed. The written
    rules are a short list, tried as one expression; several of one length do
    not fit one URL unless they are alike. A null URL and one without ``://``
    have an empty host and path and no tokens. Repeated rows are rows of their
    own. An empty table gives no rows; other columns stay, also one named like
    a column used here, but for ``url_filter``, which is replaced.
    """
    h, p = host(urls[url]), path(urls[url])
    rule, verdict = listed_rule(F.col("__u.host"), F.col("__u.path"), rules)
    own = urls.columns
    parsed = (urls.withColumn("__u", F.struct(h.alias("host"), p.alias("path"), tokens(urls[url], h, p).alias("tokens")))
              .withColumns({"__rule": rule, "__listed": verdict}))
    sets = cut_lineage(token_sets(parsed.select(F.col("__u.tokens").alias("tokens"), F.col("__listed").alias("listed"))))
    mined = mined_rules(sets, support, confidence)
    none = F.lit(None)
    if mined is None:
        judged, found = parsed, [none.cast("string"), none.cast("string"), none.cast("double")]
    else:
        known = broadcast_if_small(cut_lineage(match(sets, mined).select(
            F.col("k1").alias("__k1"), F.col("k2").alias("__k2"),
            F.struct("mined_verdict", "mined", "confidence").alias("__mined"))))
        keyed = parsed.withColumns({"__k1": F.xxhash64("__u.tokens"), "__k2": F.xxhash64(F.lit(1), "__u.tokens")})
        judged = keyed.join(known, ["__k1", "__k2"], "left")
        found = [F.col(f"__mined.{c}") for c in ("mined_verdict", "mined", "confidence")]
    unlisted = lambda c: F.when(F.col("__listed").isNull(), c)
    out = F.struct(F.col("__u.host").alias("host"), F.col("__u.path").alias("path"), F.col("__rule").alias("rule"),
                   F.coalesce("__listed", found[0], F.lit(DEFAULT)).alias("verdict"),
                   unlisted(found[1]).alias("mined"), unlisted(found[2]).alias("confidence"))
    return judged.select(*[F.col(f"`{c}`") for c in own if c != "url_filter"], out.alias("url_filter"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the written rules and by those mined from them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "url_filter.*")


def _oracle() -> str:
    listed = sorted(LISTED, key=lambda r: -(len(r[1]) + len(r[2])))
    fits = [f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')" for _, h, p in listed]
    rule = "CASE " + " ".join(f"{f} THEN '{h + p}'" for f, (_, h, p) in zip(fits, listed, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"{f} THEN '{v}'" for f, (v, _, _) in zip(fits, listed, strict=True)) + " END"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    shape = "regexp_replace({}, '([0-9])[0-9]+', '\\1#', 'g')"
    query = lower.format(r"regexp_extract(rest, '^[^?#]*\?([^#]*)', 1)")
    sized = " UNION ALL ".join(
        f"SELECT [{', '.join(f'x{i}.token' for i in range(k))}] AS items, x0.verdict FROM kept x0 "
        + " ".join(f"JOIN kept x{i} ON x{i}.rid = x0.rid AND x{i - 1}.token < x{i}.token" for i in range(1, k))
        for k in range(1, ITEMS + 1))
    return f"""
WITH r AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT *, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
), p AS (
  SELECT rid, page_id, host, path, {rule} AS rule, {verdict} AS listed, list_distinct(list_concat(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || {shape.format('x')}),
    list_transform(list_filter(string_split({lower.format('path')}, '/'), lambda x: x <> ''),
                   lambda x, i: 'p' || CAST(i - 1 AS VARCHAR) || ':' || {shape.format('x')}),
    list_transform(list_filter(list_transform(string_split({query}, '&'), lambda x: split_part(x, '=', 1)), lambda x: x <> ''),
                   lambda x: 'q:' || {shape.format('x')}))) AS tokens FROM h
), n AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE listed = '{BLOCK}') AS b, greatest(2, ceil(count(*) / {SUPPORT}.0)) AS least
  FROM p WHERE listed IS NOT NULL
), t AS (SELECT rid, listed AS verdict, unnest(tokens) AS token FROM p WHERE listed IS NOT NULL
), v AS (
  SELECT token, count(*) AS n, count(*) FILTER (WHERE verdict = '{BLOCK}') AS b FROM t GROUP BY token
  HAVING count(*) >= (SELECT least FROM n)
), kept AS (
  SELECT t.rid, t.verdict, token FROM t JOIN v USING (token), n
  QUALIFY row_number() OVER (PARTITION BY t.rid ORDER BY abs(v.b * CAST(n.n AS DOUBLE) - v.n * CAST(n.b AS DOUBLE)) DESC, token) <= {TELLING}
), counted AS (
  SELECT items, count(*) AS total, count(*) FILTER (WHERE verdict = '{ALLOW}') AS {ALLOW},
         count(*) FILTER (WHERE verdict = '{BLOCK}') AS {BLOCK} FROM ({sized}) GROUP BY items
), rules AS (
  SELECT items, total, verdict, hits FROM counted UNPIVOT (hits FOR verdict IN ({ALLOW}, {BLOCK}))
  WHERE hits >= (SELECT least FROM n) AND hits * 100 >= total * {CONFIDENCE}
), found AS (
  SELECT rid, verdict, array_to_string(items, ' ') AS mined, hits / total AS confidence
  FROM p JOIN rules ON listed IS NULL AND list_has_all(tokens, items)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY hits / total DESC, hits DESC, len(items), items, verdict) = 1
)
SELECT page_id, host, path, rule, coalesce(listed, verdict, '{DEFAULT}') AS verdict, mined, confidence
FROM p LEFT JOIN found USING (rid)
"""


QUERIES = {"op11_url_rules": op11_url_rules}
ORACLE = {"op11_url_rules": _oracle()}
