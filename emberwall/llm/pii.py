"""Personal data: fixed patterns, and more of it by bootstrapped contextual extraction.

The fixed patterns' finds and values after a few seed words are the seed
entities. What stands before an identifier-like value (its key or the word
before it, and the kind of characters it is made of) is its lexical pattern.
Patterns and values make a graph that Spark scores in rounds until none is
added; values found in one round are known in the next. A pattern is as
sure as the share of its values that are known, a value as sure as the noisy-or
of its patterns. Values that no fixed pattern has found but sure patterns
surround are added. Only DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import cut_lineage, let, match_spans, running, table

# The kinds in order and their patterns; possessive where nothing is given back. A match that cannot
# start where a run of its characters (or what a match has left of it) starts cannot start within it.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: The kind of spans that contexts discover, listed after the others.
CONTEXT = "context"

#: Words whose values are seeds beside the fixed patterns' finds.
SEED_KEYS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "ssn", "passport", "iban")
#: A pattern counts from so many known values and this share of them; a value from this score.
LEAST_KNOWN, SURE_PATTERN, SURE_VALUE = 3, 0.8, 0.8

_VALUE_CHARS = r"A-Za-z0-9+/_@%.-"
#: An identifier-like value: six or more characters with a digit among them, letter or digit last.
VALUE = rf"(?<![{_VALUE_CHARS}])(?=[A-Za-z+/_@%.-]*+[0-9])[{_VALUE_CHARS}]{{5,}}[A-Za-z0-9]"
#: How far back a context reaches, in characters.
REACH = 40

_SPANS = "array<struct<start:int,end:int,value:string,before:string>>"


def spans(text: Column, pattern: str, valid: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches that are ``valid`` as (start, end, value, before), in code points."""
    found = match_spans(text, pattern)
    return found if valid is None else F.filter(found, lambda s: valid(s["value"]))


def overlapping(listed: Column, known: Column) -> Column:
    """For each of the spans ``listed`` (in order, apart from each other), whether one of ``known`` overlaps it.

    Both are put in order, known spans by start and listed ones by end; the
    furthest end so far then tells.
    """
    events = F.array_sort(F.concat(
        F.transform(known, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("kind"), b["end"].alias("end"), F.lit(0).alias("start"))),
        F.transform(listed, lambda c: F.struct(c["end"].alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("end"), c["start"].alias("start")))))

    def told(e):
        furthest = running(F.transform(e, lambda x: x["end"]), lambda x, y: F.when(x > y, x).otherwise(y))
        return F.transform(F.filter(F.zip_with(e, furthest, lambda x, f: F.struct(
            x["kind"].alias("kind"), (f > x["start"]).alias("hit"))), lambda x: x["kind"] == 0), lambda x: x["hit"])

    return let(events, told)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    """Four numbers of at most 255, leading zeros allowed."""
    def small(part):
        short = F.regexp_replace(part, "^0+(?=.)", "")
        return (F.length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)

    return F.forall(F.split(value, "[.]"), small)


def is_card(value: Column) -> Column:
    """13 to 19 digits whose Luhn sum ends in 0."""
    digits = F.reverse(_digits(value))
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    luhn = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.when(n.between(13, 19), luhn % 10 == 0).otherwise(F.lit(False))


def is_phone(value: Column) -> Column:
    """9 to 15 digits."""
    return F.length(_digits(value)).between(9, 15)


def _base(text: Column) -> dict[str, Column]:
    """Spans of each kind; a kind is looked for only where a character that it must have occurs."""
    with_digit = F.when(text.rlike("[0-9]"), text)
    return {"email": spans(F.when(text.contains("@"), text), PATTERNS["email"]),
            "ip": spans(with_digit, PATTERNS["ip"], is_ip), "card": spans(with_digit, PATTERNS["card"], is_card),
            "phone": spans(F.when(text.contains("+"), text), PATTERNS["phone"], is_phone)}


def _context(span: Column) -> Column:
    """The lexical pattern of a value: the word before it with what is between, and the value's characters."""
    before = F.lower(F.right(span["before"], F.lit(REACH)))
    word = F.regexp_extract(before, r"([\p{L}_-]+[^\p{L}\p{N}]{0,4})$", 1)
    word = F.regexp_replace(word, r"\s+", " ")
    value = span["value"]
    made_of = F.concat(F.when(value.rlike("[a-z]"), "a").otherwise(""), F.when(value.rlike("[A-Z]"), "A").otherwise(""),
                       F.when(value.contains("@"), "@").otherwise(""), F.lit("0"))
    return F.concat(word, F.lit("|"), made_of)


def _scanned(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per document: uid, id, base spans by kind, and candidates (start, end, pattern, value, seed)."""
    body = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    found = body.select("id", "text", *[x.alias(k) for k, x in _base(F.col("text")).items()])
    none = F.array().cast(_SPANS)
    found = found.withColumns({k: F.coalesce(k, none) for k in KINDS})
    known = F.concat(*KINDS)
    listed = spans(F.when(F.col("text").rlike("[0-9]"), F.col("text")), VALUE)
    found = found.withColumns({"known": known, "listed": F.coalesce(listed, none)})
    found = found.withColumn("overlaps", overlapping(F.col("listed"), F.col("known")))

    def candidate(c, overlaps):
        pattern = _context(c)
        key = F.regexp_extract(pattern, r"^([\p{L}_-]+)\s*[=:]", 1)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), pattern.alias("pattern"),
                        F.xxhash64(c["value"]).alias("value"), overlaps.alias("known"), key.isin(*SEED_KEYS).alias("seed"))

    slim = [F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k in KINDS]
    return cut_lineage(found.select(F.monotonically_increasing_id().alias("uid"), "id", *slim,
                                    F.zip_with("listed", "overlaps", candidate).alias("candidates")))


def pattern_scores(links: DataFrame, rounds: int | None = None, least: int = LEAST_KNOWN,
                   own: bool = True) -> tuple[DataFrame, DataFrame]:
    """Scores of the graph of (pattern, value, seed): (pattern, sure) and (value, score).

    Seeds stay at 1. A pattern needs ``least`` known values, seeds or values
    that reached SURE_VALUE in an earlier round; its score is the mean of its
    values'. A value's is the noisy-or of its patterns'. Without ``own``, what a
    pattern has given a value does not count when the value rates that pattern.
    After ``rounds``, or, if None, when a round adds no pattern and no value, it ends.
    """
    links = cut_lineage(links.groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    seeds = cut_lineage(links.select("value").where("seed").distinct())
    links = cut_lineage(links.drop("seed").join(seeds.withColumn("seed", F.lit(True)), "value", "left")
                        .withColumn("seed", F.coalesce("seed", F.lit(False))))
    doubt = F.log(1 - F.least("sure", F.lit(0.999)))
    rated, before, done = links.withColumn("score", F.col("seed").cast("double")), None, 0
    while True:
        done += 1
        counted = F.sum((F.col("seed") | (F.col("score") >= SURE_VALUE)).cast("int"))
        patterns = cut_lineage(rated.groupBy("pattern").agg(F.avg("score").alias("sure"), counted.alias("known"))
                               .where(F.col("known") >= least).select("pattern", "sure"))
        with_doubt = cut_lineage(links.join(patterns.select("pattern", doubt.alias("doubt")), "pattern", "left"))
        total = cut_lineage(with_doubt.groupBy("value", "seed").agg(F.sum("doubt").alias("total")).where(
            F.col("seed") | F.col("total").isNotNull()))
        values = total.select("value", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp("total")).alias("score"))
        found = (patterns.count(), patterns.where(F.col("sure") >= SURE_PATTERN).count(),
                 values.where(F.col("score") >= SURE_VALUE).count())
        if found == before or done == rounds:
            return patterns, values
        before = found
        left = F.col("total") if own else F.col("total") - F.coalesce("doubt", F.lit(0.0))
        rated = with_doubt.join(total.drop("seed"), "value", "left").withColumn(
            "score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce(1 - F.exp(left), F.lit(0.0))))


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """One row per document: id, email, ip, card, phone, context - each an array of (start, end) in code points.

    A null or empty text has empty arrays; repeated rows repeat; a null id is
    kept; an empty table gives no rows. Columns other than the id are not
    returned. ``context`` has all values after seed words, and never overlaps the others.
    """
    scanned = _scanned(docs, id_col, text)
    places = scanned.select("uid", F.explode("candidates").alias("c")).select("uid", "c.*")
    patterns, values = pattern_scores(places.select("pattern", "value", (F.col("known") | F.col("seed")).alias("seed")), rounds,
                                      own=False)
    missed = places.where(~F.col("known"))
    sure = (missed.where(~F.col("seed")).join(patterns.where(F.col("sure") >= SURE_PATTERN).select("pattern"), "pattern")
            .join(values.where(F.col("score") >= SURE_VALUE).select("value"), "value"))
    sure = sure.select("uid", "start", "end").union(missed.where("seed").select("uid", "start", "end"))
    more = sure.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(CONTEXT))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return scanned.join(more, "uid", "left").select(
        F.col("id").alias(id_col), *KINDS, F.coalesce(CONTEXT, none).alias(CONTEXT))


def listed(kinds: tuple[str, ...]) -> Column:
    """Spans as kind:start:end, by kind in the order given, then start."""
    def of(kind):
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*map(of, kinds)), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: the fixed kinds, and what their contexts add."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(KINDS), 256).alias("base_sha256"), listed((*KINDS, CONTEXT)).alias("spans"))


QUERIES = {"op5_pii": op5_pii}
ORACLE = {}
