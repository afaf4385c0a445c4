"""Document fingerprints: SimHash over weighted word pairs, and a search by permuted block tables.

Every pair of neighbouring words votes on 64 bits by its hash, with a weight of
one to three by its length, as long words tell more. Votes are summed two bits
to a column: a sum holds one counter in each half of a long, and no text is
long enough to fill one. Only DataFrame operations.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import WORD_RUN, cut_lineage, numbered, table

#: Fingerprints at most so many bits apart are near; any such pair agrees in at least BLOCKS - RADIUS blocks.
RADIUS, BLOCKS = 3, 6
_HALVES = (1 << 32) | 1


def fingerprints(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key..., fingerprint long) of texts; equal texts have equal ones, a text without words has 0.

    Rows that repeat a key with the same text vote twice alike, which changes nothing.
    """
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_RUN), F.lit(0))
    listed = texts.select(*key, words.alias("w"))
    # a single word stands alone; of more, each but the last with its follower
    pairs = listed.select(*key, F.size("w").alias("n"), F.explode_outer(
        F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("b"))).alias("p"))
    length = F.length("p.a") + F.coalesce(F.length("p.b"), F.lit(0))
    votes = (pairs.where((F.col("n") < 2) | F.col("p.b").isNotNull())
             .select(*key, F.xxhash64("p.a", "p.b").alias("h"),
                     F.when(F.col("n") == 0, 0).when(length < 6, 1).when(length < 12, 2).otherwise(3).cast("long").alias("x")))
    sums = votes.groupBy(*key).agg(F.sum("x").alias("all"), *[
        F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_HALVES)) * F.col("x")).alias(f"s{j}") for j in range(32)])

    def bit(b: int) -> Column:
        votes_for = (F.col(f"s{b}").bitwiseAND(F.lit(0xFFFFFFFF)) if b < 32 else F.shiftrightunsigned(f"s{b - 32}", 32))
        value = (1 << b) - ((1 << 64) if b == 63 else 0)
        return F.when(votes_for * 2 > F.col("all"), F.lit(value)).otherwise(F.lit(0)).cast("long")

    return sums.select(*key, reduce(Column.bitwiseOR, [bit(b) for b in range(64)]).alias("fingerprint"))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of the weighted terms of two texts, from 0 (or opposed) to 1 (equal fingerprints)."""
    apart = F.bit_count(a.bitwiseXOR(b))
    return F.when(apart == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.cos(F.lit(3.141592653589793) * apart / 64)))


def _masks(blocks: int, radius: int) -> list[int]:
    """One mask for each choice of the blocks that agree, as signed longs."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    return [m - ((1 << 64) if m >> 63 else 0) for m in (sum(c) for c in combinations(one, blocks - radius))]


def within_radius(queries: DataFrame, fingerprint_counts: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fingerprint, n): how many rows are at most ``radius`` bits from each query fingerprint, its own included.

    ``queries`` has distinct fingerprints, ``fingerprint_counts`` distinct ones
    with their number of rows, so copies are one entry however many there are.
    Each table holds all fingerprints under the bits of one choice of blocks;
    a pair is taken from the first table in which it meets.
    """
    masks = _masks(blocks, radius)

    def posted(df, *columns):
        keys = F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])
        return df.select(*columns, F.posexplode(keys).alias("table", "block"))

    q = posted(queries.select("fingerprint"), F.col("fingerprint").alias("q"))
    i = posted(fingerprint_counts, F.col("fingerprint").alias("f"), F.col("n").alias("rows"))
    apart = F.col("q").bitwiseXOR(F.col("f"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(t)) for t, m in enumerate(masks)])
    met = q.join(i, (q["table"] == i["table"]) & (q["block"] == i["block"]) & (F.bit_count(apart) <= radius)
                 & (first == q["table"]))
    return met.groupBy(F.col("q").alias("fingerprint")).agg(F.sum("rows").alias("n"))


def _key(docs: DataFrame, id_col: str, text: str) -> list[Column]:
    body = F.coalesce(docs[text], F.lit(""))
    return [F.xxhash64(docs[id_col], docs[id_col].isNull()).alias("k0"), F.xxhash64(body).alias("k1"),
            F.xxhash64(F.lit(1), body).alias("k2")]


_KEY = ["k0", "k1", "k2"]


def with_next_edit(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents in descending order of id, each with an edited text, and the order itself.

    Returns (key, body, edited) and (place, id, key, n_chars, copies): the last
    third of a text gives way to as much of the beginning of the next one's.
    Rows equal in id and text are one document (though still rows of the
    first frame); a null id comes last, texts of one id are ordered by hash;
    the first follows the last. Whole texts are dealt out once, by key, and
    their beginnings once more.
    """
    rows = docs.select(docs[id_col].alias("id"), *_key(docs, id_col, text),
                       F.coalesce(F.length(docs[text]), F.lit(0)).cast("long").alias("n_chars"))
    distinct = rows.groupBy("id", *_KEY, "n_chars").agg(F.count("*").alias("copies"))
    order = cut_lineage(numbered(distinct, F.col("id").desc_nulls_last(), F.col("k1"), F.col("k2")))
    total = max(order.count(), 1)
    target = order.select(F.pmod(F.col("place") + 1, F.lit(total)).alias("place"), *[F.col(k).alias(f"to_{k}") for k in _KEY],
                          F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"))
    sends = cut_lineage(order.join(target, "place").select(*_KEY, *[f"to_{k}" for k in _KEY], "wanted"))
    bodies = docs.select(*_key(docs, id_col, text), F.coalesce(docs[text], F.lit("")).alias("body")).join(sends, _KEY)
    starts = (bodies.select(*[F.col(f"to_{k}").alias(k) for k in _KEY],
                            F.substring(F.col("body"), F.lit(1), F.col("wanted")).alias("start"))
              .groupBy(*_KEY).agg(F.max("start").alias("start")))
    n = F.length("body")
    kept = F.substring(F.col("body"), F.lit(1), (n - F.floor(n / 3)).cast("int"))
    return bodies.join(starts, _KEY).select(*_KEY, "body", F.concat(kept, F.col("start")).alias("edited")), order


def fingerprint_report(docs: DataFrame, query: Column | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_chars, digest of its edited text, fingerprints and how near they are.

    ``query`` says of which documents (by their id) ``n_near`` counts the other
    rows at most RADIUS bits away among all; elsewhere it is null. A null text
    is empty; an empty one has fingerprint 0. Repeated rows repeat their
    result; an empty table gives none. Other columns are not returned.
    """
    edited, order = with_next_edit(docs, id_col, text)
    # both texts' votes are summed where the texts are
    own = fingerprints(edited.select(*_KEY, "body"), _KEY, "body").withColumnRenamed("fingerprint", "own")
    edits = fingerprints(edited.select(*_KEY, F.sha2("edited", 256).alias("edited_sha256"), "edited"),
                         [*_KEY, "edited_sha256"], "edited").withColumnRenamed("fingerprint", "edit")
    prints = cut_lineage(order.join(own, _KEY).join(edits, _KEY).drop(*_KEY))
    total = max(order.count(), 1)
    following = prints.select(F.pmod(F.col("place") - 1, F.lit(total)).alias("place"), F.col("own").alias("next"))
    out = cut_lineage(prints.join(following, "place"))
    near = F.lit(None).cast("long")
    if query is not None:
        counts = cut_lineage(out.groupBy(F.col("own").alias("fingerprint")).agg(F.sum("copies").alias("n")))
        asked = out.where(query).select(F.col("own").alias("fingerprint")).distinct()
        met = within_radius(asked, counts).select(F.col("fingerprint").alias("own"), F.col("n").alias("met"))
        out = out.join(met, "own", "left")
        near = F.when(query, F.col("met") - 1)
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", hexadecimal(F.col("own")).alias("fingerprint"),
        hexadecimal(F.col("edit")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edit")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"), near.alias("n_near"),
        F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("__copy")).drop("__copy")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts; near rows of every document whose id divides by 50."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint_report(docs, query=F.col("id") % 50 == 0)


QUERIES = {"op9_simhash": op9_simhash}
ORACLE = {}
