"""MinHash near-duplicates by an inverted join over signature coordinates.

Every distinct shingle set has a signature of ``coordinates`` minima and is
posted under each (coordinate, value). Two sets that agree in ``matches``
coordinates share at least one posting among the first
``coordinates - matches + 1`` of either, in any order common to all; the order
here is rarest first, so postings that nobody shares come first and cost
nothing, and passages common to many documents come last. Candidates from those
prefixes are merged coordinate by coordinate, leaving off where the rest cannot
reach the threshold, and the survivors are confirmed on full shingle sets.

Groups of copies: equal sets are one node. In a posting list all members are
first compared with the least one; only lists whose members are then still in
different components are joined pair by pair, across components, the long ones
in blocks inside a task, so that no group is written out as its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut_lineage, table, word_count, prepare_workers
from .graph import components
from .shingles import mixed, shingle_sets

COORDINATES = 64
#: A pair at similarity 0.85 agrees in fewer than 40 of 64 coordinates once in 400,000 times.
MATCHES = 40
_SLICE = 1 << 15
#: A longer posting list is not written out as pairs but compared in blocks, whose sides hold at most about so many
#: nodes and shingles.
SHORT_LIST = 16
BLOCK_NODES = 1024
BLOCK_SHINGLES = 1 << 20


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    odd = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return odd, mixed(odd)


def signature_rows(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """A row for each (non-empty) set: every hash function's minimum, its upper 32 bits as a signed integer."""
    odd, plus = _multipliers(coordinates)
    least = np.full((len(sets), coordinates), np.iinfo(np.uint64).max, np.uint64)
    # slices that fit in a core's cache; a slice may hold many small sets or a part of a large one
    ends = np.cumsum([len(s) for s in sets])
    joined = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for at in range(0, len(joined), _SLICE):
        part = joined[at: at + _SLICE]
        first = int(np.searchsorted(ends, at, "right"))
        last = int(np.searchsorted(ends, at + len(part) - 1, "right"))
        begins = np.maximum(np.concatenate(([0], ends[first:last])) - np.array([0] + [at] * (last - first)), 0)
        hashed = np.empty(len(part), np.uint64)
        for i in range(coordinates):
            np.multiply(part, odd[i], out=hashed)
            hashed += plus[i]
            column = least[first: last + 1, i]
            np.minimum(column, np.minimum.reduceat(hashed, begins), out=column)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    a = mixed(shingles)
    return tuple(int(np.add.reduce(x)) - (1 << 63) for x in (a, mixed(a ^ np.uint64(0xA5A5A5A5A5A5A5A5))))


def _maybe_empty(sets: list[np.ndarray], coordinates: int) -> list[np.ndarray | None]:
    found = iter(signature_rows([s for s in sets if len(s)], coordinates))
    return [next(found) if len(s) else None for s in sets]


def _text_key(text: Column) -> list[Column]:
    body = F.coalesce(text, F.lit(""))
    return [F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(1), body).alias("t2")]


def _row_key(value: Column) -> list[Column]:
    return [F.xxhash64(value, value.isNull())]


def signatures(docs: DataFrame, id_col: str, text: str, size: int, coordinates: int) -> DataFrame:
    """(id, t1, t2, n, k1, k2, signature) of every row, t1 and t2 standing for its text; a set without shingles has null keys and signature."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held, rows = [], [], []
            for s in shingle_sets((x.as_py() for x in batch.column(1)), size):
                keys.append((len(s), *_set_key(s)) if len(s) else (0, None, None))
                held.append(s)
                if len(s) >= _SLICE or len(held) >= 64:
                    rows += _maybe_empty(held, coordinates)
                    held = []
            rows += _maybe_empty(held, coordinates)
            n, k1, k2 = zip(*keys, strict=True) if keys else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), *(pa.array(x, pa.int64()) for x in (n, k1, k2)),
                 pa.array(rows, pa.list_(pa.int32()))], names=["id", "t1", "t2", "n", "k1", "k2", "signature"])

    prepare_workers(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text].alias("text"), *_text_key(docs[text])).mapInArrow(
        each, f"id {kind}, t1 long, t2 long, n long, k1 long, k2 long, signature array<int>")


def _prefix_postings(nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(token, node): the rarest postings of each node that another node shares, if in its prefix."""
    posted = nodes.select("node", F.posexplode("signature").alias("i", "v")).select(
        "node", F.shiftleft(F.col("i").cast("long"), 32).bitwiseOR(
            F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token"))
    counted = posted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    shared = posted.join(counted, "token")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("n", "token"))
    alone = F.lit(coordinates) - F.count("*").over(Window.partitionBy("node"))
    return (shared.withColumn("at", rank + alone).where(F.col("at") <= coordinates - matches + 1)
            .select("token", "node"))


def _agreeing(pairs: DataFrame, nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""
    half = coordinates // 2

    def each(batches):
        for batch in batches:
            a, b = (np.stack(batch[x].to_numpy()) if len(batch) else np.empty((0, coordinates)) for x in ("sa", "sb"))
            hits = (a[:, :half] == b[:, :half]).sum(1)
            alive = np.flatnonzero(hits >= matches - (coordinates - half))  # the rest cannot reach the threshold
            hits = hits[alive] + (a[alive, half:] == b[alive, half:]).sum(1)
            yield batch[["a", "b"]].iloc[alive[hits >= matches]]

    sa = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    sb = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInPandas(each, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""

    def each(batches):
        for batch in batches:
            keep = [_similar(np.asarray(x).view(np.uint64), np.asarray(y).view(np.uint64), percent)
                    for x, y in zip(batch["xa"], batch["xb"], strict=True)]
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    xa = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    xb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    return pairs.join(xa, "a").join(xb, "b").select("a", "b", "xa", "xb").mapInPandas(each, "a long, b long")


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, size: int) -> DataFrame:
    """(node, sorted shingle hashes) of the wanted (node, first, k1, k2), made from their documents anew."""

    def each(batches):
        for batch in batches:
            out = [(n, s.view(np.int64)) for n, k1, k2, s in
                   zip(batch["node"], batch["k1"], batch["k2"], shingle_sets(iter(batch["text"]), size), strict=True)
                   if len(s) and _set_key(s) == (k1, k2)]  # rows that repeat an id may have other texts
            yield pd.DataFrame(out, columns=["node", "shingles"])

    found = (docs.select(docs[id_col].alias("id"), docs[text].alias("text"))
             .join(wanted.select("node", "first", "k1", "k2"), F.col("id").eqNullSafe(F.col("first")))
             .select("node", "k1", "k2", "text"))
    return found.mapInPandas(each, "node long, shingles array<long>").dropDuplicates(["node"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(small) + len(large) - both)


def _block_links(block: pd.DataFrame, matches: int, percent: int) -> list[tuple[int, int]]:
    """Links between the components met in one block (or pair of blocks) of a long list, as few as join them.

    A pair is looked at in the list of its smallest common token only.
    """
    nodes, side = block["node"].to_numpy(), block["side"].to_numpy()
    one, two, token = (int(block[c].iloc[0]) for c in ("one", "two", "token"))
    signed = np.stack(block["signature"].to_numpy())
    sets = [np.asarray(x).view(np.uint64) for x in block["shingles"]]
    lower = [[t for t in row if t < token] for row in block["prefix"]]
    column = {t: i for i, t in enumerate(sorted({t for row in lower for t in row}))}
    earlier = np.zeros((len(nodes), max(1, len(column))), np.float32)
    for i, row in enumerate(lower):
        earlier[i, [column[t] for t in row]] = 1
    top = {c: c for c in block["component"]}

    def root(c):
        while top[c] != c:
            c = top[c]
        return c

    own, links = block["component"].tolist(), []
    for at in range(0, len(nodes), 128):
        tile = slice(at, at + 128)
        agree = np.zeros((len(nodes[tile]), len(nodes)), np.uint8)
        for k in range(signed.shape[1]):
            agree += signed[tile, k][:, None] == signed[:, k]
        fits = (agree >= matches) & (earlier[tile] @ earlier.T == 0)
        fits &= (nodes[tile][:, None] < nodes) if one == two else (side[tile][:, None] == one) & (side == two)
        x, y = np.nonzero(fits)
        order = np.argsort(-agree[x, y].astype(int), kind="stable")  # likely links first: they make others needless
        for i, j in zip((x[order] + at).tolist(), y[order].tolist(), strict=True):
            a, b = root(own[i]), root(own[j])
            if a != b and _similar(sets[i], sets[j], percent):
                top[a] = b
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def _links_in_long_lists(lists: DataFrame, nodes: DataFrame, sets: DataFrame, prefixes: DataFrame,
                         matches: int, percent: int) -> DataFrame:
    """Links across components in lists (token, node, component) too long to write out their pairs.

    A list is dealt by node into sides of bounded size; each pair of sides is a
    block, compared inside one task.
    """
    dealt = lists.join(sets, "node").withColumn("size", F.size("shingles"))
    sides = lists.join(sets.select("node", F.size("shingles").alias("size")), "node").groupBy("token").agg(
        F.ceil(F.greatest(F.sum("size") / BLOCK_SHINGLES, F.count("*") / BLOCK_NODES)).cast("int").alias("sides"))
    side = F.pmod(F.xxhash64("node"), F.col("sides")).cast("int")
    rows = (dealt.join(sides, "token").withColumn("side", side)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
            .join(prefixes, "node").join(nodes.select("node", "signature"), "node")
            .select("token", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"), "side",
                    "node", "component", "signature", "prefix", "shingles"))

    def each(block: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_block_links(block, matches, percent), columns=["a", "b"])

    return rows.groupBy("token", "one", "two").applyInPandas(each, "a long, b long")


def _with_components(docs: DataFrame, id_col: str, text: str, size: int, percent: int, coordinates: int,
                     matches: int) -> DataFrame:
    """(id, t1, t2, n, component, component_id) of every row; without shingles the component is null."""
    signed = cut_lineage(signatures(docs, id_col, text, size, coordinates))
    grouped = (signed.where("k1 is not null").groupBy("k1", "k2")
               .agg(F.min("id").alias("first"), F.first("signature").alias("signature")))
    nodes = cut_lineage(grouped.withColumn("node", F.monotonically_increasing_id()))
    lists = _prefix_postings(nodes, coordinates, matches)
    stars = lists.groupBy("token").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    lists = cut_lineage(lists.join(stars.select("token", "a"), "token"))
    wanted = nodes.join(lists.select("node").distinct(), "node", "left_semi")
    sets = cut_lineage(_sets_of(docs, wanted, id_col, text, size))

    tried = lists.where("node <> a").select("a", F.col("node").alias("b")).distinct()
    links = cut_lineage(_confirmed(_agreeing(tried, nodes, coordinates, matches), sets, percent))
    label = components(links)
    # lists of more than one component: every pair across components, but those tried
    named = lists.join(label, "node", "left").select(
        "token", "a", "node", F.coalesce("component", "node").alias("component"))
    rest = named.where("node <> a")
    open_lists = (rest.groupBy("token").agg(F.min("component").alias("c"), F.max("component").alias("d"),
                                            F.count("*").alias("n")).where("c < d"))
    rest = cut_lineage(rest.drop("a").join(open_lists.select("token", "n"), "token"))
    short = rest.where(F.col("n") <= SHORT_LIST)
    x = short.select("token", F.col("node").alias("a"), F.col("component").alias("ca"))
    y = short.select("token", F.col("node").alias("b"), F.col("component").alias("cb"))
    across = x.join(y, (x["token"] == y["token"]) & (x["a"] < y["b"]) & (x["ca"] != y["cb"])).select("a", "b").distinct()
    more = cut_lineage(_confirmed(_agreeing(across, nodes, coordinates, matches), sets, percent))
    long = rest.where(F.col("n") > SHORT_LIST).drop("n")
    prefixes = (lists.join(long.select("node").distinct(), "node", "left_semi")
                .groupBy("node").agg(F.collect_list("token").alias("prefix")))
    blocks = cut_lineage(_links_in_long_lists(long, nodes, sets, prefixes, matches, percent))
    joined = components(links.union(more).union(blocks))

    final = nodes.select("node", "k1", "k2", "first").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = final.groupBy("component").agg(F.min("first").alias("component_id"))
    by_set = final.join(least, "component").select("k1", "k2", "component", F.col("component_id").alias("least"))
    return signed.join(by_set, ["k1", "k2"], "left").select(
        "id", "t1", "t2", "n", "component",
        F.when(F.col("k1").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 85,
                    coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Links join documents with 100 * intersection >= percent * union of their
    shingle sets; component_id is the smallest id reachable, kept whether it is
    the document's own. Fewer words than ``size`` make one shingle; a null or
    empty text has none and links with nothing. Rows that repeat an id with
    equal texts are alike in the result, with different texts they are linked
    only by their texts; a null id counts as larger than any other. An empty
    table gives no rows. Other columns of ``docs`` are not looked at.
    """
    rows = _with_components(docs, id_col, text, size, percent, coordinates, matches)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                       F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 85,
                coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """The documents themselves, one row of each near-duplicate component: the one of the smallest id.

    Rows equal in id and text count as one; texts without words are in no
    component and all stay. Columns keep their names and values.
    """
    rows = _with_components(docs, id_col, text, size, percent, coordinates, matches).where("component is not null")
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t1", "t2")).alias("first"))
    key = ["__id", "__t1", "__t2"]
    winners = first.select(_row_key(F.col("first.id"))[0].alias("__id"), F.col("first.t1").alias("__t1"),
                           F.col("first.t2").alias("__t2"), F.lit(True).alias("__won"))
    keyed = docs.withColumns(dict(zip(key, (*_row_key(docs[id_col]), *_text_key(docs[text])), strict=True)))
    turn = F.row_number().over(Window.partitionBy(*key).orderBy("__t1"))
    out = keyed.join(winners, key, "left").withColumn("__turn", turn)
    return out.where((F.col("__won") & (F.col("__turn") == 1)) | (word_count(F.col(text)) == 0)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


_ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (s)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""

QUERIES = {"op2_minhash_neardup": op2_minhash_neardup}
ORACLE = {"op2_minhash_neardup": _ORACLE}
