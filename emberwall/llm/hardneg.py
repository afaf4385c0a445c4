"""Hard negatives by best-first search of packed rectangle trees.

Vectors are packed by sort-tile-recursive: three sorts, each within the tiles
of the one before, along the coordinates that vary most. Consecutive rows are
a leaf, consecutive leaves a node, and a block of rows a tree of its own; the
boxes of the blocks are the upper level, kept as a table. A bounding box gives
an interval for every coordinate's share of an inner product and so for the
product itself.

Anchors meet the rows in chunks and blocks. Each chunk first searches the block
with the highest bound; the scores found there let it leave out blocks that
cannot hold better ones. Within a block a queue hands out boxes by the best
score they may hold, and boxes outside the score window or strictly below the
k-th score so far are pruned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut_lineage, numbered, prepare_workers, table

#: Rows to a leaf, children to a node, rows to a block, anchors to a chunk, coordinates that the rows are sorted by.
LEAF, FANOUT, BLOCK, CHUNK, AXES = 128, 8, 4096, 512, 3
#: Positives to an anchor, negatives to a positive, and the window of a negative's score in hundredths of the positive's.
POSITIVES, NEGATIVES, LOWEST, HIGHEST = 5, 10, 30, 90
#: Every n-th id is an anchor.
ANCHOR_STEP = 100
#: Stands for a null id, which comes after all others, and for a bound that no score passes.
_LAST = (1 << 63) - 1
_FLOAT_EXACT = float(1 << 53)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; beyond a long they stay at its ends."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < _FLOAT_EXACT:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most < float(1 << 62):
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -_LAST, _LAST).astype(np.int64)


def usable(vector: Column) -> Column:
    """Whether a vector is there without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


class PackedTree:
    """Rows in packed order with the bounding boxes of their leaves and of the nodes above."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        self.ids, self.leaf, self.fanout = ids, leaf, fanout
        starts = np.arange(0, len(ids), leaf)
        low, high, first = (f.reduceat(x, starts, axis=0) for f, x in
                            ((np.minimum, vectors), (np.maximum, vectors), (np.minimum, ids)))
        self.levels = [(low, high, first)]
        while len(low) > 1:
            starts = np.arange(0, len(low), fanout)
            low, high, first = (f.reduceat(x, starts, axis=0) for f, x in
                                ((np.minimum, low), (np.maximum, high), (np.minimum, first)))
            self.levels.append((low, high, first))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and greatest score of every anchor with any row of each node, by level."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(_dot(up, low) + _dot(down, high), _dot(up, high) + _dot(down, low)) for low, high, _ in self.levels]


def best_first(tree: PackedTree, bounds, anchor: int, score_leaf, allowed, low: np.ndarray, high: np.ndarray,
               floor: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window low..high of scores the k best rows: (scores, rows), highest first and ties by smaller id.

    ``floor`` holds scores that k rows elsewhere reach already, or less than any score.
    """
    top, least = high.max(), np.where(low > high, _LAST, np.maximum(low, floor))
    scores, rows = np.empty(0, np.int64), np.empty(0, np.int64)
    heap, last = [], len(tree.levels) - 1
    cut = least.min()

    def push(level: int, node: int) -> None:
        below, above = bounds[level][0][anchor, node], bounds[level][1][anchor, node]
        if above >= cut and below <= top:
            heapq.heappush(heap, (-min(int(above), int(top)), int(tree.levels[level][2][node]), level, node))

    for node in range(len(tree.levels[last][0])):
        push(last, node)
    while heap:
        best, _, level, node = heapq.heappop(heap)
        if -best < cut:
            break
        if level:
            for child in range(node * tree.fanout, min((node + 1) * tree.fanout, len(tree.levels[level - 1][0]))):
                push(level - 1, child)
            continue
        found = score_leaf(node)[anchor]
        at = node * tree.leaf
        fits = np.flatnonzero(allowed[at: at + len(found)] & (found >= cut) & (found <= top))
        if not len(fits):
            continue
        scores, rows = np.concatenate([scores, found[fits]]), np.concatenate([rows, fits + at])
        order = np.lexsort((rows, tree.ids[rows], -scores))
        scores, rows = scores[order], rows[order]
        # a window's first k of the sorted rows start at the first score not above its end
        start = np.searchsorted(-scores, -high)
        keep = np.zeros(len(rows), bool)
        for w, s in enumerate(start):
            keep[s: s + k] = True
            if s + k <= len(scores):
                least[w] = max(least[w], scores[s + k - 1])
        scores, rows, cut = scores[keep], rows[keep], least.min()
    out = []
    for w, s in enumerate(np.searchsorted(-scores, -high)):
        some = scores[s: s + k] >= max(low[w], floor[w])
        out.append((scores[s: s + k][some], rows[s: s + k][some]))
    return out


def _long_bytes(rows) -> bytes:
    return np.asarray(list(rows), np.int64).tobytes()


def _packed(rows: DataFrame, group: str, width: int) -> DataFrame:
    """One row per group: its box and its rows in packed order, as bytes."""

    def each(part):
        part = part.sort_values("place")
        v = np.array(part["vector"].tolist(), np.int64).reshape(len(part), width)
        return pd.DataFrame({group: [part[group].iloc[0]], "low": [v.min(0).astype(float)], "high": [v.max(0).astype(float)],
                             **{c: [_long_bytes(part[c])] for c in ("row", "key", "label")}, "vectors": [v.tobytes()]})

    return rows.groupBy(group).applyInPandas(
        each, f"{group} long, low array<double>, high array<double>, row binary, key binary, label binary, vectors binary")


def str_packed(rows: DataFrame) -> DataFrame:
    """(row, place): the place of each row in sort-tile-recursive order."""
    n = rows.count()
    spread = rows.select(F.posexplode("vector")).groupBy("pos").agg(F.var_pop("col").alias("spread"))
    axes = [r.pos for r in spread.orderBy(F.desc("spread"), "pos").limit(AXES).collect()]
    order = rows.select("row", *[F.get("vector", F.lit(a)).alias(f"c{i}") for i, a in enumerate(axes)])
    tiles = 1
    while tiles ** max(1, len(axes)) * LEAF < n:
        tiles += 1
    tile, placed = F.lit(0), None
    for i in range(max(1, len(axes))):
        keys = [F.col(f"c{i}")] if axes else []
        placed = numbered(order.withColumn("tile", tile), F.col("tile"), *keys, F.col("row"))
        order = placed.drop("tile", "at").withColumnRenamed("place", "at")
        # every tile holds the same number of rows, so tiles of later sorts lie within those of earlier ones
        tile, placed = F.floor(F.col("at") / (LEAF * tiles ** (len(axes) - 1 - i))), placed.select("row", "place")
    return placed


def _upper(a: str, b: str) -> Column:
    """Greatest inner product of two boxes; a little more, for rounding."""
    corner = F.arrays_zip(F.col(f"low{a}").alias("p"), F.col(f"high{a}").alias("q"), F.col(f"low{b}").alias("r"),
                          F.col(f"high{b}").alias("s"))
    most = F.aggregate(corner, F.lit(0.0), lambda t, x: t + F.greatest(x.p * x.r, x.p * x.s, x.q * x.r, x.q * x.s))
    return most + F.abs(most) * 1e-9 + 1


def _search(pairs: DataFrame, chunks: DataFrame, blocks: DataFrame, goals: DataFrame, width: int, k: int,
            same_label: bool) -> DataFrame:
    """(anchor row, goal, score, key): the k best rows of each pair of a chunk and a block for each goal."""
    names = ["row", "key", "label", "vectors"]
    joined = pairs.select("chunk", "block").join(goals, "chunk")
    for x, side, at in (("a", chunks, "chunk"), ("b", blocks, "block")):
        joined = joined.join(side.select(at, *[F.col(c).alias(c + x) for c in names]), at)

    def each(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for line in batch.to_pylist():
                a, b = ({c: np.frombuffer(line[c + x], np.int64) for c in names} for x in "ab")
                av, bv = (x["vectors"].reshape(-1, width) if width else np.zeros((len(x["row"]), 0), np.int64) for x in (a, b))
                tree = PackedTree(bv, b["key"], LEAF, FANOUT)
                bounds, leaves = tree.bounds(av), {}

                def score_leaf(node, av=av, bv=bv, leaves=leaves):
                    if node not in leaves:
                        leaves[node] = _dot(av, bv[node * LEAF: (node + 1) * LEAF])
                    return leaves[node]

                at = {r: i for i, r in enumerate(a["row"].tolist())}
                out = {"anchor": [], "goal": [], "score": [], "key": [], "found": []}
                for task in line["goals"]:
                    i = at[task["anchor"]]
                    allowed = ((b["label"] == a["label"][i]) == same_label) & (b["row"] != a["row"][i])
                    window = [np.array(task[c], np.int64) for c in ("low", "high", "floor")]
                    for goal, (scores, rows) in enumerate(best_first(tree, bounds, i, score_leaf, allowed, *window, k)):
                        out["anchor"] += [task["anchor"]] * len(rows)
                        out["goal"] += [goal] * len(rows)
                        out["score"] += scores.tolist()
                        out["key"] += b["key"][rows].tolist()
                        out["found"] += b["row"][rows].tolist()
                yield pa.RecordBatch.from_pydict(
                    out, schema=pa.schema([(c, pa.int32() if c == "goal" else pa.int64()) for c in out]))

    return joined.mapInArrow(each, "anchor long, goal int, score long, key long, found long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each goal, ranked from 1."""
    order = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), "key", "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _goals(windows: DataFrame, floors: DataFrame | None) -> DataFrame:
    """One row per chunk with the windows of its anchors; ``floors`` are k-th scores known so far."""
    if floors is not None:
        windows = windows.join(floors, ["anchor", "goal"], "left")
    else:
        windows = windows.withColumn("known", F.lit(None).cast("long"))
    by_anchor = windows.groupBy("chunk", "anchor").agg(F.sort_array(F.collect_list(F.struct(
        "goal", "low", "high", F.coalesce("known", F.lit(-_LAST)).alias("floor")))).alias("w"))
    return by_anchor.groupBy("chunk").agg(F.collect_list(F.struct(
        "anchor", *[F.col(f"w.{c}").alias(c) for c in ("low", "high", "floor")])).alias("goals"))


def _best(windows: DataFrame, pairs: DataFrame, chunks: DataFrame, blocks: DataFrame, width: int, k: int,
          same_label: bool) -> DataFrame:
    """The k best rows of every goal over all blocks: each chunk's most promising block first, then those not ruled out."""
    seed = pairs.groupBy("chunk").agg(F.max_by("block", F.struct("upper", "block")).alias("block"))
    first = cut_lineage(_first(_search(seed, chunks, blocks, _goals(windows, None), width, k, same_label), k))
    floors = first.where(F.col("rank") == k).select("anchor", "goal", F.col("score").alias("known"))
    goals = cut_lineage(_goals(windows, floors))
    needed = goals.select("chunk", F.array_min(F.flatten(F.transform("goals", lambda g: F.zip_with(
        g.low, g.floor, lambda x, y: F.greatest(x, y))))).alias("needed"))
    rest = (pairs.join(seed.withColumnRenamed("block", "done"), "chunk").where("block <> done").join(needed, "chunk")
            .where(F.col("upper") >= F.col("needed")))
    more = _search(rest, chunks, blocks, goals, width, k, same_label)
    return cut_lineage(_first(first.drop("rank").unionByName(more), k))


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label: str = "label",
                   vector: str = "embedding", scale: int = 256, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lowest: int = LOWEST, highest: int = HIGHEST) -> DataFrame:
    """Hard negatives of every positive of each anchor, with their integer scores.

    Components x count as floor(scale * x). ``anchors`` (a condition on
    ``vectors``) names the anchors; the first ``positives`` other rows of an
    anchor's label by score are its positives, and for each the first
    ``negatives`` rows of other labels whose score is ``lowest`` to ``highest``
    hundredths of the positive's come back: (anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score).

    Rows with a null label, a null vector, or null or non-finite components take
    no part. Ties go to the smaller id; a null id comes last (the largest long
    is read as null). Rows that repeat an id are rows of their own. Components
    that a shorter vector lacks count as 0; scores beyond a long stay at its
    ends. An empty table gives no rows; other columns are not looked at.
    """
    prepare_workers(vectors.sparkSession)
    whole = F.transform(vectors[vector], lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.where(vectors[label].isNotNull() & usable(vectors[vector])).select(
        F.coalesce(vectors[id_col].cast("long"), F.lit(_LAST)).alias("key"), vectors[label].cast("long").alias("label"),
        whole.alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    rows = rows.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))))
    placed = rows.join(str_packed(rows), "row")
    blocks = cut_lineage(_packed(placed.withColumn("block", F.floor(F.col("place") / BLOCK)), "block", width))
    asked = numbered(placed.where("is_anchor").drop("is_anchor").withColumnRenamed("place", "at"), F.col("at"))
    asked = cut_lineage(asked.withColumn("chunk", F.floor(F.col("place") / CHUNK)))
    chunks = cut_lineage(_packed(asked, "chunk", width))
    # every block with every chunk of the stated anchors: boxes only, one row per pair
    n_chunks = chunks.count()
    boxes = blocks.select("block", F.col("low").alias("lowb"), F.col("high").alias("highb")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, n_chunks - 1)).cast("long"))))
    pairs = cut_lineage(boxes.join(chunks.select("chunk", F.col("low").alias("lowa"), F.col("high").alias("higha")), "chunk")
                        .select("chunk", "block", _upper("a", "b").alias("upper")))
    who = asked.select("chunk", F.col("row").alias("anchor"))
    anywhere = who.select("chunk", "anchor", F.lit(0).alias("goal"), F.lit(-_LAST).alias("low"), F.lit(_LAST).alias("high"))
    near = _best(anywhere, pairs, chunks, blocks, width, positives, True)
    positive = near.select("anchor", (F.col("rank") - 1).alias("goal"), F.col("key").alias("positive"),
                           F.col("score").alias("positive_score"))
    share = F.col("positive_score").cast("decimal(38,0)")
    windows = positive.join(who, "anchor").select(
        "chunk", "anchor", "goal", F.ceil(share * lowest / 100).cast("long").alias("low"),
        F.floor(share * highest / 100).cast("long").alias("high"))
    # an anchor's goals are numbered without gaps, so empty windows (negative scores) stay in
    hard = _best(windows, pairs, chunks, blocks, width, negatives, False)
    named = hard.join(positive, ["anchor", "goal"]).join(asked.select(F.col("row").alias("anchor"), F.col("key").alias("anchor_key")), "anchor")
    shown = {"anchor_id": "anchor_key", "positive_id": "positive", "negative_id": "key"}
    ids = {name: F.nullif(F.col(c), F.lit(_LAST)) for name, c in shown.items()}
    return named.select(ids["anchor_id"].alias("anchor_id"), ids["positive_id"].alias("positive_id"), "rank",
                        ids["negative_id"].alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all; every seventh label is moved on by one first."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(v.withColumn("label", moved), F.col("vec_id") % ANCHOR_STEP == 0)


_ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_STEP} = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND {LOWEST} * positive_score <= 100 * score
  AND 100 * score <= {HIGHEST} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE = {"op13_hard_negatives": _ORACLE}
