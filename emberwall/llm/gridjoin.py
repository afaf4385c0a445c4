"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors at a cosine of c or more lie at most epsilon = sqrt(2 - 2 c)
apart. They are projected on a few leading principal directions and sorted by
the grid cells (epsilon wide) of those coordinates. Intervals of the sequence
are joined recursively, first between blocks by DataFrame rounds, then within
a pair of blocks in numpy; a pair of intervals whose bounding boxes are more
than epsilon apart is skipped, as no pair in it can be near. What remains is
compared in double precision.

Equal vectors are one node with a count. A pair of blocks gives each node's
number of links and as many links as join what it joins, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import cut_lineage, numbered, table
from .graph import components

COSINE = 0.9
#: Principal directions, rounds of subspace iteration that find them, vectors to a block and to a leaf, children
#: to an interval of blocks.
DIRECTIONS, ROUNDS, BLOCK, LEAF, FANOUT = 8, 3, 4096, 512, 8


def _unit(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors of length one in double precision, padded with zeros."""
    out = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        x = np.asarray(x, float)
        x = x / np.abs(x).max()  # squares of very large or small numbers would leave the range of a double
        out[i, : len(x)] = x / np.sqrt(x @ x)
    return out


def _vectors(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def valid(vector: Column) -> Column:
    """Whether a vector can link at all: there, without null or non-finite components, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def principal_directions(nodes: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns near the leading principal directions, by subspace iteration over all vectors.

    Any orthonormal columns give right results; better ones skip more.
    """
    m = min(DIRECTIONS, width)
    basis = np.linalg.qr(np.random.default_rng(7).normal(size=(width, m)))[0]
    for _ in range(ROUNDS):
        q = basis

        def each(batches, q=q):
            total, plain, n = np.zeros((width, m)), np.zeros(width), 0
            for batch in batches:
                u = _unit(_vectors(batch, "vector"), width)
                total += u.T @ (u @ q)
                plain += u.sum(0)
                n += len(u)
            values = np.concatenate([total.ravel(), plain, [n]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])

        # one number for each entry of the basis: at most (DIRECTIONS + 1) * width + 1 rows
        sums = nodes.select("vector").mapInArrow(each, "at long, value double").groupBy("at").agg(F.sum("value").alias("v"))
        values = np.array([r.v for r in sums.orderBy("at").collect()])
        if not len(values) or not values[-1]:
            return basis
        total, mean = values[: width * m].reshape(width, m), values[width * m: -1] / values[-1]
        basis = np.linalg.qr(total - values[-1] * np.outer(mean, mean @ q))[0]
    return basis


def _placed(nodes: DataFrame, width: int, basis: np.ndarray, epsilon: float) -> DataFrame:
    """Vectors in epsilon grid order: (node, copies, vector, place)."""

    def each(batches):
        for batch in batches:
            cells = np.floor(_unit(_vectors(batch, "vector"), width) @ basis / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(cells), pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "cells"])

    schema = T.StructType([*nodes.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    celled = nodes.mapInArrow(each, schema)
    return numbered(celled, F.size("vector"), F.col("cells"), F.col("node")).drop("cells")


def _blocks(placed: DataFrame, width: int, basis: np.ndarray) -> DataFrame:
    """One row per block: its bounding box (vector lengths first, so that unlike lengths are far apart) and its rows."""

    def each(block):
        block = block.sort_values("place")
        rows = [np.asarray(x) for x in block["vector"]]
        size = np.array([len(x) for x in rows], np.int32)
        u = _unit(rows, width)
        spread = np.column_stack([size * 10.0, u @ basis])
        return pd.DataFrame({
            "block": [int(block["place"].iloc[0]) // BLOCK], "low": [spread.min(0)], "high": [spread.max(0)],
            "nodes": [block["node"].to_numpy(np.int64).tobytes()], "copies": [block["copies"].to_numpy(np.int64).tobytes()],
            "sizes": [size.tobytes()], "units": [u.tobytes()]})

    return placed.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("block").applyInPandas(
        each, "block long, low array<double>, high array<double>, nodes binary, copies binary, sizes binary, units binary")


def _apart(a: str, b: str) -> Column:
    """Square of the distance of two bounding boxes."""
    gap = F.zip_with(F.zip_with(f"low{b}", f"high{a}", lambda x, y: x - y),
                     F.zip_with(f"low{a}", f"high{b}", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)


def block_pairs(boxes: DataFrame, n_blocks: int, epsilon: float) -> DataFrame:
    """(a, b), a <= b: pairs of blocks that may hold near vectors, found from the whole sequence downwards."""
    spark, levels = boxes.sparkSession, 0
    while FANOUT ** levels < n_blocks:
        levels += 1
    pairs = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    size = len(boxes.first()["low"])
    for level in reversed(range(levels)):
        span = FANOUT ** level
        box = boxes.groupBy(F.floor(F.col("block") / span).alias("at")).agg(
            F.array(*[F.min(F.get("low", F.lit(i))) for i in range(size)]).alias("low"),
            F.array(*[F.max(F.get("high", F.lit(i))) for i in range(size)]).alias("high"))
        child = F.sequence(F.lit(0), F.lit(FANOUT - 1))
        pairs = (pairs.withColumn("i", F.explode(child)).withColumn("j", F.explode(child))
                 .select((F.col("a") * FANOUT + F.col("i")).alias("a"), (F.col("b") * FANOUT + F.col("j")).alias("b"))
                 .where("a <= b"))
        for x in "ab":
            pairs = pairs.join(box.select(F.col("at").alias(x), F.col("low").alias(f"low{x}"),
                                          F.col("high").alias(f"high{x}")), x)
        pairs = cut_lineage(pairs.where(_apart("a", "b") <= epsilon * epsilon).select("a", "b"))
    return pairs


class _Interval:
    """Part of a block: its rows and bounding box, halved on demand."""

    def __init__(self, u, low_high, at, end):
        self.u, self.x, self.at, self.end = u, low_high, at, end
        self.low, self.high = low_high[at:end].min(0), low_high[at:end].max(0)

    def halves(self):
        middle = (self.at + self.end) // 2
        return _Interval(self.u, self.x, self.at, middle), _Interval(self.u, self.x, middle, self.end)


def _leaves(a: _Interval, b: _Interval, same: bool, epsilon: float) -> Iterator[tuple[_Interval, _Interval]]:
    """Pairs of small intervals that are not provably distant; of one block with itself, each pair once."""
    gap = np.maximum(np.maximum(a.low - b.high, b.low - a.high), 0)
    if gap @ gap > epsilon * epsilon:
        return
    if a.end - a.at <= LEAF and b.end - b.at <= LEAF:
        yield a, b
        return
    if same and a.at == b.at:
        one, two = a.halves()
        for pair in ((one, one), (one, two), (two, two)):
            yield from _leaves(*pair, same, epsilon)
    elif a.end - a.at >= b.end - b.at:
        for part in a.halves():
            yield from _leaves(part, b, same, epsilon)
    else:
        for part in b.halves():
            yield from _leaves(a, part, same, epsilon)


def _joined(a: dict, b: dict, same: bool, basis: np.ndarray, cosine: float, epsilon: float):
    """(node, links) of the linked nodes of two blocks, and links that join what is joined."""
    counts = [np.zeros(len(a["nodes"]), np.int64), np.zeros(len(b["nodes"]), np.int64)]
    if same:
        counts[1] = counts[0]
    far = 0 if same else len(a["nodes"])
    label = np.arange(far + len(b["nodes"]))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    whole = [_Interval(x["units"], x["units"] @ basis, 0, len(x["nodes"])) for x in (a, b)]
    for p, q in _leaves(*whole, same, epsilon):
        near = p.u[p.at:p.end] @ q.u[q.at:q.end].T >= cosine
        near &= a["sizes"][p.at:p.end][:, None] == b["sizes"][q.at:q.end]
        diagonal = same and p.at == q.at
        if diagonal:
            np.fill_diagonal(near, False)
        if not near.any():
            continue
        counts[0][p.at:p.end] += near @ b["copies"][q.at:q.end]
        if not diagonal:
            counts[1][q.at:q.end] += near.T @ a["copies"][p.at:p.end]
        # each row's links lead to its first column's tree; whole rows are alike within a group of copies
        for i in np.flatnonzero(near.any(1)):
            mine = root(p.at + int(i))
            others = label[far + q.at + np.flatnonzero(near[i])]
            for t in np.unique(others).tolist():
                t = root(t)
                if t != mine:
                    label[max(t, mine)] = min(t, mine)
                    mine = min(t, mine)
    nodes = a["nodes"] if same else np.concatenate([a["nodes"], b["nodes"]])
    links = counts[0] if same else np.concatenate(counts)
    tops = np.array([root(i) for i in range(len(label))])
    tied = np.flatnonzero(tops != np.arange(len(tops)))
    some = np.flatnonzero(links)
    return nodes[some], links[some], nodes[tied], nodes[tops[tied]]


def _links(pairs: DataFrame, blocks: DataFrame, width: int, basis: np.ndarray, cosine: float, epsilon: float) -> DataFrame:
    """(node, links, other): a count of links where ``other`` is null, else a link."""
    names = ["nodes", "copies", "sizes", "units"]
    for x in "ab":
        pairs = pairs.join(blocks.select(F.col("block").alias(x), *[F.col(c).alias(c + x) for c in names]), x)

    def each(batches):
        for batch in batches:
            for row in batch.to_pylist():
                one, two = ({"nodes": np.frombuffer(row["nodes" + x], np.int64),
                             "copies": np.frombuffer(row["copies" + x], np.int64),
                             "sizes": np.frombuffer(row["sizes" + x], np.int32),
                             "units": np.frombuffer(row["units" + x]).reshape(-1, width)} for x in "ab")
                node, links, low, top = _joined(one, two, row["a"] == row["b"], basis, cosine, epsilon)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([node, low])),
                     pa.array(np.concatenate([links, np.zeros(len(low), np.int64)])),
                     pa.array([None] * len(node) + top.tolist(), pa.int64())], names=["node", "links", "other"])

    return pairs.mapInArrow(each, "node long, links long, other long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    ``n_links`` counts the other rows at a cosine of at least ``cosine``;
    ``component_id`` is the smallest id reachable by links, ``kept`` whether it
    is the row's own. Null, zero and empty vectors and those with null or
    non-finite components link with nothing, nor do vectors of unlike lengths.
    Rows that repeat an id are rows of their own; a null id counts as larger
    than any other. An empty table gives no rows; other columns are not looked at.
    """
    epsilon = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    v = vectors[vector]
    keyed = vectors.select(vectors[id_col].alias("id"), F.when(valid(v), v).alias("vector"))
    keyed = keyed.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(1), "vector")})
    good = keyed.where("vector is not null")
    nodes = cut_lineage(good.groupBy("k1", "k2").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id()))
    n, width = nodes.agg(F.count("*"), F.max(F.size("vector"))).first()
    found = None
    if n:
        basis = principal_directions(nodes, width)
        slim = nodes.select("node", "copies", "vector")
        blocks = cut_lineage(_blocks(_placed(slim, width, basis, epsilon), width, basis))
        pairs = block_pairs(blocks.select("block", "low", "high"), -(-n // BLOCK), epsilon)
        found = cut_lineage(_links(pairs, blocks, width, basis, cosine, epsilon))
        label = components(found.where("other is not null").select("node", "other"))
        counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
        named = (nodes.select("node", "k1", "k2", "first", "copies").join(label, "node", "left").join(counts, "node", "left")
                 .withColumn("component", F.coalesce("component", "node")))
        least = named.groupBy("component").agg(F.min("first").alias("component_id"))
        known = named.join(least, "component").select(
            "k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
        linked = good.select("id", "k1", "k2").join(known, ["k1", "k2"])
        found = linked.select("id", F.col("links").alias("n_links"), "component_id")
    alone = keyed.where("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = alone if found is None else found.union(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op1_grid_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors at a cosine of 0.9, whatever their labels."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


_ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= {COSINE}
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) JOIN least USING (vec_id)
"""

QUERIES = {"op1_grid_neardup": op1_grid_neardup}
ORACLE = {"op1_grid_neardup": _ORACLE}
