"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Only DataFrame operations. What passes through the driver are single sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import broadcast_if_small, cut_lineage, numbered, table, word_count

#: Ordered hash ranges per source in which the cut of a fractional repetition is located.
HASH_BITS = 13
#: A source that its cut leaves further from its target than this share is filled up with later draws that fit, in so
#: many steps at most (each goes on behind the first draw that does not fit any more).
NEAR, FILLS = 0.001, 12
#: A source of at most so many different documents that is still further off than this share is drawn in so many seeded
#: orders, and the one that comes nearest without going over is taken.
FEW, FAR, ORDERS = 1000, 0.005, 64


def _draw(docs: DataFrame, text: str, id_col: str, seed: int) -> Column:
    """A document's seeded place in the order of draws."""
    return F.xxhash64(F.lit(seed), docs[id_col], docs[text])


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_epochs: float = 3.0) -> DataFrame:
    """Target words of each source.

    ``sizes`` has ``source`` and ``size``. Sources in code-point order (null last)
    weigh ``weights``, repeating, and share all words; a source is clamped at
    ``max_epochs`` times its size and its excess is reshared by weight until no
    source is above. Returns source, source_size, target. Sources without words
    get 0; an empty input gives no rows.
    """
    # places by code point, null last
    totals = numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    totals = cut_lineage(totals.select(
        "source", "source_size", F.get(cycle, (F.col("place") % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")))
    whole = totals.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level, clamped = float(whole[0] or 0), 0.0, -1
    if total:
        level = total / whole[1]
    while total:
        full = F.col("weight") * F.lit(level) >= F.col("cap")
        n, cap, free = totals.agg(F.sum(full.cast("int")), F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
                                  F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == clamped or not free:
            break
        clamped, level = n, (total - cap) / free
    return totals.select("source", "source_size",
                         F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _with_run(units: DataFrame) -> DataFrame:
    """``units`` (source, draw, words) with ``run``: a source's words up to each draw.

    Summed by hash range first and then within each, so that no task sorts all the draws of one source.
    """
    units = cut_lineage(units.withColumn("bin", F.shiftright("draw", 64 - HASH_BITS)))
    ranges = units.groupBy(F.col("source").alias("r_source"), F.col("bin").alias("r_bin")).agg(F.sum("words").alias("all"))
    before = ranges.withColumn("before", F.sum("all").over(Window.partitionBy("r_source").orderBy("r_bin")) - F.col("all"))
    inner = F.sum("words").over(Window.partitionBy("source", "bin").orderBy("draw"))
    return (units.withColumn("inner", inner)
            .join(before, units["source"].eqNullSafe(F.col("r_source")) & (F.col("bin") == F.col("r_bin")))
            .withColumn("run", F.col("before") + F.col("inner")).drop("r_source", "r_bin", "all", "before", "inner", "bin"))


def _fills(base: DataFrame, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps (source, after, upto, limit) that take the draws between of at most ``limit`` words, and (source, gap) left.

    Only sources whose cut is far from the target are looked at; theirs are few documents or very long ones.
    """
    todo = cut_lineage(cuts.where((F.col("gap") >= 1) & (F.col("gap") > F.col("target") * NEAR)).select(
        F.col("source").alias("s"), F.when(~F.col("none"), F.col("cut")).alias("after"), F.col("gap").alias("limit")))
    later = F.col("after").isNull() | (F.col("draw") > F.col("after"))
    fits = (base["size"] >= 1) & (F.col("size") <= F.col("limit")) & later
    rows = cut_lineage(base.join(todo, base["source"].eqNullSafe(F.col("s"))).where(fits).select("source", "size", "draw"))
    steps, gaps = todo.select(F.col("s").alias("source"), "after", F.lit(0).cast("long").alias("upto"), "limit").limit(0), None
    for _ in range(FILLS):
        units = _with_run(rows.join(todo, rows["source"].eqNullSafe(F.col("s")))
                          .where((F.col("size") <= F.col("limit")) & later)
                          .groupBy("source", "after", "limit", "draw").agg(F.sum("size").alias("words")))
        good = F.col("run") <= F.col("limit")
        taken = cut_lineage(units.groupBy("source", "after", "limit").agg(
            F.max(F.when(good, F.col("draw"))).alias("upto"), F.max(F.when(good, F.col("run"))).alias("got"),
            F.min(F.when(~good, F.col("draw"))).alias("stop")))
        if taken.isEmpty():
            break
        steps = steps.union(taken.where("upto is not null").select("source", "after", "upto", "limit"))
        left = taken.select(F.col("source").alias("s"), F.col("stop").alias("after"),
                            (F.col("limit") - F.coalesce("got", F.lit(0))).alias("limit"))
        gaps = left.select(F.col("s").alias("source"), F.col("limit").alias("gap")) if gaps is None else gaps.union(
            left.select("s", "limit"))
        todo = cut_lineage(left.where("after is not null and limit >= 1"))
    none = cuts.select("source", "gap").limit(0) if gaps is None else gaps
    return steps, none.groupBy("source").agg(F.min("gap").alias("gap"))


def _chosen(base: DataFrame, cuts: DataFrame) -> DataFrame:
    """(source, chosen): of far sources of few documents, the draws to take once more; at most ``FEW`` of them."""
    far = cuts.where(F.col("gap") > F.col("target") * FAR).select(F.col("source").alias("s"), "goal")
    units = base.where("size >= 1").groupBy("source", "draw").agg(F.sum("size").alias("words"))
    few = units.groupBy(F.col("source").alias("f")).agg(F.count("*").alias("n")).where(F.col("n") <= FEW).select("f")
    packs = (units.join(few, units["source"].eqNullSafe(F.col("f"))).join(far, units["source"].eqNullSafe(F.col("s")))
             .groupBy("source", "goal").agg(F.collect_list(F.struct("draw", "words")).alias("u")))
    tries = packs.withColumn("try", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))))
    order = F.array_sort(F.transform("u", lambda x: F.struct(
        F.xxhash64(F.col("try"), x["draw"]).alias("o"), x["draw"].alias("draw"), x["words"].alias("words"))))
    none = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("draws"))
    made = F.aggregate(order, none, lambda s, x: F.when(s["sum"] + x["words"] <= F.col("goal"), F.struct(
        (s["sum"] + x["words"]).alias("sum"), F.concat(s["draws"], F.array(x["draw"])).alias("draws"))).otherwise(s))
    best = F.max_by("made", F.struct("made.sum", -F.col("try")))
    return tries.withColumn("made", made).groupBy(F.col("source").alias("h_source")).agg(best["draws"].alias("chosen"))


def mixing_plan(docs: DataFrame, weights=(1, 2, 3), max_epochs: float = 3.0, seed: int = 17,
                id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per source: source, source_size, target, whole (repetitions of every document), cut, fills, extra and chosen.

    A document is taken once more if its draw is at most ``cut``, lies in one of
    the ``fills`` or equals ``extra``. The cut lies where the words drawn reach
    the fractional part of the target; ``fills`` pass over documents that are
    too long for what is left and take later ones that fit; ``extra`` is the one
    further document, if any, that brings the sum nearer. Where ``chosen`` is
    not null its draws are those taken instead.
    """
    base = cut_lineage(docs.select(docs[source].alias("source"), word_count(docs[text]).alias("size"),
                                   _draw(docs, text, id_col, seed).alias("draw")))
    goals = cut_lineage(source_targets(base, weights, max_epochs)
                        .withColumn("whole", F.when(F.col("source_size") > 0,
                                                    F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)))
                        .withColumn("goal", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    shift = 64 - HASH_BITS
    in_range = F.shiftright("draw", shift)
    ranges = (base.groupBy("source", in_range.alias("bin")).agg(F.sum("size").alias("words"))
              .withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("bin"))))
    edge = (ranges.alias("r").join(goals.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
            .where("upto >= goal").groupBy("g.source", "goal", "whole", "source_size", "target")
            .agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("edge"))
            .select("source", "goal", "whole", "source_size", "target", "edge.*"))
    edge = cut_lineage(edge)
    e = edge.select(F.col("source").alias("e_source"), "bin", "before", "goal")
    at_edge = (base.join(e, base["source"].eqNullSafe(F.col("e_source")) & (in_range == F.col("bin")))
               .groupBy("source", "draw", "before", "goal").agg(F.sum("size").alias("words"))
               .withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("draw")))
               .where("upto <= goal").groupBy("source").agg(F.max("draw").alias("last"), F.max("upto").alias("got")))
    a = at_edge.select(F.col("source").alias("a_source"), "last", "got")
    cuts = (edge.join(a, edge["source"].eqNullSafe(F.col("a_source")), "left")
            .select("source", "source_size", "target", "whole", "goal",
                    F.coalesce("last", F.shiftleft("bin", shift) - 1).alias("cut"),
                    # below the lowest range a cut of one less than the least long would wrap around
                    (F.col("last").isNull() & (F.col("bin") == -(1 << (HASH_BITS - 1)))).alias("none"),
                    (F.col("goal") - F.coalesce("got", "before")).alias("gap")))
    cuts = cut_lineage(cuts)
    steps, gaps = _fills(base, cuts)
    steps = steps.groupBy(F.col("source").alias("f_source")).agg(F.collect_list(F.struct("after", "upto", "limit")).alias("fills"))
    gaps = gaps.select(F.col("source").alias("g_source"), F.col("gap").alias("left"))
    cuts = (cuts.join(steps, cuts["source"].eqNullSafe(F.col("f_source")), "left")
            .join(gaps, cuts["source"].eqNullSafe(F.col("g_source")), "left"))
    cuts = cut_lineage(cuts.withColumns({"gap": F.coalesce("left", "gap"), "fills": F.coalesce("fills", F.array().cast(_FILLS))})
                       .drop("f_source", "g_source", "left"))
    c = cuts.select(F.col("source").alias("c_source"), "cut", "none", "gap", "fills")
    # a document and its copies are taken or left together, so whether they bring the sum nearer is asked of all
    units = (base.join(c, base["source"].eqNullSafe(F.col("c_source"))).where(~_drawn(F.col("draw"), F.col("size"), c))
             .where("size >= 1 and size < 2 * gap").groupBy("source", "draw", "gap").agg(F.sum("size").alias("words")))
    miss = F.abs(F.col("words") - F.col("gap"))
    nearest = units.where(miss < F.col("gap")).groupBy("source").agg(
        F.min(F.struct(miss.alias("miss"), "draw"))["draw"].alias("extra"))
    n = nearest.select(F.col("source").alias("n_source"), "extra")
    return (cuts.join(n, cuts["source"].eqNullSafe(F.col("n_source")), "left")
            .join(_chosen(base, cuts), cuts["source"].eqNullSafe(F.col("h_source")), "left")
            .select("source", "source_size", "target", "whole", "cut", "none", "fills", "extra", "chosen"))


_FILLS = "array<struct<after:bigint,upto:bigint,limit:double>>"


def _drawn(draw: Column, size: Column, plan) -> Column:
    """Whether the cut or a fill of a source's plan takes a document."""
    filled = F.exists(plan["fills"], lambda f: (f["after"].isNull() | (draw > f["after"])) & (draw <= f["upto"])
                      & (size >= 1) & (size <= f["limit"]))
    return ((draw <= plan["cut"]) & ~plan["none"]) | filled


def mix(docs: DataFrame, weights=(1, 2, 3), max_epochs: float = 3.0, seed: int = 17,
        id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Documents with how often the mix takes them.

    Adds ``mix`` = struct(size, source_size, target, reps) to the columns given,
    whatever they are called otherwise. The words of a source's repetitions come
    near its target: every document ``whole`` times, and a seeded draw of them
    once more, never above ``max_epochs`` times. The same rows give the same mix.
    A null text has size 0; null is a source of its own, ordered last; a source
    without words keeps its documents once and takes no words; fully equal rows
    share one decision; an empty table gives no rows.
    """
    plan = broadcast_if_small(cut_lineage(mixing_plan(docs, weights, max_epochs, seed, id_col, text, source)))
    plan = plan.select(F.struct(*plan.columns).alias("__plan"))
    draw, p = F.col("__draw"), F.col("__plan")
    once_more = F.when(p["chosen"].isNotNull(), F.array_contains(p["chosen"], draw)).otherwise(
        _drawn(draw, F.col("__size"), p) | draw.eqNullSafe(p["extra"]))
    return (docs.withColumns({"__draw": _draw(docs, text, id_col, seed), "__size": word_count(docs[text])})
            .join(plan, docs[source].eqNullSafe(p["source"]), "left")
            .withColumn("mix", F.struct(F.col("__size").alias("size"), p["source_size"].alias("source_size"),
                                        p["target"].alias("target"),
                                        (p["whole"] + F.when(once_more & (p["source_size"] > 0), 1).otherwise(0))
                                        .cast("int").alias("reps")))
            .drop("__draw", "__size", "__plan"))


def repeat_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixed corpus itself: each row as often as its ``mix.reps`` says (0: not at all)."""
    return (mixed.where("mix.reps > 0")
            .select(*columns, F.explode(F.array_repeat(F.lit(True), F.col("mix.reps"))).alias("__rep")).drop("__rep"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 1, 2, 3 by source, at most three epochs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target",
                            (F.col("mix.size") * F.col("mix.reps")).alias("taken"),
                            F.col("mix.reps").alias("reps"))


QUERIES = {"op4_mix_sources": op4_mix_sources}
ORACLE = {}
