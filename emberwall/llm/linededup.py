"""Line dedup: a suffix array over line ids, built by prefix doubling, and its intervals of common prefixes.

Only DataFrame operations. A line is a text's part between newlines; its id is
a hash pair. Round k names every run of 2 ** k lines: the distinct pairs of
names from the round before are sorted over the cluster and numbered in order,
so names order the suffixes by their first 2 ** k lines, and equal names mark
an interval of the suffix array. Runs that occur once are left out at once.
Coming back down, each position keeps the deepest interval of which it is not
the first member (the first stays with the interval as its witness), which
gives the longest run that starts there and has occurred before.

Equal texts are one sequence, represented by their first document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut_lineage, numbered, table, word_count

MIN_WORDS = 10


def _text_key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _sequences(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per distinct text: h1, h2, its first id, its lines as (l1, l2, words), and its order ``doc``."""
    lines = F.transform(F.split(F.coalesce(docs[text], F.lit("")), "\n", -1),
                        lambda x: F.struct(F.xxhash64(x).alias("l1"), F.hash(x).alias("l2"),
                                           word_count(x).cast("int").alias("words")))
    rows = docs.select(docs[id_col].alias("id"), *_text_key(docs[text]), lines.alias("lines"))
    distinct = rows.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("lines").alias("lines"))
    return cut_lineage(numbered(distinct, F.col("id").asc_nulls_last(), F.col("h1"), F.col("h2"), into="doc"))


def _named(rows: DataFrame, key: list[str]) -> DataFrame:
    """(pos, name, first) of the rows whose key occurs more than once; names are in the order of the keys."""
    groups = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1")
    names = cut_lineage(groups.orderBy(*key).withColumn("rank", F.monotonically_increasing_id()).drop("n"))
    return cut_lineage(rows.join(names, key).select("pos", F.col("rank").alias("name"), "first"))


def _at(level: DataFrame) -> DataFrame:
    return level.select(F.col("pos").alias("at"), F.col("name").alias("next"))


def doubled(lines: DataFrame) -> list[DataFrame]:
    """Levels of the suffix array: level k has (pos, name, first) of all positions whose 2 ** k lines repeat.

    ``lines`` has (pos, l1, l2); positions of one text are consecutive and
    those of different texts further apart than any run is long.
    """
    levels = [_named(lines, ["l1", "l2"])]
    while not levels[-1].isEmpty():
        here = levels[-1]
        pairs = here.join(_at(here), F.col("at") == F.col("pos") + (1 << (len(levels) - 1)))
        levels.append(_named(cut_lineage(pairs.select("pos", "name", "next")), ["name", "next"]))
    return levels[:-1]


def longest_earlier(levels: list[DataFrame]) -> DataFrame | None:
    """(pos, len): for every position whose line has occurred before, the longest run from it that has."""
    state, top = None, len(levels)
    for k in reversed(range(top)):
        step = 1 << k
        if state is not None:
            # which members of an interval also share the next 2 ** k lines
            tried = cut_lineage(state.join(_at(levels[k]), F.col("at") == F.col("pos") + F.col("len"), "left").drop("at"))
            finer = (tried.where("next is not null").groupBy("len", "node", "next")
                     .agg(F.min("pos").alias("first"), F.max(F.when(F.col("query"), F.col("pos"))).alias("last"))
                     .where("last > first").withColumn("finer", F.monotonically_increasing_id()))
            finer = cut_lineage(finer)
            moved = F.col("query") & (F.col("pos") > F.col("first"))
            joined = tried.join(finer.drop("last"), ["len", "node", "next"], "left")
            state = joined.select(
                "pos", F.when(moved, F.col("len") + step).otherwise(F.col("len")).alias("len"),
                F.when(moved, F.col("finer")).otherwise(F.col("node")).alias("node"), "query",
            ).union(finer.select(F.col("first").alias("pos"), (F.col("len") + step).alias("len"),
                                 F.col("finer").alias("node"), F.lit(False).alias("query")))
        later = levels[k].where("pos <> first")
        if k + 1 < top:
            later = later.join(levels[k + 1].where("pos <> first").select("pos"), "pos", "left_anti")
        later = cut_lineage(later.select("pos", F.lit(step).cast("long").alias("len"),
                                         F.col("name").alias("node"), F.lit(True).alias("query"), "first"))
        witnesses = later.select(F.col("first").alias("pos"), "len", "node", F.lit(False).alias("query")).distinct()
        fresh = later.drop("first").union(witnesses)
        state = cut_lineage(fresh if state is None else state.union(fresh))
    return None if state is None else state.where("query").select("pos", "len")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct text: h1, h2, its first id, runs = array of (start, end) of lines that repeat.

    Runs are maximal repeats of at least ``min_words`` words, in line numbers from 0, end exclusive, by start.
    """
    texts = _sequences(docs, id_col, text)
    longest = texts.agg(F.max(F.size("lines"))).first()[0] or 1
    bits = longest.bit_length() + 1  # room for a run past the last line, so that texts stay apart
    lines = texts.select((F.shiftleft("doc", bits)).alias("base"), F.posexplode("lines").alias("line", "x")).select(
        (F.col("base") + F.col("line")).alias("pos"), "x.l1", "x.l2")
    found = longest_earlier(doubled(lines))
    if found is None:
        return texts.select("h1", "h2", "id", _no_spans().alias("runs"))
    start = F.col("pos").bitwiseAND(F.lit((1 << bits) - 1))
    spans = (found.select(F.shiftright("pos", bits).alias("doc"), start.cast("int").alias("start"),
                          (start + F.col("len")).cast("int").alias("end"))
             # runs that end at one line are parts of the longest of them
             .groupBy("doc", "end").agg(F.min("start").alias("start"))
             .groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))

    def enough(span):
        part = F.slice("lines", span["start"] + 1, span["end"] - span["start"])
        return F.aggregate(part, F.lit(0), lambda a, x: a + x["words"]) >= min_words

    return texts.join(spans, "doc", "left").select(
        "h1", "h2", "id", F.coalesce(F.filter("spans", enough), _no_spans()).alias("runs"))


def _id_key(value: Column) -> Column:
    return F.xxhash64(value, value.isNull())


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,end:int>>")


def _merged(spans: Column) -> Column:
    """Spans ordered by start, made disjoint: one that begins within or right after the last is joined to it."""

    def add(done, span):
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(span["start"] <= last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
                      ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, _no_spans(), add)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``line_dedup`` = struct(text, n_lines, n_removed, removed).

    Documents are ordered by id (null last, then by a hash of the text). A line
    goes if it lies in a run of consecutive lines, of one document, that has at
    least ``min_words`` words and has occurred before, earlier in the same
    document included; ``removed`` lists such lines as ordered disjoint
    (start, end), from 0, end exclusive, and ``text`` is what remains, newlines
    between. Shorter repeats stay. Of rows with equal texts the first keeps its
    lines; among rows equal in id and text too, any one of them does. A null
    text counts as one empty line and stays null. An empty table gives no rows.
    Columns of ``docs`` keep their names and values.
    """
    key = ["__h1", "__h2", "__id"]
    known = repeated_runs(docs, min_words, id_col, text)
    known = known.select(*[F.col(c).alias(k) for c, k in zip(("h1", "h2"), key)], _id_key(F.col("id")).alias("__id"),
                         F.col("runs").alias("__runs"))
    h1, h2 = _text_key(docs[text])
    # the join finds the first document of each text; its other documents find nothing
    joined = docs.withColumns({"__h1": h1, "__h2": h2, "__id": _id_key(docs[id_col])}).join(known, key, "left")
    turn = F.row_number().over(Window.partitionBy(*key).orderBy("__h1"))
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.size(lines).alias("end")))
    copy = F.when(word_count(F.col(text)) >= min_words, whole).otherwise(_no_spans())
    out = joined.withColumn("__turn", turn).withColumn(
        "__removed", F.when(F.col("__runs").isNull() | (F.col("__turn") > 1), copy)
        .when(F.size("__runs") < 2, F.col("__runs")).otherwise(_merged(F.col("__runs"))))
    removed = F.col("__removed")
    n_removed = F.aggregate(removed, F.lit(0), lambda a, s: a + s["end"] - s["start"])
    left = F.array_join(F.filter(lines, lambda x, i: ~F.exists(removed, lambda s: (s["start"] <= i) & (i < s["end"]))), "\n")
    return out.withColumn("line_dedup", F.struct(
        F.when(F.size(removed) == 0, F.col(text)).otherwise(left).alias("text"),
        F.size(lines).alias("n_lines"), n_removed.alias("n_removed"), removed.alias("removed"),
    )).drop(*key, "__runs", "__turn", "__removed")


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """The documents themselves after ``dedup_lines``: later copies cut out, and documents left without a line gone."""
    out = dedup_lines(docs, min_words, text=text).where("line_dedup.n_removed < line_dedup.n_lines")
    return out.withColumn(text, F.col("line_dedup.text")).drop("line_dedup")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of all documents: line counts, the lines removed and a digest of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.array_join(F.transform("line_dedup.removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return dedup_lines(docs).select(
        "doc_id", F.col("line_dedup.n_lines").cast("long").alias("n_lines"),
        F.col("line_dedup.n_removed").cast("long").alias("n_removed"), spans.alias("removed"),
        F.sha2(F.coalesce("line_dedup.text", F.lit("")), 256).alias("text_sha256"))


# A line lies in a repeated run of enough words exactly if it lies in such a run that is either the shortest
# from its first line on or the shortest up to the line itself, so those windows are compared as wholes.
_ORACLE = rf"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l,
         list_transform(string_split(coalesce(text, ''), chr(10)),
           lambda x: len(regexp_extract_all(x, '[^ 	-
]+'))) AS w
  FROM documents
), places AS (
  SELECT doc_id, l, w, unnest(range(1, len(l) + 1)) AS p FROM lines
), windows AS (
  SELECT doc_id, p, 'from' AS kind, p AS a, list_first(list_filter(range(p, len(l) + 1),
           lambda e: list_sum(w[p:e]) >= {MIN_WORDS})) AS b, l FROM places
  UNION ALL
  SELECT doc_id, p, 'upto', list_last(list_filter(range(1, p + 1),
           lambda s: list_sum(w[s:p]) >= {MIN_WORDS})), p, l FROM places
), ranked AS (
  SELECT doc_id, a, b, row_number() OVER (PARTITION BY kind, l[a:b] ORDER BY doc_id, a) AS n
  FROM windows WHERE a IS NOT NULL AND b IS NOT NULL
), gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS p FROM ranked WHERE n > 1
), islands AS (
  SELECT doc_id, min(p) - 1 AS s, max(p) AS e FROM (
    SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM gone) GROUP BY doc_id, g
), removed AS (
  SELECT doc_id, sum(e - s)::BIGINT AS n, string_agg(s || ':' || e, ',' ORDER BY s) AS r FROM islands GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(l[p], chr(10) ORDER BY p) AS t FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(l)::BIGINT AS n_lines, coalesce(n, 0) AS n_removed, coalesce(r, '') AS removed,
       sha256(coalesce(t, '')) AS text_sha256
FROM lines LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES = {"op10_line_dedup": op10_line_dedup}
ORACLE = {"op10_line_dedup": _ORACLE}
