"""Conversation structure repair by a dynamic program over a shared grammar.

A turn is a symbol: the initial of its role and its fault. A conversation is
repaired by edits (keep, rerole, delete, insert) that make its initials fit
``(s?(ua)+)?`` at the least cost; among cheapest edits the audit, the string
of their initials, is the least. A symbol's part in this is a 4 x 4 min-plus
transfer matrix over the states of that pattern, and matrices of consecutive
turns multiply.

Equal sequences of symbols are one. Re-Pair rules, counted over all distinct
sequences by Spark, replace frequent pairs; every rule's matrix is the product
of its two parts, made once, bottom-up, and used wherever the rule stands. An
entry keeps its cost, the state between its parts (so an audit is a rope that
is spelt out at the end) and its rank among the entries of its matrix: inserts
stand before the edit of a turn, so no audit of a matrix is the beginning of
another, and ranks of the parts order the audits of the whole.

Conversations are cut into segments of a bounded number of turns wherever they
meet a block border; the matrices of a long conversation's segments multiply
in turn, so only they, not its turns, meet in one task.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import broadcast_if_small, cut_lineage, numbered, prepare_workers, table

#: Turns to a segment at most; sequences whose matrices are multiplied together.
SEGMENT, TOGETHER = 4096, 256
#: Re-Pair: rounds, rules to a round, and the share of all symbols that a pair must save to become a rule. More rules
#: would only save work; results do not depend on them.
ROUNDS, RULES, WORTH = 8, 32, 1e-4
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a. Where an initial leads.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Inserts that complete a conversation from each state.
_END = ("", "II", "I", "")
_INITIALS, _LEGAL = "sua", {"su", "ua", "au"}
#: Faults in the order of their symbols: none, blank, duplicate, truncated.
_NONE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_SPACE = " \t\n\x0b\x0c\r"
_FIRST, _RULE = 0x41, 0xE000
_INF = 1 << 40


def symbol(role: Column, fault: Column) -> Column:
    """One character for the initial of a role (s, u, a or another) and a fault."""
    kind = F.when(role.startswith("s"), 0).when(role.startswith("u"), 1).when(role.startswith("a"), 2).otherwise(3)
    return F.char(F.lit(_FIRST) + kind * 4 + fault)


def _inserts(state: int) -> Iterator[tuple[str, int]]:
    """Inserts from a state without coming back to one, and where they lead."""
    seen, made = set(), ""
    while state is not None and state not in seen:
        yield made, state
        seen.add(state)
        state, made = next((_NEXT[state, c] for c in "ua" if (state, c) in _NEXT), None), made + "I"


def _turn_matrix(kind: int, fault: int) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Cost, rank and audit of every entry of one turn's matrix."""
    best = [[(_INF, "")] * 4 for _ in range(4)]
    extra = TRUNCATED if fault == _TRUNCATED else 0
    for i in range(4):
        for made, k in _inserts(i):
            ways = [(DELETE, "D", k)]
            if fault not in (_BLANK, _DUPLICATE):
                if kind < 3 and (k, _INITIALS[kind]) in _NEXT:
                    ways.append((extra, "K", _NEXT[k, _INITIALS[kind]]))
                ways += [(REROLE + extra, "R", _NEXT[k, c]) for c in "ua" if (k, c) in _NEXT]
            for cost, edit, j in ways:
                best[i][j] = min(best[i][j], (cost + INSERT * len(made), made + edit))
    audits = [[entry[1] for entry in row] for row in best]
    order = {a: n for n, a in enumerate(sorted({a for row in audits for a in row}))}
    return (np.array([[e[0] for e in row] for row in best]), np.array([[order[a] for a in row] for row in audits]), audits)


def _product(cost1, rank1, cost2, rank2):
    """Min-plus products of batches of matrices: cost, rank and the state between the parts."""
    key = (((cost1[..., :, :, None] + cost2[..., None, :, :]) << 8) | (rank1[..., :, :, None] << 4) | rank2[..., None, :, :])
    between = key.argmin(-2)
    least = key.min(-2)
    code = (least & 255).reshape(*least.shape[:-2], 16)
    rank = (code[..., :, None] > code[..., None, :]).sum(-1).reshape(least.shape)
    return np.minimum(least >> 8, _INF), rank, between


class Grammar:
    """Re-Pair rules with their transfer matrices."""

    def __init__(self, pairs: list[str]):
        self.pairs = pairs
        turns = [_turn_matrix(kind, fault) for kind in range(4) for fault in range(4)]
        self.cost, self.rank = [t[0] for t in turns], [t[1] for t in turns]
        self.audits, self.between = [t[2] for t in turns], [None] * 16
        self.at = {chr(_FIRST + n): n for n in range(16)}
        for pair in pairs:  # a rule's parts are turns or earlier rules
            a, b = (self.at[c] for c in pair)
            cost, rank, between = _product(self.cost[a], self.rank[a], self.cost[b], self.rank[b])
            self.at[chr(_RULE + len(self.at) - 16)] = len(self.cost)
            self.cost.append(cost), self.rank.append(rank), self.between.append(between)
        self.costs, self.ranks = np.array(self.cost), np.array(self.rank)

    def packed(self, sequence: str) -> str:
        for n, pair in enumerate(self.pairs):
            sequence = sequence.replace(pair, chr(_RULE + n))
        return sequence

    def __getstate__(self):
        return self.pairs

    def __setstate__(self, pairs):
        self.__init__(pairs)

    def speller(self):
        """Audit of an entry of a symbol's matrix, its rope spelt out; shared parts once."""

        @lru_cache(maxsize=1 << 16)
        def spelt(n: int, i: int, j: int) -> str:
            if n < 16:
                return self.audits[n][i][j]
            a, b = (self.at[c] for c in self.pairs[n - 16])
            k = int(self.between[n][i, j])
            return spelt(a, i, k) + spelt(b, k, j)

        return spelt

    def folded(self, sequences: list[str]):
        """Matrices of the sequences (cost, rank) and a function that spells the audit of an entry."""
        symbols = [[self.at[c] for c in self.packed(s)] for s in sequences]
        lengths = np.array([len(s) for s in symbols])
        first = np.array([s[0] for s in symbols])
        cost, rank = self.costs[first].copy(), self.ranks[first].copy()
        states: list[dict[int, int]] = []
        steps = []
        for t in range(1, int(lengths.max())):
            some = np.flatnonzero(lengths > t)
            nth = np.array([symbols[n][t] for n in some])
            cost[some], rank[some], between = _product(cost[some], rank[some], self.costs[nth], self.ranks[nth])
            states.append(dict(zip(some.tolist(), range(len(some)), strict=True)))
            steps.append(between.astype(np.uint8))
        spelt = self.speller()

        def audit(n: int, i: int, j: int) -> str:
            parts = []
            for t in range(len(symbols[n]) - 1, 0, -1):
                k = int(steps[t - 1][states[t - 1][n], i, j])
                parts.append(spelt(symbols[n][t], k, j))
                j = k
            return "".join([spelt(symbols[n][0], i, j), *reversed(parts)])

        return cost, rank, audit


def _ended(cost: np.ndarray, rank: np.ndarray) -> int:
    """Last state of the cheapest repair that starts with nothing; the least audit decides among equals."""
    return min(range(4), key=lambda j: (int(cost[0, j]) + INSERT * len(_END[j]), int(rank[0, j])))


def repair_grammar(sequences: DataFrame) -> Grammar:
    """Re-Pair rules of the distinct sequences: each round counts all adjacent pairs and adds the most frequent that do not overlap."""
    pairs: list[str] = []
    for _ in range(ROUNDS):
        grammar = Grammar(pairs)

        def counted(batches, grammar=grammar):
            counts: Counter = Counter()
            for batch in batches:
                for s in batch.column(0).to_pylist():
                    s = grammar.packed(s)
                    counts.update(map("".join, zip(s, s[1:])))
                    counts[""] += len(s)
            yield pa.RecordBatch.from_pydict({"pair": list(counts), "n": list(counts.values())},
                                             schema=pa.schema([("pair", pa.string()), ("n", pa.int64())]))

        # pairs of at most 16 + ROUNDS * RULES symbols; the most frequent alone reach the driver
        counts = sequences.select("seq").mapInArrow(counted, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.orderBy(F.desc("n"), "pair").limit(4 * RULES + 1).collect()
        total = next((r.n for r in top if r.pair == ""), 0)
        left, right, new = set(), set(), []
        for r in top:
            if r.pair and r.n >= max(2, WORTH * total) and len(new) < RULES:
                a, b = r.pair
                if a not in right and b not in left and (a != b or a not in left | right):
                    left.add(a), right.add(b), new.append(r.pair)
        if not new:
            break
        pairs += new
    return Grammar(pairs)


def _order(turns: DataFrame) -> list[Column]:
    return [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("md5")]


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The columns used, under names of their own; a conversation is a struct, so that null is a key like any other."""
    one = lambda c: F.coalesce(turns[c], F.lit(" "))
    return turns.select(F.struct(turns[conv].alias("id")).alias("conv"), turns[turn].cast("long").alias("turn"),
                        one(role).alias("role"), one(text).alias("text")).withColumn("md5", F.md5("text"))


def _segments(turns: DataFrame) -> DataFrame:
    """(conv, first, seq): the symbols of every segment in order; ``first`` numbers the segments by place."""
    shown = F.rtrim("text", F.lit(_SPACE))
    plain = turns.select("conv", "turn", "role", "md5", F.when(shown == "", _BLANK).when(
        F.substring(shown, -1, 1).isin(".", "!", "?"), _NONE).otherwise(_TRUNCATED).alias("fault"))
    placed = cut_lineage(numbered(plain, *_order(plain)))
    alike = placed.groupBy("conv", "role", "md5").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    known = placed.join(alike, ["conv", "role", "md5"], "left")
    fault = F.when((F.col("fault") != _BLANK) & (F.col("place") > F.col("earliest")), _DUPLICATE).otherwise(F.col("fault"))
    marks = known.select("conv", "place", symbol(F.col("role"), fault).alias("symbol"))
    grouped = marks.groupBy("conv", F.floor(F.col("place") / SEGMENT).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "symbol"))).alias("s"))
    return grouped.select("conv", F.get("s", F.lit(0)).place.alias("first"),
                          F.array_join(F.transform("s", lambda x: x.symbol), "").alias("seq"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _counts(s: str) -> list[int]:
    code = [ord(c) - _FIRST for c in s]
    fault = Counter(c % 4 for c in code)
    initials = [_INITIALS[c // 4] if c < 12 else "?" for c in code]
    return [fault[_BLANK], fault[_DUPLICATE], fault[_TRUNCATED],
            sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))]


def _solved(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """Each distinct sequence with its counts, its matrix, and the repair of a conversation that is just it."""

    def each(batches):
        for batch in batches:
            every = batch.column(0).to_pylist()
            for at in range(0, len(every), TOGETHER):
                part = every[at: at + TOGETHER]
                cost, rank, audit = grammar.folded(part)
                ends = [_ended(cost[n], rank[n]) for n in range(len(part))]
                counts = np.array([_counts(s) for s in part])
                yield pa.RecordBatch.from_pydict({
                    "seq": part, **{c: counts[:, n].tolist() for n, c in enumerate(_COUNTS)},
                    "cost": [int(cost[n, 0, j]) + INSERT * len(_END[j]) for n, j in enumerate(ends)],
                    "audit": [audit(n, 0, j) + _END[j] for n, j in enumerate(ends)],
                    "matrix": [np.concatenate([cost[n].ravel(), rank[n].ravel()]).tolist() for n in range(len(part))],
                }, schema=pa.schema([("seq", pa.string()), *[(c, pa.int64()) for c in (*_COUNTS, "cost")],
                                     ("audit", pa.string()), ("matrix", pa.list_(pa.int64()))]))

    return sequences.select("seq").mapInArrow(
        each, "seq string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, matrix array<long>")


def _crossed(long: DataFrame) -> DataFrame:
    """(first, seq, i, j, ending, step_cost, border): the states that a long conversation's segments start and end in.

    A group has one small row for each ``SEGMENT`` turns of its conversation.
    """

    def each(part):
        part = part.sort_values("first").reset_index(drop=True)
        both = np.array(part["matrix"].tolist()).reshape(len(part), 2, 4, 4)
        cost, rank, steps = both[0, 0], both[0, 1], []
        for n in range(1, len(part)):
            cost, rank, between = _product(cost, rank, both[n, 0], both[n, 1])
            steps.append(between)
        j = _ended(cost, rank)
        last, i_s, j_s = j, [0] * len(part), [0] * len(part)
        for n in range(len(part) - 1, -1, -1):
            i = int(steps[n - 1][0, j]) if n else 0
            i_s[n], j_s[n], j = i, j, i
        ends = [""] * (len(part) - 1) + [_END[last]]
        costs = [int(both[n, 0, i_s[n], j_s[n]]) + INSERT * len(ends[n]) for n in range(len(part))]
        initial = lambda c: _INITIALS[(ord(c) - _FIRST) // 4] if ord(c) - _FIRST < 12 else "?"
        border = [0] + [int(initial(a[-1]) + initial(b[0]) not in _LEGAL) for a, b in zip(part["seq"], part["seq"][1:])]
        return pd.DataFrame({"first": part["first"], "seq": part["seq"], "i": i_s, "j": j_s, "ending": ends,
                             "step_cost": costs, "border": border})

    return long.select("conv", "first", "seq", "matrix").groupBy("conv").applyInPandas(
        each, "first long, seq string, i int, j int, ending string, step_cost long, border long")


def _spelt(wanted: DataFrame, grammar: Grammar) -> DataFrame:
    """(seq, i, j, audit) for distinct entries of matrices."""

    def each(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for at in range(0, len(rows), TOGETHER):
                part = rows[at: at + TOGETHER]
                _, _, audit = grammar.folded([r["seq"] for r in part])
                yield pa.RecordBatch.from_pydict(
                    {**{c: [r[c] for r in part] for c in ("seq", "i", "j")},
                     "audit": [audit(n, r["i"], r["j"]) for n, r in enumerate(part)]},
                    schema=pa.schema([("seq", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("audit", pa.string())]))

    return wanted.mapInArrow(each, "seq string, i int, j int, audit string")


_PLAN = ("first", *_COUNTS, "cost", "audit")


def _plans(turns: DataFrame) -> DataFrame:
    """(conv, first, blank, duplicate, truncated, illegal, cost, audit) of every segment; a conversation's add up."""
    segments = cut_lineage(_segments(turns))
    sequences = cut_lineage(segments.select("seq").distinct())
    grammar = repair_grammar(sequences)
    solved = cut_lineage(segments.join(cut_lineage(_solved(sequences, grammar)), "seq"))
    # each border of a block of turns cuts one conversation at most
    cut = broadcast_if_small(cut_lineage(segments.groupBy("conv").count().where("count > 1").select("conv")))
    whole = solved.join(cut, "conv", "left_anti").select("conv", *_PLAN)
    long = solved.join(cut, "conv", "left_semi")
    crossed = cut_lineage(_crossed(long))
    spelt = _spelt(crossed.select("seq", "i", "j").distinct(), grammar).withColumnRenamed("audit", "said")
    parts = long.drop("seq", "audit").join(crossed.join(spelt, ["seq", "i", "j"]), "first").select(
        "conv", "first", *_COUNTS[:3], (F.col("illegal") + F.col("border")).alias("illegal"),
        F.col("step_cost").alias("cost"), F.concat("said", "ending").alias("audit"))
    return whole.unionByName(parts)


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Conversations one after the other: ('plan', conv, sums, audit), then ('turn', conv, turn, role, text) for each repaired
    turn (``turn`` is None for an inserted one), then ('end', conv, turns' gaps)."""
    conv = edits = sums = None
    state = at = seen = 0
    least = most = None
    lines: list[str] = []

    def inserts():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            initial = "a" if state == 2 else "u"
            state, at = _NEXT[state, initial], at + 1
            yield "turn", conv, None, "user" if initial == "u" else "assistant", ""

    def finished():
        yield from inserts()
        yield "end", conv, (most - least + 1 - seen) if seen else 0

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in range(batch.num_columns)]
        for key, plan, turn, role, text in zip(*columns, strict=True):
            key = key["id"]
            if plan is not None:
                if conv is None or edits is not None or conv != (key,):
                    if edits is not None:
                        yield from finished()
                    conv, edits, lines, sums = (key,), None, [], dict.fromkeys((*_COUNTS, "cost"), 0)
                lines.append(plan["audit"])
                for c in sums:
                    sums[c] += plan[c]
                continue
            if edits is None:
                edits, state, at, seen, least, most, before = "".join(lines), 0, 0, 0, None, None, None
                yield "plan", conv, sums, edits
            if turn is not None and turn != before:
                before, seen = turn, seen + 1
                least, most = turn if least is None else least, turn
            yield from inserts()
            edit, at = edits[at], at + 1
            if edit == "D":
                continue
            initial = role[:1]
            if edit == "R":
                initial = "a" if state == 2 else "u"
                role = "user" if initial == "u" else "assistant"
            state = _NEXT[state, initial]
            yield "turn", conv, turn, role, text
    if edits is not None:
        yield from finished()


def _streamed(turns: DataFrame) -> DataFrame:
    """Plans and turns of each conversation together and in order: its plans first, by place, then its turns.

    A conversation is read through by one task (its digest is one pass over its whole text), never held.
    """
    plans = _plans(turns)
    names = ["plan", "turn", "role", "text", "md5"]
    told = plans.select("conv", F.struct(*_PLAN).alias("plan"), *[F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in names[1:]])
    said = turns.select("conv", F.lit(None).cast(told.schema["plan"].dataType).alias("plan"), *names[1:])
    return (told.unionByName(said).repartition("conv").sortWithinPartitions(
        F.col("conv"), F.col("plan.first").asc_nulls_last(), F.col("turn").asc_nulls_first(), "role", "md5")
        .select("conv", *names[:-1]))


def _written(conv_type: pa.DataType, rows: Iterator[tuple], names: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv", conv_type), *names])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, str]:
    prepare_workers(turns.sparkSession)
    return _turns(turns, conv, turn, role, text), turns.schema[conv].dataType.simpleString()


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The turns after the cheapest repair: conversation, ``at`` (0, 1, 2, ...), turn (null if inserted), role, text.

    See ``repair_report`` for the rules and the odd cases.
    """
    rows, kind = _prepared(turns, conv, turn, role, text)

    def each(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return

        def lines():
            at = 0
            for what, key, *rest in _rendered(_chain(first, batches)):
                if what == "plan":
                    at = 0
                elif what == "turn":
                    yield key[0], at, *rest
                    at += 1

        yield from _written(first.schema.field("conv").type.field(0).type, lines(),
                            [("at", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    out = _streamed(rows).mapInArrow(each, f"conv {kind}, at long, turn long, role string, text string")
    return out.select(F.col("conv").alias(conv), "at", F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text))


def _chain(first, rest):
    yield first
    yield from rest


def repair_report(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns go by ``turn`` (nulls first), those of one turn by role and the md5 of
    their texts. A null role or text counts as one space, a null conversation
    id is a conversation of its own. A turn's first fault counts: blank,
    duplicate (role and text seen earlier in the conversation), truncated (its
    last visible character does not end a sentence). Roles that start with
    none of s, u, a are deleted or reroled. ``gaps`` are the numbers missing
    between the least and the greatest turn. The digest is that of the repaired
    ``role:text`` lines. Repeated rows are duplicates; texts may be of any
    length; an empty table gives no rows; other columns are not looked at.
    """
    rows, kind = _prepared(turns, conv, turn, role, text)

    def each(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return

        def lines():
            digest = sums = audit = None
            for what, key, *rest in _rendered(_chain(first, batches)):
                if what == "plan":
                    (sums, audit), digest, begun = rest, hashlib.sha256(), False
                elif what == "turn":
                    digest.update((b"\n" if begun else b"") + f"{rest[1]}:{rest[2]}".encode())
                    begun = True
                else:
                    yield key[0], rest[0], *[sums[c] for c in (*_COUNTS, "cost")], audit, digest.hexdigest()

        yield from _written(first.schema.field("conv").type.field(0).type, lines(),
                            [(c, pa.int64()) for c in ("gaps", *_COUNTS, "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())])

    out = _streamed(rows).mapInArrow(each, f"conv {kind}, gaps long, blank long, duplicate long, truncated long, "
                                           "illegal long, cost long, audit string, repaired_sha256 string")
    return out.withColumnRenamed("conv", conv)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, by the crc32 of ``conv_id:turn`` (nulls are one space): one in twenty dropped, emptied,
    without ends of sentences, repeated, or of role user."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    chance = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    text = F.when(chance == 1, F.lit("")).when(chance == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text"))
    copies = F.when(chance == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.where(chance != 0).select(
        "conv_id", "turn", F.when(chance == 4, F.lit("user")).otherwise(one("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of every conversation after planted damage."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report = repair_report(damaged(turns))
    every = turns.select("conv_id").distinct()
    found = report.withColumnRenamed("conv_id", "id")
    zeros = {c: 0 for c in ("gaps", *_COUNTS, "cost")} | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").drop("id").fillna(zeros)


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLE: dict[str, str] = {}
