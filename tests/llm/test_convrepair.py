"""Conversation repair against a plain search of all edits."""

import hashlib
import random
import zlib

import pytest

from conftest import SF01
from emberwall.llm import convrepair as C

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(turns):
    """(cost, audit) by keeping every cheapest string of edits at each turn and state."""
    best = {"": (0, {""})}

    def relax(table, state, cost, audits):
        old = table.get(state)
        if old is None or cost < old[0]:
            table[state] = (cost, set(audits))
        elif cost == old[0]:
            old[1].update(audits)

    def inserted(table):
        for _ in range(4):
            for state, (cost, audits) in list(table.items()):
                for c in "ua":
                    if (state, c) in NEXT:
                        relax(table, NEXT[state, c], cost + 3, {a + "I" for a in audits})
        return table

    for initial, fault in turns:
        after = {}
        for state, (cost, audits) in inserted(best).items():
            relax(after, state, cost + 4, {a + "D" for a in audits})
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            if (state, initial) in NEXT:
                relax(after, NEXT[state, initial], cost + extra, {a + "K" for a in audits})
            for c in "ua":
                if (state, c) in NEXT:
                    relax(after, NEXT[state, c], cost + 3 + extra, {a + "R" for a in audits})
        best = after
    done = [(best[s][0], min(best[s][1])) for s in inserted(best) if s in ("", "a")]
    return min(done)


def plain(rows):
    """Report by conversation of (conv, turn, role, text) rows."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))
        seen, symbols, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not shown else "duplicate" if (role, text) in seen else
                     "" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
            symbols.append((role[:1], fault))
            if fault:
                counts[fault] += 1
        cost, audit = cheapest(symbols)
        at, state, lines = 0, "", []
        for edit in audit:
            if edit != "I":
                _, role, text = turns[at]
                at += 1
            if edit == "D":
                continue
            if edit in "IR":
                role = "assistant" if state == "u" else "user"
            text = "" if edit == "I" else text
            state = NEXT[state, role[0]]
            lines.append(f"{role}:{text}")
        numbers = {t for t, _, _ in turns if t is not None}
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *counts.values(),
                     sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(symbols, symbols[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def hurt(rows):
    for conv, turn, role, text in rows:
        chance = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if chance == 0:
            continue
        text = "" if chance == 1 else "".join(c for c in text if c not in ".!?") if chance == 2 else text
        for _ in range(2 if chance == 3 else 1):
            yield conv, turn, "user" if chance == 4 else role, text


NAMES = "conv_id long, turn long, role string, text string"
ODD = [
    (None, 0, "user", "a."), (None, 1, "assistant", "b."), (-1, None, None, None), (-1, None, "user", "x"),
    (-2, 5, "tool", "t."), (-2, 9, "", "u."), (-2, 9, "", "u."), (-3, 1, "system", "s."), (-3, 2, "system", "t."),
    (-3, 3, "user", " \t "), (-4, 0, "user", "long. " * 50_000), (-4, 1, "assistant", "say." * 50_000 + "?"),
    (-5, 1, "user", "same"), (-5, 2, "user", "same"), (-5, 2, "assistant", "same"), (-6, 3, "unicorn", "ok!"),
]


@pytest.fixture(params=[C.SEGMENT, 3])
def segment(request, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", request.param)


def test_query(spark, segment, tmp_path):
    given = spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text")
    many = [(-100 - n // 40, n % 40, random.Random(n).choice(["user", "assistant", "system", "tool"]),
             random.Random(-n).choice(["one.", "two.", "three", ""]) + str(n % 7) * (n % 3) + "." * (n % 2)) for n in range(80)]
    rows = [tuple(r) for r in given.collect()] + ODD + many
    folder = str(tmp_path)
    spark.createDataFrame(rows, NAMES).write.parquet(f"{folder}/conversations.parquet")
    got = reported(C.op12_conversation_repair(spark, folder))
    want = plain(hurt(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got == {conv: want.get(conv, nothing) for conv, *_ in rows}


def test_all_short_conversations(spark):
    """Every role and fault up to three turns, both ways of reading the grammar."""
    texts = {"": "fine.", "blank": " ", "truncated": "and"}
    import itertools

    rows, n = [], 0
    for size in (1, 2, 3):
        for combo in itertools.product(itertools.product(("system", "user", "assistant", "x"), texts), repeat=size):
            n += 1
            rows += [(n, at, role, texts[f] + ("" if f == "blank" else f" {at}" + "." * (f == ""))) for at, (role, f) in enumerate(combo)]
    got = reported(C.repair_report(spark.createDataFrame(rows, NAMES)))
    assert got == plain(rows)


def test_turns_fit_the_pattern_and_give_the_digest(spark):
    import re

    rows = ODD + [(7, 0, "user", "q?"), (7, 1, "user", "r?"), (7, 2, "assistant", "b.")]
    df = spark.createDataFrame(rows, NAMES)
    report, turns = reported(C.repair_report(df)), {}
    for r in C.repaired_turns(df).orderBy("conv_id", "at").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv, digest in ((c, v[-1]) for c, v in report.items()):
        lines = turns.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in lines))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest() == digest


def test_grammar_does_not_change_products():
    sequences = ["".join(chr(C._FIRST + random.Random(s * 100 + i).randrange(16)) for i in range(60)) for s in range(20)]
    pairs = [sequences[0][0:2], sequences[0][2:4], chr(C._RULE) + chr(C._RULE + 1)]
    bare, ruled = C.Grammar([]), C.Grammar(pairs)
    assert ruled.packed(sequences[0])[0] == chr(C._RULE + 2)
    (c1, _, a1), (c2, _, a2) = bare.folded(sequences), ruled.folded(sequences)
    assert (c1 == c2).all()
    for n in range(20):
        for i in range(4):
            for j in range(4):
                if c1[n, i, j] < C._INF:
                    assert a1(n, i, j) == a2(n, i, j)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], NAMES)
    assert C.repair_report(empty).count() == 0 and C.repaired_turns(empty).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "a.", "x", 5)], NAMES + ", conv string, place long")
    assert reported(C.repair_report(df))[1][5:7] == (3, "KI")
