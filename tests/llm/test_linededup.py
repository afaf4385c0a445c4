"""Line dedup against a plain search for the longest earlier run at each line."""

import random

from emberwall.llm.linededup import dedup_lines, without_repeated_lines

SCHEMA = "doc_id long, text string, line_dedup_note string, h1 int"


def brute(rows, min_words):
    """Lines removed of each row, in the order of the rows given (ids distinct)."""
    docs = [(t or "").split("\n") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    at = [(i, p) for i in order for p in range(len(docs[i]))]
    gone = {i: set() for i in order}
    starts = {}
    for n, (i, p) in enumerate(at):
        best = 0
        for j, q in starts.get(docs[i][p], ()):
            k = 0
            while p + k < len(docs[i]) and q + k < len(docs[j]) and docs[i][p + k] == docs[j][q + k]:
                k += 1
            best = max(best, k)
        if sum(len(x.split()) for x in docs[i][p:p + best]) >= min_words:
            gone[i].update(range(p, p + best))
        starts.setdefault(docs[i][p], []).append((i, p))
    return [sorted(gone[i]) for i in range(len(rows))]


def got(spark, rows, min_words):
    df = dedup_lines(spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA).repartition(3), min_words)
    assert df.columns == ["doc_id", "text", "line_dedup_note", "h1", "line_dedup"]
    out = {}
    for r in df.collect():
        lost = [x for s in r.line_dedup.removed for x in range(s.start, s.end)]
        lines = (r.text or "").split("\n")
        assert r.line_dedup.n_lines == len(lines) and r.line_dedup.n_removed == len(lost)
        left = "\n".join(x for i, x in enumerate(lines) if i not in set(lost))
        assert (r.line_dedup.text or "") == left
        out[r.doc_id] = lost
    return [out[d] for d, _ in rows]


def test_runs_of_every_length(spark):
    rng = random.Random(6)
    lines = ["a", "b c", "d e f", "g", "h i j k l m", ""]
    rows = [(i * 37 % 101, "\n".join(rng.choices(lines, k=rng.randrange(1, 14)))) for i in range(60)]
    shared = rng.choices(lines, k=25)
    rows += [(200 + i, "\n".join(rng.choices(lines, k=2) + shared[i:] + rng.choices(lines, k=2))) for i in range(8)]
    rows += [(300, rows[0][1]), (301, rows[0][1])]
    for min_words in (1, 6):
        assert got(spark, rows, min_words) == brute(rows, min_words)


def test_shorter_match_behind_a_deeper_one(spark):
    # the second and third share three lines, the first only two with each: all later copies go
    rows = [(1, "a a\nb b\nx"), (2, "a a\nb b\nc c"), (3, "q\na a\nb b\nc c")]
    assert got(spark, rows, 3) == brute(rows, 3) == [[], [0, 1], [1, 2, 3]]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "one two " * 30_000), (5, "one two " * 30_000), (6, "x\n" * 500)]
    assert got(spark, rows, 10) == brute(rows, 10)
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup_lines(empty).count() == 0
    same = spark.createDataFrame([(7, "a b c", "n", 1)] * 3 + [(None, "a b c", "n", 1), (8, None, "n", 1)], SCHEMA)
    assert sorted(r.line_dedup.n_removed for r in dedup_lines(same, 2).collect()) == [0, 0, 1, 1, 1]
    kept = without_repeated_lines(same, 2)
    assert kept.columns == same.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["7", "8"]
