"""The near-dedup stage of the pipeline links pairs from a similarity of 0.80, not from op2's 0.85."""

import corpus_pipeline as p

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def similarity(a, b):
    x, y = ({tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_pairs_from_080_to_085_go(spark):
    rows, expected = [], set()
    for k, shared in enumerate((150, 170, 175, 176, 178, 182, 186)):
        # 200 shingles in the first text; the second shares its first `shared` and has others after them
        words = [f"d{k}w{i}" for i in range(204)]
        first, second = " ".join(words), " ".join(words[:shared + 4] + [f"d{k}x{i}" for i in range(20)])
        rows += [(2 * k, first, "en", "s", len(first)), (2 * k + 1, second, "en", "s", len(second))]
        expected |= {2 * k} | ({2 * k + 1} if similarity(first, second) < 0.8 else set())
    near = [similarity(rows[i][1], rows[i + 1][1]) for i in range(0, len(rows), 2)]
    assert sum(0.8 <= x < 0.85 for x in near) >= 3 and any(x < 0.8 for x in near)
    out = p.dedup_near(spark, spark.createDataFrame(rows, SCHEMA), "/root/testdata/sf0.001")
    assert {r.doc_id for r in out.collect()} == expected
