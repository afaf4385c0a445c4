"""Every registered query against its DuckDB oracle (sf0.01), as the driver checks."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF01

KEYS = sorted(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(cols, rows):
    return sorted(repr(tuple(_norm(x) for x in r)) for r in rows)


@pytest.fixture(scope="module")
def oracle_con():
    import duckdb

    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, oracle_con, key):
    df = E.queries()[key](spark, SF01)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = oracle_con.sql(E.oracle_sql()[key])
    dcols = sorted(rel.columns)
    drows = [tuple(r[rel.columns.index(c)] for c in dcols) for r in rel.fetchall()]
    assert cols == dcols
    assert len(srows) == len(drows)
    assert _rows(cols, srows) == _rows(dcols, drows)


def test_every_key_without_oracle_runs(spark):
    for key in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[key](spark, SF01).count() >= 1, key


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["log_type", "severity", "count"]
    assert df.count() > 0
