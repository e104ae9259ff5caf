"""Every exact registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as se

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


EXACT = sorted(se.oracle_sql())


def test_every_query_registered():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert len(se.queries()) >= 70


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["endpoint", "n"]
    assert df.count() > 0


@pytest.mark.parametrize("name", EXACT)
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    cols, srows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(dcols)
    assert _rows(cols, srows) == _rows(dcols, rel.fetchall())
