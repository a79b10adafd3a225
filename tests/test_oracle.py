"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from voxmill.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return (None if math.isnan(v) else round(v, 6) + 0.0) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    answer = duck.execute(catalog.ORACLE[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in answer.fetchall()), key=repr)
    assert got == want
    assert got


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
