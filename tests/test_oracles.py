"""Each core query against its SQL on the smallest tables."""

from __future__ import annotations

import decimal
import os
from pathlib import Path

import pytest

from lessonlake.plans.registry import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    return round(v, 9) if isinstance(v, float) else float(v) if isinstance(v, decimal.Decimal) else v


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    q = db.execute(ORACLES[name])
    names = [x[0] for x in q.description]
    assert sorted(names) == cols
    assert got == sorted(repr([plain(r[names.index(c)]) for c in cols]) for r in q.fetchall())
