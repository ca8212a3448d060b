"""The llm queries that SQL can express against their SQL, on the smallest tables."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from lessonlake.llm.oracles import ORACLES
from lessonlake.llm.queries import QUERIES
from lessonlake.llm.tokens import TOKENIZER

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")


def plain(v):
    return round(float(v), 9) if isinstance(v, float) else v


@pytest.mark.skipif(not Path(DATA).exists() or not os.path.exists(TOKENIZER), reason="no test data or tokenizer files")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    df = QUERIES[name](spark, DATA)
    q = c.execute(ORACLES[name])
    names = [x[0] for x in q.description]
    cols = sorted(df.columns)
    assert sorted(names) == cols
    assert sorted(repr([plain(r[k]) for k in cols]) for r in df.collect()) == sorted(repr([plain(r[names.index(k)]) for k in cols]) for r in q.fetchall())
