"""The registered queries of this subpackage that have SQL, against that SQL."""

import os

import pytest

from papyrion.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    want = c.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    rows = lambda names, found: sorted([tuple("" if v is None else str(v) for _, v in sorted(zip(names, r))) for r in found])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())
