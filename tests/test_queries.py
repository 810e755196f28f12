"""Every query with SQL against that SQL, on the smallest tables."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from papyrion.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def plain(rows, columns):
    frame = pd.DataFrame(rows, columns=columns, dtype=object)[sorted(columns)]
    text = lambda v: "" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql(spark, name):
    """These have tests of their own: graph_clusters and extract_pages in test_operators, topics below."""
    rows = catalog.QUERIES[name](spark, FOLDER)
    assert rows.count() > 0 and rows.count() == rows.dropDuplicates().count()


def test_topics_hold_every_document(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    topics = catalog.QUERIES["tfidf_kmeans"](spark, FOLDER).collect()
    assert sum(r["documents"] for r in topics) == docs.where(r"text rlike '\\S'").count()
    assert all(len(r["top_terms"].split(",")) <= 10 for r in topics) and len(topics) <= 20


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
