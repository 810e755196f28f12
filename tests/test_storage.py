"""Bucket tables and the vector index: what is written, what is read, and the results."""

import pytest
from pyspark.sql import functions as F

from papyrion.operators import buckets, vector, vector_index
from papyrion.operators.vector_index import IndexConfig


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("part-*.parquet")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_upsert_of_one_key_leaves_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).selectExpr("cast(id % 50 as int) as doc_id", "cast(id as string) as v")
    buckets.create(rows, path, "doc_id", 8)
    before = files_of(tmp_path / "t")
    new = spark.createDataFrame([(7, "new"), (None, "no key")], "doc_id int, v string")
    buckets.upsert(new.where("doc_id = 7"), path)
    after = files_of(tmp_path / "t")
    changed = {f.split("/")[0] for f in before.items() ^ after.items() for f in [f[0]]}
    assert len(changed) == 1 and len({f.split("/")[0] for f in before}) == 8
    got = {tuple(r) for r in buckets.read(spark, path).collect()}
    assert got == {(i % 50, str(i)) for i in range(200) if i % 50 != 7} | {(7, "new")}
    found = buckets.lookup(spark, path, 7, 8)
    assert {tuple(r) for r in found.collect()} == {t for t in got if t[0] in (7, 8)}
    assert "PartitionFilters: [bucket" in plan_of(found)
    buckets.upsert(new.where("doc_id is null"), path)
    buckets.append(new.where("doc_id = 7"), path)
    assert buckets.read(spark, path).count() == len(got) + 2


def test_deletes_and_emptied_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, i) for i in range(6)], "k long, bucket_no long")
    buckets.create(rows, path, "k", 64)
    buckets.delete(spark.createDataFrame([(i,) for i in (0, 1, 2, 99)], "k long"), path)
    assert sorted(r["k"] for r in buckets.read(spark, path).collect()) == [3, 4, 5]
    buckets.delete(rows, path)
    assert buckets.read(spark, path).count() == 0
    buckets.upsert(rows.where("k < 2"), path, rows)
    assert buckets.read(spark, path).count() == 2
    with pytest.raises(FileNotFoundError):
        buckets.read(spark, str(tmp_path / "none"))


def test_a_change_that_fails_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.create(spark.range(20).toDF("k"), path, "k", 4)
    with pytest.raises(Exception, match="killed"):
        buckets.upsert(spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("k")), path, spark.range(3).toDF("k"))
    assert buckets.read(spark, path).count() == 20


def vectors_of(spark, n=400, dim=6):
    x = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: (F.pmod(F.xxhash64(F.col("id"), i), F.lit(1000)) / 500 - 1).cast("float"))
    return spark.range(n).select(F.col("id").alias("vec_id"), x.alias("embedding"), F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("document_type"))


def pairs(df):
    return {(r["query_id"], r["vec_id"], r["place"]) for r in df.collect()}


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
def test_index_finds_what_a_full_search_finds(spark, tmp_path, metric):
    path, config = str(tmp_path / "ivf"), IndexConfig(lists=12, metric=metric)
    rows = vectors_of(spark)
    vector_index.build(rows.unionByName(spark.createDataFrame([(9999, None, "t0")], "vec_id long, embedding array<float>, document_type string")), path, config)
    queries = rows.where("vec_id % 25 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    want = pairs(vector.nearest_batch(rows, queries, metric=metric))
    exact = vector_index.search(spark, path, queries, probes=3, exact=True, config=config)
    assert pairs(exact) == want
    most = pairs(vector_index.search(spark, path, queries, probes=12, config=config))
    assert most == want
    some = pairs(vector_index.search(spark, path, queries, probes=6, config=config))
    assert len({p[:2] for p in some} & {p[:2] for p in want}) >= 0.8 * len(want)
    one = vector_index.search(spark, path, queries.limit(1), probes=2, config=config)
    assert "PartitionFilters: [list" in plan_of(one)
    only = rows.where("document_type = 't1'")
    got = vector_index.search(spark, path, queries, n=3, probes=1, exact=True, filters={"document_type": "t1"}, config=config)
    assert pairs(got) == pairs(vector.nearest_batch(only, queries, n=3, metric=metric))


def test_rows_come_and_go(spark, tmp_path):
    path, config = str(tmp_path / "ivf"), IndexConfig(lists=6)
    rows = vectors_of(spark, 200)
    vector_index.build(rows.where("vec_id < 150"), path, config)
    before = files_of(tmp_path / "ivf" / "data")
    vector_index.add(rows.where("vec_id >= 150"), path, config)
    assert before.items() <= files_of(tmp_path / "ivf" / "data").items()
    gone = rows.where("vec_id in (3, 170)").select("vec_id")
    vector_index.remove(gone, path)
    vector_index.remove(gone, path)
    queries = rows.where("vec_id < 10").select(F.col("vec_id").alias("query_id"), "embedding")
    left = rows.where("vec_id not in (3, 170)")
    assert pairs(vector_index.search(spark, path, queries, exact=True, probes=1, config=config)) == pairs(vector.nearest_batch(left, queries))


def test_empty_index_and_equal_vectors(spark, tmp_path):
    rows = vectors_of(spark, 5)
    vector_index.build(rows.limit(0), str(tmp_path / "none"))
    queries = rows.select(F.col("vec_id").alias("query_id"), "embedding")
    assert vector_index.search(spark, str(tmp_path / "none"), queries, exact=True).count() == 0
    same = spark.range(90).select(F.col("id").alias("vec_id"), F.expr("array(1f, 0f)").alias("embedding"))  # one list holds all
    vector_index.build(same, str(tmp_path / "same"))
    got = vector_index.search(spark, str(tmp_path / "same"), spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>"), exact=True)
    assert [r["vec_id"] for r in got.orderBy("place").collect()] == [0, 1, 2, 3, 4]
