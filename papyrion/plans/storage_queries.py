"""Queries of stores and indexes on disk, made from the given tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrion.operators import buckets, vector, vector_index
from papyrion.plans import table_queries  # noqa: F401  (its SQL is that of the queries here)
from papyrion.plans.inputs import LISTING, REGISTRY, STATE, frame
from papyrion.plans.registry import ORACLES, query, table
from papyrion.session import scratch_folder
from papyrion.streaming import changes


def _index(spark, folder):
    path = scratch_folder(spark, "vectors")
    rows = table(spark, folder, "embeddings")
    vector_index.build(rows, path)
    return path, rows, rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query("knn_index", ORACLES["knn"])
def _knn_index(spark, folder):
    """The exact neighbours, by way of the index."""
    path, _, queries = _index(spark, folder)
    found = vector_index.search(spark, path, queries, exact=True)
    return found.select("query_id", "vec_id", F.round("distance", 6).alias("distance"), "place")


@query("knn_index_recall", "SELECT count(*) AS queries, true AS recall_reached FROM embeddings WHERE vec_id % 50 = 0")
def _knn_index_recall(spark, folder):
    """Whether the nearest lists alone hold 95 percent of the neighbours that a search through all rows finds."""
    path, rows, queries = _index(spark, folder)
    want = vector.nearest_batch(rows, queries).select("query_id", "vec_id")
    found = want.join(vector_index.search(spark, path, queries).select("query_id", "vec_id").withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left")
    return found.agg(F.countDistinct("query_id").alias("queries"), (F.count("hit") >= 0.95 * F.count(F.lit(1))).alias("recall_reached"))


@query("meta_upsert_store", ORACLES["meta_upsert"])
def _meta_upsert_store(spark, folder):
    """The upsert of ``meta_upsert``, on a table in buckets."""
    path, docs = scratch_folder(spark, "registry"), frame(spark, folder, REGISTRY)
    buckets.create(docs, path, "doc_id", 16)
    buckets.upsert(docs.where("doc_id % 10 = 0").withColumns({"doc_id": F.col("doc_id") + 1000, "quality_score": F.col("quality_score") + 1}), path)
    return buckets.read(spark, path).select("doc_id", "title", F.round("quality_score", 6).alias("quality_score"))


@query("inc_plan_stream", ORACLES["inc_plan"])
def _inc_plan_stream(spark, folder):
    """The plan of ``inc_plan`` as a stream: the state's files are a first scan, the listing is a second one."""
    path = scratch_folder(spark, "scans")
    for i, files in enumerate((STATE, LISTING), 1):
        changes.add_scan(frame(spark, folder, files), f"{path}/scans", f"2024-01-0{i} 00:00:00")
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
    changes.follow(spark, f"{path}/scans", f"{path}/checkpoint", write).awaitTermination()
    found = spark.read.parquet(f"{path}/changes")
    return found.where("scan = timestamp '2024-01-02 00:00:00'").select("file_key", "status")
