"""Chunk vectors: nearest neighbours with filters, and the flat rows that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.operators import buckets
from papyrion.operators import nearest as nearest_groups
from papyrion.sources import shared

FILTERS = ("document_id", "document_type", "chunk_type", "semantic_role")


def squared_distance(a: Column, b: Column) -> Column:
    parts = F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.aggregate(parts, F.lit(0.0), lambda t, x: t + x)


def cosine_distance(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda t, v: t + v)
    return 1 - F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


METRICS = {"l2sq": squared_distance, "cosine": cosine_distance}


def filtered(chunks: DataFrame, filters: dict[str, str] | None) -> DataFrame:
    """Equality filters; keys other than the known ones are ignored."""
    for key, value in (filters or {}).items():
        if key in FILTERS:
            chunks = chunks.where(F.col(key) == value)
    return chunks


def nearest(vectors: DataFrame, query: list[float], n: int = 5, metric: str = "l2sq", filters: dict[str, str] | None = None) -> DataFrame:
    """The ``n`` nearest rows to one query vector, which is a literal in the plan: no join, one top-n."""
    distance = METRICS[metric](F.col("embedding"), F.array(*(F.lit(float(x)) for x in query)))
    return filtered(vectors, filters).withColumn("distance", distance).orderBy("distance", "vec_id").limit(n)


def _compared(pairs: DataFrame, metric: str) -> DataFrame:
    return pairs.select("query_id", "vec_id", METRICS[metric](F.col("embedding"), F.col("q")).alias("distance"))


def nearest_batch(vectors: DataFrame, queries: DataFrame, n: int = 5, metric: str = "l2sq", block_rows: int = nearest_groups.GROUP_QUERIES) -> DataFrame:
    """(query_id, vec_id, distance, place): the ``n`` nearest of each stated query, over all vectors.

    Vectors and queries (in groups of about ``block_rows``) meet in groups of
    bounded size, each of which gives its n best for each query (``nearest``).
    Pairs with a vector that has a null, an infinite component or another number
    of components go by the column expression; those without a distance come last.
    """
    total, width = queries.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    asked, width = queries.select("query_id", F.col("embedding").alias("q")), width or 0
    rows = vectors.select("vec_id", "embedding")
    spark = vectors.sparkSession
    odd = lambda c: ~nearest_groups.regular(F.col(c), width, metric)
    count, odd_rows = rows.agg(F.count(F.lit(1)), F.count_if(odd("embedding"))).first()
    listed = rows.withColumn("list", F.lit(0))
    found = nearest_groups.among(listed, asked.withColumn("lists", F.array(F.lit(0))), n, metric, width, nearest_groups.groups(spark, count, nearest_groups.GROUP_ROWS), max(1, -(-total // block_rows)))
    # a product of tables is slow even where a side is empty
    if odd_rows:
        found = found.unionByName(_compared(rows.where(odd("embedding")).crossJoin(asked), metric))
    if not asked.where(odd("q")).isEmpty():
        found = found.unionByName(_compared(rows.where(~odd("embedding")).crossJoin(asked.where(odd("q"))), metric))
    w = Window.partitionBy("query_id").orderBy(F.col("distance").asc_nulls_last(), "vec_id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def flat_metadata(chunks: DataFrame) -> DataFrame:
    """The flat projection of enriched chunks that is stored beside a vector."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return chunks.select(
        "chunk_id", F.col("doc_id").alias("document_id"), text("title").alias("document_title"), text("doc_type").alias("document_type"), "chunk_type", "semantic_role",
        text("chapter").alias("chapter"), text("section").alias("section"), F.array_join("key_concepts", ",").alias("key_concepts"), F.array_join("prerequisites", ",").alias("prerequisites"),
        "position", "token_count", "extraction_confidence",
    )


def with_embedding(rows: DataFrame, dim: int = 64, text_col: str = "content") -> DataFrame:
    """Rows with an ``embedding``: their own, or that of ``hashed_embedding`` where they have none."""
    if "embedding" not in rows.columns:
        return hashed_embedding(rows, dim, text_col)
    given = rows.withColumnRenamed("embedding", "_given")
    return hashed_embedding(given, dim, text_col).withColumn("embedding", F.coalesce("_given", "embedding")).drop("_given")


def _key_of(rows: DataFrame, key: str | None) -> str:
    return key or ("document_id" if "document_id" in rows.columns else "chunk_id")


def write_vectors(rows: DataFrame, path: str, text_col: str = "content", key: str | None = None) -> None:
    """Put rows into the store at ``path``, in place of all rows of the same documents (or chunks, without ``document_id``) that it has."""
    rows, key = with_embedding(rows, text_col=text_col), _key_of(rows, key)
    if buckets.is_table(rows.sparkSession, path):
        buckets.upsert(rows, path)
    else:
        buckets.create(rows, path, key)


def reset(rows: DataFrame, path: str, key: str | None = None) -> None:
    """Drop the store at ``path`` and begin an empty one with the columns of ``rows``."""
    shared.delete(rows.sparkSession, path)
    buckets.create(rows.limit(0), path, _key_of(rows, key))


def chunk_by_id(chunks: DataFrame, chunk_id: str) -> DataFrame:
    """The chunk with that id, or no row."""
    return chunks.where(F.col("chunk_id") == chunk_id)


def statistics(chunks: DataFrame) -> DataFrame:
    """Chunks by document_type and by chunk_type, with totals, in one pass."""
    known = chunks.select(F.coalesce("document_type", F.lit("unknown")).alias("document_type"), F.coalesce("chunk_type", F.lit("unknown")).alias("chunk_type"))
    return known.groupingSets([["document_type"], ["chunk_type"], []], "document_type", "chunk_type").agg(F.count(F.lit(1)).alias("n"))


def hashed_embedding(docs: DataFrame, dim: int = 64, text_col: str = "content") -> DataFrame:
    """Adds ``embedding``: counts of hashed words, of unit length; a text without words is all zeros."""
    from papyrion.functions import text as T

    w = F.transform(T.words(F.lower(text_col)), lambda x: F.pmod(F.xxhash64(x), F.lit(dim)))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.size(F.filter("_w", lambda x: x == i)).cast("double"))
    norm = F.sqrt(F.aggregate("_c", F.lit(0.0), lambda t, x: t + x * x))
    out = docs.withColumn("_w", w).withColumn("_c", counts).withColumn("_n", norm)
    return out.withColumn("embedding", F.transform("_c", lambda x: F.when(F.col("_n") > 0, x / F.col("_n")).otherwise(0.0).cast("float"))).drop("_w", "_c", "_n")
