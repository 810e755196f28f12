"""Relational metadata: documents with authors, tags, history and metrics, as tables.

Tables are DataFrames; a change makes new frames (``upsert``, ``delete``), which
``save_tables`` writes as a new version beside the old one.  A store on disk
(``open_store``) keeps each table in buckets of the document id, so a change
writes the buckets of its documents only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.operators import buckets

TABLES = ("documents", "authors", "tags", "processing_history", "quality_metrics")
SCHEMAS = {
    "documents": "doc_id string, title string, doc_type string, file_path string, file_size long, total_pages int, total_chunks int, creation_date string, last_modified string, processed_at timestamp, extraction_method string, language string, version string, metadata_json string, quality_score double, processing_time double",
    "authors": "doc_id string, author_name string",
    "tags": "doc_id string, tag_name string",
    "processing_history": "doc_id string, processed_at timestamp, processing_version string, chunks_created int, quality_score double, processing_time double, notes string",
    "quality_metrics": "doc_id string, metric_name string, metric_value double, measured_at timestamp",
}

SCHEMA_COLUMNS = {name: [c.split()[0] for c in schema.split(", ")] for name, schema in SCHEMAS.items()}


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {t: spark.createDataFrame([], SCHEMAS[t]) for t in TABLES}


def save_tables(tables: Mapping[str, DataFrame], folder: str, version: int) -> str:
    path = f"{folder}/v{version:08d}"
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    return path


def load_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {t: spark.read.schema(SCHEMAS[t]).parquet(f"{path}/{t}") for t in TABLES}


def open_store(spark: SparkSession, folder: str, count: int = 64) -> dict[str, DataFrame]:
    """The tables of the store at ``folder``; a table that is not there yet is made, empty, in ``count`` buckets."""
    for name, empty in empty_tables(spark).items():
        if not buckets.is_table(spark, f"{folder}/{name}"):
            buckets.create(empty, f"{folder}/{name}", "doc_id", count)
    return {name: buckets.read(spark, f"{folder}/{name}") for name in TABLES}


def store_on_disk(spark: SparkSession, new: Mapping[str, DataFrame], folder: str) -> None:
    """``store`` for an opened store: documents, authors, tags and metrics replaced by key, history appended."""
    replaced = new.get("documents")
    for name in TABLES:
        path = f"{folder}/{name}"
        rows = new.get(name)
        if name == "processing_history":
            if rows is not None:
                buckets.append(rows, path)
        elif rows is not None:
            keys = rows.select("doc_id") if replaced is None else rows.select("doc_id").unionByName(replaced.select("doc_id"))
            buckets.upsert(rows.select(*SCHEMA_COLUMNS[name]), path, keys)
        elif replaced is not None and name in ("authors", "tags"):
            buckets.delete(replaced.select("doc_id"), path)


def delete_on_disk(keys: DataFrame, folder: str) -> None:
    """Take documents out of all tables of an opened store."""
    for name in TABLES:
        buckets.delete(keys.select("doc_id"), f"{folder}/{name}")


def document_on_disk(spark: SparkSession, folder: str, doc_id: str) -> DataFrame:
    """One document with its authors and tags; one bucket of each table is read."""
    one = lambda name: buckets.lookup(spark, f"{folder}/{name}", doc_id)
    return with_children(one("documents"), one("authors"), one("tags"))


def upsert(old: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """``old`` with all rows of each key in ``new`` replaced by those of ``new``."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def delete(old: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    return old.join(keys.select(key).distinct(), key, "left_anti").select(*old.columns)


def store(tables: Mapping[str, DataFrame], new: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Documents, authors, tags and metrics replaced by key; history appended."""
    out = dict(tables)
    for name, df in new.items():
        out[name] = out[name].unionByName(df) if name == "processing_history" else upsert(out[name], df)
    if "documents" in new:  # a document without authors or tags now has none
        for name in ("authors", "tags"):
            if name not in new:
                out[name] = delete(out[name], new["documents"])
    return out


def delete_document(tables: Mapping[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    return {name: delete(df, keys) for name, df in tables.items()}


def retain(df: DataFrame, column: str, as_of, days: int = 365) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return df.where(F.col(column) >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def with_children(documents: DataFrame, authors: DataFrame, tags: DataFrame) -> DataFrame:
    """Documents with sorted arrays of authors and tags; children are gathered before the join."""
    a = authors.groupBy("doc_id").agg(F.array_sort(F.collect_set("author_name")).alias("authors"))
    t = tags.groupBy("doc_id").agg(F.array_sort(F.collect_set("tag_name")).alias("tags"))
    none = F.array().cast("array<string>")
    return documents.join(a, "doc_id", "left").join(t, "doc_id", "left").withColumns({"authors": F.coalesce("authors", none), "tags": F.coalesce("tags", none)})


def matching(documents: DataFrame, authors: DataFrame, tags: DataFrame, *, doc_type=None, title_contains=None, language=None, min_quality_score=None, processed_after=None, author=None, tag=None) -> DataFrame:
    """Documents that meet all filters given.  Text filters are LIKE patterns without regard to case."""
    out = documents
    for column, value in (("doc_type", doc_type), ("language", language)):
        if value is not None:
            out = out.where(F.col(column) == value)
    if title_contains is not None:
        out = out.where(F.col("title").ilike(f"%{title_contains}%"))
    if min_quality_score is not None:
        out = out.where(F.col("quality_score") >= min_quality_score)
    if processed_after is not None:
        out = out.where(F.col("processed_at") >= F.lit(processed_after).cast("timestamp"))
    if author is not None:
        out = out.join(authors.where(F.col("author_name").ilike(f"%{author}%")), "doc_id", "left_semi")
    if tag is not None:
        out = out.join(tags.where(F.col("tag_name").ilike(f"%{tag}%")), "doc_id", "left_semi")
    return out


def search(documents: DataFrame, authors: DataFrame, tags: DataFrame, limit: int = 100, offset: int = 0, **filters) -> DataFrame:
    """A page of matching documents, latest first, with their authors and tags."""
    page = matching(documents, authors, tags, **filters).orderBy(F.desc("processed_at"), "doc_id").offset(offset).limit(limit)
    ids = page.select("doc_id")
    return with_children(page, authors.join(ids, "doc_id", "left_semi"), tags.join(ids, "doc_id", "left_semi"))


def counts(df: DataFrame, column: str) -> DataFrame:
    """Rows by value, without null and empty ones."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def spread(df: DataFrame, column: str) -> DataFrame:
    """Mean, least and greatest of the positive values; no row without any."""
    out = df.where(F.col(column) > 0).agg(F.avg(column).alias("avg_value"), F.min(column).alias("min_value"), F.max(column).alias("max_value"))
    return out.where("avg_value is not null")


def activity(df: DataFrame, days: int = 30) -> DataFrame:
    """Documents by day for the latest days."""
    return df.groupBy(F.to_date("processed_at").alias("day")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("day")).limit(days)


def most_frequent(df: DataFrame, column: str, most: int) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(most)
