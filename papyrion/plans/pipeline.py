"""The whole run as one lazy plan: files to accepted chunks, metadata, vectors and a report.

    files -> plan of changes -> pages -> documents -> chunks -> context -> scores
          -> accepted and rejected documents -> tables

Everything is keyed by ``doc_id``, which is the file's name, so a changed file
replaces its own chunks.  Pages are read once; each table is written as a new
version.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.config import PipelineConfig
from papyrion.functions import metadata
from papyrion.functions import text as T
from papyrion.operators import buckets, chunk_classes, chunking, enrich, incremental, store, vector
from papyrion.session import saved, scratch_folder, set_checkpoint_folder
from papyrion.sources import files


@dataclass
class RunResult:
    documents: DataFrame
    chunks: DataFrame
    results: DataFrame
    tables: dict[str, DataFrame]
    vectors: DataFrame
    state: DataFrame
    report: DataFrame
    #: Rows of this run for each table, and the ids of documents whose files are gone.
    new: dict[str, DataFrame]
    gone: DataFrame


def document_metadata(pages: DataFrame) -> DataFrame:
    """Title, type, authors, dates, version, tags, language and structure of each document.

    Text fields look at the first three pages, structure at all of them.
    """
    head = pages.where("page_number <= 3").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_number", "content"))).alias("p"))
    head = head.select("doc_id", F.array_join(F.transform("p", lambda p: F.concat(p["content"], F.lit("\n"))), "").alias("content"))
    fields = {
        "title": metadata.title, "doc_type": metadata.document_type, "authors": metadata.authors, "creation_date": metadata.created_on, "last_modified": metadata.modified_on,
        "version": metadata.version, "tags": metadata.tags, "language": metadata.language,
    }
    described = head.select("doc_id", *(f("content").alias(n) for n, f in fields.items()))
    totals = pages.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("total_pages"), F.sum("char_count").alias("total_chars"), F.first("extraction_method").alias("extraction_method"), F.bool_or("extraction_failed").alias("extraction_failed"))
    return described.join(totals, "doc_id").join(metadata.structure_of(pages), "doc_id")


def joined_text(pages: DataFrame) -> DataFrame:
    """One text a document; pages are parted by a blank line."""
    gathered = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_number", "content"))).alias("p"))
    return gathered.select("doc_id", F.array_join("p.content", "\n\n").alias("content"))


def process_pages(pages: DataFrame, config: PipelineConfig = PipelineConfig()) -> tuple[DataFrame, DataFrame]:
    """(documents, scored chunks) of extracted pages."""
    documents = document_metadata(pages)
    chunks = chunking.chunk_pages(pages, joined_text(pages), config.chunking)
    described = documents.select("doc_id", "title", "doc_type", "total_pages")
    if not config.learned_types:
        return documents, enrich.validate_chunks(enrich.enrich_chunks(chunks, described))
    chunks = saved(chunks, "chunks")  # read to learn, and again to classify
    enriched = enrich.enrich_chunks(chunks, described)
    typed = chunk_classes.classify(enriched, chunk_classes.train(chunks))
    return documents, enrich.validate_chunks(typed.select(*enriched.columns))


def run(spark: SparkSession, folder: str, state: DataFrame | None = None, tables: dict[str, DataFrame] | None = None, config: PipelineConfig = PipelineConfig(), force_all: bool = False, materialize: bool = False) -> RunResult:
    """Plan, extract, chunk, enrich, validate and store what changed in ``folder``.

    A document fails if no backend could read it, or if its score is below the
    gate; failed files stay out of the state and come again at the next run.
    With ``materialize`` pages, documents and chunks are written to the shared
    folder once, instead of being made anew for each table that is used.
    """
    once = lambda df: df.checkpoint() if materialize else df
    if materialize:
        set_checkpoint_folder(spark)
    state = state if state is not None else spark.createDataFrame([], incremental.STATE)
    tables = tables if tables is not None else store.empty_tables(spark)
    extraction = config.extraction
    listed = files.text_listing(spark, folder, extraction.pattern) if extraction.in_parts else files.scan(spark, folder, extraction.pattern)
    planned = incremental.plan(listed.select("file_key", "hash"), state)
    chosen = listed if force_all else listed.join(incremental.to_process(planned), "file_key", "left_semi")
    if extraction.in_parts:
        pages = once(files.text_pages(spark, folder, extraction.pattern).join(chosen.select(F.col("file_key").alias("doc_id")), "doc_id", "left_semi"))
    else:
        pages = once(files.extract_pages(chosen, extraction.primary, extraction.fallback))
    documents, chunks = map(once, process_pages(pages, config))
    judged = documents.join(enrich.document_quality(chunks, config.min_quality_score), "doc_id", "left")
    ok = F.coalesce(F.col("accepted"), F.lit(False)) & ~F.col("extraction_failed")
    results = judged.withColumn("status", F.when(ok, "success").otherwise("failed")).withColumnsRenamed({"chunks": "chunks_created", "overall_score": "quality_score"})
    good = results.where("status = 'success'")
    kept = chunks.join(good.select("doc_id"), "doc_id", "left_semi")
    now = F.lit(config.as_of).cast("timestamp")
    sizes = chosen.select(F.col("file_key").alias("doc_id"), "path", "hash", "size", "modified")
    rows = good.join(sizes, "doc_id")
    none = F.lit(None).cast("string")
    new = {
        "documents": rows.select("doc_id", "title", "doc_type", F.col("path").alias("file_path"), F.col("size").alias("file_size"), "total_pages", F.col("chunks_created").cast("int").alias("total_chunks"), F.col("creation_date").cast("string").alias("creation_date"), F.col("last_modified").cast("string").alias("last_modified"),
                                 now.alias("processed_at"), "extraction_method", "language", "version", F.to_json(F.struct("chapter_count", "section_count", "estimated_reading_time")).alias("metadata_json"), "quality_score", F.lit(0.0).alias("processing_time")),
        "authors": good.select("doc_id", F.explode("authors").alias("author_name")),
        "tags": good.select("doc_id", F.explode("tags").alias("tag_name")),
        "processing_history": good.select("doc_id", now.alias("processed_at"), F.lit(config.version).alias("processing_version"), F.col("chunks_created").cast("int").alias("chunks_created"), "quality_score", F.lit(0.0).alias("processing_time"), none.alias("notes")),
        "quality_metrics": kept.select("doc_id", F.concat(F.lit("chunk_"), F.col("chunk_index").cast("string"), F.lit("_score")).alias("metric_name"), F.col("score").alias("metric_value"), now.alias("measured_at")),
    }
    gone = incremental.pending_deletions(planned, state.select("file_key").limit(0)).withColumnRenamed("file_key", "doc_id")
    stored = store.delete_document(store.store(tables, new), gone)
    done = rows.select(F.col("doc_id").alias("file_key"), "hash", "doc_id", now.alias("processed_at"), F.col("chunks_created").cast("int").alias("chunks_created"), F.lit(0.0).alias("processing_time"), "quality_score", F.col("size").alias("file_size"), F.col("modified").alias("file_modified"))
    vectors = vector.hashed_embedding(kept.select("doc_id", "chunk_id", "doc_type", "content"), config.embedding_dim)
    left = incremental.mark_processed(state, done).join(gone.select(F.col("doc_id").alias("file_key")), "file_key", "left_anti")
    return RunResult(documents, kept, results, stored, vectors, left.select(*state.columns), incremental.run_report(results), new, gone)


def _put(rows: DataFrame, path: str, keys: DataFrame, gone: DataFrame) -> None:
    """Rows of the documents ``keys`` into a bucket table in place of what it has of them and of ``gone``."""
    if not buckets.is_table(rows.sparkSession, path):
        buckets.create(rows.limit(0), path, "doc_id")
    buckets.upsert(rows, path, keys.select("doc_id").unionByName(gone.select("doc_id")))


def persist(done: RunResult, target: str, source: str) -> None:
    """Put a run's results into the store at ``target``: chunks, vectors, metadata tables, and the state of the folder ``source`` last.

    Only buckets of documents that the run processed or found deleted are
    written.  A run that is cut off leaves the state as it was, so its files come
    again and replace what it had written.
    """
    spark, keys = done.documents.sparkSession, done.new["documents"]
    _put(done.chunks, f"{target}/chunks", keys, done.gone)
    _put(done.vectors, f"{target}/vectors", keys, done.gone)
    store.open_store(spark, f"{target}/metadata")
    store.store_on_disk(spark, done.new, f"{target}/metadata")
    store.delete_on_disk(done.gone, f"{target}/metadata")
    folder = state_folder(target, source)
    incremental.save_state(done.state, incremental.load_state(spark, folder)[1], folder)


def state_folder(target: str, source: str) -> str:
    """Each folder of files has a state of its own, so the files of one are not missed in another."""
    return f"{target}/state/{hashlib.sha256(source.rstrip('/').encode()).hexdigest()[:16]}"


def load(spark: SparkSession, target: str) -> tuple[DataFrame | None, DataFrame | None, dict[str, DataFrame]]:
    """(chunks, vectors, metadata tables) of a store; chunks and vectors are None before the first run."""
    chunks, vectors = (buckets.read(spark, f"{target}/{n}") if buckets.is_table(spark, f"{target}/{n}") else None for n in ("chunks", "vectors"))
    return chunks, vectors, store.open_store(spark, f"{target}/metadata")


def run_into(spark: SparkSession, folder: str, target: str, config: PipelineConfig = PipelineConfig(), force_all: bool = False) -> DataFrame:
    """Process what changed in ``folder`` since its last run into the store at ``target``; the run's report."""
    state, _ = incremental.load_state(spark, state_folder(target, folder))
    done = run(spark, folder, state, load(spark, target)[2], config, force_all, materialize=True)
    report = done.report.checkpoint()
    persist(done, target, folder)
    return report


def run_batch(spark: SparkSession, batches: Sequence[tuple[str, Mapping]], target: str | None = None, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Several folders, each with fields of ``config`` to replace; (folder, status, files, chunk_count, store) of each.

    All go into the store at ``target``, by default a new one in the shared
    folder.  A batch that is repeated with its target processes what changed.
    """
    target = target or scratch_folder(spark, "batch")
    out = None
    for folder, override in batches:
        report = run_into(spark, folder, target, replace(config, **override))
        status = F.when(F.col("failed") == 0, "success").when(F.col("successful") == 0, "failed").otherwise("partial")
        row = report.select(F.lit(folder).alias("folder"), status.alias("status"), F.col("total_files_processed").alias("files"), F.col("total_chunks").alias("chunk_count"), F.lit(target).alias("store"))
        out = row if out is None else out.unionByName(row)
    return out


def simple_report(chunks: DataFrame, confidence: float = 0.85) -> DataFrame:
    """(doc_id, chunks, average_chunk_size, quality_score) of the simple profile."""
    out = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum("char_count").alias("n"))
    return out.select("doc_id", "chunks", F.floor(F.col("n") / F.col("chunks")).alias("average_chunk_size"), F.lit(confidence * 100).alias("quality_score"))


def run_simple(spark: SparkSession, folder: str, pattern: str = "*.pdf", size: int = 1000) -> DataFrame:
    """The simple profile: plain windows with constant confidence, ids unique over documents."""
    pages = files.extract_pages(files.scan(spark, folder, pattern)).where("not extraction_failed")
    chunks = chunking.simple(joined_text(pages).where(F.length(T.stripped("content")) >= files.MIN_CHARS), size)
    named = chunks.withColumn("chunk_id", F.concat_ws("_chunk_", "doc_id", "chunk_index"))
    return enrich.navigation(named).withColumns({"extraction_confidence": F.lit(0.85), "completeness_score": F.lit(0.9)})
