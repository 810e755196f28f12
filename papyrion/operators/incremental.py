"""What changed since the last run: listing against state, and the state's upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.sources import shared

VALUES = "key string, value string"
STATE = "file_key string, hash string, doc_id string, processed_at timestamp, chunks_created int, processing_time double, quality_score double, file_size long, file_modified timestamp"


def plan(listing: DataFrame, state: DataFrame) -> DataFrame:
    """(file_key, status) by a full outer join: new, modified, unchanged or deleted."""
    a, b = listing.select("file_key", F.col("hash").alias("now")), state.select("file_key", F.col("hash").alias("then"))
    status = F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "deleted").when(F.col("now") != F.col("then"), "modified").otherwise("unchanged")
    return a.join(b, "file_key", "full_outer").select("file_key", status.alias("status"))


def to_process(planned: DataFrame) -> DataFrame:
    return planned.where(F.col("status").isin("new", "modified")).select("file_key")


def pending_deletions(planned: DataFrame, pending: DataFrame) -> DataFrame:
    return planned.where("status = 'deleted'").select("file_key").union(pending.select("file_key")).distinct()


def mark_processed(state: DataFrame, done: DataFrame) -> DataFrame:
    """State with the rows of files that succeeded; failed files stay as they were and come again."""
    return state.join(done.select("file_key"), "file_key", "left_anti").select(*state.columns).unionByName(done.select(*state.columns))


def without_deleted(chunks: DataFrame, state: DataFrame, deletions: DataFrame) -> DataFrame:
    """Chunks without those of deleted files."""
    gone = state.join(deletions, "file_key", "left_semi").select("doc_id").distinct()
    return chunks.join(gone, "doc_id", "left_anti").select(*chunks.columns)


def statistics(state: DataFrame) -> DataFrame:
    """One row: files, chunks, means; zeros for an empty state."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return state.agg(
        F.count(F.lit(1)).alias("total_files"), F.coalesce(F.sum("chunks_created"), F.lit(0)).alias("total_chunks"), mean("processing_time").alias("avg_processing_time"), mean("quality_score").alias("avg_quality_score"), mean("chunks_created").alias("chunks_per_file"),
        F.max("processed_at").alias("last_processing"),
    )


def inc_report(state: DataFrame, pending: DataFrame, version: str = "unknown") -> DataFrame:
    """One row: the statistics, the worst files, how many deletions are pending, and the state's version."""
    worst = low_quality(state).agg(F.to_json(F.array_sort(F.collect_list(F.struct("quality_score", "file_key", "chunks_created")))).alias("low_quality_files"))
    waiting = pending.agg(F.countDistinct("file_key").alias("deleted_files_pending"))
    return statistics(state).join(worst).join(waiting).withColumns({"pipeline_version": F.lit(version), "processed_files_count": F.col("total_files")})


_POINTER = "current"


def _versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n[1:]) for n in shared.names(spark, folder) if n[:1] == "v" and n[1:].isdigit())


def save_state(state: DataFrame, values: DataFrame, folder: str, keep: int = 2) -> int:
    """Processed files and the key-value state (key, value) as a new version under ``folder``; returns its number.

    Both tables are written beside the versions before, then a pointer file is
    moved in one step.  A save that is cut off changes nothing that
    ``load_state`` reads, and its remains are no obstacle to the next one.  The
    ``keep`` latest versions stay, so what was loaded from the last one can
    still be read.
    """
    spark = state.sparkSession
    known = _versions(spark, folder)
    number = known[-1] + 1 if known else 1
    state.write.parquet(f"{folder}/v{number:08d}/processed")
    values.write.parquet(f"{folder}/v{number:08d}/values")
    shared.write_text(spark, f"{folder}/{_POINTER}", str(number))
    for old in known:
        if old <= number - keep:
            shared.delete(spark, f"{folder}/v{old:08d}")
    return number


def load_state(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """What the last whole ``save_state`` wrote; empty if there was none.  A version that cannot be read raises."""
    number = shared.read_text(spark, f"{folder}/{_POINTER}")

    def read(name: str, schema: str) -> DataFrame:
        if number is None:
            return spark.createDataFrame([], schema)
        found = spark.read.parquet(f"{folder}/v{int(number):08d}/{name}")
        return found.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")))

    return read("processed", STATE), read("values", VALUES)


def update_value(values: DataFrame, key: str, value: str, as_of: str) -> DataFrame:
    """Key-value state with one key set, and ``last_updated``."""
    rows = values.sparkSession.createDataFrame([(key, value), ("last_updated", as_of)], VALUES)
    return values.join(rows.select("key"), "key", "left_anti").unionByName(rows)


def get_value(values: DataFrame, key: str, default: str | None = None) -> str | None:
    row = values.where(F.col("key") == key).first()
    return row["value"] if row else default


def history(state: DataFrame, values: DataFrame) -> dict[str, DataFrame]:
    """The tables of a history export (``sinks.export_json``): state, files and statistics."""
    return {"pipeline_state": values, "processed_files": state, "statistics": statistics(state)}


def low_quality(state: DataFrame, below: float = 70.0, most: int = 10) -> DataFrame:
    return state.where(F.col("quality_score") < below).orderBy("quality_score", "file_key").limit(most)


def reset(state: DataFrame, confirm: bool = False) -> DataFrame:
    if not confirm:
        raise ValueError("pass confirm=True to forget all processed files")
    return state.limit(0)


def run_report(results: DataFrame) -> DataFrame:
    """Counts and quality of a run; a result's own status says whether it failed."""
    ok = F.col("status") == "success"
    return results.agg(
        F.count(F.lit(1)).alias("total_files_processed"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), F.coalesce(F.sum(F.when(ok, F.col("chunks_created"))), F.lit(0)).alias("total_chunks"),
        F.avg(F.when(ok, F.col("quality_score"))).alias("avg_quality"), F.min(F.when(ok, F.col("quality_score"))).alias("min_quality"), F.max(F.when(ok, F.col("quality_score"))).alias("max_quality"),
    )
