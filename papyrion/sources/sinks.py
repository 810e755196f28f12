"""Exports, backups and their way back, all written by Spark as JSON or Parquet folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_json(tables: Mapping[str, DataFrame], folder: str) -> None:
    """One folder of JSON lines for each table."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def import_json(spark: SparkSession, folder: str, schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).json(f"{folder}/{name}") for name, schema in schemas.items()}


def as_json_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row) with each row as JSON text: all tables in one frame."""
    out = None
    for name, df in tables.items():
        rows = df.select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("row"))
        out = rows if out is None else out.unionByName(rows)
    return out


GRAPH = {
    "nodes": "doc_id string, title string, doc_type string, creation_date string, authors array<string>, tags array<string>, chunk_count int, quality_score double",
    "edges": "source_doc_id string, target_doc_id string, relation_type string, strength double, metadata map<string, string>",
}


def export_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    export_json({"nodes": nodes, "edges": edges}, folder)


def import_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of an export; edges with an end that is not there are left out."""
    from papyrion.operators.graph import valid_edges

    found = import_json(spark, folder, GRAPH)
    return found["nodes"], valid_edges(found["edges"], found["nodes"])


def backup(chunks: DataFrame, folder: str) -> None:
    chunks.write.mode("errorifexists").parquet(folder)


def restore(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def write_report(report: DataFrame, folder: str, run: str) -> None:
    """A run's report beside those of earlier runs, and once more as the latest."""
    for place in (run, "latest"):
        report.coalesce(1).write.mode("overwrite").json(f"{folder}/{place}")
