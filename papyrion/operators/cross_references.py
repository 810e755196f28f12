"""What a chunk's references point to.

A reference ("see ...", ``functions.chunk_text.references``) is the number or
the title of a heading of its own document, or the title of a document.  Each is
looked up by an equi-join, the nearest meaning first; what is found nowhere is
kept as dangling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.functions import chunk_text
from papyrion.functions import text as T
from papyrion.operators.enrich import headings

_NUMBER = r"(?i)^(?:chapter|section|kapitel|abschnitt)?\s*(\d+(?:\.\d+)*)\.?$"


def _plain(title: Column) -> Column:
    return F.regexp_replace(F.lower(T.stripped(title)), r"\s+", " ")


def resolve(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, reference, kind, target_doc_id, target_chunk_id) of each distinct reference of each chunk.

    ``kind`` is ``number`` or ``heading`` for a heading of the same document
    (of several the first in its order, the chunk's own ones too), ``document``
    for another document by title (of several the one with the least id; the
    target is its first chunk), else ``dangling`` with null targets.
    ``documents`` has doc_id and title.
    """
    asked = chunks.select("doc_id", "chunk_id", F.explode(chunk_text.references("content")).alias("reference")).withColumn("number", F.nullif(F.regexp_extract("reference", _NUMBER, 1), F.lit(""))).withColumn("name", _plain(F.col("reference")))
    order = F.struct("chunk_index", "line")
    found = headings(chunks)
    numbers = found.groupBy("doc_id", F.regexp_replace("number", r"\.$", "").alias("number")).agg(F.min_by("chunk_id", order).alias("by_number"))
    titles = found.groupBy("doc_id", _plain(F.col("title")).alias("name")).agg(F.min_by("chunk_id", order).alias("by_title"))
    first = chunks.groupBy("doc_id").agg(F.min_by("chunk_id", "chunk_index").alias("first_chunk"))
    # a title that many documents have has two candidates: the least id, and the next for references from that one
    named = documents.where("title is not null").select(F.col("doc_id").alias("other"), _plain(F.col("title")).alias("name")).join(first.withColumnRenamed("doc_id", "other"), "other")
    ranked = named.withColumn("k", F.row_number().over(Window.partitionBy("name").orderBy("other"))).where("k <= 2")
    named = ranked.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("other", "first_chunk"))).alias("others"))
    met = asked.join(numbers, ["doc_id", "number"], "left").join(titles, ["doc_id", "name"], "left").join(named, "name", "left")
    met = met.withColumn("other", F.get(F.filter("others", lambda o: o["other"] != F.col("doc_id")), F.lit(0)))
    kind = F.when(F.col("by_number").isNotNull(), "number").when(F.col("by_title").isNotNull(), "heading").when(F.col("other").isNotNull(), "document").otherwise("dangling")
    inside = F.coalesce("by_number", "by_title")
    return met.select("doc_id", "chunk_id", "reference", kind.alias("kind"), F.when(inside.isNotNull(), F.col("doc_id")).otherwise(F.col("other.other")).alias("target_doc_id"), F.coalesce(inside, F.col("other.first_chunk")).alias("target_chunk_id"))


def referenced_by(resolved: DataFrame) -> DataFrame:
    """(chunk_id, referenced_by): for each target the sorted chunks that point to it, itself left out."""
    kept = resolved.where("target_chunk_id is not null and target_chunk_id <> chunk_id")
    return kept.groupBy(F.col("target_chunk_id").alias("chunk_id")).agg(F.array_sort(F.collect_set("chunk_id")).alias("referenced_by"))
