"""Substring search by trigram postings.

Every text's lower-case trigrams are kept in posting blocks of one trigram and
one chunk of rows.  A LIKE pattern's literal parts give trigrams that a match
must have; the rarest few lists are read and intersected chunk by chunk, and the
rows left are confirmed with the pattern itself.  A pattern without three
literal characters in a row has no trigrams, and all rows are compared.

    path/blocks/bucket=3/...  gram, chunk, ids; buckets by gram
    path/grams/bucket=3/...   gram, rows
    path/rows/bucket=3/...    id, text; a bucket table by id
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.operators import buckets
from papyrion.operators.buckets import bucket_of
from papyrion.sources import shared


@dataclass(frozen=True)
class SubstringConfig:
    chunk_rows: int = 4096
    buckets: int = 32
    #: Lists that are intersected for a pattern, the rarest ones.
    lists: int = 3


def trigrams(text: Column) -> Column:
    """The distinct trigrams of the lower-case text, by code points."""
    low = F.lower(text)
    grams = F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substr(low, i, F.lit(3)))
    return F.when(F.length(low) >= 3, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def literal_parts(pattern: str) -> list[str]:
    """The runs of literal characters of a LIKE pattern, in lower case; a backslash escapes the next character."""
    parts, at = [""], 0
    while at < len(pattern):
        c = pattern[at]
        if c in "%_":
            parts.append("")
        else:
            at += c == "\\"
            parts[-1] += pattern[at : at + 1]
        at += 1
    return [p.lower() for p in parts if p]


def needed_trigrams(pattern: str) -> list[str]:
    return sorted({p[i : i + 3] for p in literal_parts(pattern) for i in range(len(p) - 2)})


def build(rows: DataFrame, path: str, config: SubstringConfig = SubstringConfig(), id_col: str = "id", text_col: str = "text") -> None:
    """Index the rows (id, text) in a new folder; null texts match nothing and are left out, and so are rows without an id.

    Where many rows share a text, index the distinct texts, with the text as id.
    """
    spark = rows.sparkSession
    buckets.create(rows.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), f"{path}/rows", "id", config.buckets)
    held = buckets.read(spark, f"{path}/rows")
    chunks = max(1, -(-held.count() // config.chunk_rows))
    shared.write_text(spark, f"{path}/layout.json", json.dumps({"buckets": config.buckets}))
    each = held.select("id", F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk"), F.explode(trigrams(F.col("text"))).alias("gram"))
    blocks = each.groupBy("gram", "chunk").agg(F.collect_list("id").alias("ids")).withColumn("bucket", bucket_of(F.col("gram"), config.buckets))
    blocks.repartition("bucket", "chunk").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{path}/blocks")
    if any(n.startswith("bucket=") for n in shared.names(spark, f"{path}/blocks")):
        counts = spark.read.parquet(f"{path}/blocks").groupBy("bucket", "gram").agg(F.sum(F.size("ids")).alias("rows"))
        counts.repartition("bucket").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{path}/grams")


def _of(table: DataFrame, grams: list[str], n: int) -> DataFrame:
    # folded to numbers, so only these partitions are read
    return table.where(F.col("bucket").isin([bucket_of(F.lit(g), n) for g in grams]) & F.col("gram").isin(grams))


def candidates(spark: SparkSession, path: str, pattern: str, config: SubstringConfig = SubstringConfig()) -> DataFrame | None:
    """The ids of rows that have the rarest trigrams of the pattern, or None if it has none."""
    grams = needed_trigrams(pattern)
    if not grams:
        return None
    n = json.loads(shared.read_text(spark, f"{path}/layout.json"))["buckets"]
    nothing = buckets.read(spark, f"{path}/rows").select("id").limit(0)
    if not shared.exists(spark, f"{path}/grams"):
        return nothing
    found = {r["gram"]: r["rows"] for r in _of(spark.read.parquet(f"{path}/grams"), grams, n).collect()}  # at most as many as the pattern is long
    if len(found) < len(grams):
        return nothing
    rarest = sorted(grams, key=lambda g: (found[g], g))[: config.lists]
    lists = _of(spark.read.parquet(f"{path}/blocks"), rarest, n).groupBy("chunk").agg(F.collect_list("ids").alias("lists"))
    common = F.aggregate(F.slice("lists", 2, len(rarest)), F.get("lists", F.lit(0)), F.array_intersect)
    return lists.where(F.size("lists") == len(rarest)).select(F.explode(common).alias("id"))


def search(spark: SparkSession, path: str, pattern: str, config: SubstringConfig = SubstringConfig()) -> DataFrame:
    """(id, text) of the rows whose text is like the pattern, without regard to case."""
    rows = buckets.read(spark, f"{path}/rows")
    ids = candidates(spark, path, pattern, config)
    if ids is not None:
        rows = rows.join(ids.distinct(), "id", "left_semi")
    return rows.where(F.col("text").ilike(pattern)).select("id", "text")
