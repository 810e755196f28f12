"""Keyword search by an inverted index with block maxima, ranked by BM25.

Documents fall into chunks of about ``chunk_rows`` by a hash of their id.  A
posting block holds one term's occurrences in one chunk and the largest
contribution that any of them can make, so no group is larger than a chunk
however common its term.  A search adds up the block maxima of a query's terms
to a bound for each chunk, reading no postings; it scores the chunks with the
highest bounds, takes the score of the k-th best document, and then scores only
the chunks whose bound reaches it.  The result is that of scoring everything.

Contributions are whole millionths, so a sum does not depend on its order.

    path/blocks/bucket=3/...  term, chunk, peak, docs: array of (doc_id, tf, length); buckets by term
    path/terms/bucket=3/...   term, documents
    path/totals               documents, words, chunks
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrion.functions import text as T
from papyrion.operators.buckets import bucket_of
from papyrion.session import set_checkpoint_folder


@dataclass(frozen=True)
class TextIndexConfig:
    k1: float = 1.2
    b: float = 0.75
    chunk_rows: int = 1024
    buckets: int = 32
    #: Chunks that are scored first for each query.
    first_chunks: int = 4
    #: Up to so many terms are pushed down to the files as a list.
    pushed_terms: int = 1000
    #: Chunks that a task takes where there are enough for all cores.
    chunks_per_task: int = 4
    #: Terms of queries, and chunks of queries, are broadcast up to so many rows; beyond that Spark shuffles both sides.
    broadcast_rows: int = 1_000_000


def terms_of(text: Column | str) -> Column:
    """Lower-case words without white space."""
    return T.words(F.lower(T.col(text)))


def _impact(tf: Column, length: Column, average: float, config: TextIndexConfig) -> Column:
    return tf * (config.k1 + 1) / (tf + config.k1 * (1 - config.b + config.b * length / average))


def _millionths(x: Column) -> Column:
    return F.floor(x * 1e6 + 0.5).cast("long")


def build(docs: DataFrame, path: str, config: TextIndexConfig = TextIndexConfig(), id_col: str = "doc_id", text_col: str = "content") -> None:
    """Index all rows of ``docs`` in a new folder.  Ids are unique; rows without an id or words are counted but not found."""
    worded = docs.select(F.col(id_col).alias("doc_id"), terms_of(text_col).alias("words"))
    totals = worded.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.size("words")), F.lit(0)).cast("long").alias("words")).first()
    chunks = max(1, -(-totals["documents"] // config.chunk_rows))
    average = max(1, totals["words"]) / max(1, totals["documents"])
    spark = docs.sparkSession
    spark.createDataFrame([(totals["documents"], totals["words"], chunks)], "documents long, words long, chunks long").coalesce(1).write.parquet(f"{path}/totals")
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks))
    # texts move once; what follows has the chunk in its keys and stays in its task
    dealt = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null").withColumn("chunk", chunk).repartition(_tasks(spark, chunks, config), "chunk")
    words = dealt.select("doc_id", "chunk", terms_of("text").alias("words"))
    occurring = words.select("chunk", F.explode("words").alias("term"), "doc_id", F.size("words").cast("long").alias("length"))
    counted = occurring.groupBy("chunk", "term", "doc_id", "length").agg(F.count(F.lit(1)).alias("tf"))
    blocks = counted.groupBy("chunk", "term").agg(
        F.max(_impact(F.col("tf"), F.col("length"), average, config)).alias("peak"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("doc_id", "tf", "length")).alias("docs")
    )
    bucket = bucket_of(F.col("term"), config.buckets)
    blocks.select("term", "chunk", "peak", "n", "docs", bucket.alias("bucket")).sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/blocks")
    if totals["words"]:
        found = spark.read.parquet(f"{path}/blocks").groupBy("bucket", "term").agg(F.sum("n").alias("documents"))
        found.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms")


def _tasks(spark: SparkSession, chunks: int, config: TextIndexConfig) -> int:
    return max(-(-chunks // config.chunks_per_task), min(chunks, spark.sparkContext.defaultParallelism))


def _few(rows: DataFrame, config: TextIndexConfig) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= config.broadcast_rows else rows


def _wanted(table: DataFrame, asked: list[str], buckets: list[int], config: TextIndexConfig) -> DataFrame:
    table = table.where(F.col("bucket").isin(buckets))
    return table.where(F.col("term").isin(asked)) if len(asked) <= config.pushed_terms else table


@dataclass
class _Search:
    """A search's tables: blocks of the asked terms, and (query_id, term, idf)."""

    blocks: DataFrame
    terms: DataFrame
    average: float
    chunks: int
    config: TextIndexConfig

    def bounds(self) -> DataFrame:
        """(query_id, chunk, bound): no document of the chunk scores higher.  Reads no postings."""
        heads = self.blocks.select("term", "chunk", "peak").join(_few(self.terms, self.config), "term")
        return heads.groupBy("query_id", "chunk").agg(F.sum(_millionths(F.col("idf") * F.col("peak"))).alias("bound"))

    def scored(self, chunks: DataFrame) -> DataFrame:
        """(query_id, doc_id, score) of all documents in the given chunks (query_id, chunk) that have a term of the query."""
        # a block moves once, however many queries ask for it, and a task adds up all of a chunk's scores
        wanted = _few(chunks.select("query_id", "chunk").checkpoint(), self.config)
        blocks = self.blocks.select("term", "chunk", "docs").join(wanted.select("chunk").distinct(), "chunk", "left_semi")
        blocks = blocks.repartition(_tasks(blocks.sparkSession, self.chunks, self.config), "chunk")
        met = blocks.join(_few(self.terms, self.config), "term").join(wanted, ["query_id", "chunk"])
        each = met.select("query_id", "chunk", "idf", F.explode("docs").alias("d"))
        part = _millionths(F.col("idf") * _impact(F.col("d.tf"), F.col("d.length"), self.average, self.config))
        each = each.select("query_id", "chunk", F.col("d.doc_id").alias("doc_id"), part.alias("part"))
        return each.groupBy("query_id", "chunk", "doc_id").agg(F.sum("part").alias("score")).select("query_id", "doc_id", "score")


def _open(spark: SparkSession, path: str, queries: DataFrame, config: TextIndexConfig) -> _Search | None:
    totals = spark.read.parquet(f"{path}/totals").first()
    asked = queries.select("query_id", F.explode(F.array_distinct(terms_of("text"))).alias("term")).withColumn("bucket", bucket_of(F.col("term"), config.buckets)).checkpoint()
    buckets = sorted(r["bucket"] for r in asked.select("bucket").distinct().collect())  # at most config.buckets numbers
    if not totals["words"] or not buckets:
        return None
    few = [r["term"] for r in asked.select("term").distinct().limit(config.pushed_terms + 1).collect()]
    n = F.lit(totals["documents"])
    idf = F.log(1 + (n - F.col("documents") + 0.5) / (F.col("documents") + 0.5))
    known = _wanted(spark.read.parquet(f"{path}/terms"), few, buckets, config)
    terms = asked.join(known.select("term", "documents"), "term").select("query_id", "term", idf.alias("idf"))
    return _Search(_wanted(spark.read.parquet(f"{path}/blocks"), few, buckets, config), terms.checkpoint(), max(1, totals["words"]) / totals["documents"], totals["chunks"], config)


def _top(scored: DataFrame, n: int) -> DataFrame:
    return scored.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))).where(F.col("place") <= n)


def remaining_chunks(bounds: DataFrame, first: DataFrame, n: int, config: TextIndexConfig) -> DataFrame:
    """Of ``bounds`` those after the first chunks that can still hold one of the ``n`` best, given the best of the first chunks."""
    least = first.where(F.col("place") == n).select("query_id", F.col("score").alias("least"))
    return _ranked(bounds).where(F.col("nth") > config.first_chunks).join(least, "query_id", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least"))).select("query_id", "chunk")


def _ranked(bounds: DataFrame) -> DataFrame:
    return bounds.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "chunk")))


def search(spark: SparkSession, path: str, queries: DataFrame, n: int = 10, config: TextIndexConfig = TextIndexConfig()) -> DataFrame:
    """(query_id, doc_id, score, place): the ``n`` documents of each query (query_id, text) with the highest BM25 scores, in millionths.

    Each distinct word of a query counts once.  Equal scores are placed by id.
    Documents without a word of the query are not found.
    """
    set_checkpoint_folder(spark)
    found = _open(spark, path, queries, config)
    if found is None:
        return queries.limit(0).select("query_id", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("score"), F.lit(None).cast("int").alias("place"))
    bounds = found.bounds().checkpoint()
    first = _top(found.scored(_ranked(bounds).where(F.col("nth") <= config.first_chunks)), n).checkpoint()
    more = found.scored(remaining_chunks(bounds, first, n, config))
    return _top(first.drop("place").unionByName(more), n)


def fuse(rankings: list[DataFrame], n: int = 10, k: int = 60) -> DataFrame:
    """(query_id, doc_id, score, place) by reciprocal ranks: each ranking (query_id, doc_id, place) adds 1 / (k + place), in millionths."""
    out = None
    for r in rankings:
        part = r.select("query_id", F.col("doc_id").cast("long").alias("doc_id"), F.floor(F.lit(1_000_000) / (F.col("place") + k)).cast("long").alias("part"))
        out = part if out is None else out.unionByName(part)
    return _top(out.groupBy("query_id", "doc_id").agg(F.sum("part").alias("score")), n)
