"""Text vectors learned from a corpus: which words stand near which.

Terms are the ``terms`` words with the highest document frequency.  A term's row
in the matrix of positive pointwise mutual information says how much more often
than by chance each other term stands within ``window`` words of it.  A random
projection with signs from a hash of the other term keeps the rows' angles in
``DIM`` numbers, so the matrix itself is never made: each of its entries adds to
or takes from the sums.  Words that stand near the same words get like vectors,
whether or not they ever occur together.  A text is the sum of its terms'
vectors, weighted by how rare they are, at unit length.

All sums are of whole numbers, so they do not depend on their order.

The texts are read twice: for the terms, and for the pairs of terms.  Both times
a task counts windows of texts in numpy and hands on counts, never a row for
each word or pair; a pair is its cell in the table of terms by terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrion.functions import text as T
from papyrion.session import saved, ship_package

#: Numbers in a vector, one for each bit of the hash.
DIM = 64
#: Bytes of text that a task counts at a time; a longer text is a window of its own.
_WINDOW = 8 << 20
#: A task adds up its pairs in a table of at most so many cells (128 MB); for more terms it hands them on by window and distance.
_CELLS = 1 << 24
#: Rows of an Arrow batch that a task returns.
_ROWS = 1 << 17


@dataclass(frozen=True)
class EmbeddingConfig:
    #: Terms with a vector; their table (about 600 bytes a term) is broadcast.
    terms: int = 2048
    min_documents: int = 2
    window: int = 4


def _words(text_col: str) -> Column:
    return T.words(F.lower(text_col))


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """By window of lower-case texts: words, the text that each is of, and which of them are words (an empty one stands at a text's ends)."""
    for batch in batches:
        texts = batch.column(0)
        ends, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while start < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + _WINDOW, "right")))
            lists = pc.ascii_split_whitespace(texts.slice(start, stop - start))
            words = lists.flatten()
            yield words, pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64), pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
            start = stop


def _lower(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.lower(text_col), F.lit("")).alias("text"))


def _count_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents) of each window."""
    for words, holder, full in _worded(batches):
        coded = words.dictionary_encode()
        size = max(1, len(coded.dictionary))
        held = np.sort((holder * size + coded.indices.to_numpy(zero_copy_only=False))[full])
        held = held[np.diff(held, prepend=-1) > 0]  # a word of a text once
        n = np.bincount(held % size, minlength=len(coded.dictionary))
        found = np.flatnonzero(n)
        terms = coded.dictionary.take(pa.array(found)).cast(pa.string())
        for i in range(0, len(found), _ROWS):
            yield pa.RecordBatch.from_arrays([terms[i : i + _ROWS], pa.array(n[found[i : i + _ROWS]], pa.int64())], names=["term", "documents"])


def vocabulary(docs: DataFrame, config: EmbeddingConfig = EmbeddingConfig(), text_col: str = "content") -> DataFrame:
    """(term, documents): at most ``terms`` rows."""
    ship_package(docs.sparkSession)
    counted = _lower(docs, text_col).mapInArrow(_count_holders, "term string, documents long").groupBy("term").agg(F.sum("documents").alias("documents"))
    return counted.where(F.col("documents") >= config.min_documents).orderBy(F.desc("documents"), "term").limit(config.terms)


def _count_pairs(terms: list[bytes], window: int):
    """A function of ``mapInArrow``: (cell, n) of the pairs of two terms within ``window`` words.

    The cell of terms i <= j is i times the number of terms plus j.
    """
    width, known = len(terms), pa.array(terms, pa.binary())
    cells = width * width

    def rows(found: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(found), _ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(found[i : i + _ROWS], pa.int64()), pa.array(n[i : i + _ROWS], pa.int64())], names=["cell", "n"])

    def met(words: pa.Array, holder: np.ndarray, full: np.ndarray) -> Iterator[np.ndarray]:
        """The cells of pairs at one distance."""
        ids = pc.fill_null(pc.index_in(words.cast(pa.binary()), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)[full]
        holder = holder[full]
        for k in range(1, window + 1):
            x, y = ids[:-k], ids[k:]
            both = np.flatnonzero((x >= 0) & (y >= 0) & (holder[:-k] == holder[k:]))
            x, y = x[both], y[both]
            yield np.minimum(x, y) * width + np.maximum(x, y)

    def run(batches):
        total = np.zeros(cells, np.int64) if cells <= _CELLS else None
        for words, holder, full in _worded(batches):
            for found in met(words, holder, full):
                if total is None:
                    yield from rows(*np.unique(found, return_counts=True))
                elif len(found) > cells // 8:
                    total += np.bincount(found, minlength=cells)
                else:
                    np.add.at(total, found, 1)
        if total is not None:
            found = np.flatnonzero(total)
            yield from rows(found, total[found])

    return run


def _hashes(term: Column) -> list[Column]:
    return [F.conv(F.substring(F.sha2(term, 256), 1 + 8 * i, 8), 16, 10).cast("long") for i in (0, 1)]


def _signs(prefix: str) -> list[Column]:
    """1 or -1 for each number of a vector, from columns with the hashes of a term."""
    return [2 * F.shiftright(F.col(f"{prefix}{j // 32}"), j % 32).bitwiseAND(1) - 1 for j in range(DIM)]


def term_vectors(docs: DataFrame, config: EmbeddingConfig = EmbeddingConfig(), text_col: str = "content") -> DataFrame:
    """(term, documents, vector) of each term; whole numbers, in thousandths of the information times signs.

    A term that stands near no other one more often than by chance has zeros.
    """
    spark = docs.sparkSession
    top = vocabulary(docs, config, text_col).select(F.col("term").cast("binary"), "documents").collect()  # at most ``terms`` rows
    terms = [bytes(r["term"]) for r in top]
    known = pa.table({"id": range(len(top)), "term": terms, "documents": [r["documents"] for r in top]}, pa.schema({"id": pa.int64(), "term": pa.binary(), "documents": pa.int64()}))
    known = spark.createDataFrame(known).withColumn("term", F.col("term").cast("string"))
    cells = _lower(docs, text_col).mapInArrow(_count_pairs(terms, config.window), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    a, b = (F.expr(f"cell {f} {max(1, len(terms))}L") for f in ("div", "%"))
    # at most as many rows as there are pairs of terms; a term beside itself is met from both sides
    pairs = saved(cells.select(a.alias("a"), b.alias("b"), F.when(a == b, 2 * F.col("n")).otherwise(F.col("n")).alias("n")), "near")
    turned = lambda df: df.union(df.where("a <> b").select("b", "a", df.columns[2]))
    sums = turned(pairs).groupBy("a").agg(F.sum("n").alias("of_a"))
    total = sums.agg(F.coalesce(F.sum("of_a"), F.lit(0)).alias("total"))
    # at most as many rows as there are terms
    rated = pairs.join(F.broadcast(sums), "a").join(F.broadcast(sums.select(F.col("a").alias("b"), F.col("of_a").alias("of_b"))), "b").crossJoin(F.broadcast(total))
    rated = rated.select("a", "b", F.floor(1000 * F.log(F.col("n").cast("double") * F.col("total") / (F.col("of_a").cast("double") * F.col("of_b")))).cast("long").alias("v")).where("v > 0")
    signs = F.broadcast(known.select(F.col("id").alias("b"), *(h.alias(f"h{i}") for i, h in enumerate(_hashes(F.col("term"))))))
    summed = turned(rated).join(signs, "b").groupBy("a").agg(*(F.sum(F.col("v") * s).alias(f"v{j}") for j, s in enumerate(_signs("h"))))
    vector = F.array(*(F.coalesce(f"v{j}", F.lit(0).cast("long")) for j in range(DIM)))
    return known.join(summed.withColumnRenamed("a", "id"), "id", "left").select("term", "documents", vector.alias("vector"))


def embed(docs: DataFrame, vectors: DataFrame, total: int, id_col: str = "doc_id", text_col: str = "content") -> DataFrame:
    """``docs`` with an ``embedding`` of floats at unit length, zeros for a text without terms.

    ``vectors`` are those of ``term_vectors`` (save them: they are made from the
    whole corpus), ``total`` the number of documents that they come from.  Ids
    are unique.
    """
    weight = F.floor(100 * F.log(F.lit(float(max(1, total))) / F.col("documents"))).cast("long")
    terms = F.broadcast(vectors.select("term", weight.alias("w"), "vector"))
    held = docs.select(id_col, F.explode(_words(text_col)).alias("term")).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n")).join(terms, "term")
    sums = held.groupBy(id_col).agg(*(F.sum(F.col("n") * F.col("w") * F.get("vector", F.lit(j))).alias(f"v{j}") for j in range(DIM)))
    vector = F.array(*(F.coalesce(F.col(f"v{j}").cast("double"), F.lit(0.0)) for j in range(DIM)))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda t, x: t + x * x))
    out = docs.join(sums, id_col, "left").select(*docs.columns, vector.alias("_v"))
    return out.withColumn("_n", norm).select(*docs.columns, F.transform("_v", lambda x: F.when(F.col("_n") > 0, x / F.col("_n")).otherwise(0.0).cast("float")).alias("embedding"))
