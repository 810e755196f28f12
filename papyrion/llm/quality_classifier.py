"""Document quality from learned subword embeddings.

A document is the mean of the embedding vectors of its hashed words and
character n-grams; a softmax layer over that mean gives the odds of each class.
Vectors and layer are trained together by stochastic gradient descent in numpy
on a bounded sample of labelled documents.

Mean and layer are both linear, so after training each bucket's vector can be
multiplied through the layer once.  Scoring then gathers one number for each
n-gram instead of a vector, over the text's bytes, without making word objects.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrion.llm.bytewords import SPACED, Piece, pieces
from papyrion.llm.scratch import ship_package


@dataclass(frozen=True)
class QualityClassifierConfig:
    """``max_sample`` bounds the training documents, taken in the order of a hash of their id."""

    buckets_log2: int = 17
    dim: int = 8
    ngrams: tuple[int, ...] = (2, 3, 4)
    max_sample: int = 4000
    epochs: int = 6
    rate: float = 0.2
    seed: int = 7
    #: A document is accepted from this score on.
    accept: float = 0.3


def _buckets(h: np.ndarray, bits: int) -> np.ndarray:
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def feature_buckets(piece: Piece, config: QualityClassifierConfig):
    """(buckets, rows' offsets) for each kind of feature: n-grams of bytes, words, repeats.

    A feature belongs to the row that it begins in; n-grams that reach over a
    row's end are left out by their bucket being -1.
    """
    data = piece.data.astype(np.uint32)
    n = len(data)
    h = np.zeros(n, np.uint32)
    size = 0
    for order in config.ngrams:
        while size < order:
            h = h[: max(0, n - size)] * np.uint32(0x01000193) + data[size : size + max(0, n - size)] + np.uint32(1)
            size += 1
        out = np.full(n, -1, np.int32)
        out[: len(h)] = _buckets(h ^ np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF), config.buckets_log2)
        for back in range(1, order):
            at = piece.offsets[1:] - back
            out[at[at >= 0]] = -1
        yield out, piece.offsets
    starts, ends, offsets = piece.words(SPACED)
    hashes = piece.hashes(starts, ends, lower=False)
    yield (hashes >> np.uint64(64 - config.buckets_log2)).astype(np.int32), offsets
    # a word again after itself is the word pair that marks stuttering texts, whichever word it is
    same = np.zeros(len(hashes), np.int32)
    same[1:] = hashes[1:] == hashes[:-1]
    yield same, offsets


class SubwordClassifier:
    """Embeddings E (buckets x dim) and a softmax layer W (dim x 2), b."""

    def __init__(self, config: QualityClassifierConfig):
        self.config = config
        rng = np.random.default_rng(config.seed)
        self.E = (rng.standard_normal((1 << config.buckets_log2, config.dim)) / config.dim).astype(np.float32)
        self.W = (rng.standard_normal((config.dim, 2)) / config.dim).astype(np.float32)
        self.b = np.zeros(2, np.float32)

    def fit(self, features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> SubwordClassifier:
        """``features``: each document's distinct buckets and their shares, which sum to 1."""
        c, n = self.config, len(features)
        rng = np.random.default_rng(c.seed)
        steps, step = max(1, c.epochs * n), 0
        for _ in range(c.epochs):
            for i in rng.permutation(n):
                at, share = features[i]
                if not len(at):
                    continue
                rate = c.rate * (1 - step / steps)
                step += 1
                x = share @ self.E[at]
                z = x @ self.W + self.b
                p = np.exp(z - z.max())
                p /= p.sum()
                p[labels[i]] -= 1
                back = self.W @ p
                self.W -= rate * np.outer(x, p)
                self.b -= rate * p
                # a bucket's share is small in a long text; its vector moves by share / largest share
                self.E[at] -= (rate * share / share.max())[:, None] * back
        return self

    def bucket_scores(self) -> np.ndarray:
        """What one n-gram of each bucket adds to the log odds of class 1, times the text's features."""
        return (self.E @ (self.W[:, 1] - self.W[:, 0])).astype(np.float32)

    def bias(self) -> float:
        return float(self.b[1] - self.b[0])


def log_odds(piece: Piece, scores: np.ndarray, bias: float, config: QualityClassifierConfig) -> np.ndarray:
    """Of each row: the mean score of its features plus the bias; the bias alone without features."""
    total, count = np.zeros(piece.rows), np.zeros(piece.rows)
    padded = np.append(scores, np.float32(0))  # bucket -1
    for buckets, offsets in feature_buckets(piece, config):
        sums = np.concatenate([[0.0], np.cumsum(padded[buckets], dtype=np.float64)])
        used = np.concatenate([[0], np.cumsum(buckets >= 0)])
        total += sums[offsets[1:]] - sums[offsets[:-1]]
        count += used[offsets[1:]] - used[offsets[:-1]]
    return total / np.maximum(count, 1) + bias


def _document_features(config: QualityClassifierConfig):
    schema = pa.schema([("label", pa.int32()), ("buckets", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))])

    def run(batches):
        for batch in batches:
            for piece in pieces(batch.column(1)):
                kinds = list(feature_buckets(piece, config))
                at, shares = [], []
                for r in range(piece.rows):
                    own = np.concatenate([b[o[r] : o[r + 1]] for b, o in kinds])
                    ids, n = np.unique(own[own >= 0], return_counts=True)
                    at.append(ids.astype(np.int32))
                    shares.append((n / max(1, n.sum())).astype(np.float32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.first, piece.rows), pa.array(at, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))], schema=schema)

    return run


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, train: Column) -> DataFrame:
    """(label, text) of at most ``most`` labelled ids for which ``train`` holds.

    The choice follows a hash of the id, so it is the same at every run, and
    each class is taken in proportion: both shrink by one factor.  Rows that
    repeat id and text count once, different texts under one id each; an id with
    both labels has 1.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    n = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    keep = min(1.0, most / max(1, sum(n.values())))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(keep * 1_000_000) + 1)
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id").dropDuplicates(["doc_id", "text"]).select("label", F.coalesce("text", F.lit("")).alias("text"))


def training_rows(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from; the other fifth is held out."""
    return ~held_out(id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, config: QualityClassifierConfig = QualityClassifierConfig(), label: str = "quality") -> SubwordClassifier:
    """Fit on a sample of the labelled rows of ``docs`` that are not held out.

    Features are made by Spark; the driver gets at most ``max_sample``
    documents, each as at most 2**``buckets_log2`` numbers.  With no labels, or
    one class only, the scores follow the bias.
    """
    ship_package(docs.sparkSession)
    sample = sample_labelled(docs, labels, label, config.max_sample, training_rows())
    rows = sample.mapInArrow(_document_features(config), "label int, buckets array<int>, shares array<float>").toArrow().combine_chunks()
    # a defined order, whatever partition a row came from
    features = [(np.asarray(b), np.asarray(s)) for b, s in zip(_split(rows["buckets"]), _split(rows["shares"]))]
    y = np.asarray(rows["label"])
    order = sorted(range(len(y)), key=lambda i: (len(features[i][0]), int(y[i]), features[i][0].tobytes()))
    return SubwordClassifier(config).fit([features[i] for i in order], y[order])


def _split(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        values, offsets = np.asarray(chunk.values), np.asarray(chunk.offsets)
        out += [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    return out


def score_documents(docs: DataFrame, model: SubwordClassifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each row: the odds of class 1.  Null and empty texts get those of the bias."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    # One float for each bucket: 0.5 MB at the default.
    shared = docs.sparkSession.sparkContext.broadcast((model.bucket_scores(), model.bias(), model.config))

    def run(batches):
        scores, bias, config = shared.value
        for batch in batches:
            for piece in pieces(batch.column(1), 1 << 18):
                z = np.clip(log_odds(piece, scores, bias, config), -500, 500)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.first, piece.rows), pa.array(1 / (1 + np.exp(-z)))], names=[id_col, "score"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, score double")


def keep_accepted(docs: DataFrame, model: SubwordClassifier) -> DataFrame:
    """The rows of ``docs`` that the model accepts, unchanged."""
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast((model.bucket_scores(), model.bias(), model.config))

    def run(batches):
        scores, bias, config = shared.value
        cut = np.log(config.accept / (1 - config.accept))
        for batch in batches:
            for piece in pieces(batch.column(at), 1 << 18):
                yield batch.slice(piece.first, piece.rows).filter(pa.array(log_odds(piece, scores, bias, config) >= cut))

    return docs.mapInArrow(run, docs.schema)
