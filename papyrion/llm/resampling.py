"""Documents resampled towards a target distribution, with exact ranks.

Every run of words of a text is a feature, hashed to one of ``buckets`` places.
Two arrays of counts, of all documents and of all target texts, give each place
a gain: the log of how much likelier the target has it.  A document's weight is
the sum of its features' gains, looked up in that array; Gumbel noise from a
hash of its id makes the highest scores a sample without replacement.

The order of the scores is found by a distributed radix sort of the least
significant digit first.  In each pass every row has a position; positions fall
into blocks of ``block_rows``.  Rows are counted by digit and block, prefix sums
of the counts (digits first, then blocks) say where each group goes, and a row's
destination is its group's offset plus its place in the group.  Groups keep
their order, so the pass is stable, and no group is larger than a block, however
many rows share a digit.  After the last digit of the most significant key the
positions are the ranks.  No step sorts all rows or has them in one task.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.llm.bytewords import ALNUM, LOWER
from papyrion.llm.scratch import Scratch


@dataclass(frozen=True)
class ResamplingConfig:
    #: Features are runs of 1 to so many words.
    max_run: int = 1
    buckets: int = 10_000
    #: Documents with fewer words are not drawn.
    min_words: int = 20
    draw_percent: int = 10
    seed: int = 2024
    #: Bits of a digit of the radix sort.
    digit_bits: int = 8
    #: Positions of a block; a power of two.
    block_rows: int = 4096


#: Words have the bytes that match ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` once A-Z is lower case; all others become spaces.
_WORD_BYTES = bytes(int(LOWER[b]) if ALNUM[b] else 32 for b in range(256))
#: Split about so many bytes at a time.
_PART = 4 << 20
_CACHED = 1 << 20


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size."""
    text, at = text.translate(_WORD_BYTES), 0
    while at < len(text):
        end = text.find(b" ", at + _PART)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def features(words: list[bytes], max_run: int, before: list[bytes] = []) -> Iterator[bytes]:
    """All runs of up to ``max_run`` words that end in ``words``; ``before`` are the words before those."""
    yield from words
    words = [*before, *words]
    for n in range(2, max_run + 1):
        for i in range(max(0, len(before) - n + 1), len(words) - n + 1):
            yield b" ".join(words[i : i + n])


def _tail(before: list[bytes], words: list[bytes], max_run: int) -> list[bytes]:
    return [*before, *words][-(max_run - 1) :] if max_run > 1 else []


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


_COUNTS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])


def _count_features(config: ResamplingConfig):
    def run(batches):
        counts, long_enough = np.zeros(config.buckets, np.int64), 0
        for b in batches:
            for known, text in zip(b.column(0).is_valid().to_pylist(), _bytes(b.column(1))):
                before, n = [], 0
                for words in word_lists(text):
                    for feature, k in Counter(features(words, config.max_run, before)).items():
                        counts[zlib.crc32(feature) % config.buckets] += k
                    before, n = _tail(before, words, config.max_run), n + len(words)
                long_enough += known and n >= config.min_words
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1)), pa.array(np.append(counts[found], long_enough))], schema=_COUNTS)

    return run


def count_features(texts: DataFrame, config: ResamplingConfig) -> tuple[np.ndarray, int]:
    """Occurrences in each bucket over all rows (id, text), and how many rows with an id have enough words.

    Each task sends at most ``buckets`` sums, and so many reach the driver.
    """
    found = texts.mapInArrow(_count_features(config), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts, rows = np.zeros(config.buckets, np.int64), 0
    for bucket, n in found:
        if bucket < 0:
            rows = n
        else:
            counts[bucket] = n
    return counts, rows


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floor of 1000 times the log of the smoothed ratio of shares, target over source."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + k)) / float((s + 1) * (t_all + k)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


class _Gains(dict):
    """Gains of features met so far."""

    def __init__(self, gains: np.ndarray):
        super().__init__()
        self.gains = gains.tolist()

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        gain = self[feature] = self.gains[zlib.crc32(feature) % len(self.gains)]
        return gain


_WEIGHED = "doc_id long, n_words long, n_features long, weight long, score long"


def _weigh(config: ResamplingConfig, gains: np.ndarray):
    def run(batches):
        gain = _Gains(gains).__getitem__
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), _bytes(b.column(1))):
                before, n_words, n_features, weight = [], 0, 0, 0
                for words in word_lists(text):
                    found = words if config.max_run == 1 else list(features(words, config.max_run, before))
                    before, n_words, n_features, weight = _tail(before, words, config.max_run), n_words + len(words), n_features + len(found), weight + sum(map(gain, found))
                rows.append((doc_id, n_words, n_features, weight, None if doc_id is None else weight + gumbel(doc_id, config.seed)))
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [()] * 5)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def _digits(rows: DataFrame, keys: list[tuple[str, bool]], bits: int) -> Iterator[Column]:
    """The digits of a composite key that differ between rows, least significant first; ``keys``: (column of longs, descending), most significant first.

    The driver gets two numbers for each key.
    """
    ends = rows.agg(*(f(k).alias(f"{f.__name__}_{k}") for k, _ in keys for f in (F.min, F.max))).first()
    for i, (k, descending) in reversed(list(enumerate(keys))):
        low, high = ends[f"min_{k}"], ends[f"max_{k}"]
        width = (high - low).bit_length()
        if width < 64:
            value = F.lit(high) - F.col(k) if descending else F.col(k) - F.lit(low)
        else:  # a difference may not fit, but the order of signed longs is that of unsigned ones with the sign bit turned
            value = F.col(k).bitwiseXOR(F.lit(-(1 << 63)))
            value = F.bitwise_not(value) if descending else value
        for shift in range(0, width or (i == 0), bits):  # the last key has a pass even where all rows are equal, so that positions become dense
            yield F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def radix_ranks(rows: DataFrame, keys: list[tuple[str, bool]], scratch: Scratch, config: ResamplingConfig = ResamplingConfig()) -> DataFrame:
    """``rows`` with their ``rank`` (1, 2, 3 ...) by ``keys``: (column of longs without nulls, descending), most significant first.

    ``rows`` must be a saved table.  Rows with equal keys have consecutive ranks, in the order of the table.
    """
    held = rows.columns
    place = F.floor(F.col("at") / config.block_rows)
    now = rows.withColumn("at", F.monotonically_increasing_id())
    if rows.isEmpty():
        return rows.withColumn("rank", F.lit(None).cast("long"))
    for i, digit in enumerate(_digits(rows, keys, config.digit_bits)):
        dealt = now.withColumn("digit", digit).withColumn("block", place)
        counts = scratch.save(dealt.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n")), f"counts{i}")
        # as many rows as a digit has values
        lower = counts.groupBy("digit").agg(F.sum("n").alias("n")).select("digit", F.coalesce(F.sum("n").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lower"))
        earlier = F.coalesce(F.sum("n").over(Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = counts.withColumn("earlier", earlier).join(F.broadcast(lower), "digit").select("digit", "block", (F.col("lower") + F.col("earlier")).alias("start"))
        within = dealt.withColumn("k", F.row_number().over(Window.partitionBy("digit", "block").orderBy("at")))
        moved = within.join(starts, ["digit", "block"]).select(*held, (F.col("start") + F.col("k") - 1).alias("at"))
        now = scratch.save(moved, f"pass{i}")
        for old in (f"counts{i}", f"pass{i - 1}"):
            scratch.drop(old)
    return now.select(*held, (F.col("at") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, config: ResamplingConfig = ResamplingConfig(), id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``, all long; rank is null for what is not drawn.

    Words are maximal runs of a-z, 0-9 and all that is not ASCII, A-Z lower-cased
    first.  The ``draw_percent`` of the rows with ``min_words`` words are drawn,
    rounded down, the highest scores first and of equal ones the smaller id.
    A null or blank text has no features and weight 0.  A row without an id
    counts in the statistics, but has no score and is not drawn.  Rows that
    repeat an id have the same noise; where score and id are equal, they take
    consecutive ranks.  An empty target or corpus has counts of zero.  Other
    columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.col(target_text_col).cast("string").alias("text"))
    source_counts, n = count_features(texts, config)
    gains = bucket_gains(source_counts, count_features(wanted, config)[0])
    weighed = scratch.save(texts.mapInArrow(_weigh(config, gains), _WEIGHED), "weighed")
    drawable = (F.col("n_words") >= config.min_words) & F.col("doc_id").isNotNull()
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = radix_ranks(weighed.where(drawable).select(*columns), [("score", True), ("doc_id", False)], scratch, config)
    ranked = ranked.select(*columns, F.when(F.col("rank") <= config.draw_percent * n // 100, F.col("rank")).alias("rank"))
    return ranked.unionByName(weighed.where(~drawable).select(*columns, F.lit(None).cast("long").alias("rank")))
