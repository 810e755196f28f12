"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into a hierarchy of phrases (signature encoding).  On
each level equal neighbours become one symbol with a count; then deterministic
coin tossing labels every symbol by where it first differs from the symbol
before it, repeated until labels are below 6, and symbols whose label is a local
maximum begin a new phrase.  A phrase is named by a 64-bit hash of its symbols
and is one symbol of the next level, until one symbol is left.  Where a phrase
begins depends on a few symbols around it, not on its distance from the start,
so equal substrings have equal phrases inside, at whatever offset they stand.

A fingerprint is the ``size`` least hashes of the text's phrase names from
``level`` up, each occurrence of a name counted as a name of its own, which is a
sketch: two of them estimate the share of common phrases.  The hierarchy is built with numpy over all texts of a batch at once.

For the comparison with edited texts each row meets the next one.  Rows are
dealt into ranges of ids, texts move once, and the first rows of a range are
also handed to the range before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrion.llm.bytewords import mix
from papyrion.llm.scratch import ship_package


@dataclass(frozen=True)
class FingerprintConfig:
    #: Hashes in a fingerprint, of 32 bits each.
    size: int = 64
    #: The lowest level of phrases that counts (about 2.5, 6 and 15 bytes a phrase on levels 1, 2 and 3).
    level: int = 2
    #: Parse texts of about so many bytes together.
    batch_bytes: int = 1 << 18
    #: Ranges of ids for each shuffle partition.
    ranges: int = 2


_ROTATE = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
#: A 64-bit symbol for each byte, and a factor for each place in a phrase (labels are below 6, so a phrase has at most 11 symbols).
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POWER = mix(np.arange(1, 33, dtype=np.uint64) * _ROTATE) | np.uint64(1)
#: Place of the lowest set bit of a byte.
_LOW_BIT = np.array([(b & -b).bit_length() - 1 if b else 0 for b in range(256)], np.uint8)


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: 2 * (place of the lowest bit in which a symbol differs from the one before) + that bit.

    Neighbours that differ keep differing.  The first symbol of a row takes bit 0.
    """
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = ~x[first]
    differ = x ^ before
    if x.dtype == np.uint8:
        low = _LOW_BIT[differ]
    else:
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
    return (low << 1) | ((x >> low.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)


def coin_labels(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 of symbols without equal neighbours in a row; ``first``: where rows begin."""
    labels = _toss(x, first)  # 64 bits to 128 labels, then 14, 8, 6
    for _ in range(3):
        labels = _toss(labels, first)
    return labels


def _starts(row: np.ndarray) -> np.ndarray:
    first = np.empty(len(row), bool)
    first[:1] = True
    np.not_equal(row[1:], row[:-1], out=first[1:])
    return first


def phrase_levels(data: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(names, rows) of each level from 1 up; a row that is one phrase goes no higher.

    ``data``: bytes of all rows; ``row``: each byte's row, ascending.
    """
    x = data
    while len(x):
        # runs of equal symbols in a row become one
        first = _starts(row)
        begins = first.copy()
        begins[1:] |= x[1:] != x[:-1]
        at = np.flatnonzero(begins)
        if len(at) < len(x):
            lengths = np.diff(at, append=len(x))
            x, row, first = x[at], row[at], first[at]
            long = np.flatnonzero(lengths > 1)
            labels = coin_labels(x, np.flatnonzero(first))
            x = _BYTE[x] if x.dtype == np.uint8 else x
            x[long] = mix(x[long] ^ (lengths[long].astype(np.uint64) * _ROTATE))
        else:
            labels = coin_labels(x, np.flatnonzero(first))
            x = _BYTE[x] if x.dtype == np.uint8 else x
        # a label above both neighbours begins a phrase; neighbours differ, so phrases have at least two symbols but at a row's ends
        begins, rises = first.copy(), labels[1:] > labels[:-1]
        begins[1:-1] |= rises[:-1] & ~rises[1:] & ~first[1:-1] & ~first[2:]
        at = np.flatnonzero(begins)
        place = np.arange(len(x))
        place -= np.repeat(at, np.diff(at, append=len(x)))
        x = mix(np.add.reduceat(x * _POWER[place], at))
        row = row[at]
        yield x, row
        alone = _starts(row)
        alone[:-1] &= alone[1:]  # a row's only phrase
        x, row = x[~alone], row[~alone]


def fingerprints(texts: list[bytes], config: FingerprintConfig = FingerprintConfig()) -> list[np.ndarray]:
    """The sorted least hashes of the phrase names of each text; an empty text has none."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    names, rows, top = [], [], np.zeros(len(texts), bool)
    for level, (x, r) in enumerate(phrase_levels(data, row), 1):
        if level >= config.level:
            names.append(x)
            rows.append(r)
        else:  # a text that ends below the counted levels is its one phrase
            ends = _starts(r)
            ends[:-1] &= ends[1:]
            names.append(x[ends])
            rows.append(r[ends])
    if not names:
        return [np.zeros(0, np.uint32) for _ in texts]
    x, r = np.concatenate(names) >> np.uint64(32), np.concatenate(rows).astype(np.uint64) << np.uint64(32)
    keys = r | x
    keys.sort()
    # the second, third ... occurrence of a name in a row is a name of its own
    same = np.flatnonzero(keys[1:] == keys[:-1]) + 1
    if len(same):
        new = np.append(True, same[1:] != same[:-1] + 1)
        nth = np.arange(len(same)) - np.repeat(np.flatnonzero(new), np.diff(np.flatnonzero(new), append=len(same))) + 1
        repeat = keys[same]
        keys[same] = (repeat & ~_LOW) | (mix(repeat << np.uint64(32) | nth.astype(np.uint64)) >> np.uint64(32))
        keys.sort()
    keys = keys[np.append(True, keys[1:] != keys[:-1])]
    ends = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    least = keys.astype(np.uint32)
    return [least[a : min(b, a + config.size)] for a, b in zip(ends[:-1], ends[1:])]


def to_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, size: int = FingerprintConfig.size) -> float:
    """The share of common phrases, estimated from the least hashes of both together; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)[:size]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(common, both, assume_unique=True).sum() / len(both))


def edited(text: str, after: str) -> str:
    """``text`` whose last third, rounded down, is replaced by the first as many characters of ``after``."""
    n = len(text) // 3
    return text[: len(text) - n] + after[:n]


def fingerprint_documents(docs: DataFrame, config: FingerprintConfig = FingerprintConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, a map over the texts.  A null or empty text has the empty fingerprint.  Other columns are not read."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            texts = [x.as_py() or b"" for x in b.column(1).cast(pa.large_binary())]
            found = [to_text(f) for part in _parts(texts, config.batch_bytes) for f in fingerprints(part, config)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], names=["id", "fingerprint"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id_col)


def _parts(texts: list[bytes], limit: int) -> Iterator[list[bytes]]:
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= limit:
            yield part
            part, held = [], 0
    if part:
        yield part


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are at most ``key``, by binary search."""
    if not cuts:
        return F.lit(0)
    held = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # folded to one literal
    state = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))

    def step(s, _):
        middle = F.shiftright(s["low"] + s["high"], 1)
        above = (s["low"] < s["high"]) & (F.get(held, middle) <= key)
        low = F.when(above, middle + 1).otherwise(s["low"])
        return F.struct(low.alias("low"), F.when(above | (s["low"] >= s["high"]), s["high"]).otherwise(middle).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(cuts).bit_length())), state, step)["low"]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_edited(docs: DataFrame, config: FingerprintConfig = FingerprintConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Rows are in descending order of id, those without an id last; rows of one id
    follow each other by text.  The row after the last is the first, so a single
    row is its own next.  The edited text is :func:`edited` with the next row's
    text.  A null text is empty; empty fingerprints are like each other and
    nothing else.  Lone surrogates do not occur in Spark's strings.  Rows that
    share an id are one task's work.  Other columns are not read.
    """
    ship_package(docs.sparkSession)
    least = -(1 << 63)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows, key = rows.withColumn("key", F.coalesce("doc_id", F.lit(least))), F.col("key")
    n = config.ranges * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("key")
    cuts = sorted({int(c) for c in ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n)).first()[0] or []})
    # ranges count downwards, in the order of the rows
    part = F.lit(len(cuts)) - _range_of(key, cuts)
    firsts = sorted((r["part"], r["top"]) for r in ids.select("key", part.alias("part")).groupBy("part").agg(F.max("key").alias("top")).collect())
    carried_to = {top: firsts[i - 1][0] for i, (_, top) in enumerate(firsts)}  # the first range's first rows go to the last range
    tops = F.split(F.lit(",".join(str(t) for t in carried_to)), ",").cast("array<bigint>")
    targets = F.split(F.lit(",".join(str(p) for p in carried_to.values())), ",").cast("array<int>")
    at = F.array_position(tops, key).cast("int")
    both = F.array(F.struct(part.alias("part"), F.lit(False).alias("carried")), F.struct(F.get(targets, at - 1).alias("part"), F.lit(True).alias("carried")))
    places = F.when(at > 0, both).otherwise(F.slice(both, 1, 1))
    dealt = rows.withColumn("place", F.explode(places)).select("doc_id", "text", "place.part", "place.carried")
    dealt = dealt.repartition(n, "part").sortWithinPartitions("part", "carried", F.desc_nulls_last("doc_id"), "text")
    return dealt.mapInArrow(_compare(config), _OUT)


def _compare(config: FingerprintConfig):
    names = [field.split()[0] for field in _OUT.split(", ")]

    def rows(batches):
        """(part, carried, doc_id, text) with only the first of a part's carried rows."""
        over = None
        for b in batches:
            for doc_id, text, part, carried in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if not carried:
                    yield part, False, doc_id, text.as_py()
                elif over != part:
                    over = part
                    yield part, True, doc_id, text.as_py()

    def finish(held: list) -> Iterator[pa.RecordBatch]:
        """All of ``held`` but the last row, which only serves as next."""
        texts = [text.encode() for _, _, _, text in held]
        edits = [edited(a[3], b[3]).encode() for a, b in zip(held, held[1:])]
        prints = [fingerprints(part, config) for part in (texts, edits)]
        out = []
        for i, (part, carried, doc_id, text) in enumerate(held[:-1]):
            if not carried:
                own, other, after = prints[0][i], prints[1][i], prints[0][i + 1]
                out.append((doc_id, len(text), hashlib.sha256(edits[i]).hexdigest(), to_text(own), to_text(other), likeness(own, other, config.size), likeness(own, after, config.size)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)

    def run(batches):
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += len(row[3])
            if size >= config.batch_bytes and len(held) > 1:
                yield from finish(held)
                held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield from finish(held)

    return run
