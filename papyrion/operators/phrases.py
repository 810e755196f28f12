"""Concepts of several words, found by statistics over the whole corpus.

A candidate is a run of two to four words inside one stretch of text between
punctuation marks; its words are letters only, and function words stand neither
first nor last.  Its C-value is the log of its number of words times how often
it occurs, less the mean frequency of the longer candidates that hold it: so
``machine learning`` counts where it stands by itself, and a fragment that
occurs only inside one longer term counts nothing.

Most runs of words are rare, and each word of a frequent run stands as often
beside the next.  So pairs of words are counted first, by 32-bit cells of their
hashes, and a task hands on only candidates whose pairs all lie in frequent cells.
The set of cells is a bitmap of bounded size: where it fills up, more is handed on,
never less.  Candidates are then counted by their words.  A text that holds enough
of the highest terms of all, of which a bounded number is broadcast, needs no
others; only the rest of the texts hand on what can be a term, to be joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.functions import quality
from papyrion.session import saved, ship_package

#: Bytes of text whose candidates a task looks for at a time; a longer text is a window of its own.
_WINDOW = 8 << 20
#: A task adds up so many pairs of words before it hands on their counts.
_PAIRS = 1 << 22
#: Bits of a set of cells (16 MB), and of the part of it that is one row (the size that Spark's bitmaps have).
_BITS, _PART = 1 << 27, 1 << 15
#: Rows of an Arrow batch that a task returns.
_ROWS = 1 << 17


@dataclass(frozen=True)
class PhraseConfig:
    most_words: int = 4
    #: Rarer candidates are no terms, nor do they nest others.
    min_count: int = 5
    stop_words: tuple[str, ...] = tuple(quality.FUNCTION_WORDS)
    #: About so many terms with the highest C-values are broadcast to place a text's concepts where it is read.
    most_broadcast: int = 1 << 18


def _stretches(text: Column | str) -> Column:
    """The text in lower case; what ends a stretch becomes a word that is no candidate's."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[.!?;:,()\n]+", " . ")


def candidates(text: Column | str, config: PhraseConfig = PhraseConfig()) -> Column:
    """All candidates of a text, as lower-case words with a space between them, each as often as it occurs."""
    found = F.flatten(F.array(*(F.regexp_extract_all(_stretches(text), F.lit(_pattern(n, config)), F.lit(1)) for n in range(2, config.most_words + 1))))
    return F.transform(found, lambda p: F.regexp_replace(p, r"\s+", " "))


def _pattern(n: int, config: PhraseConfig) -> str:
    """A run of ``n`` plain words, looked for from every word on."""
    plain = r"\p{L}{2,}"
    no_stop = r"(?!(?:" + "|".join(rf"\Q{w}\E" for w in config.stop_words) + r")(?!\S))" if config.stop_words else ""
    return rf"(?<!\S){no_stop}(?=({plain}(?:\s+{plain}){{{n - 2}}}\s+{no_stop}{plain})(?!\S))"


@dataclass
class _Worded:
    """The words of a window of texts, by their codes, and which pairs of neighbours can stand in a candidate."""

    words: pa.Array
    codes: np.ndarray
    holder: np.ndarray
    stop: np.ndarray
    hashes: np.ndarray
    beside: np.ndarray

    def cells(self, at: np.ndarray, n: int) -> np.ndarray:
        """A 32-bit cell of each run of ``n`` words that begins at ``at``."""
        out = np.full(len(at), n, np.uint64)
        for k in range(n):
            out = (out + self.hashes[self.codes[at + k]]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return (out >> np.uint64(32)).astype(np.uint32)

    def runs(self, most: int, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, keys) of the candidates of 2 to ``most`` words of which all pairs are in ``pairs``; equal ones have equal keys."""
        at = np.flatnonzero(pairs)
        keys, size = self.codes[at], max(1, len(self.words))
        for n in range(2, most + 1):
            if n > 2:
                on = at + n - 2 < len(pairs)
                on[on] = pairs[at[on] + n - 2]
                at, keys = at[on], keys[on]
            keys = np.unique(keys * size + self.codes[at + n - 1], return_inverse=True)[1]
            ends = ~self.stop[at] & ~self.stop[at + n - 1]
            yield n, at[ends], keys[ends]

    def names(self, at: np.ndarray, n: int) -> pa.Array:
        return pc.binary_join_element_wise(*(self.words.take(pa.array(self.codes[at + k])) for k in range(n)), " ")


def _worded(texts: pa.Array, config: PhraseConfig) -> Iterator[tuple[int, _Worded]]:
    """The first text of each window, and the window."""
    stops = frozenset(config.stop_words)
    ends, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while start < len(texts):
        to = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _WINDOW, "right")))
        lists = pc.ascii_split_whitespace(texts.slice(start, to - start))
        coded = lists.flatten().dictionary_encode()
        codes, holder = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        plain = np.array([len(w) > 1 and w.isalpha() for w in words], bool)[codes]
        hashes = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words], np.uint64)
        stop = np.array([w in stops for w in words], bool)[codes]
        yield start, _Worded(coded.dictionary, codes, holder, stop, hashes, plain[:-1] & plain[1:] & (holder[:-1] == holder[1:]))
        start = to


def _rows(names: list[str], *columns: pa.Array) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), _ROWS):
        yield pa.RecordBatch.from_arrays([c[i : i + _ROWS] for c in columns], names=names)


def _in(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which cells are in a set of ``_cell_set``."""
    bit = cells >> np.uint32(5)
    return (bits[bit >> np.uint32(3)] >> (bit & np.uint32(7)).astype(np.uint8)) & 1 == 1


def _cell_set(cells: DataFrame) -> Broadcast:
    """The 27 highest bits of all ``cell``, as a bitmap for the tasks."""
    bit = F.shiftrightunsigned(F.col("cell"), 5).cast("long") + 1
    parts = cells.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(_BITS // 8, np.uint8)
    for r in parts.toLocalIterator():  # 16 MB at most
        at = (r["part"] - 1) * _PART // 8
        out[at : at + _PART // 8] = np.frombuffer(r["bits"], np.uint8)
    return cells.sparkSession.sparkContext.broadcast(out)


def _frequent_pairs(docs: DataFrame, config: PhraseConfig, text_col: str) -> Broadcast:
    """The cells of the pairs of words that can be in a candidate and occur ``min_count`` times."""

    def count(batches):
        held, size = [], 0

        def handed_on():
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return _rows(["cell", "n"], pa.array(cells.view(np.int32)), pa.array(n, pa.int32()))

        for b in batches:
            for _, window in _worded(b.column(0), config):
                held.append(window.cells(np.flatnonzero(window.beside), 2))
                size += len(held[-1])
                if size >= _PAIRS:
                    yield from handed_on()
                    size = 0
        if size:
            yield from handed_on()

    counted = docs.select(_stretches(text_col).alias("text")).mapInArrow(count, "cell int, n int").groupBy("cell").agg(F.sum("n").alias("n"))
    return _cell_set(counted.where(F.col("n") >= config.min_count))


def terms(docs: DataFrame, config: PhraseConfig = PhraseConfig(), text_col: str = "content") -> DataFrame:
    """(term, words, occurrences, nested_in, c_value) of the candidates that occur ``min_count`` times.

    ``nested_in`` counts the longer terms that hold it; ``c_value`` is in
    ten-thousandths.  Null and empty texts have no candidates.
    """
    ship_package(docs.sparkSession)
    frequent = _frequent_pairs(docs, config, text_col)

    def count(batches):
        for b in batches:
            for _, window in _worded(b.column(0), config):
                pairs = window.beside.copy()
                pairs[pairs] = _in(frequent.value, window.cells(np.flatnonzero(pairs), 2))
                for n, at, keys in window.runs(config.most_words, pairs):
                    _, first, often = np.unique(keys, return_index=True, return_counts=True)
                    yield from _rows(["name", "n"], window.names(at[first], n), pa.array(often, pa.int64()))

    counted = docs.select(_stretches(text_col).alias("text")).mapInArrow(count, "name string, n long").groupBy("name").agg(F.sum("n").alias("occurrences")).where(F.col("occurrences") >= config.min_count)
    counted = counted.withColumn("term", F.split("name", " "))
    # each longer term tells its parts, once each, how often it occurs
    inner = F.array_distinct(F.flatten(F.array(*(_parts(F.col("term"), n) for n in range(2, config.most_words)))))
    told = counted.select(F.explode(inner).alias("part"), F.size("term").alias("words"), "occurrences").where(F.size("part") < F.col("words"))
    told = told.groupBy(F.array_join("part", " ").alias("name")).agg(F.count(F.lit(1)).alias("nested_in"), F.sum("occurrences").alias("within"))
    joined = counted.join(told, "name", "left").withColumn("nested_in", F.coalesce("nested_in", F.lit(0)))
    alone = F.col("occurrences") - F.when(F.col("nested_in") > 0, F.col("within") / F.col("nested_in")).otherwise(0.0)
    value = F.floor(F.log2(F.size("term").cast("double")) * alone * 1e4 + 0.5).cast("long")
    return joined.select(F.col("name").alias("term"), F.size("term").alias("words"), "occurrences", "nested_in", value.alias("c_value"))


def _parts(term: Column, n: int) -> Column:
    starts = F.when(F.size(term) >= n, F.sequence(F.lit(1), F.size(term) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(term, i, n))


def concepts(docs: DataFrame, known: DataFrame, most: int = 10, config: PhraseConfig = PhraseConfig(), text_col: str = "content", id_col: str = "doc_id") -> DataFrame:
    """(id, concepts): each row's ``most`` terms with the highest C-values above 0, highest first, then in order; rows without any are left out."""
    ship_package(docs.sparkSession)
    known = saved(known.where("c_value > 0").select("term", "c_value"), "terms")
    size, cut = known.count(), 0
    if size > config.most_broadcast:
        # all terms above the cut, those at it left out
        cut = known.agg(F.percentile_approx("c_value", F.lit(1 - config.most_broadcast / size))).first()[0]
    highest = known.where(F.col("c_value") > cut)
    top = sorted(((-r["c_value"], r["term"]) for r in highest.toLocalIterator()))
    ranked = docs.sparkSession.sparkContext.broadcast(([t for _, t in top], np.array([-c for c, _ in top], np.int64)))

    def placed(batches):
        """The cell of each term."""
        for b in batches:
            for _, window in _worded(b.column(0), config):
                first = np.flatnonzero(np.diff(window.holder, prepend=-1))
                words = np.diff(first, append=len(window.holder))
                for n in range(2, config.most_words + 1):
                    yield from _rows(["cell"], pa.array(window.cells(first[words == n], n).view(np.int32)))

    cells = lambda df: _cell_set(df.select("term").mapInArrow(placed, "cell int"))
    in_top, in_all = cells(highest), None if cut == 0 else cells(known)
    kind = docs.schema[id_col].dataType.simpleString()

    def hold(batches):
        """(id, term, c_value): the ``most`` highest of a text that has so many, else all that can be its terms, without the value."""
        names, values = ranked.value
        terms = pa.array(names, pa.string())
        rows = lambda ids, holder, found, c: _rows([id_col, "term", "c_value"], ids.take(pa.array(holder)), found, c)
        for b in batches:
            for start, window in _worded(b.column(0), config):
                ids, texts = b.column(1).slice(start), int(window.holder.max(initial=-1)) + 1
                runs = [(n, at, window.cells(at, n), keys) for n, at, keys in window.runs(config.most_words, window.beside)]
                ranks = [np.zeros(0, np.int64)]
                for n, at, found, _ in runs:
                    at = at[_in(in_top.value, found)]
                    rank = pc.fill_null(pc.index_in(window.names(at, n), value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                    ranks.append((window.holder[at] * len(names) + rank)[rank >= 0])
                held = np.unique(np.concatenate(ranks))  # a text's term once, the highest first
                holder, rank = held // max(1, len(names)), held % max(1, len(names))
                number = np.bincount(holder, minlength=texts)
                settled = (number >= most) | (in_all is None)
                kept = settled[holder] & (np.arange(len(held)) - np.repeat(np.cumsum(number) - number, number) < most)
                yield from rows(ids, holder[kept], terms.take(pa.array(rank[kept])), pa.array(values[rank[kept]]))
                for n, at, found, keys in runs if in_all is not None else ():
                    met = ~settled[window.holder[at]]
                    met[met] = _in(in_all.value, found[met])
                    at, keys = at[met], keys[met]
                    at = at[np.unique(window.holder[at] * (keys.max(initial=0) + 1) + keys, return_index=True)[1]]
                    yield from rows(ids, window.holder[at], window.names(at, n), pa.nulls(len(at), pa.int64()))

    held = saved(docs.select(_stretches(text_col).alias("text"), id_col).mapInArrow(hold, f"`{id_col}` {kind}, term string, c_value long"), "concepts")
    met = held.where("c_value is not null")
    if in_all is not None:
        met = met.unionByName(held.where("c_value is null").drop("c_value").join(known, "term").select(id_col, "term", "c_value"))
    top = met.withColumn("k", F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("c_value"), "term"))).where(F.col("k") <= most)
    return top.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "term"))), lambda x: x["term"]).alias("concepts"))
