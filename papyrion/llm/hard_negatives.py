"""Hard negatives of anchors by exact inner products from lookup tables.

Components are whole numbers.  A block of candidates is kept as bit planes: for
each bit of the numbers and each group of eight dimensions one byte a row, which
holds that bit of the eight components.  For an anchor and a group there is a
table of the sums of all 256 subsets of the anchor's eight components (Four
Russians).  A plane's byte looks up what that plane adds, so a full score is
Horner's scheme over the planes: shift, look up, add.  The highest plane is the
sign and is taken off.  Scores are exact, whatever the components.

Anchors and candidates are packed into blocks of rows, one row of the job for a
block.  Every block of candidates meets every block of anchors in one of many
groups of bounded size, which are the tasks' work; a group gives at most a few
rows for each anchor.  The first pass finds an anchor's positives, the second
finds, between the limits that these set, the highest rows of other labels.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.llm.scratch import Scratch


@dataclass(frozen=True)
class NegativeConfig:
    #: Components are the floor of this many times the given ones.
    scale: int = 256
    #: Anchors are the rows whose id this divides.
    anchor_every: int = 50
    #: Rows whose id this divides have a changed label; none if 0.
    relabel_every: int = 7
    labels: int = 10
    positives: int = 5
    negatives: int = 3
    #: A negative's score is between these percentages of the positive's.
    low_percent: int = 50
    high_percent: int = 95
    #: Rows in a block of anchors and of candidates, and blocks of candidates in a group.
    anchor_rows: int = 1024
    candidate_rows: int = 2048
    group_blocks: int = 4


#: Anchors whose tables are used at a time, and candidates, so that sums stay in cache.
_ANCHORS, _CANDIDATES = 64, 1024
#: No component may be larger, so that scores fit in 64 bits.
_LARGEST = 1 << 27


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, n) bytes of ``rows``, (n, dimensions) whole numbers; the last plane is the sign."""
    n, dims = rows.shape
    planes = max(int(np.abs(rows).max(initial=0)).bit_length(), 1) + 1
    padded = np.zeros((n, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = rows
    bits = np.stack([(padded >> j) & 1 for j in range(planes)]).astype(np.uint8)
    return np.ascontiguousarray(np.packbits(bits, axis=2, bitorder="little").transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray, groups: int, kind=np.int64) -> np.ndarray:
    """(groups, 256, m): the sum of each anchor's components that each byte selects."""
    m, dims = anchors.shape
    padded = np.zeros((groups * 8, m), kind)
    padded[: min(dims, groups * 8)] = anchors.T[: groups * 8]
    out = np.zeros((groups, 256, m), kind)
    for bit in range(8):  # the sums without this bit, plus its component
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + padded[bit::8][:, None]
    return out


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(n, m) inner products of the rows in ``planes`` and the anchors in ``tables``."""
    n, m = planes.shape[2], tables.shape[2]
    total, found = np.zeros((n, m), tables.dtype), np.empty((n, m), tables.dtype)
    for j in range(len(planes) - 1, -1, -1):
        total <<= 1
        for g in range(planes.shape[1]):
            np.take(tables[g], planes[j, g], axis=0, out=found, mode="clip")
            if j == len(planes) - 1:
                total -= found
            else:
                total += found
    return total


def _fits(anchors: np.ndarray, planes: int) -> type:
    """The kind of number that holds every sum of the scheme."""
    most = int(np.abs(anchors).sum(axis=1).max(initial=0)) << planes
    return np.int32 if most < 1 << 31 else np.int64


_BLOCK = pa.schema([("number", pa.int64()), ("head", pa.string()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("limits", pa.binary())])
_BLOCK_TYPE = "number long, head string, ids binary, labels binary, vectors binary, limits binary"


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out = np.zeros((len(column), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _pack(size: int, as_planes: bool):
    """Rows (key, label, vector, limits) to blocks of ``size`` rows."""

    def block(number: int, rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        vectors = _matrix(rows.column("vector").combine_chunks())
        if np.abs(vectors).max(initial=0) > _LARGEST:
            raise ArithmeticError(f"components must be at most {_LARGEST}")
        # ascending ids, so that of equal scores the first is the one with the smaller id
        keys = rows.column("vec_id").to_numpy()
        order = np.argsort(keys, kind="stable")
        vectors = vectors[order]
        limits = _matrix(rows.column("limits").combine_chunks())[order]
        held = bit_planes(vectors) if as_planes else vectors
        head = json.dumps({"shape": held.shape, "limits": limits.shape[1]})
        parts = (keys[order], rows.column("label").to_numpy()[order], held, limits)
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([head]), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts)], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, number = [], 0, 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                taken = b.slice(at, size - n)
                held.append(taken)
                n, at = n + taken.num_rows, at + taken.num_rows
                if n == size:
                    yield block(number, pa.Table.from_batches(held))
                    held, n, number = [], 0, number + 1
        if n:
            yield block(number, pa.Table.from_batches(held))

    return run


class _Block:
    """A packed block as arrays."""

    def __init__(self, ids: bytes, labels: bytes, vectors: bytes, limits: bytes, head: str, as_planes: bool):
        head = json.loads(head)
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors, np.uint8 if as_planes else np.int64).reshape(head["shape"])
        self.limits = np.frombuffer(limits, np.int64).reshape(len(self.ids), head["limits"])


def _blocks(table: pa.Table, as_planes: bool) -> Iterator[_Block]:
    for row in table.select(["ids", "labels", "vectors", "limits", "head"]).to_batches():
        for values in zip(*row.columns):
            yield _Block(*(v.as_py() for v in values), as_planes)


def _scored(anchors: _Block, candidates: _Block) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(anchors, candidates, scores) of all pairs of two blocks, piece by piece."""
    planes = candidates.vectors
    kind = _fits(anchors.vectors, len(planes))
    for a in range(0, len(anchors.ids), _ANCHORS):
        mine = slice(a, min(a + _ANCHORS, len(anchors.ids)))
        tables = subset_sums(anchors.vectors[mine], planes.shape[1], kind)
        for c in range(0, len(candidates.ids), _CANDIDATES):
            theirs = slice(c, min(c + _CANDIDATES, len(candidates.ids)))
            yield mine, theirs, scores(np.ascontiguousarray(planes[:, :, theirs]), tables)


class _Top:
    """The highest rows met so far of each of several lists; of equal scores the smaller id."""

    def __init__(self, lists: int, size: int):
        self.size, self.rows = size, [[] for _ in range(lists)]
        #: A lower score than this can not enter a full list.
        self.least = np.full(lists, np.iinfo(np.int64).min)

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.size:
            order = np.lexsort((ids, -scores))[: self.size]
            scores, ids = scores[order], ids[order]
        rows = sorted([*self.rows[at], *zip((-scores).tolist(), ids.tolist())])[: self.size]
        self.rows[at] = rows
        if len(rows) == self.size:
            self.least[at] = -rows[-1][0]


_FOUND = pa.schema([("anchor_id", pa.int64()), ("anchor", pa.int64()), ("list", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_FOUND_TYPE = "anchor_id long, anchor long, list long, id long, score long"


def _found(top: _Top, anchors: _Block, lists: int) -> Iterator[tuple]:
    for at, rows in enumerate(top.rows):
        a = at // lists
        for minus, vec_id in rows:
            yield int(anchors.ids[a]), int(anchors.limits[a, 0]), at % lists, vec_id, -minus


def _search(config: NegativeConfig, negatives: bool):
    """For each pair of cogroups: the best rows of each anchor, or of each anchor's positive.

    An anchor block's limits are its row's number and, in the second pass, its positives' scores (filled up with -1, which has no negatives).
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, candidates = [], list(_blocks(left, True))
        for anchors in _blocks(right, False):
            lists = max(anchors.limits.shape[1] - 1, 1)
            top = _Top(len(anchors.ids) * lists, config.negatives if negatives else config.positives)
            for block in candidates:
                (_negatives if negatives else _positives)(config, anchors, block, top)
            out += _found(top, anchors, lists)
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else [()] * 5)], schema=_FOUND)

    return run


def _positives(config: NegativeConfig, anchors: _Block, candidates: _Block, top: _Top) -> None:
    for mine, theirs, s in _scored(anchors, candidates):
        fits = candidates.labels[theirs, None] == anchors.labels[mine]
        fits &= candidates.ids[theirs, None] != anchors.ids[mine]
        fits &= s >= top.least[mine]
        _take(fits, s, candidates.ids[theirs], mine.start, 1, 0, top)


def _negatives(config: NegativeConfig, anchors: _Block, candidates: _Block, top: _Top) -> None:
    lists = anchors.limits.shape[1] - 1
    for mine, theirs, s in _scored(anchors, candidates):
        other = candidates.labels[theirs, None] != anchors.labels[mine]
        positives = anchors.limits[mine, 1:]
        low, high = -(-config.low_percent * positives // 100), config.high_percent * positives // 100  # whole scores between the limits
        low = np.where(positives < 0, 1, np.maximum(low, top.least.reshape(-1, lists)[mine]))
        high = np.where(positives < 0, 0, high)
        for k in range(lists):
            fits = s >= low[:, k]
            fits &= s <= high[:, k]
            fits &= other
            _take(fits, s, candidates.ids[theirs], mine.start, lists, k, top)


def _take(fits: np.ndarray, s: np.ndarray, ids: np.ndarray, first: int, lists: int, k: int, top: _Top) -> None:
    by_anchor, places = np.nonzero(np.ascontiguousarray(fits.T))
    for a, at in zip(*_runs(by_anchor)):
        rows = places[at]
        top.add((first + int(a)) * lists + k, s[rows, a].astype(np.int64), ids[rows])


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    begins = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)
    ends = np.append(begins[1:], len(sorted_keys))
    return sorted_keys[begins], [slice(b, e) for b, e in zip(begins, ends)]


def whole_vectors(rows: DataFrame, config: NegativeConfig, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, labels and components as they are scored."""
    x = F.col(vector_col).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    label = F.col(label_col).cast("long")
    if config.relabel_every:
        label = F.when(F.col(id_col) % config.relabel_every == 0, (label + 1) % config.labels).otherwise(label)
    taken = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & ~odd
    return rows.where(taken).select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.transform(x, lambda v: F.floor(v * config.scale).cast("long")).alias("vector"))


def _in_blocks(rows: DataFrame, size: int, as_planes: bool) -> DataFrame:
    packed = rows.select("vec_id", "label", "vector", "limits").mapInArrow(_pack(size, as_planes), _BLOCK_TYPE)
    return packed.withColumn("number", F.monotonically_increasing_id())


def _best(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    order: list[Column] = [F.col("score").desc(), F.col("id")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= size)


def mine(rows: DataFrame, config: NegativeConfig = NegativeConfig(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hard negatives of every anchor's positives.

    An anchor's positives are the ``positives`` rows of its label and another id
    with the highest scores; a positive's negatives are the ``negatives`` highest
    rows of other labels between the two percentages of its score.  Of equal
    scores the smaller id comes first.  A negative positive score has none.
    Rows with a null id, label or vector, or a null or not finite component, take
    no part.  A shorter vector counts as filled up with zeros; an empty one
    scores 0.  Repeated rows are rows of their own: each repeated anchor has its
    results, each repeated row is met once for each time it is there.
    Components larger than 2**27 after scaling raise an ``ArithmeticException`` or
    ``ArithmeticError``.  Other columns are not read.
    """
    scratch = Scratch(rows.sparkSession, "negatives")
    none = F.array().cast("array<long>")
    taken = whole_vectors(rows, config, id_col, vector_col, label_col)
    candidates = scratch.save(_in_blocks(taken.withColumn("limits", none), config.candidate_rows, True), "candidates")
    anchors = scratch.save(taken.where(F.col("vec_id") % config.anchor_every == 0).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    n_anchors, n_blocks = anchors.count(), candidates.count()
    parts, slots = max(1, -(-n_anchors // config.anchor_rows)), max(1, -(-n_blocks // config.group_blocks))

    def search(limits: Column, which: DataFrame, negatives: bool) -> DataFrame:
        dealt = which.withColumn("limits", limits).select("vec_id", "label", "vector", "limits").repartition(parts)
        blocks = scratch.save(_in_blocks(dealt, config.anchor_rows, False), "negative-blocks" if negatives else "positive-blocks")
        number = blocks.select("number", F.row_number().over(Window.orderBy("number")).alias("part"))  # one row for each block of anchors
        left = candidates.withColumn("slot", F.pmod(F.xxhash64("number"), F.lit(slots)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(1), F.lit(max(blocks.count(), 1)))))
        right = blocks.join(F.broadcast(number), "number").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        return left.groupBy("part", "slot").cogroup(right.groupBy("part", "slot")).applyInArrow(_search(config, negatives), _FOUND_TYPE)

    found = search(F.array("anchor"), anchors, False)
    positives = scratch.save(_best(found, ["anchor"], config.positives), "positives")
    scores_of = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("held"))
    with_scores = anchors.join(scores_of, "anchor")
    filled = F.transform(F.sequence(F.lit(0), F.lit(config.positives - 1)), lambda i: F.coalesce(F.get("held", i), F.lit(-1).cast("long")))
    found = search(F.concat(F.array("anchor"), filled), with_scores, True)
    best = _best(found, ["anchor", "list"], config.negatives).select("anchor", (F.col("list") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = positives.select("anchor_id", "anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return named.join(best, ["anchor", "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
