"""The kernel of nearest-neighbour searches: a group of vectors against a group of queries, in numpy.

Vectors and queries meet in groups of bounded size, spread by the hashes of
their ids.  In a group a matrix product gives each distance up to its rounding
error; pairs within that error of a query's n-th distance are then computed as
the metric's column expression computes them, component by component, so
distances and ties are those of the expression.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrion.session import ship_package

#: Vectors and queries of a group.
GROUP_ROWS = 32_768
GROUP_QUERIES = 16_384
#: Pairs of a matrix product.
_TILE = 1 << 21


def regular(embedding: Column, width: int, metric: str) -> Column:
    """Whether a vector has all ``width`` components, finite, and a direction if the metric needs one: then the kernel takes it."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < 1e100))
    if metric == "cosine":
        sound = sound & F.exists(embedding, lambda x: F.abs(x.cast("double")) > 1e-100)
    return F.coalesce((F.size(embedding) == width) & sound, F.lit(False))


def groups(spark, rows: int, size: int) -> int:
    return max(spark.sparkContext.defaultParallelism if rows > 4096 else 1, -(-rows // size))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().astype(np.float64, copy=False).reshape(-1, width)


def _exact(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Distances of row pairs, summed in the order of the column expression."""
    total = np.zeros(len(x))
    if metric == "l2sq":
        for j in range(x.shape[1]):
            apart = x[:, j] - q[:, j]
            total += apart * apart
        return total
    xx, qq = np.zeros(len(x)), np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * q[:, j]
        xx += x[:, j] * x[:, j]
        qq += q[:, j] * q[:, j]
    return 1 - total / (np.sqrt(xx) * np.sqrt(qq))


def _without_copies(x: np.ndarray, lists: np.ndarray, n: int) -> np.ndarray:
    """Rows but those that follow ``n`` equal ones with smaller ids: they are no query's nearest.  Rows come in the order of list and id."""
    x = x + 0.0  # one zero
    keys = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, same = np.unique(keys, return_inverse=True)
    order = np.lexsort((np.arange(len(x)), lists, same))
    first = np.r_[True, (same[order][1:] != same[order][:-1]) | (lists[order][1:] != lists[order][:-1])]
    starts = np.maximum.accumulate(np.where(first, np.arange(len(x)), 0))
    return np.sort(order[np.arange(len(x)) - starts < n])


def _group(rows: pa.Table, asked: pa.Table, n: int, metric: str) -> tuple[np.ndarray, ...]:
    """Pairs (query, vector), by query, that hold the ``n`` nearest of each; the vectors' rows, vectors and queries.  Rows come in the order of list and id."""
    width = len(rows["embedding"][0])
    x, q, lists = _matrix(rows["embedding"], width), _matrix(asked["q"], width), rows["list"].to_numpy()
    kept = _without_copies(x, lists, n)
    x, lists = x[kept], lists[kept]
    probed = asked["lists"].combine_chunks()
    owner, wanted = pc.list_parent_indices(probed).to_numpy(), pc.list_flatten(probed).to_numpy()
    order = np.argsort(wanted, kind="stable")
    owner, wanted = owner[order], wanted[order]
    bounds = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1], True])
    x2, q2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", q, q)
    if metric == "cosine":
        xs, qs = x / np.sqrt(x2)[:, None], q / np.sqrt(q2)[:, None]
        slack = np.full(len(q), 1e-15 * (width + 8) * 8)
    else:
        xs, qs = x, q
        slack = 1e-15 * (width + 8) * 4 * (q2 + x2.max())
    best = np.full((len(q), n), np.inf)
    met_q, met_x, met_d = [], [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        asking = owner[np.searchsorted(wanted, lists[a]) : np.searchsorted(wanted, lists[a], "right")]
        for c in range(a, b, 4096):
            d = min(c + 4096, b)
            step = max(1, _TILE // (d - c))
            for k in range(0, len(asking), step):
                some = asking[k : k + step]
                near = qs[some] @ xs[c:d].T
                near = 1 - near if metric == "cosine" else x2[None, c:d] + q2[some, None] - 2 * near
                hit = near.min(axis=1) <= best[some].max(axis=1) + 2 * slack[some]
                some, near = some[hit], near[hit]
                best[some] = np.partition(np.concatenate([best[some], near], axis=1), n - 1, axis=1)[:, :n]
                i, j = np.nonzero(near <= (best[some].max(axis=1) + 2 * slack[some])[:, None])
                met_q.append(some[i])
                met_x.append(j + c)
                met_d.append(near[i, j])
    met_q, met_x, met_d = (np.concatenate(m) if m else np.zeros(0, int) for m in (met_q, met_x, met_d))
    within = met_d <= (best.max(axis=1) + 2 * slack)[met_q] if len(met_q) else np.zeros(0, bool)
    met_q, met_x = met_q[within], met_x[within]
    order = np.argsort(met_q, kind="stable")
    met_q, met_x = met_q[order], met_x[order]
    return met_q, met_x, kept, x, q


def among(vectors: DataFrame, queries: DataFrame, n: int, metric: str, width: int, row_groups: int, query_groups: int) -> DataFrame:
    """(query_id, vec_id, distance): each query's ``n`` nearest of every group, of the regular vectors (list, vec_id, embedding) in its lists.

    ``queries`` has (query_id, q, lists), ``lists`` without repeats.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.where(regular(F.col("embedding"), width, metric)).select("list", "vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(row_groups)).cast("int").alias("vg"))
    rows = rows.withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1))))
    asked = queries.where(regular(F.col("q"), width, metric)).select("query_id", "q", "lists", F.pmod(F.xxhash64("query_id"), F.lit(query_groups)).cast("int").alias("qg"))
    asked = asked.withColumn("vg", F.explode(F.sequence(F.lit(0), F.lit(row_groups - 1))))
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, vec_id {vectors.schema['vec_id'].dataType.simpleString()}, distance double"

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": right["query_id"][:0], "vec_id": left["vec_id"][:0], "distance": pa.array([], pa.float64())})
        left = left.sort_by([("list", "ascending"), ("vec_id", "ascending")])
        met_q, met_x, kept, x, q = _group(left, right, n, metric)
        got_q, got_x, got_d, place, k = [], [], [], _by_id(left["vec_id"]), 0
        while k < len(met_q):
            # whole queries, some ten thousand pairs at a time
            end = np.searchsorted(met_q, met_q[min(k + 16_384, len(met_q)) - 1], "right")
            qi, xi = met_q[k:end], met_x[k:end]
            apart = np.concatenate([_exact(x[xi[s : s + 16_384]], q[qi[s : s + 16_384]], metric) for s in range(0, len(qi), 16_384)])
            # equal distances go by id, whatever their lists
            order = np.lexsort((place[kept[xi]], apart, qi))
            qi, xi, apart = qi[order], xi[order], apart[order]
            starts = np.maximum.accumulate(np.where(np.r_[True, qi[1:] != qi[:-1]], np.arange(len(qi)), 0))
            keep = np.arange(len(qi)) - starts < n
            got_q.append(qi[keep])
            got_x.append(kept[xi[keep]])
            got_d.append(apart[keep])
            k = end
        empty = [np.zeros(0, int)]
        return pa.table({"query_id": right["query_id"].take(pa.array(np.concatenate(got_q or empty))), "vec_id": left["vec_id"].take(pa.array(np.concatenate(got_x or empty))), "distance": np.concatenate(got_d or [np.zeros(0)])})

    return rows.groupBy("vg", "qg").cogroup(asked.groupBy("vg", "qg")).applyInArrow(nearest, schema)


def _by_id(ids: pa.ChunkedArray) -> np.ndarray:
    """Each row's place in the order of ids."""
    return pc.rank(ids.combine_chunks(), sort_keys="ascending", tiebreaker="first").to_numpy()
