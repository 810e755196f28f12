"""URL rules in a sorted array of 64-bit digests.

A rule is a host and the beginning of a path.  The driver hashes each rule's
key with xxHash64, sorts the digests and writes them with the keys to one file
in the shared folder, which Spark hands to every machine.  Tasks memory-map that
file, keys included, so all workers of a machine share the pages, and probe the
digests with a vectorised binary search.  A URL's keys are its host and parent domains joined with those
beginnings of its path whose lengths occur in some rule; Spark hashes them with
its own xxHash64.  A hit counts only if the stored key equals the URL's key.

The file is made only up to ``max_table_bytes``; larger rule sets are joined on
the same keys instead, which needs no table on any one machine.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrion.llm.scratch import Scratch

_SEED = 42  # Spark's xxhash64 uses this seed


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for host and its subdomains where the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


#: A host and path that are rules for blocking or allowing, the longest match wins.
DEFAULT_RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)


def digest(key: str) -> int:
    """Spark's xxhash64 of the string, as a signed 64-bit integer."""
    h = xxhash.xxh64_intdigest(key.encode(), seed=_SEED)
    return h - (1 << 64) if h >= 1 << 63 else h


class DigestTable:
    """Sorted digests, memory-mapped, with the full keys to confirm a hit.

    The file: the number of rules, their digests, where each key begins in the
    texts, where each verdict does (and the end of all), and the texts.
    """

    @staticmethod
    def to_bytes(rules: Sequence[UrlRule]) -> bytes:
        """Of rules with equal keys the last one counts."""
        rules = list({r.key: r for r in rules}.values())
        rules.sort(key=lambda r: (digest(r.key), r.key))
        texts = [t.encode() for r in rules for t in (r.key, r.verdict)]
        limits = np.cumsum([0, *map(len, texts)])
        return b"".join(np.asarray(x, "<i8").tobytes() for x in ([len(rules)], [digest(r.key) for r in rules], limits)) + b"".join(texts)

    def __init__(self, path: str):
        numbers = int(np.fromfile(path, "<i8", 1)[0])
        whole = np.memmap(path, np.uint8, "r")
        self.digests = whole[8 : 8 + 8 * numbers].view("<i8")
        self._limits = whole[8 + 8 * numbers : 16 + 24 * numbers].view("<i8")
        self._texts = whole[16 + 24 * numbers :]

    def _text(self, i: int) -> str:
        return self._texts[self._limits[i] : self._limits[i + 1]].tobytes().decode()

    def key(self, rule: int) -> str:
        return self._text(2 * rule)

    def verdict(self, rule: int) -> str:
        return self._text(2 * rule + 1)

    def find(self, digests: np.ndarray, key_at) -> np.ndarray:
        """For each digest the index of the rule whose key equals ``key_at(i)``, else -1."""
        found = np.full(len(digests), -1)
        at = np.searchsorted(self.digests, digests)
        hit = np.flatnonzero(at < len(self.digests))
        hit = hit[self.digests[at[hit]] == digests[hit]] if len(hit) else hit
        for i in hit:
            j = at[i]
            while j < len(self.digests) and self.digests[j] == digests[i]:  # digests may collide
                if self.key(j) == key_at(i):
                    found[i] = j
                    break
                j += 1
        return found


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _keys(lengths: list[int]) -> Column:
    """Keys to probe: the host and each parent domain, with each path beginning of such a length."""
    labels = F.split("host", r"\.")
    hosts = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    paths = F.array_distinct(F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)), lambda p: p.isNotNull()))
    made = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(F.concat(h, p).alias("key"), F.length(p).alias("path_length")))))
    return F.when(F.col("host") != "", made).otherwise(F.slice(made, 1, 0))


def filter_urls(pages: DataFrame, rules: Sequence[UrlRule] = DEFAULT_RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow", max_table_bytes: int = 64 << 20) -> DataFrame:
    """Per row: the id, host, path, rule (null if none fits) and verdict (block or allow).

    A rule fits its host and all subdomains, from a label's start, where the
    path begins with the rule's; the longest key wins, of equally long ones that
    with the longer host, and of rules with equal keys the last.  A null url, or one
    without ``://``, has an empty host and path and fits no rule.  Rows keep
    their number; no rows of an empty table give no rows.
    """
    located = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if sum(8 + len(r.key.encode()) + 16 for r in rules) > max_table_bytes:
        return _joined(located, rules, id_col, default)
    spark = pages.sparkSession
    name = f"url-rules-{uuid.uuid4().hex}"
    spark.sparkContext.addFile(Scratch(spark, "urls").write_bytes(DigestTable.to_bytes(rules), name))
    keys = _keys(sorted({len(r.path) for r in rules}))
    keyed = located.select("*", keys.alias("k")).select(id_col, "host", "path", F.col("k.key").alias("keys"), F.transform("k", lambda k: F.xxhash64(k["key"])).alias("digests"))

    def run(batches):
        table = DigestTable(SparkFiles.get(name))
        for b in batches:
            keys, digests = b.column(3), b.column(4)
            ends = np.cumsum([len(x) for x in digests], dtype=np.int64)
            flat = keys.flatten()
            found = table.find(np.asarray(digests.flatten()), lambda i: flat[int(i)].as_py())
            best = [-1] * b.num_rows
            for i in np.flatnonzero(found >= 0):
                row = int(np.searchsorted(ends, i, "right"))
                if best[row] < 0 or len(table.key(found[i])) > len(table.key(best[row])):
                    best[row] = found[i]
            rule = pa.array([table.key(j) if j >= 0 else None for j in best], pa.string())
            verdict = pa.array([table.verdict(j) if j >= 0 else default for j in best], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), rule, verdict], names=[id_col, "host", "path", "rule", "verdict"])

    kind = located.schema[0].dataType.simpleString()
    return keyed.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def _joined(located: DataFrame, rules: Sequence[UrlRule], id_col: str, default: str) -> DataFrame:
    """The same by an equi-join on keys; each distinct host and path is judged once."""
    spark = located.sparkSession
    table = spark.createDataFrame([(r.key, r.verdict) for r in {r.key: r for r in rules}.values()], "key string, verdict string")
    places = located.select("host", "path").distinct()
    keyed = places.select("host", "path", F.explode(_keys(sorted({len(r.path) for r in rules}))).alias("k")).select("host", "path", "k.*")
    order = F.struct(F.length("key"), -F.col("path_length"))
    best = keyed.join(table, "key").groupBy("host", "path").agg(F.max_by(F.struct("key", "verdict"), order).alias("b"))
    out = located.join(best, ["host", "path"], "left")
    return out.select(id_col, "host", "path", F.col("b.key").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))
