"""Near-duplicate documents by MinHash signatures, banding and star contraction.

The job in order:

1. One pass over the texts makes, for each row, the size of its set of word
   shingles, a 128-bit digest of that set, and a signature of universal hash
   minima.  Rows with equal digests have equal sets; from here on one row stands
   for them, so a group of exact copies costs one row.
2. Signatures are cut into bands.  Rows that share a band form a bucket.  Each
   member is proposed against one pivot, never against all others: the member
   that meets the most rows over all its bands, which in a group of near copies
   is the text that they were made from.  A proposal is checked on the
   signatures, then on the full sets.  Members that are not linked with their
   pivot get another one, round after round, as long as that links many.
3. Links become components by alternating large-star and small-star.
4. What could still link two components is found without pairing members.  All
   members of buckets with one pivot p are written as their differences to p's
   set: what they have more, and what they lack.  Two sets are as far apart as
   their differences are, so linked members share many differences, and one of
   the rarest few of each (prefix filtering, the order is that of frequency
   within p).  Texts that have a passage in common, or lack the same shingles of
   p, so meet only if they also share something rare.  A difference that only
   one component has is no key, and where one component holds most of a key,
   its members are not paired among themselves.

So no bucket is capped and no candidate is lost, while a group of near copies
costs about as many checks as it has members.

Shingles are compared by 64-bit hashes: for two texts of a million words each
the odds that any of their shingles collide are below one in ten million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrion.llm.bytewords import SPACED, mix, pieces, shingles
from papyrion.llm.scratch import Scratch


@dataclass(frozen=True)
class NearDedupConfig:
    """``bands`` bands of ``rows`` minima each.

    A pair at the threshold of 0.8 shares no band with odds of
    (1 - 0.8**5)**32 = 3e-6, and a larger similarity makes that smaller.
    ``signature_floor`` is the share of equal minima under which a pair is not
    compared in full.  With 160 minima the share is within 0.2 of the similarity
    (five standard deviations), so what it rejects is under 0.6.
    """

    shingle_words: int = 5
    threshold_percent: int = 80
    bands: int = 32
    rows: int = 5
    signature_floor: float = 0.4
    #: Ids (8 bytes each) that are broadcast to pick texts; beyond that the join is left to Spark.
    broadcast_ids: int = 500_000
    #: Another round of pivots follows one that has linked at least 1 of so many proposed pairs.
    worthwhile: int = 8


_SIGNED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("sig", pa.list_(pa.int32()))])
_SETS = pa.schema([("doc_id", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("shingle_set", pa.list_(pa.int64()))])


def _row_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    for piece in pieces(column):
        starts, ends, offsets = piece.words(SPACED)
        hashes = piece.hashes(starts, ends)
        for a, b in zip(offsets[:-1], offsets[1:]):
            yield shingles(hashes[a:b], k)


def _fingerprints(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two 64-bit columns: the first half of the SHA-256 of each sorted set."""
    digests = np.frombuffer(b"".join(hashlib.sha256(s).digest()[:16] for s in sets), np.int64).reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(digests[:, i])) for i in (0, 1)]


def minima(values: np.ndarray, multipliers: np.ndarray, addends: np.ndarray) -> np.ndarray:
    """The least a*x+b modulo 2**32 over the set, for each (a, b)."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, (np.multiply.outer(multipliers, x[at : at + 1024]) + addends[:, None]).min(axis=1), out=out)
    return out


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n fixed members of the universal family a*x+b, a odd."""
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> np.uint64(32)).astype(np.uint32)


def _list(values: list[np.ndarray], kind: pa.DataType, dtype) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values).view(dtype) if values else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def _sign(k: int, n_minima: int):
    def run(batches):
        a, b = hash_family(n_minima)
        for batch in batches:
            ids = batch.column(0)
            for at in range(0, batch.num_rows, 2048):
                sets = list(_row_sets(batch.column(1).slice(at, 2048), k))
                sigs = [minima(s, a, b) if len(s) else np.zeros(0, np.uint32) for s in sets]
                columns = [ids.slice(at, 2048), batch.column(2).slice(at, 2048), pa.array(list(map(len, sets)), pa.int64()), *_fingerprints(sets), _list(sigs, pa.int32(), np.int32)]
                yield pa.RecordBatch.from_arrays(columns, schema=_SIGNED)

    return run


def _full_sets(k: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = list(_row_sets(batch.column(1).slice(at, 512), k))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 512), *_fingerprints(sets), _list(sets, pa.int64(), np.int64)], schema=_SETS)

    return run


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each ``a`` has one edge and no ``b`` is the ``a`` of another."""
    roles = edges.select(F.col("a").alias("x"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    sums = roles.groupBy("x").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return sums.where("low > 1 or (low > 0 and high > 0)").isEmpty()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "star") -> DataFrame:
    """(node, component) for each node of ``edges`` (u, v: long); component is the least node reachable.

    Alternates large-star and small-star until no edge changes.  Minima combine
    before each shuffle, and a hub's edges are an ordinary join that Spark
    splits when it is skewed.  Null ends and self loops are left out.
    """
    old = scratch.save(edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), f"{name}0")
    turn = 0
    while not _is_star_forest(old):
        both = old.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(old.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # written, so that both sides of the join below are plain exchanges, of which a hub's is split
        least = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-least{turn}")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = small.unionByName(root.select("a", F.col("m").alias("b"))).distinct()
        old, turn = scratch.save(new, f"{name}{turn + 1}"), turn + 1
        scratch.drop(f"{name}{turn - 1}")
        scratch.drop(f"{name}-least{turn - 1}")
    roots = old.select(F.col("b").alias("node")).distinct()
    return old.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def near_duplicates(docs: DataFrame, config: NearDedupConfig = NearDedupConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are maximal runs without white space, A-Z lower-cased.  Rows are
    linked when the similarity of their sets of shingles reaches the threshold.
    A text with fewer words than a shingle is one shingle; a null, empty or
    blank text has none, is linked with nothing, and is kept.  Rows repeated in
    full are one document; different texts under one id are judged each by its
    own.  A row without an id has a null component and is
    kept.  Other columns of ``docs`` are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.lit(0).cast("long").alias("text_key"))
    return _judge(texts, config, Scratch(docs.sparkSession, "dedup")).drop("text_key")


def _judge(texts: DataFrame, config: NearDedupConfig, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of the rows doc_id, text, text_key."""
    k, n_minima = config.shingle_words, config.bands * config.rows
    signed = texts.mapInArrow(_sign(k, n_minima), "doc_id long, text_key long, n_shingles long, fp1 long, fp2 long, sig array<int>")
    signed = scratch.save(signed, "signed")

    same = ["n_shingles", "fp1", "fp2"]
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    reps = usable.groupBy(*same).agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    # ids may repeat under different texts, so each set has a number of its own
    reps = scratch.save(reps.withColumn("node", F.monotonically_increasing_id()), "reps")

    band = F.array(*(F.xxhash64(F.slice("sig", i * config.rows + 1, config.rows), F.lit(i)) for i in range(config.bands)))
    banded = reps.select("node", F.explode(band).alias("band"))
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = scratch.save(banded.join(buckets, "band"), "members")
    weights = members.groupBy("node").agg(F.sum("members").alias("weight"))
    weighed = scratch.save(members.join(weights, "node").select("band", "node", "weight"), "weighed")
    scratch.drop("members")

    sets = _sets_of(reps.join(weighed.select("node").distinct(), "node"), texts, config, scratch)
    places, links = _pivot_links(weighed, reps.select("node", "sig"), sets, config, scratch)
    first = scratch.save(connected_components(links, scratch, "first"), "components")
    more = _links_between(places, first, sets, config, scratch)
    second = scratch.save(connected_components(more, scratch, "second"), "merged")

    found = reps.select(*same, "doc_id", "node").join(first, "node", "left").select(*same, "doc_id", F.coalesce("component", "node").alias("node"))
    found = found.join(second, "node", "left").select(*same, "doc_id", F.coalesce("component", "node").alias("node"))
    least = found.groupBy("node").agg(F.min("doc_id").alias("found"))
    found = scratch.save(found.join(least, "node").select(*same, "found"), "found")
    scratch.drop_all_but("signed", "found")
    rows = signed.select("doc_id", "text_key", *same).join(found, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return rows.select("doc_id", "text_key", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _few(ids: DataFrame, config: NearDedupConfig) -> DataFrame:
    """Saved ids or keys, broadcast if they are few; else Spark chooses, and texts may be shuffled."""
    return F.broadcast(ids) if ids.count() <= config.broadcast_ids else ids


def _sets_of(reps: DataFrame, texts: DataFrame, config: NearDedupConfig, scratch: Scratch) -> DataFrame:
    """(node, shingle_set) of the given rows of distinct sets (doc_id, fp1, fp2, node)."""
    wanted = _few(scratch.save(reps.select("doc_id", "fp1", "fp2", "node"), "wanted"), config)
    sets = texts.select("doc_id", "text").join(wanted.select("doc_id"), "doc_id", "left_semi").mapInArrow(_full_sets(config.shingle_words), "doc_id long, fp1 long, fp2 long, shingle_set array<bigint>")
    return scratch.save(sets.join(wanted, ["doc_id", "fp1", "fp2"]).select("node", "shingle_set"), "sets")


def _linked_pairs(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, config: NearDedupConfig) -> DataFrame:
    """The pairs (u, v) whose signatures are near enough and whose full sets reach the threshold."""
    least = int(config.signature_floor * config.bands * config.rows)
    left, right = (signatures.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "uv")
    equal = F.aggregate(F.zip_with("sig_u", "sig_v", lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    near = pairs.join(left, "u").join(right, "v").where(equal >= least).select("u", "v").distinct()
    a, b = (sets.select(F.col("node").alias(x), F.col("shingle_set").alias(f"set_{x}")) for x in "uv")
    common = F.size(F.array_intersect("set_u", "set_v"))
    both = near.join(a, "u").join(b, "v").select("u", "v", F.size("set_u").alias("nu"), F.size("set_v").alias("nv"), common.alias("common"))
    return both.where(100 * F.col("common") >= config.threshold_percent * (F.col("nu") + F.col("nv") - F.col("common"))).select("u", "v").distinct()


def _pivot_links(members: DataFrame, signatures: DataFrame, sets: DataFrame, config: NearDedupConfig, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, pivot) of the first round, and the links (u, v) of all rounds.  ``members``: band, node, weight."""
    places, links, turn = None, None, 0
    while True:
        pivots = members.groupBy("band").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("pivot"))
        placed = scratch.save(members.join(pivots, "band").where("node <> pivot"), f"placed{turn}")
        pairs = scratch.save(placed.select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct(), f"pairs{turn}")
        linked = scratch.save(_linked_pairs(pairs, signatures, sets, config), f"linked{turn}")
        places = pairs.select(F.col("u").alias("node"), F.col("v").alias("pivot")) if places is None else places
        links = linked if links is None else links.unionByName(linked)
        if config.worthwhile * linked.count() <= pairs.count():
            return places, links
        left = placed.join(linked.select(F.col("u").alias("node"), F.col("v").alias("pivot")), ["node", "pivot"], "left_anti").select("band", "node", "weight")
        going = left.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
        members = scratch.save(left.join(going, "band"), f"open{turn}")
        turn += 1


def _links_between(places: DataFrame, components: DataFrame, sets: DataFrame, config: NearDedupConfig, scratch: Scratch) -> DataFrame:
    """The links between components as pairs (u, v) of components, among nodes that have a pivot in common.

    Let R be a member's differences to the pivot p, c = (100 - percent) /
    (100 + percent), and |u| a set's size.  Two sets are linked if their difference,
    which is that of their R, is at most c * (|u| + |v|).  So linked ones share at
    least o = (|R_u| + |R_v| - c * (|u| + |v|)) / 2 differences, which is no less
    than |R_u| - |u| * (100 - percent) / percent: one of the first |R_u| - o + 1
    of R_u, in any order that both keep, is among the first |R_v| - o + 1 of R_v.

    One of two linked members from different components, u, is not in p's
    component and so not linked with p: |R_u| > c * (|u| + |p|).  If the other, v,
    is in p's component, o is more than (|R_v| + c * (|p| - |v|)) / 2.
    """
    percent = config.threshold_percent
    of = lambda x: components.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    spaces = places.join(of("node"), "node", "left").join(of("pivot"), "pivot", "left")
    spaces = spaces.select(F.col("pivot").alias("p"), F.col("node").alias("m"), F.coalesce("c_node", "node").alias("c"), F.coalesce("c_pivot", "pivot").alias("cp"))
    spaces = scratch.save(spaces, "spaces")
    # some member outside p's component, and another of another component
    mixed = spaces.groupBy("p").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("p")
    spaces = spaces.join(mixed, "p")
    own, pivots = sets.select(F.col("node").alias("m"), F.col("shingle_set").alias("s")), sets.select(F.col("node").alias("p"), F.col("shingle_set").alias("t"))
    more, lacks = F.array_except("s", "t"), F.transform(F.array_except("t", "s"), lambda x: F.bitwise_not(x))  # a lacking member is its hash's complement
    around = spaces.join(own, "m").join(pivots, "p").select("p", "m", "c", "cp", F.size("s").alias("n"), F.size("t").alias("np"), more.alias("more"), lacks.alias("lacks"))
    around = around.select("p", "m", "c", "cp", "n", "np", F.size("more").alias("a"), F.size("lacks").alias("l"), F.concat("more", "lacks").alias("r"))
    around = scratch.save(around.dropDuplicates(["p", "m"]), "around")

    each = around.select("p", "m", "c", F.explode("r").alias("d"))
    held = each.groupBy("p", "d", "c").agg(F.count(F.lit(1)).alias("k"))
    keys = held.groupBy("p", "d").agg(F.sum("k").alias("f"), F.max_by("c", "k").alias("top"), F.count(F.lit(1)).alias("kinds")).where("f > 1")
    keys = scratch.save(keys, "keys")
    item = F.struct(F.coalesce("f", F.lit(1)).alias("f"), F.col("d"), F.when(F.col("kinds") > 1, F.col("top")).alias("top"))
    ranked = each.join(keys, ["p", "d"], "left").groupBy("p", "m").agg(F.array_sort(F.collect_list(item)).alias("r"))

    q = (F.size("r") + (F.col("np") - F.col("n")) * (100 - percent) / F.lit(100.0 + percent)) / 2
    short = F.floor(F.col("n") * (100 - percent) / F.lit(float(percent)) + 1e-9).cast("int") + 1
    prefix = F.when(F.col("c") == F.col("cp"), F.least(short, F.size("r") - F.floor(q).cast("int"))).otherwise(short)
    first = around.drop("r").join(ranked, ["p", "m"]).select("p", "m", "c", "n", "a", "l", F.size("r").alias("len"), F.posexplode(F.slice("r", 1, F.greatest(prefix, F.lit(0)))).alias("at", "e"))
    # keys of one component are left out here, when each place in the order is known
    entries = scratch.save(first.where("e.top is not null").select("p", F.col("e.d").alias("d"), F.col("e.top").alias("top"), "m", "c", "n", "a", "l", "len", "at"), "entries")
    side = lambda i: entries.select("p", "d", *(F.col(x).alias(x + i) for x in ("m", "c", "n", "a", "l", "len", "at", "top")))
    need = f"((len1 + len2 - {100 - percent} * (n1 + n2) / {100.0 + percent}) / 2 - 1e-9)"
    fits = f"c1 <> c2 and {percent} * greatest(n1, n2) <= 100 * least(n1, n2) and least(a1, a2) + least(l1, l2) >= {need} and least(len1 - at1, len2 - at2) >= {need}"
    pairs = side("1").where("c1 <> top1").join(side("2"), ["p", "d"]).where(fits)
    pairs = pairs.select(F.greatest("m1", "m2").alias("u"), F.least("m1", "m2").alias("v"), "p").groupBy("u", "v").agg(F.min("p").alias("p"))
    pairs = scratch.save(pairs, "others")

    left, right = (around.select("p", F.col("m").alias(x), F.col("c").alias(f"c_{x}"), F.col("n").alias(f"n_{x}"), F.col("r").alias(f"r_{x}")) for x in "uv")
    apart = F.size("r_u") + F.size("r_v") - 2 * F.size(F.array_intersect("r_u", "r_v"))
    sizes = F.col("n_u") + F.col("n_v")
    linked = pairs.join(left, ["p", "u"]).join(right, ["p", "v"]).where(100 * (sizes - apart) >= percent * (sizes + apart))
    return linked.select(F.col("c_u").alias("u"), F.col("c_v").alias("v")).distinct()


def keep_one_of_each_group(docs: DataFrame, config: NearDedupConfig = NearDedupConfig()) -> DataFrame:
    """The rows of ``docs`` without those that ``near_duplicates`` drops; columns unchanged.

    Rows are told apart by id and text, so of different texts under one id each
    goes or stays by itself.  Of rows that repeat id and text one stays.
    """
    scratch = Scratch(docs.sparkSession, "dedup")
    key = {"doc_id": F.col("doc_id").cast("long"), "text_key": F.xxhash64("text")}
    texts = docs.select(key["doc_id"].alias("doc_id"), F.col("text").cast("string").alias("text"), key["text_key"].alias("text_key"))
    rows = _judge(texts, config, scratch).groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("kept"))
    rows = scratch.save(rows.where("doc_id is not null and (n > 1 or not kept)"), "rows")
    scratch.drop_all_but("rows")
    keyed = docs.withColumn(_ID, key["doc_id"]).withColumn(_KEY, key["text_key"])
    named = lambda which: _few(rows.where(which).select(F.col("doc_id").alias(_ID), F.col("text_key").alias(_KEY)), config)
    out = keyed.join(named("true"), [_ID, _KEY], "left_anti").select(*docs.columns)
    repeated = keyed.join(named("kept"), [_ID, _KEY], "left_semi").dropDuplicates([_ID, _KEY])
    return out.unionByName(repeated.select(*docs.columns))


_ID, _KEY = "papyrion_id", "papyrion_text_key"
