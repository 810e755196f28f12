"""Near duplicates against all pairs, and components."""

import random
import re

from papyrion.llm import near_dedup
from papyrion.llm.near_dedup import NearDedupConfig
from papyrion.llm.scratch import Scratch


def brute_force(rows, k, percent=80):
    sets = {}
    for i, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, n):
    """Groups around bases that are themselves missing or late, chains, and distant copies."""
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(n):
            words = list(base)
            for _ in range(int(len(words) * rng.choice([0, 0.01, 0.03, 0.05, 0.07, 0.1]))):
                p = rng.randrange(len(words))
                if rng.random() < 0.4:
                    del words[p]
                else:
                    words[p] = rng.choice(vocabulary[:40])
            rows.append((1000 - i if group % 2 else i, " ".join(words)))
            i += 1
    chain = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(15):
        chain = list(chain)
        for _ in range(5):
            chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
        rows.append((2000 + i, " ".join(chain)))
        i += 1
    return rows


def test_against_all_pairs(spark):
    rows = near_copies(random.Random(5), 25) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "x " * 30_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for k in (2, 5):
        got = {r["doc_id"]: r for r in near_dedup.near_duplicates(frame, NearDedupConfig(shingle_words=k)).collect()}
        want = brute_force(rows, k)
        assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
        assert all(r["kept"] == (i == want[i][1]) for i, r in got.items())


def test_odd_tables(spark):
    frame = spark.createDataFrame([(1, "a b c", 0), (1, "a b c", 1), (None, "a b c", 2), (None, None, 3)], "doc_id long, text string, kept int")
    got = sorted(near_dedup.near_duplicates(frame).collect(), key=lambda r: (r["doc_id"] is None, r["n_shingles"]))
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got] == [(1, 1, True), (1, 1, True), (None, None, True), (None, None, True)]
    assert near_dedup.near_duplicates(frame.limit(0)).count() == 0
    assert near_dedup.keep_one_of_each_group(frame).columns == frame.columns


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "u long, v long")
    got = {r["node"]: r["component"] for r in near_dedup.connected_components(edges, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
