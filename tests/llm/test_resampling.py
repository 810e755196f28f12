"""Importance resampling: weights by plain loops, ranks of the radix sort against ``sorted``."""

import math
import random
import re
import zlib
from hashlib import sha256

import pytest

from papyrion.llm import resampling
from papyrion.llm.resampling import ResamplingConfig
from papyrion.llm.scratch import Scratch


def plain(docs, target, config):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    runs = lambda w: [" ".join(w[i : i + n]) for n in range(1, config.max_run + 1) for i in range(len(w) - n + 1)]
    place = lambda f: zlib.crc32(f.encode()) % config.buckets
    s, t = [0] * config.buckets, [0] * config.buckets
    for _, x in docs:
        for f in runs(words(x)):
            s[place(f)] += 1
    for x in target:
        for f in runs(words(x)):
            t[place(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + config.buckets) / ((a + 1) * (sum(t) + config.buckets)))) for a, b in zip(s, t)]
    out = []
    for i, x in docs:
        f = runs(words(x))
        w = sum(gain[place(y)] for y in f)
        h = int(sha256(f"{config.seed}:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), w, None if i is None else w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(x))])
    can = sorted((r for r in out if r[4] >= config.min_words and r[0] is not None), key=lambda r: (-r[3], r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(can[: len(can) * config.draw_percent // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("config", [ResamplingConfig(min_words=3, draw_percent=40, block_rows=8, digit_bits=3), ResamplingConfig(max_run=3, buckets=50, min_words=5, draw_percent=100)])
def test_weights_and_ranks(spark, config):
    rng = random.Random(5)
    text = lambda: " ".join(rng.choice(["Alpha", "béta", "x1", "γ", "end.of", "--"]) for _ in range(rng.randrange(12)))
    docs = [(i, text()) for i in range(-20, 120)] + [(500, None), (501, ""), (None, "alpha alpha alpha alpha alpha"), (502, "word " * 50_000)]
    target = [text() for _ in range(9)] + [None]
    got = resampling.resample(spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, score int, rank int").repartition(5), spark.createDataFrame([(x,) for x in target], "text string"), config)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, target, config)


def test_parts_of_a_long_text_join(monkeypatch):
    monkeypatch.setattr(resampling, "_PART", 7)
    text, before, found = b"one two three four five six seven", [], []
    for words in resampling.word_lists(text):
        found += resampling.features(words, 3, before)
        before = resampling._tail(before, words, 3)
    w = text.split()
    assert sorted(found) == sorted(b" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))


@pytest.mark.parametrize("ids", [[2**63 - 1, -(2**63), 0, 5, -5], list(range(1000)), [7] * 50, [3]])
def test_radix_ranks_are_dense_and_in_order(spark, ids):
    rng = random.Random(1)
    rows = [(i, rng.choice([-4, 0, 9, 10**12])) for i in ids]
    scratch = Scratch(spark, "test")
    table = scratch.save(spark.createDataFrame(rows, "a long, b long").repartition(3), "rows")
    got = resampling.radix_ranks(table, [("b", True), ("a", False)], scratch, ResamplingConfig(block_rows=16)).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, len(ids) + 1))
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["rank"])] == sorted(rows, key=lambda r: (-r[1], r[0]))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(docs, docs.select("text")).count() == 0
    one = resampling.resample(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), docs.select("text"), ResamplingConfig(min_words=1, draw_percent=100)).first()
    assert (one["n_features"], one["rank"]) == (3, 1)
