"""Offsets of fixed windows, and packing, against plain loops; long documents in linear time."""

import random
import time

import pytest
from pyspark.sql import functions as F

from papyrion.operators import chunking
from papyrion.operators.chunking import ChunkingConfig


def plain_windows(texts, size, overlap, least):
    words, out = " ".join(texts).split(), []
    for s in range(0, max(len(words), 1), size - overlap):
        w = words[s : s + size]
        if len(w) >= least:
            start = len(" ".join(words[:s]))
            out.append((len(out), start, start + len(" ".join(w)) - 1))
    return out


@pytest.mark.parametrize("size,overlap,least", [(10, 2, 1), (7, 4, 3), (8, 0, 0), (1000, 200, 10)])
def test_window_offsets(spark, size, overlap, least):
    rng = random.Random(size)
    pages = lambda: [" ".join("x" * rng.randrange(1, 9) for _ in range(rng.choice([0, 1, 5, 8, 30]))) for _ in range(rng.randrange(1, 6))]
    docs = {i: pages() for i in range(30)} | {100: [""], 101: ["", "a b", "", ""], 102: ["w " * 1600], 103: ["w " * 16, "", ""]}
    rows = spark.createDataFrame([(i, k + 1, t) for i, ts in docs.items() for k, t in enumerate(ts)], "doc_id int, page_number int, content string")
    got = {}
    for r in chunking.window_offsets(rows, ChunkingConfig(size=size, overlap=overlap, min_size=10 * least)).collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_index"], r["start_offset"], r["end_offset"]))
    want = {i: w for i, ts in docs.items() if (w := plain_windows(ts, size, overlap, least))}
    assert {i: sorted(v) for i, v in got.items()} == want


def test_a_long_document_costs_in_proportion(spark):
    timed = {}
    for n in (50_000, 50_000, 800_000):
        rows = spark.range(1).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page_number"), F.repeat(F.lit("word "), n).alias("content"))
        began = time.time()
        assert chunking.window_offsets(rows).count() == -(-n // 800)
        timed[n] = time.time() - began
    assert timed[800_000] < 16 * max(timed[50_000], 1.0)


def test_packing_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(chunking, "_BLOCK", 3)
    parts = [" ".join(["w"] * n) for n in (1, 2, 9, 1, 1, 1, 4, 4, 5, 1, 12, 1, 3, 3, 3, 3, 3)]
    row = spark.createDataFrame([(parts,), ([],)], "p array<string>").select(chunking.packed(F.col("p"), 5).alias("t")).collect()
    want, held = [], []
    for p in parts:
        if held and sum(len(h.split()) for h in held) + len(p.split()) > 5:
            want.append("\n\n".join(held))
            held = []
        held.append(p)
    assert row[0]["t"] == [*want, "\n\n".join(held)] and row[1]["t"] == []
