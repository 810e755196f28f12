"""Keyword and substring search against loops and LIKE, and what they read."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from papyrion.operators import substring_index, text_index
from papyrion.operators.substring_index import SubstringConfig
from papyrion.operators.text_index import TextIndexConfig


def plain_bm25(docs, queries, n, c):
    words = {i: (t or "").lower().split() for i, t in docs}
    average = max(1, sum(map(len, words.values()))) / len(words)
    holders = Counter(w for ws in words.values() for w in set(ws))
    out = {}
    for q, text in queries:
        scores = {}
        for i, ws in words.items():
            if i is None:
                continue
            for w in set((text or "").lower().split()) & set(ws):
                idf = math.log(1 + (len(words) - holders[w] + 0.5) / (holders[w] + 0.5))
                tf = ws.count(w)
                scores[i] = scores.get(i, 0) + math.floor(idf * (tf * (c.k1 + 1) / (tf + c.k1 * (1 - c.b + c.b * len(ws) / average))) * 1e6 + 0.5)
        best = sorted(scores.items(), key=lambda r: (-r[1], r[0]))[:n]
        out |= {(q, i, s, k + 1): 1 for k, (i, s) in enumerate(best)}
    return set(out)


@pytest.mark.parametrize("config", [TextIndexConfig(), TextIndexConfig(chunk_rows=16, buckets=3, first_chunks=2, pushed_terms=2)])
def test_bm25_equals_plain_loops(spark, tmp_path, config):
    rng = random.Random(7)
    word = lambda: f"w{min(int(rng.expovariate(0.15)), 60)}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(40)))) for i in range(300)] + [(900, None), (901, " "), (902, "W1 " * 5000), (903, "the hot word"), (904, "the hot word")]
    queries = [(1, "w0 W1 w30"), (2, "hot hot word"), (3, "nowhere"), (4, None), (5, "w55"), (6, " ".join(f"w{i}" for i in range(60)))]
    path = str(tmp_path / "index")
    text_index.build(spark.createDataFrame(docs, "doc_id long, content string").repartition(5), path, config)
    asked = spark.createDataFrame(queries, "query_id int, text string")
    got = text_index.search(spark, path, asked, 5, config)
    assert {tuple(r) for r in got.collect()} == plain_bm25(docs, queries, 5, config)
    assert text_index.search(spark, path, asked.limit(0), 5, config).count() == 0


def test_a_search_reads_its_terms_and_stops_early(spark, tmp_path):
    config = TextIndexConfig(chunk_rows=10, buckets=8, first_chunks=1)
    docs = [(i, "common " + ("rare " * 9 if i == 77 else f"other{i} ") * 2) for i in range(400)]
    path = str(tmp_path / "index")
    text_index.build(spark.createDataFrame(docs, "doc_id long, content string"), path, config)
    asked = spark.createDataFrame([(1, "rare common")], "query_id int, text string")
    found = text_index._open(spark, path, asked, config)
    plan = found.blocks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(term, [" in plan
    assert "docs" not in found.bounds()._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]
    bounds = found.bounds()
    first = text_index._top(found.scored(text_index._ranked(bounds).where("nth <= 1")), 1)
    assert bounds.count() == 40 and text_index.remaining_chunks(bounds, first, 1, config).count() == 0
    assert text_index.search(spark, path, asked, 1, config).first()["doc_id"] == 77


def test_empty_keyword_index(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, content string")
    text_index.build(docs, str(tmp_path / "index"))
    assert text_index.search(spark, str(tmp_path / "index"), spark.createDataFrame([(1, "a")], "query_id int, text string")).count() == 0


def test_fused_ranks(spark):
    a = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "query_id int, doc_id int, place int")
    b = spark.createDataFrame([(1, 6, 1), (1, 7, 2)], "query_id int, doc_id int, place int")
    got = [tuple(r) for r in text_index.fuse([a, b], 2).orderBy("place").collect()]
    assert got == [(1, 6, 1_000_000 // 62 + 1_000_000 // 61, 1), (1, 5, 1_000_000 // 61, 2)]


def test_literal_parts():
    assert substring_index.literal_parts(r"%aB\%c_d%") == ["ab%c", "d"]
    assert substring_index.needed_trigrams("ab_abc%ABCD") == ["abc", "bcd"]
    assert substring_index.literal_parts("%_%") == [] and substring_index.literal_parts("x\\") == ["x"]


def test_substrings_equal_like_on_random_patterns(spark, tmp_path):
    rng = random.Random(11)
    letters = "abAB%_ é日\\"
    text = lambda n: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    rows = [(i, text(14)) for i in range(500)] + [(600, None), (None, "abab"), (601, ""), (602, "ab" * 20_000), (603, "ÀÉab日"), (604, "àéAB日")]
    given = spark.createDataFrame(rows, "id long, text string")
    path, config = str(tmp_path / "index"), SubstringConfig(chunk_rows=32, buckets=4)
    substring_index.build(given, path, config)
    patterns = [f"%{''.join(rng.choice('abAB_%é日') for _ in range(rng.randrange(2, 6)))}%" for _ in range(12)] + ["%àéab%", "", "%", "%zzz%", "%baba%"]
    for p in patterns:
        want = given.where(F.col("id").isNotNull() & F.col("text").ilike(p))
        assert sorted(map(tuple, substring_index.search(spark, path, p, config).collect())) == sorted(map(tuple, want.collect())), p


def test_a_substring_search_reads_its_lists_only(spark, tmp_path):
    path = str(tmp_path / "index")
    substring_index.build(spark.range(3000).selectExpr("id", "concat('Title ', id, ' end') as text"), path)
    found = substring_index.candidates(spark, path, "%title 123%")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(gram, [" in plan
    assert found.count() == 11 + 0  # 123, 1230 to 1239
    assert substring_index.candidates(spark, path, "%xyz%").count() == 0
    assert substring_index.candidates(spark, path, "%12%") is None


def test_scores_add_up_where_a_chunk_lies(spark, tmp_path):
    config = TextIndexConfig(chunk_rows=10)
    docs = spark.createDataFrame([(i, f"common w{i % 3}") for i in range(100)], "doc_id long, content string")
    text_index.build(docs, str(tmp_path / "index"), config)
    found = text_index._open(spark, str(tmp_path / "index"), spark.createDataFrame([(q, "common w1") for q in range(20)], "query_id int, text string"), config)
    scored = found.scored(found.bounds().select("query_id", "chunk"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" not in plan and plan.count("hashpartitioning(chunk") >= 1
    assert scored.count() == 20 * 100
