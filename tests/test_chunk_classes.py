"""Learned chunk types: exact against plain loops, right on unlabelled chunks, odd inputs."""

import math
import random
from collections import Counter

from papyrion.config import from_mapping
from papyrion.operators import chunk_classes
from papyrion.operators.chunk_classes import ChunkClassesConfig
from papyrion.plans import pipeline

PHRASES = {"example": "for example", "warning": "caution: mind", "summary": "in summary", "reference": '(see annex 7)'}


def corpus(n, seed):
    """Every second text has its type's phrase at its end, the others only words of the type."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = sorted(PHRASES)[i // 2 % 4]
        words = [f"{kind[:3]}{rng.randrange(15)}" if rng.random() < 0.5 else f"common{rng.randrange(25)}" for _ in range(25)]
        out.append((i, kind, " ".join(words) + ("\n\n" + PHRASES[kind] if i % 2 == 0 else "")))
    return out


def plain(rows, config):
    kinds = list(PHRASES)
    seeds = [(k, set(t.lower().split())) for k in kinds for _, _, t in rows if PHRASES[k] in t]
    n, of_term = Counter(k for k, _ in seeds), Counter(w for _, ws in seeds for w in ws)
    of_both, labels = Counter((w, k) for k, ws in seeds for w in ws), [k for k in chunk_classes.LABELS if k in PHRASES]
    known = sorted((w for w, c in of_term.items() if c >= config.min_chunks), key=lambda w: (-of_term[w], w))[: config.terms]
    out = {}
    for i, _, t in rows:
        terms = set(t.split("\n\n")[0][: config.head_chars].lower().split()) & set(known)
        scores = []
        for at, k in enumerate(labels):
            gain = lambda w: math.floor(1000 * math.log((of_both[w, k] * len(seeds) + config.smoothing * of_term[w]) / (of_term[w] * (n[k] + config.smoothing))))  # noqa: B023, E731
            scores.append((-math.floor(1000 * math.log((n[k] + 1) / (len(seeds) + len(labels)))) - sum(map(gain, terms)), at, k))
        scores.sort()
        out[i] = (scores[0][2], scores[1][0] - scores[0][0]) if terms else (None, None)
    return out


def test_equals_plain_loops(spark):
    rows, config = corpus(120, 1), ChunkClassesConfig(terms=40, min_chunks=3, head_chars=60)
    chunks = spark.createDataFrame(rows, "chunk_id int, kind string, content string").repartition(3)
    got = chunk_classes.classify(chunks, chunk_classes.train(chunks, config)).collect()
    assert {r["chunk_id"]: (r["learned_type"], r["margin"]) for r in got} == plain(rows, config)


def test_texts_without_a_phrase_get_their_type(spark):
    chunks = spark.createDataFrame(corpus(400, 2), "chunk_id int, kind string, content string")
    got = chunk_classes.classify(chunks, chunk_classes.train(chunks)).where("chunk_id % 2 = 1").collect()
    assert len(got) == 200 and sum(r["chunk_type"] == r["kind"] for r in got) >= 195


def test_margin_too_small_leaves_the_rules(spark):
    chunks = spark.createDataFrame(corpus(80, 3), "chunk_id int, kind string, content string")
    got = chunk_classes.classify(chunks, chunk_classes.train(chunks, ChunkClassesConfig(least_margin=10**9))).collect()
    assert all(r["chunk_type"] == (r["kind"] if r["chunk_id"] % 2 == 0 and r["kind"] != "reference" else "unknown") for r in got)


def test_odd_inputs(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "for example one two", "x"), (4, "unmet words", "x"), (5, "one " * 50_000, "x")]
    odd = spark.createDataFrame(rows, "chunk_id int, content string, term string").selectExpr("*", "'old' as chunk_type", "1 as gains", "2 as label")
    model = chunk_classes.train(spark.createDataFrame([("for example one two",)] * 6, "content string"))
    assert model.labels == ["example"]
    got = {r["chunk_id"]: r for r in chunk_classes.classify(odd, model).collect()}
    assert len(got) == 5 and [got[i]["chunk_type"] for i in (1, 2, None, 4, 5)] == ["unknown", "unknown", "example", "unknown", "unknown"]
    assert (got[5]["learned_type"], got[5]["margin"], got[4]["learned_type"], got[None]["margin"]) == ("example", 0, None, None)
    assert set(got[1].asDict()) == {"chunk_id", "content", "term", "gains", "label", "learned_type", "margin", "chunk_type"}


def test_nothing_to_learn_from(spark):
    chunks = spark.createDataFrame([(1, "plain words"), (2, None)], "chunk_id int, content string")
    model = chunk_classes.train(chunks)
    assert model.labels == [] and model.gains.count() == 0
    assert [r["chunk_type"] for r in chunk_classes.classify(chunks, model).collect()] == ["unknown"] * 2
    assert chunk_classes.classify(chunks.limit(0), model).count() == 0


def test_a_run_with_learned_types(spark):
    """Pages of one paragraph each; without the setting those without a phrase have no type."""
    pages = spark.createDataFrame([(f"d{i}", 1, t.replace("\n\n", " "), k) for i, k, t in corpus(160, 4)], "doc_id string, page_number int, content string, kind string")
    pages = pages.selectExpr("*", "length(content) as char_count", "'text' as extraction_method", "false as extraction_failed")
    ruled = pipeline.process_pages(pages.drop("kind"), from_mapping({"chunking": {"min_chunk_size": 1}}))[1]
    typed = pipeline.process_pages(pages.drop("kind"), from_mapping({"learned_types": True, "chunking": {"min_chunk_size": 1}}))[1]
    assert typed.schema.names == ruled.schema.names
    kinds = pages.select("doc_id", "kind")
    right = lambda chunks: chunks.join(kinds, "doc_id").where("chunk_type = kind").count()
    n = typed.count()
    assert n >= 160 and right(typed) >= 0.95 * n and right(ruled) <= 0.5 * n
