"""Learned vectors: exact sums against plain loops, and related texts before others."""

import hashlib
import math
import random
from collections import Counter

from papyrion.operators import embedding, vector
from papyrion.operators.embedding import EmbeddingConfig


def plain_vectors(texts, config):
    words = [(t or "").lower().split() for t in texts]
    holders = Counter(w for ws in words for w in set(ws))
    known = sorted((w for w, n in holders.items() if n >= config.min_documents), key=lambda w: (-holders[w], w))[: config.terms]
    pairs = Counter()
    for ws in words:
        for i, x in enumerate(ws):
            for y in ws[i + 1 : i + 1 + config.window]:
                if x in known and y in known:
                    pairs[x, y] += 1
                    pairs[y, x] += 1
    sums = Counter()
    for (a, _), n in pairs.items():
        sums[a] += n
    total, out = sum(sums.values()), {w: [0] * 64 for w in known}
    for (a, b), n in pairs.items():
        v = math.floor(1000 * math.log(n * total / (sums[a] * sums[b])))
        bits = int(hashlib.sha256(b.encode()).hexdigest()[:8], 16), int(hashlib.sha256(b.encode()).hexdigest()[8:16], 16)
        if v > 0:
            for j in range(64):
                out[a][j] += v * (2 * (bits[j // 32] >> j % 32 & 1) - 1)
    return out


def test_vectors_equal_plain_loops(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("Aa b c d e f gg hh".split()) for _ in range(rng.randrange(25))) for _ in range(30)] + [None, "", "only once here"]
    config = EmbeddingConfig(terms=6, window=2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, content string").repartition(3)
    got = {r["term"]: r["vector"] for r in embedding.term_vectors(docs, config).collect()}
    assert got == plain_vectors(texts, config)


def test_related_texts_are_nearest(spark):
    rng = random.Random(5)
    topics = {t: [f"{t}{i}" for i in range(12)] for t in "abcd"}
    docs = []
    for i in range(240):
        t = "abcd"[i % 4]
        docs.append((i, t, " ".join(rng.choice(topics[t]) if rng.random() < 0.6 else f"filler{rng.randrange(20)}" for _ in range(30))))
    # pairs of texts of one topic that have no word in common
    for k, t in enumerate("abcd"):
        docs += [(1000 + k, t, " ".join(topics[t][:6])), (2000 + k, t, " ".join(topics[t][6:]))]
    frame = spark.createDataFrame(docs, "vec_id int, topic string, content string")
    vectors = embedding.term_vectors(frame).cache()
    embedded = embedding.embed(frame, vectors, len(docs), "vec_id").cache()
    found = {r["vec_id"]: r["embedding"] for r in embedded.where("vec_id >= 1000").collect()}
    cosine = lambda x, y: sum(a * b for a, b in zip(found[x], found[y]))
    related = [cosine(1000 + k, 2000 + k) for k in range(4)]
    others = [cosine(1000 + k, 2000 + m) for k in range(4) for m in range(4) if k != m]
    assert min(related) > max(others) and sum(related) / 4 - sum(others) / 12 > 0.3
    queries = embedded.where("vec_id >= 1000").selectExpr("vec_id as query_id", "embedding")
    near = vector.nearest_batch(embedded.where("vec_id < 1000"), queries, 5).join(frame.selectExpr("vec_id", "topic"), "vec_id").join(frame.selectExpr("vec_id as query_id", "topic as wanted"), "query_id")
    assert near.where("topic = wanted").count() >= 0.9 * near.count()


def test_no_terms(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, content string")
    vectors = embedding.term_vectors(docs)
    assert vectors.count() == 0
    assert all(r["embedding"] == [0.0] * 64 for r in embedding.embed(docs, vectors, 2).collect())
