"""Counts of terms and of pairs of terms by window of texts, and that no row is made for each word or pair."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from papyrion.functions import text as T
from papyrion.operators import embedding
from papyrion.operators.embedding import EmbeddingConfig

ODD = ["", " ", "\x0ba\x0bb\x0c", "a b c d", "\r\n\tA a\t", "Ärger ärger", "x\x1cy z\x85w", "a " * 500, "İ i̇", "a"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_counted_without_a_row_for_each_word(spark):
    docs = spark.createDataFrame([(i, f"a b c{i % 5} a") for i in range(40)], "doc_id int, content string")
    for plan in (_plan(embedding.vocabulary(docs)), _plan(embedding.term_vectors(docs))):
        assert "Generate" not in plan and "explode" not in plan


def test_vocabulary_has_the_words_of_the_column_expression(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None, *ODD[3:]])], "doc_id int, content string").repartition(3)
    expected = docs.select(F.explode(F.array_distinct(T.words(F.lower("content")))).alias("term")).groupBy("term").count()
    got = embedding.vocabulary(docs, EmbeddingConfig(min_documents=1))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("window, cells", [(1, 1 << 24), (40, 1 << 24), (40, 0), (1 << 20, 0), (1 << 20, 1 << 24)])
def test_pairs_equal_plain_loops_for_any_window_of_texts(monkeypatch, window, cells):
    monkeypatch.setattr(embedding, "_WINDOW", window)
    monkeypatch.setattr(embedding, "_CELLS", cells)
    monkeypatch.setattr(embedding, "_ROWS", 3)
    rng = random.Random(7)
    texts = [" ".join(rng.choice("a b c d e f".split()) for _ in range(rng.randrange(12))) + rng.choice(["", " ", "\n"]) for _ in range(60)] + ["", " a  b ", "a", ""]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 25])], names=["text"]) for i in range(0, len(texts), 25)]
    terms, expected, holders = [b"c", b"a", b"e", b"b"], Counter(), Counter()
    for t in texts:
        words = [w.encode() for w in t.split()]
        holders.update(set(words))
        for i, x in enumerate(words):
            for y in words[i + 1 : i + 4]:
                if x in terms and y in terms:
                    low, high = sorted((terms.index(x), terms.index(y)))
                    expected[low * len(terms) + high] += 1
    got = Counter()
    for b in embedding._count_pairs(terms, 3)(batches):
        for cell, n in zip(*(c.to_pylist() for c in b.columns)):
            got[cell] += n
    assert got == expected
    counted = Counter()
    for b in embedding._count_holders(iter(batches)):
        for term, n in zip(*(c.to_pylist() for c in b.columns)):
            counted[term.encode()] += n
    assert counted == holders


def test_a_task_hands_on_no_more_rows_than_cells():
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(20)])
    batches = [pa.RecordBatch.from_arrays([pa.array([" ".join(rng.choice(words, 200)) for _ in range(50)])], names=["text"]) for _ in range(4)]
    out = list(embedding._count_pairs([w.encode() for w in words], 4)(batches))
    assert sum(b.num_rows for b in out) == 20 * 21 // 2
    assert sum(sum(b.column(1).to_pylist()) for b in out) == 4 * 50 * (199 + 198 + 197 + 196)
