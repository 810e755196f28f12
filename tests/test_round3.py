"""Plans and limits of queries whose cost grew faster than their input."""

import contextlib
import io

from pyspark.sql import functions as F

from papyrion.functions import quality
from papyrion.operators import chunking, extensions
from papyrion.plans import catalog
from papyrion.sources import files

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_vec_meta_compares_no_chunks(spark):
    assert "array_intersect" not in plan(catalog.QUERIES["vec_meta"](spark, FOLDER))


def test_pages_offsets_shuffle_no_text(spark):
    pages = spark.createDataFrame([("a", 2, "one two"), ("a", 1, "three"), (None, 1, "x"), ("b", 1, "")], "doc_id string, page_number int, content string")
    for f, gap in ((chunking.page_offsets, 2), (chunking.spaced_offsets, 1)):
        got = {(r["doc_id"], r["page_number"]): (r["start_offset"], r["end_offset"]) for r in f(pages).collect()}
        assert got == {("a", 1): (0, 5), ("a", 2): (5 + gap, 12 + gap), (None, 1): (0, 1), ("b", 1): (0, 0)}
        text = plan(f(pages))
        assert "content" not in text[text.index("Window") : text.index("Exchange")]


def test_windows_of_equal_pages(spark):
    # equal page numbers and texts, and a document without a name
    pages = spark.createDataFrame([(d, 1, "word " * 700) for d in ("a", "a", None, None)], "doc_id string, page_number int, content string")
    got = sorted((r["doc_id"] or "", r["chunk_index"], r["start_offset"], r["end_offset"]) for r in chunking.window_offsets(pages).collect())
    one = [(0, 0, 4997), (1, 3999, 6997)]
    assert [x[1:] for x in got if x[0] == ""] == [x[1:] for x in got if x[0] == "a"] and len(got) == 2 * len(one)
    assert [x[1] for x in got if x[0] == "a"] == [0, 1] and [x[2] for x in got if x[0] == "a"] == [0, 3999]


def test_repeats_counts_long_words(spark):
    rows = spark.createDataFrame([(1, "word " * 8), (2, "Word " * 5 + "x word " * 4), (3, "the " * 20), (4, ""), (5, None)], "i int, content string")
    got = {r["i"]: r["r"] for r in rows.select("i", quality.repeats(F.col("content"), 8).alias("r")).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False, 5: False}


def test_letters_that_occur_once(spark):
    many = "".join(chr(0x4E00 + i) for i in range(1100))
    rows = spark.createDataFrame([("a", many), ("b", many[:300] + "a" * 900), ("c", many[:500] + "a " * 300), ("d", "plain text " * 200), ("e", "x")], "doc_id string, content string")
    assert {r["doc_id"]: r["valid"] for r in files.valid_extractions(rows).collect()} == {"a": False, "b": True, "c": False, "d": True, "e": False}


def test_topics_make_no_document_dense(spark):
    rows = [(i, ("red green blue " if i % 2 else "one two three ") * 5) for i in range(20)]
    found = extensions.topics(spark.createDataFrame(rows, "doc_id int, content string"), 2)
    assert sorted(r["documents"] for r in found.collect()) == [10, 10]
    text = plan(found)
    assert "aggregate_metrics" in text.lower() or "summar" in text.lower() or "ObjectHashAggregate" in text
