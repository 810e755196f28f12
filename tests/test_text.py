"""Golden rows for text functions, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from papyrion.functions import chunk_text, metadata, quality
from papyrion.functions import text as T
from papyrion.operators import chunking


def value(spark, column, **given):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in given.items())).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "line,kind",
    [("Introduction", "header"), ("Introduction: scope", "special_section"), ("Chapter 1", None), ("Chapter 12", "chapter"), ("Chapter 1: Intro", "chapter"), ("1. Setup", "section"), ("1. setup", "section"), ("1. 2nd", "list_item"), ("- item", "list_item"), ("1.1 install", "subsection"), ("1.1.1 Deep", "subsubsection"), ("Über uns", None)],
)
def test_element_types(spark, line, kind):
    assert value(spark, chunking.element_type(F.col("s")), s=line) == kind


@pytest.mark.parametrize("text,day", [("05/01/2024", "2024-01-05"), ("01/31/2024", "2024-01-31"), ("13/25/2024", None), ("5.1.24", None), ("2024-03-09", "2024-03-09"), ("9 March 2024", "2024-03-09")])
def test_dates(spark, text, day):
    found = value(spark, metadata.parse_date("s"), s=text)
    assert (str(found) if found else None) == day


@pytest.mark.parametrize("text,lang", [("This is the text that we have from the start and with care for you.", "en"), ("Das ist der Text und die Daten sind mit dem Haus von uns, dass wir haben.", "de"), ("xyz qqq", "unknown")])
def test_language(spark, text, lang):
    assert value(spark, metadata.language("s"), s=text) == lang


@pytest.mark.parametrize("text,conf,complete", [("", 0.0, 0.7), ("short text", 0.3402, 0.7), ("Ends well. " * 6, 0.9, 0.9), ("word " * 59 + "word.", 0.9, 1.0), ("```code\n" + "w " * 60, 0.9, 0.5)])
def test_confidence_and_completeness(spark, text, conf, complete):
    assert value(spark, chunk_text.confidence("s", T.word_count("s")), s=text) == pytest.approx(conf)
    assert value(spark, chunk_text.completeness("s"), s=text) == pytest.approx(complete)


@pytest.mark.parametrize("n,sizes", [(9, []), (10, [10]), (805, [805]), (1800, [1000, 1000, 200]), (2500, [1000, 1000, 900, 100])])
def test_windows(spark, n, sizes):
    parts = value(spark, chunking.window_texts("s", 1000, 800, 10), s=" ".join(["w"] * n))
    assert [len(p.split()) for p in parts] == sizes


def test_packing_keeps_order_and_words(spark):
    text = "\n\n".join(" ".join(f"p{i}w{j}" for j in range(i + 1)) for i in range(12))
    packed = value(spark, chunking.packed(chunking.paragraphs("s"), 10), s=text)
    assert "\n\n".join(packed) == text
    assert all(len(p.split()) <= 10 or "\n\n" not in p for p in packed)


def test_scores_stay_within_bounds(spark):
    texts = ["", "x", "The end. " * 50, "a|b\n|||\nc|\n" * 5, "word " * 3000, "�     \n\n", "- a\n\n\n\n\n- b"]
    rows = spark.createDataFrame([(t,) for t in texts], "content string").withColumns({"token_count": T.word_count("content"), "char_count": F.length("content")})
    given = {c: F.col(c) for c in ("content", "token_count", "char_count")} | {c: F.lit(None).cast("string") for c in ("chapter", "section", "previous_chunk_id", "next_chunk_id", "chunk_type")}
    total = sum((check(given)["score"] for check in quality.CHECKS.values()), F.lit(0)) / quality.FULL_SCORE * 100
    for row in rows.select(total.alias("s")).collect():
        assert 0 <= row["s"] <= 92.15


def test_null_content_does_not_fail(spark):
    rows = spark.createDataFrame([(1, None), (2, "a b")], "doc_id int, content string")
    assert chunking.overlapping(rows).count() == 0
    assert chunking.create_chunks(rows).count() == 0  # under ten words


@pytest.mark.parametrize(
    "text,names",
    [("Author: Ann Lee; Bob Ray", ["Ann Lee", "Bob Ray"]), ("Authors\n  Max Moe and Lia Poe\nx", ["Lia Poe", "Max Moe"]), ("\u00a9 2020, Eve Stone.", ["Eve Stone"]), ("Author: 12-3", []), ("no names", [])],
)
def test_authors(spark, text, names):
    assert value(spark, metadata.authors("s"), s=text) == names


@pytest.mark.parametrize(
    "text,created,modified",
    [("Created: 05/01/2024 Date: 2023-02-03", "2023-02-03", None), ("Date: 2023-02-03 issued 9 march  2022", "2022-03-09", None), ("March 5, 2021 and 1 May 2020", "2021-03-05", None), ("Revised: 31-12-2023 Modified: 5.1.24", None, "2023-12-31")],
)
def test_dates_in_texts(spark, text, created, modified):
    assert [str(d) if d else None for d in (value(spark, metadata.created_on("s"), s=text), value(spark, metadata.modified_on("s"), s=text))] == [created, modified]
