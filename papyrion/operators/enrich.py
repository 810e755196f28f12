"""Context of chunks: neighbours, position, hierarchy, related chunks, and all of it as one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.functions import chunk_text, quality
from papyrion.functions import text as T

# Heading patterns, case-sensitive, at the start of a stripped line.
CHAPTER = r"^(?:Chapter|CHAPTER)\s+(\d+\.?\d*):?\s*(.+)"
SECTION = r"^(\d+\.?\d*)\s+([A-Z][^.]+)"
SUBSECTION = r"^(\d+\.\d+\.?\d*)\s+(.+)"


def _in_order():
    return Window.partitionBy("doc_id").orderBy("chunk_index")


def navigation(chunks: DataFrame) -> DataFrame:
    """Adds previous_chunk_id, next_chunk_id and position (0 to under 1)."""
    w = _in_order()
    n = F.count(F.lit(1)).over(Window.partitionBy("doc_id"))
    return chunks.withColumns({"previous_chunk_id": F.lag("chunk_id").over(w), "next_chunk_id": F.lead("chunk_id").over(w), "position": (F.row_number().over(w) - 1) / n})


def headings(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk_id, chunk_index, line, level, number, title, chapter, section) in document order.

    Looks at each chunk's first five lines.  A section needs a chapter before
    it, a subsection a section; both carry on over later chapters.
    """
    each = chunks.select("doc_id", "chunk_id", "chunk_index", F.posexplode(F.slice(T.lines("content"), 1, 5)).alias("line", "raw")).withColumn("s", T.stripped("raw"))
    is_chapter = F.col("s").rlike(CHAPTER)
    before = Window.partitionBy("doc_id").orderBy("chunk_index", "line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.where(F.col("s").rlike(r"^(?:Chapter|CHAPTER|\d)")).withColumn("chapter", F.last(F.when(is_chapter, F.regexp_extract("s", CHAPTER, 1)), True).over(before))
    is_section = ~is_chapter & F.col("s").rlike(SECTION) & F.col("chapter").isNotNull()
    each = each.withColumn("section", F.last(F.when(is_section, F.regexp_extract("s", SECTION, 1)), True).over(before))
    is_subsection = F.col("s").rlike(SUBSECTION) & F.col("section").isNotNull()
    level = F.when(is_chapter, "chapter").when(is_section, "section").when(is_subsection, "subsection")
    pattern = {"chapter": CHAPTER, "section": SECTION, "subsection": SUBSECTION}
    part = lambda g: F.coalesce(*(F.when(F.col("level") == k, F.regexp_extract("s", p, g)) for k, p in pattern.items()))
    each = each.withColumn("level", level).where("level is not null")
    return each.select("doc_id", "chunk_id", "chunk_index", "line", "level", part(1).alias("number"), part(2).alias("title"), "chapter", "section")


def hierarchy(chunks: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Adds chapter, section, subsection with their numbers, and depth_level.

    Only a chunk that contains a heading gets a context, from its last heading
    of each level; a chapter's title is that of the first chapter with its
    number in the document.
    """
    found = headings(chunks) if found is None else found
    order = F.struct("chunk_index", "line")
    pick = lambda level, c: F.max_by(F.when(F.col("level") == level, F.col(c)), F.when(F.col("level") == level, order))
    own = found.groupBy("doc_id", "chunk_id").agg(
        pick("chapter", "number").alias("own_chapter"), pick("section", "title").alias("section"), pick("section", "number").alias("section_number"), pick("section", "chapter").alias("section_chapter"),
        pick("subsection", "title").alias("subsection"), pick("subsection", "number").alias("subsection_number"),
    )
    titles = found.where("level = 'chapter'").groupBy("doc_id", F.col("number").alias("chapter_number")).agg(F.min_by("title", order).alias("chapter"))
    own = own.withColumn("chapter_number", F.coalesce("own_chapter", "section_chapter")).join(titles, ["doc_id", "chapter_number"], "left")
    depth = F.when(F.col("subsection").isNotNull(), 3).when(F.col("section").isNotNull(), 2).otherwise(1)
    return chunks.join(own.drop("own_chapter", "section_chapter"), ["doc_id", "chunk_id"], "left").withColumn("depth_level", depth)


def related_chunks(chunks: DataFrame, least: int = 3) -> DataFrame:
    """(doc_id, chunk_id, related_id, related_index, strength): chunks of one document that share concepts.

    Chunks that share ``least`` concepts share one of all but ``least`` - 1 of
    each, in any common order.  With the order of frequency within the document
    the equi-join on document and concept leaves out what most chunks have.
    """
    each = chunks.select("doc_id", "chunk_id", "chunk_index", F.explode(chunk_text.key_concepts("content")).alias("concept"))
    each = each.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "concept")))
    ranked = each.groupBy("doc_id", "chunk_id", "chunk_index").agg(F.array_sort(F.collect_list(F.struct("n", "concept"))).alias("r"))
    ranked = ranked.select("doc_id", "chunk_id", "chunk_index", F.col("r.concept").alias("concepts"), F.slice("r.concept", 1, F.greatest(F.size("r") - (least - 1), F.lit(0))).alias("first"))
    # the two sides have the same columns, so Spark makes and shuffles them once
    one = ranked.select("doc_id", "chunk_id", "chunk_index", "concepts", "first", F.explode("first").alias("concept"))
    other = one.select("doc_id", F.col("chunk_id").alias("related_id"), F.col("chunk_index").alias("related_index"), F.col("concepts").alias("theirs"), F.col("first").alias("their_first"), "concept")
    # a pair meets once for each concept that both have first; it counts at the least of them
    pairs = one.join(other, ["doc_id", "concept"]).where((F.col("chunk_index") < F.col("related_index")) & (F.array_min(F.array_intersect("first", "their_first")) == F.col("concept")))
    strength = F.size(F.array_intersect("concepts", "theirs")).cast("long")
    found = pairs.select("doc_id", "chunk_id", "chunk_index", "related_id", "related_index", strength.alias("strength")).where(F.col("strength") >= least)
    way = lambda a, b, at: F.struct(F.col(a).alias("chunk_id"), F.col(b).alias("related_id"), F.col(at).alias("related_index"))
    both = F.array(way("chunk_id", "related_id", "related_index"), way("related_id", "chunk_id", "chunk_index"))
    return found.select("doc_id", "strength", F.explode(both).alias("x")).select("doc_id", "x.chunk_id", "x.related_id", "x.related_index", "strength")


def strongest_related(related: DataFrame, most: int = 5) -> DataFrame:
    """The ``most`` strongest related chunks of each chunk; equal ones in document order."""
    w = Window.partitionBy("doc_id", "chunk_id").orderBy(F.desc("strength"), "related_index")
    return related.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def content_context(chunks: DataFrame) -> DataFrame:
    """Adds chunk_type, semantic_role, key_concepts and prerequisites."""
    return chunks.withColumns({"chunk_type": chunk_text.chunk_type("content"), "semantic_role": chunk_text.semantic_role("content"), "key_concepts": chunk_text.key_concepts("content"), "prerequisites": chunk_text.prerequisites("content")})


def enrich_chunks(chunks: DataFrame, documents: DataFrame, related: bool = True) -> DataFrame:
    """Chunks with all context columns and those of their document (title, doc_type, ...).

    Without ``related`` there is no column of related chunks, which compares a document's chunks with each other.
    """
    out = content_context(hierarchy(navigation(chunks)))
    out = out.withColumns({"extraction_confidence": chunk_text.confidence("content", F.col("token_count")), "completeness_score": chunk_text.completeness("content")})
    if not related:
        return out.join(documents, "doc_id", "left")
    top = strongest_related(related_chunks(chunks)).groupBy("doc_id", "chunk_id").agg(F.array_sort(F.collect_list(F.struct("place", "related_id"))).alias("r"))
    top = top.select("doc_id", "chunk_id", F.col("r.related_id").alias("related_chunk_ids"))
    out = out.join(top, ["doc_id", "chunk_id"], "left").withColumn("related_chunk_ids", F.coalesce("related_chunk_ids", F.array().cast("array<string>")))
    return out.join(documents, "doc_id", "left")


def with_document_context(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks with title, doc_type and total_pages of their document, and defaults where it has none."""
    d = documents.select("doc_id", F.col("title").alias("t"), F.col("doc_type").alias("k"), F.col("total_pages").alias("n"))
    out = chunks.join(d, "doc_id", "left")
    return out.select(*chunks.columns, F.coalesce("t", F.lit("Untitled")).alias("title"), F.coalesce("k", F.lit("unknown")).alias("doc_type"), F.coalesce("n", F.lit(0)).alias("total_pages"))


def navigation_integrity(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunks, linked, first_with_previous, last_with_next): the last two count what should not be."""
    order = F.col("chunk_index")
    ends = chunks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("previous_chunk_id").isNotNull() | F.col("next_chunk_id").isNotNull()).alias("linked"),
        F.min_by(F.struct("previous_chunk_id"), order).alias("f"), F.max_by(F.struct("next_chunk_id"), order).alias("l"),
    )
    issue = lambda c: F.col(c).isNotNull().cast("long")
    return ends.select("doc_id", "chunks", "linked", issue("f.previous_chunk_id").alias("first_with_previous"), issue("l.next_chunk_id").alias("last_with_next"))


def validate_chunks(chunks: DataFrame) -> DataFrame:
    """Adds a struct for each check, issues, and score: the sum of the checks as a percentage."""
    given = {c: F.col(c) for c in ("content", "chapter", "section", "previous_chunk_id", "next_chunk_id", "chunk_type", "token_count", "char_count")}
    out = chunks.withColumns({f"q_{name}": check(given) for name, check in quality.CHECKS.items()})
    names = [f"q_{n}" for n in quality.CHECKS]
    total: Column = sum((F.col(n)["score"] for n in names), F.lit(0))
    return out.withColumns({"issues": F.flatten(F.array(*(F.col(n)["issues"] for n in names))), "score": total / quality.FULL_SCORE * 100})


def document_quality(scored: DataFrame, minimum: float = 50.0) -> DataFrame:
    """(doc_id, chunks, overall_score, grade, accepted) of each document.

    The overall score is the mean of the chunks' scores, from the sum of their
    whole points, so neither it nor a grade depends on the order of chunks.
    """
    mean = F.sum(quality.points(F.col("score"))) / (F.count(F.lit(1)) * (quality.FULL_SCORE // 100))
    out = scored.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), mean.alias("overall_score"), F.count_if(F.col("score") >= 80).alias("good_chunks"))
    return out.withColumns({"grade": quality.grade(F.col("overall_score")), "accepted": F.col("overall_score") >= minimum})


def frequent_issues(scored: DataFrame, most: int = 3) -> DataFrame:
    """The most frequent issues of each document, equal counts by name."""
    counts = scored.select("doc_id", F.explode("issues").alias("issue")).groupBy("doc_id", "issue").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("n"), "issue")
    return counts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).withColumn("text", F.format_string("%s (%d chunks)", "issue", "n"))


def coverage(chunks: DataFrame, total_pages: DataFrame) -> DataFrame:
    """Characters, pages covered, and their share of all pages, by document."""
    pages = chunks.select("doc_id", F.explode("page_numbers").alias("p")).groupBy("doc_id").agg(F.countDistinct("p").alias("pages_covered"))
    chars = chunks.groupBy("doc_id").agg(F.sum("char_count").alias("total_chars"))
    return chars.join(pages, "doc_id", "left").join(total_pages, "doc_id").select("doc_id", "total_chars", "pages_covered", (F.col("pages_covered") / F.greatest("total_pages", F.lit(1))).alias("coverage_ratio"))
