"""Documents to chunks.

Input frames have ``doc_id`` and ``content`` (and ``page_number`` where pages
matter); output frames have doc_id, chunk_index from 0, content, token_count and
char_count.  Window and greedy strategies work inside a row, without a shuffle;
structure needs one exchange by document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrion.functions import text as T


@dataclass(frozen=True)
class ChunkingConfig:
    strategy: str = "contextual"
    size: int = 1000
    overlap: int = 200
    min_size: int = 100
    max_size: int = 2000
    preserve_structure: bool = True
    include_headers: bool = True


# Line patterns of structure elements, in order of precedence.
ELEMENTS = [
    ("chapter", r"(?i)^(?:chapter|kapitel)\s+\d+\.?\s*:?\s*.+"),
    ("section", r"(?i)^\d+\.\s+[a-z][^.]+"),
    ("subsection", r"(?i)^\d+\.\d+\s+[a-z][^.]+"),
    ("subsubsection", r"(?i)^\d+\.\d+\.\d+\s+[a-z][^.]+"),
    ("header", r"(?i)^[a-z][a-z\s]+$"),
    ("list_item", r"^(?:\d+\.|-|\*|•)\s+.+"),
    ("special_section", r"(?i)^(?:abstract|summary|zusammenfassung|introduction|einleitung|conclusion|fazit)"),
]
BOUNDARIES = ["chapter", "section", "subsection", "special_section"]


def _rows(df: DataFrame, parts: Column, *keys: str, locate: bool = False) -> DataFrame:
    """One row for each content of the array ``parts``."""
    out = df.select(*keys, F.col("content").alias("whole"), F.posexplode(parts).alias("chunk_index", "content"))
    return _measured(_located(out, locate))


def _measured(chunks: DataFrame) -> DataFrame:
    return chunks.withColumns({"token_count": T.word_count("content"), "char_count": F.length("content")})


def _located(chunks: DataFrame, locate: bool) -> DataFrame:
    """Without the column ``whole``; with start_offset and end_offset in it, if asked for (null where it is not found)."""
    if locate:
        start = F.nullif(found_at(F.col("content"), F.col("whole")).cast("long"), F.lit(-1))
        chunks = chunks.withColumn("start_offset", start).withColumn("end_offset", F.col("start_offset") + F.length("content"))
    return chunks.drop("whole")


def window_texts(content: Column | str, size: int, step: int, least: int = 1) -> Column:
    """Texts of ``size`` words every ``step`` words; windows of fewer than ``least`` words are dropped."""

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(step))
        parts = F.transform(starts, lambda s: F.slice(w, s + 1, size))
        return F.transform(F.filter(parts, lambda p: F.size(p) >= least), lambda p: F.array_join(p, " "))

    return T.let(T.words(content), cut)


def overlapping(docs: DataFrame, config: ChunkingConfig = ChunkingConfig(), least: int = 10, locate: bool = False) -> DataFrame:
    """Overlapping windows; tails under ten words go.  Numbers count emitted chunks."""
    return _rows(docs, window_texts("content", config.size, config.size - config.overlap, least), "doc_id", locate=locate)


def fixed(docs: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    return overlapping(docs, config)


def simple(docs: DataFrame, size: int = 1000) -> DataFrame:
    """Windows side by side, as in the simple profile."""
    return _rows(docs, window_texts("content", size, size), "doc_id")


def paragraphs(content: Column | str) -> Column:
    return F.filter(F.transform(F.split(T.col(content), r"\n\s*\n"), T.stripped), lambda p: p != "")


def packed(parts: Column, size: int, prefix: Column | None = None) -> Column:
    """Greedy packing: paragraphs joined by a blank line while they hold at most ``size`` words.

    A paragraph that is larger stands alone.  With a prefix, each text begins
    with it and its words count.
    """
    start = F.size(T.words(prefix)) if prefix is not None else F.lit(0)
    none = F.array().cast("array<string>")
    # finished texts go into blocks, so that a long document's list is not copied for each of them
    empty = F.struct(F.array().cast("array<array<string>>").alias("blocks"), none.alias("done"), none.alias("open"), start.alias("n"))

    def add(a: Column, p: Column) -> Column:
        n = T.word_count(p)
        full = (a["n"] + n > size) & (F.size(a["open"]) > 0)
        whole = F.size(a["done"]) >= _BLOCK
        closed = F.array(F.array_join(a["open"], "\n\n"))
        then = F.struct(
            F.when(whole, F.concat(a["blocks"], F.array(a["done"]))).otherwise(a["blocks"]).alias("blocks"), F.when(whole, closed).otherwise(F.concat(a["done"], closed)).alias("done"),
            F.array(p).alias("open"), (start + n).alias("n"),
        )
        return F.when(full, then).otherwise(F.struct(a["blocks"].alias("blocks"), a["done"].alias("done"), F.concat(a["open"], F.array(p)).alias("open"), (a["n"] + n).alias("n")))

    def finish(a: Column) -> Column:
        last = F.when(F.size(a["open"]) > 0, F.array(F.array_join(a["open"], "\n\n"))).otherwise(none)
        return F.concat(F.flatten(a["blocks"]), a["done"], last)

    texts = F.aggregate(parts, empty, add, finish)
    return texts if prefix is None else F.transform(texts, lambda t: F.concat(prefix, F.lit("\n\n"), t))


#: Finished texts in a block of ``packed``.
_BLOCK = 256


def semantic(pages: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """Paragraphs packed page by page; numbers run on over a document's pages."""
    per_page = pages.select("doc_id", "page_number", F.posexplode(packed(paragraphs("content"), config.size)).alias("at", "content"))
    order = Window.partitionBy("doc_id").orderBy("page_number", "at")
    out = per_page.select("doc_id", (F.row_number().over(order) - 1).alias("chunk_index"), "content", F.array("page_number").alias("page_numbers"))
    return out.withColumns({"token_count": T.word_count("content"), "char_count": F.length("content")})


def element_type(line: Column) -> Column:
    out = None
    for name, pattern in ELEMENTS:
        out = F.when(line.rlike(pattern), name) if out is None else out.when(line.rlike(pattern), name)
    return out


def structure_elements(docs: DataFrame) -> DataFrame:
    """(doc_id, line_number, text, type) of each line that is a structure element."""
    lines = docs.select("doc_id", F.posexplode(T.lines("content")).alias("line_number", "raw"))
    lines = lines.select("doc_id", "line_number", T.stripped("raw").alias("text")).where("text <> ''")
    return lines.withColumn("type", element_type(F.col("text"))).where("type is not null")


def sections(docs: DataFrame) -> DataFrame:
    """(doc_id, whole, start_line, end_line, header, content): a section runs from one boundary to the next.

    The first section begins at line 0; headers and list items are no boundaries.
    """
    numbered = F.transform(T.lines("content"), lambda x, i: F.struct(i.alias("i"), T.stripped(x).alias("s"), x.alias("raw")))
    marked = docs.select("doc_id", F.col("content").alias("whole"), numbered.alias("all"))
    starts = F.transform(F.filter("all", lambda x: element_type(x["s"]).isin(BOUNDARIES)), lambda x: x["i"])
    marked = marked.withColumn("starts", F.array_distinct(F.concat(F.array(F.lit(0)), starts))).withColumn("n", F.size("all"))
    end = lambda k: F.coalesce(F.get("starts", k + 1), F.col("n"))
    head = lambda part: F.get(part, F.lit(0))["s"]
    header = lambda part: F.when(element_type(head(part)).isin(BOUNDARIES), head(part)).otherwise("")
    # a section's lines are cut out in the document's row, so that no row holds all lines once for each section
    cut = F.transform("starts", lambda s, k: T.let(F.slice("all", s + 1, end(k) - s), lambda part: F.struct(s.alias("start_line"), end(k).alias("end_line"), header(part).alias("header"), F.array_join(F.transform(part, lambda x: x["raw"]), "\n").alias("content"))))
    return marked.select("doc_id", "whole", F.explode(cut).alias("c")).select("doc_id", "whole", "c.*")


def structured(docs: DataFrame, config: ChunkingConfig = ChunkingConfig(), locate: bool = False) -> DataFrame:
    """Sections as chunks; those of under ``min_size`` characters go, those of over ``max_size`` words are packed."""
    cut = sections(docs).where(F.length(T.stripped("content")) >= config.min_size)
    body = F.when(T.word_count("content") <= config.max_size, F.array("content")).otherwise(packed(paragraphs("content"), config.max_size, F.col("header") if config.include_headers else None))
    each = _located(cut.select("doc_id", "whole", "start_line", "header", F.posexplode(body).alias("at", "content")), locate)
    order = Window.partitionBy("doc_id").orderBy("start_line", "at")
    return _measured(each.withColumn("chunk_index", F.row_number().over(order) - 1).drop("start_line", "at"))


def contextual(docs: DataFrame, config: ChunkingConfig = ChunkingConfig(), locate: bool = False) -> DataFrame:
    """Structure where a document has any element, overlapping windows elsewhere."""
    any_element = F.exists(T.lines("content"), lambda x: element_type(T.stripped(x)).isNotNull()) if config.preserve_structure else F.lit(False)
    marked = docs.select("doc_id", "content", any_element.alias("has"))
    by_structure = structured(marked.where("has"), config, locate).drop("header")
    return by_structure.unionByName(overlapping(marked.where("not has"), config, locate=locate))


STRATEGIES = {"contextual": contextual, "fixed": fixed, "semantic": semantic}


def named(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("chunk_id", F.concat(F.col("doc_id").cast("string"), F.lit("_chunk_"), F.col("chunk_index").cast("string")))


def chunk_pages(pages: DataFrame, joined: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """Chunks with page_numbers: ``pages`` (doc_id, page_number, content), ``joined`` their text by document, parted by blank lines."""
    if config.strategy == "semantic":
        return create_chunks(pages, config)
    if config.strategy == "fixed":
        chunks, spans = create_chunks(joined, config), page_spans(named(window_offsets(pages, config)), spaced_offsets(pages))
    else:
        chunks = named(contextual(joined, config, locate=True))
        spans = page_spans(chunks, page_offsets(pages))
    return chunks.drop("start_offset", "end_offset").join(spans, "chunk_id")


def create_chunks(docs: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """By the configured strategy; an unknown one is contextual.  Adds chunk_id."""
    if config.strategy == "semantic" and "page_number" not in docs.columns:
        docs = docs.withColumn("page_number", F.lit(1))
    return named(STRATEGIES.get(config.strategy, contextual)(docs, config))


def page_offsets(pages: DataFrame) -> DataFrame:
    """Where each page begins and ends in the joined text; pages are parted by a blank line."""
    before = Window.partitionBy("doc_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("_n") + 2).over(before), F.lit(0))
    # lengths only: a document's pages meet in one task
    return pages.select("doc_id", "page_number", F.length("content").alias("_n")).select("doc_id", "page_number", start.alias("start_offset"), (start + F.col("_n")).alias("end_offset"))


def page_spans(chunks: DataFrame, offsets: DataFrame) -> DataFrame:
    """(chunk_id, page_numbers) for chunks with start_offset and end_offset: pages that they touch, else page 1.

    Both ends count.  Chunks and pages meet in stretches of ``_STRETCH``
    characters, so a long document costs about as many pairs as it has overlaps.
    """
    stretches = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / _STRETCH), F.floor(F.col(b) / _STRETCH)))
    o = offsets.select("doc_id", "page_number", F.col("start_offset").alias("page_start"), F.col("end_offset").alias("page_end"), stretches("start_offset", "end_offset").alias("stretch"))
    c = chunks.select("chunk_id", "doc_id", "start_offset", "end_offset")
    placed = c.where("start_offset is not null").select("*", stretches("start_offset", "end_offset").alias("stretch"))
    touching = placed.join(o, ["doc_id", "stretch"]).where("start_offset <= page_end and end_offset >= page_start")
    hit = c.select("chunk_id").join(touching.groupBy("chunk_id").agg(F.array_sort(F.collect_set("page_number")).alias("p")), "chunk_id", "left")
    return hit.select("chunk_id", F.when(F.size("p") > 0, F.col("p")).otherwise(F.array(F.lit(1).cast(offsets.schema["page_number"].dataType))).alias("page_numbers"))


_STRETCH = 4096


def found_at(part: Column, whole: Column) -> Column:
    """Where the first hundred characters of a part first occur in the whole; -1 where they do not."""
    return F.position(F.substring(part, 1, 100), whole) - 1


def window_offsets(pages: DataFrame, config: ChunkingConfig = ChunkingConfig()) -> DataFrame:
    """(doc_id, chunk_index, start_offset, end_offset) of fixed windows, in the words joined by single spaces.

    As ``end_offset`` is the last character's place, a window ends before it.
    Windows begin and end on a grid of words.  Each page gives the words and
    characters of its part of each grid cell, so a text is cut once, and running
    sums over a document's cells give the offsets.
    """
    step = config.size - config.overlap
    grid = math.gcd(config.size, step)
    # words stay with their page; only its number of words meets those of the document's other pages
    alike = Window.partitionBy("doc_id", "page_number").orderBy("_h")
    hashed = pages.withColumn("_h", F.xxhash64("content"))
    pages = hashed.select("doc_id", "page_number", "_h", "content").withColumn("_k", F.row_number().over(alike))
    counted = hashed.select("doc_id", "page_number", "_h", T.word_count("content").alias("n")).withColumn("k", F.row_number().over(alike))
    before = Window.partitionBy("d").orderBy("p", "k").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select(F.col("doc_id").alias("d"), F.col("page_number").alias("p"), "k", "n").withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int"))
    placed = pages.join(counted, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("page_number").eqNullSafe(F.col("p")) & (F.col("_k") == F.col("k"))).select("doc_id", T.words("content").alias("_w"), "n", "first")
    inner = F.pmod(-F.col("first"), F.lit(grid))
    begins = F.array_distinct(F.concat(F.array(F.lit(0)), F.when(inner < F.col("n"), F.sequence(inner, F.col("n") - 1, F.lit(grid))).otherwise(F.array().cast("array<int>"))))
    cell = lambda at: F.floor((F.col("first") + at) / grid).cast("int")
    end = lambda at: F.least(F.col("n"), (cell(at) + 1) * grid - F.col("first"))
    part = F.transform(begins, lambda at: F.struct(cell(at).alias("cell"), (end(at) - at).alias("words"), F.length(F.array_join(F.slice("_w", at + 1, end(at) - at), "")).alias("chars")))
    cells = placed.select("doc_id", F.explode(part).alias("x")).groupBy("doc_id", "x.cell").agg(F.sum("x.words").alias("words"), F.sum("x.chars").alias("chars"))
    order = Window.partitionBy("doc_id").orderBy("cell")
    spaced = F.sum(F.col("chars") + F.col("words"))  # a space after each word
    found = cells.select(
        "doc_id", "cell", F.coalesce(spaced.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), spaced.over(order.rowsBetween(0, config.size // grid - 1)).alias("length"),
        F.sum("words").over(order.rowsBetween(0, config.size // grid - 1)).alias("n"), F.sum("words").over(Window.partitionBy("doc_id")).alias("total"),
    )
    windows = found.where((F.col("cell") % (step // grid) == 0) & (F.col("cell") * grid <= F.greatest(F.col("total") - 1, F.lit(0))) & (F.col("n") >= config.min_size // 10))
    start = F.greatest(F.col("start") - 1, F.lit(0))  # where the words before it end
    last = start + F.greatest(F.col("length") - 1, F.lit(0)) - 1
    return windows.select("doc_id", (F.col("cell") / (step // grid)).cast("int").alias("chunk_index"), start.cast("long").alias("start_offset"), last.cast("long").alias("end_offset"))


def spaced_offsets(pages: DataFrame) -> DataFrame:
    """Where each page begins and ends when pages are joined by a space, which belongs to the page before it."""
    before = Window.partitionBy("doc_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("_n") + 1).over(before), F.lit(0))
    # lengths only: a document's pages meet in one task
    return pages.select("doc_id", "page_number", F.length("content").alias("_n")).select("doc_id", "page_number", start.alias("start_offset"), (start + F.col("_n")).alias("end_offset"))
