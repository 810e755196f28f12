"""Files to pages: listing, hashing, and a cascade of page extractors."""

from __future__ import annotations

import html
import importlib.util
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrion.functions import text as T


@dataclass(frozen=True)
class Page:
    number: int
    text: str
    tables: int | None = None
    images: int | None = None


#: A backend takes a file's bytes and returns its pages with text, or None if it cannot read them.
Backend = Callable[[bytes], "list[Page] | None"]
PAGES = "doc_id string, page_number int, content string, char_count int, has_tables boolean, table_count int, has_images boolean, image_count int, extraction_method string, extraction_failed boolean"
MIN_CHARS = 100
_TAG = re.compile(r"(?s)<(script|style)\b.*?</\1\s*>|<[^>]*>")


def _name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def scan(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(file_key, path, hash, size, modified, content) of the files in a folder, subfolders left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(_name().alias("file_key"), "path", F.sha2("content", 256).alias("hash"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def listing(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    return scan(spark, folder, pattern).drop("content")


def _numbered(texts: Sequence[str]) -> list[Page]:
    """Pages with text, under their numbers among all pages."""
    return [Page(i, t) for i, t in enumerate(texts, 1) if t and t.strip()]


def utf8_text(data: bytes) -> list[Page] | None:
    """Plain text; a form feed begins a new page."""
    try:
        return _numbered(data.decode("utf-8").split("\f"))
    except UnicodeDecodeError:
        return None


def html_text(data: bytes) -> list[Page] | None:
    if b"<" not in data:
        return None
    return _numbered([html.unescape(_TAG.sub(" ", data.decode("utf-8", "replace"))).strip()])


def table_text(tables: Sequence[Sequence[Sequence[object]]]) -> str:
    """Rows of all tables, a line each, as they are put after a page's text."""
    rows = [" | ".join(str(cell) if cell else "" for cell in row) + "\n" for table in tables for row in table if row]
    return "\n\nTables:\n" + "".join(rows) if rows else ""


def pdf_with_tables(data: bytes) -> list[Page]:
    import io

    import pdfplumber

    out = []
    with pdfplumber.open(io.BytesIO(data)) as pdf:
        for i, page in enumerate(pdf.pages, 1):
            if text := page.extract_text():
                tables = page.extract_tables()
                out.append(Page(i, text + table_text(tables), tables=len(tables)))
    return out


def pdf_with_images(data: bytes) -> list[Page]:
    import fitz

    with fitz.open(stream=data, filetype="pdf") as pdf:
        return [Page(i, text, images=len(page.get_images())) for i, page in enumerate(pdf, 1) if (text := page.get_text())]


def pdf_text(data: bytes) -> list[Page]:
    import io

    from pypdf import PdfReader

    return _numbered([page.extract_text() or "" for page in PdfReader(io.BytesIO(data)).pages])


BACKENDS: dict[str, Backend] = {"pdf": pdf_text, "pdfplumber": pdf_with_tables, "pymupdf": pdf_with_images, "html": html_text, "text": utf8_text}
#: What a backend needs besides the standard library.
NEEDS = {"pdf": "pypdf", "pdfplumber": "pdfplumber", "pymupdf": "fitz"}


def supported() -> list[str]:
    """The backends whose libraries are installed."""
    return [b for b in BACKENDS if b not in NEEDS or importlib.util.find_spec(NEEDS[b])]


def read_with(backend: str, data: bytes) -> list[Page] | None:
    """Pages by one backend; None where it is not installed or cannot read the file, so that the next one may."""
    if backend in NEEDS and not importlib.util.find_spec(NEEDS[backend]):
        return None
    try:
        return BACKENDS[backend](data)
    except Exception:  # whatever a parser makes of a damaged file
        return None


def order(primary: str, fallback: str | None = None) -> list[str]:
    """Primary, fallback, then all others, each once."""
    return list(dict.fromkeys([b for b in (primary, fallback, *BACKENDS) if b in BACKENDS]))


def is_valid(pages: Sequence[str]) -> bool:
    """Enough text, and no long page in which over 30 % of the characters are letters that occur once."""
    if not pages or sum(map(len, pages)) < MIN_CHARS:
        return False
    return not any(len(p) > 1000 and sum(c.isalpha() and p.count(c) == 1 for c in set(p)) > 0.3 * len(p) for p in pages)


def extract_pages(files: DataFrame, primary: str = "pdf", fallback: str | None = "text") -> DataFrame:
    """A row for each page from the first backend whose pages are valid; else one error page."""
    names = order(primary, fallback)
    columns = [c.split()[0] for c in PAGES.split(", ")]
    some = lambda n: None if n is None else n > 0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, data in zip(frame["file_key"], frame["content"]):
                for name in names:
                    pages = read_with(name, bytes(data))
                    if pages and is_valid([p.text for p in pages]):
                        rows = [(key, p.number, p.text, len(p.text), some(p.tables), p.tables, some(p.images), p.images, name, False) for p in pages]
                        break
                else:
                    rows = [(key, 1, f"[PDF extraction failed for {key}]", 0, None, None, None, None, "fallback", True)]
                yield pd.DataFrame(rows, columns=columns)  # a file at a time

    return files.select("file_key", "content").mapInPandas(run, PAGES)


def text_pages(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """The pages of plain text files as ``extract_pages`` gives them, for files of any size.

    A form feed parts pages, and Spark's text reader parts a file at form feeds:
    it is read in many tasks, each about ``spark.sql.files.maxPartitionBytes``,
    and no task or row holds more than a part or a page.  A page's number is its
    place in its part and the number of pages in the parts before.  Bytes that
    are not UTF-8 become U+FFFD; they do not make a file fail.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(F.col("_metadata.file_path").alias("file"), _name().alias("doc_id"))
    raw = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\f").text(folder)
    parts = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = parts.withColumn("place", F.row_number().over(Window.partitionBy("file", "part").orderBy("at")))
    counts = raw.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.join(counts.select("file", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), ["file", "part"])
    pages = numbered.where(r"value rlike '\\S'").select("file", (F.col("before") + F.col("place")).cast("int").alias("page_number"), F.col("value").alias("content"))
    valid = valid_extractions(pages.withColumnRenamed("file", "doc_id")).where("valid").select(F.col("doc_id").alias("file"))
    none = lambda kind: F.lit(None).cast(kind)
    tables = [none("boolean").alias("has_tables"), none("int").alias("table_count"), none("boolean").alias("has_images"), none("int").alias("image_count")]
    good = listed.join(valid, "file").join(pages, "file").select("doc_id", "page_number", "content", F.length("content").alias("char_count"), *tables, F.lit("text").alias("extraction_method"), F.lit(False).alias("extraction_failed"))
    failed = listed.join(valid, "file", "left_anti").select("doc_id", F.lit(1).alias("page_number"), F.concat(F.lit("[PDF extraction failed for "), F.col("doc_id"), F.lit("]")).alias("content"), F.lit(0).alias("char_count"), *tables, F.lit("fallback").alias("extraction_method"), F.lit(True).alias("extraction_failed"))
    return good.unionByName(failed)


def text_listing(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(file_key, path, hash, size, modified) of text files of any size; the hash is one of all lines and their places, added up from the file's parts."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    listed = listed.select(F.col("_metadata.file_path").alias("file"), _name().alias("file_key"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    raw = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\f").text(folder)
    pages = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("at"))
    pages = pages.withColumn("place", F.row_number().over(Window.partitionBy("file", "part").orderBy("at")))
    sums = pages.groupBy("file").agg(*(F.bit_xor(F.xxhash64(F.lit(seed), "value", "part", "place")).alias(f"h{seed}") for seed in (1, 2)), F.count(F.lit(1)).alias("n"))
    joined = listed.join(sums, "file", "left")
    return joined.select("file_key", "path", F.sha2(F.concat_ws(",", "size", "n", "h1", "h2"), 256).alias("hash"), "size", "modified")


#: What a PDF says of itself, by the names under which its reader has it.
INFO = {"title": "title", "author": "author", "subject": "subject", "creator": "creator", "producer": "producer", "creation_date": "creationDate", "modification_date": "modDate"}


def file_info(files: DataFrame) -> DataFrame:
    """(file_key, size, modified, ...) with what each PDF says of itself; nulls where no reader is installed."""
    names = list(INFO)

    def read(data: bytes) -> list[str | None]:
        try:
            import fitz

            with fitz.open(stream=data, filetype="pdf") as pdf:
                return [pdf.metadata.get(INFO[n]) or "" for n in names]
        except Exception:  # no reader, or no PDF
            return [None] * len(names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield pd.DataFrame([(row.file_key, row.size, row.modified, *read(bytes(row.content)))], columns=["file_key", "size", "modified", *names])

    return files.select("file_key", "size", "modified", "content").mapInPandas(run, "file_key string, size long, modified timestamp, " + ", ".join(f"{n} string" for n in names))


def page_totals(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_pages"), F.sum("char_count").alias("total_chars"))


def valid_extractions(pages: DataFrame) -> DataFrame:
    """(doc_id, valid) by the same rule as ``is_valid``, in columns."""
    chars = F.filter(F.split("content", ""), lambda c: c != "")
    once = T.let(F.sort_array(F.filter(chars, lambda c: c.rlike(r"\p{L}"))), lambda s: F.size(F.filter(F.transform(s, lambda c, i: ~F.coalesce(F.get(s, i - 1) == c, F.lit(False)) & ~F.coalesce(F.get(s, i + 1) == c, F.lit(False))), lambda b: b)))
    # no more letters can occur once than there are ASCII letters and other characters; few texts have so many
    most = 52 + F.length(F.regexp_replace("content", r"[\x00-\x7F]+", ""))
    odd = F.when((F.length("content") > 1000) & (most > 0.3 * F.length("content")), once > 0.3 * F.length("content")).otherwise(False)
    return pages.groupBy("doc_id").agg(F.sum(F.length("content")).alias("n"), F.bool_or(odd).alias("odd")).select("doc_id", ((F.col("n") >= MIN_CHARS) & ~F.col("odd")).alias("valid"))
