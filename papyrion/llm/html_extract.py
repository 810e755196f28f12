"""Main text of web pages by comparing each page with its nearest URL.

A page becomes lines: text between block-level tags, with the containers that
it stands in.  Scripts, styles, forms and what is marked as menu, header,
footer, sidebar, notice, advert or comments are no candidates for text.

Pages of a host whose lines are all equal are copies and count as one page, at
the first of their URLs.  The others are ordered by path; of a page's two
neighbours the nearest is the one with which its path has more characters in
common from the start, and no other page of the host has more.  The lines of
both, all of them and in order, are aligned by their longest common subsequence,
and candidates that they share are template and deleted, in all copies alike.
Inside an explicit article (``<article>`` or
``<main>``) lines are the author's own even when another page quotes them, so
there shared lines stay unless ``protect_articles`` is off; such a page has no
candidates outside its article.

The order is a range partitioning of paths by host, path and id, which spreads a
large host over many tasks; the pages at the ends of a task are also handed to
its neighbours, so every page meets the page before and the page after it.  Every
page is compared, whether it has lines that may be deleted or not, by 64-bit
digests of its lines; which of the shared lines are to be deleted is decided after
that, and comes back to a page as line numbers.
"""

from __future__ import annotations

import hashlib
import html as entities
import os.path
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrion.llm.scratch import Scratch
from papyrion.llm.url_filter import host_of, path_of

#: Content that is never text, up to its own end tag.
RAW = frozenset(("script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "textarea", "select", "title"))
#: Containers outside the main text, by tag.
ASIDE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head"))
MAIN = ("article", "main")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset(("a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
#: Containers outside the main text, by a word of their class, id or role.
ASIDE_NAME = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|promoted|related|replies|share|sharing|sidebar|signup|social|sponsored|subscribe|toolbar|widget)(?=$|[\s_-])"
)
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(/?)>|<[!?][^>]*>", re.S)
_UNFINISHED = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?\Z")
_NAMES = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")


@dataclass
class Block:
    text: str
    aside: bool
    main: bool


def blocks(page: str) -> list[Block]:
    """The non-empty blocks of a page in order, white space inside each made single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, opens an aside, opens a main part
    parts: list[str] = []
    aside = main = 0

    def flush():
        if not parts:
            return
        text = "".join(parts)
        parts.clear()
        text = " ".join((entities.unescape(text) if "&" in text else text).split())
        if text:
            out.append(Block(text, aside > 0, main > 0))

    def close(to: int):
        nonlocal aside, main
        while len(stack) > to:
            _, a, m = stack.pop()
            aside, main = aside - a, main - m

    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        m = _TOKEN.match(page, start) if start >= 0 else None
        if not m:
            # an unfinished tag at the end of a cut page is markup, any other "<" is text
            cut = start >= 0 and _UNFINISHED.match(page, start)
            end = n if start < 0 or cut else start + 1
            parts.append(page[at : start if cut else end])
            at = end
            continue
        if start > at:
            parts.append(page[at:start])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        closing = bool(m.group(1))
        if tag not in INLINE:
            flush()
        if tag in RAW:
            if not closing and not m.group(4):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag not in INLINE:
            if tag == "p" or tag in ("li", "dd", "dt", "tr", "td", "th", "option"):  # these end by themselves
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            names = " ".join(x for g in _NAMES.findall(m.group(3)) for x in g if x) if "=" in m.group(3) else ""
            named = bool(names) and bool(ASIDE_NAME.search(names))
            opens_aside = (tag in ASIDE and not (tag == "header" and main)) or named and tag not in ("html", "body", *MAIN)
            opens_main = tag in MAIN and not named
            stack.append((tag, opens_aside, opens_main))
            aside, main = aside + opens_aside, main + opens_main
    flush()
    return out


def shared_lines(ours: list, theirs: list) -> set[int]:
    """The indices of ``ours`` in a longest common subsequence of the two lists.

    Equal ends are cut off first; the rest is aligned by the positions of equal
    lines (Hunt and Szymanski), so unlike pages cost next to nothing.
    """
    import bisect

    first, last = 0, 0
    while first < min(len(ours), len(theirs)) and ours[first] == theirs[first]:
        first += 1
    while last < min(len(ours), len(theirs)) - first and ours[-1 - last] == theirs[-1 - last]:
        last += 1
    places: dict[object, list[int]] = {}
    for j in range(len(theirs) - last - 1, first - 1, -1):
        places.setdefault(theirs[j], []).append(j)
    ends: list[int] = []  # least end in theirs of a common subsequence of each length
    links: list[tuple] = []
    for i in range(first, len(ours) - last):
        for j in places.get(ours[i], ()):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    out = set(range(first)) | set(range(len(ours) - last, len(ours)))
    link = links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def candidates(page: list[Block], protect_articles: bool = True) -> tuple[list[str], list[int]]:
    """(lines, places): the lines that may be text, and for each block its place among them, or -1 if it is no line that can be deleted."""
    explicit = any(b.main and not b.aside for b in page)
    lines, places = [], []
    for b in page:
        taken = not b.aside and (b.main or not explicit)
        places.append(len(lines) if taken and not (b.main and protect_articles) else -1)
        if taken:
            lines.append(b.text)
    return lines, places


def _digest(*lines: str) -> int:
    return int.from_bytes(hashlib.blake2b("\n".join(lines).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", protect_articles: bool = True) -> DataFrame:
    """(id, url, text, n_chars) of each row; text is empty where a page has none.

    A null page is empty.  Pages without a host are compared with no other page.
    Two neighbours that are equally near count in their order, the one before
    first.  Pages of one host with equal lines are never templates of each other.
    Other columns are not read.
    """
    scratch = Scratch(pages.sparkSession, "html")
    located = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    kind = located.schema["id"].dataType.simpleString()

    def parse(batches):
        for b in batches:
            lines, places, digests, whole = [], [], [], []
            for x in b.column(2):
                page = blocks(x.as_py())
                found = candidates(page, protect_articles)
                lines.append(found[0])
                places.append(found[1])
                digests.append([_digest(y.text) for y in page])
                whole.append(_digest(*(y.text for y in page)))
            columns = [pa.array(lines, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32())), pa.array(digests, pa.list_(pa.int64())), pa.array(whole, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), b.column(4), *columns], names=["id", "url", "host", "path", "lines", "places", "digests", "whole"])

    parsed = located.mapInArrow(parse, f"id {kind}, url string, host string, path string, lines array<string>, places array<int>, digests array<long>, whole long")
    parsed = scratch.save(parsed.withColumn("row", F.monotonically_increasing_id()), "parsed")
    deleted = scratch.save(_deleted(parsed, scratch), "deleted")
    scratch.drop_all_but("parsed", "deleted")
    size = deleted.agg(F.sum(4 * F.size("deleted") + 24)).first()[0] or 0
    if size <= _BROADCAST_BYTES:  # else Spark chooses how to join
        deleted = F.broadcast(deleted)
    kept = F.when(F.col("deleted").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x, i: ~F.array_contains("deleted", i)))
    text = F.array_join(kept, " ")
    return parsed.select("row", F.col("id").alias(id_col), "url", "lines").join(deleted, "row", "left").select(id_col, "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


#: Line numbers of deleted lines are broadcast up to so many bytes.
_BROADCAST_BYTES = 8 << 20


def _aligned(parsed: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, whole, shared): of each page of a host with other pages, copies once, the places of the blocks that it shares with its nearest URL."""
    located = parsed.where("host <> ''").select("row", "host", "path", "id", "whole")
    firsts = scratch.save(located.groupBy("host", "whole").agg(F.min(F.struct("path", "id", "row")).alias("first")).select("host", "whole", "first.path", "first.id", "first.row"), "firsts")
    nearest = _nearest(firsts, scratch).join(firsts.select("row", "host", "whole"), "row")
    lines = parsed.select("row", "digests")
    both = nearest.join(lines, "row").join(lines.withColumnsRenamed({"row": "other", "digests": "theirs"}), "other")
    return scratch.save(both.select("host", "whole", "digests", "theirs").mapInArrow(_shared, "host string, whole long, shared array<int>"), "shared")


def _deleted(parsed: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, deleted): the places of the lines to delete, of each page that has some."""
    shared = _aligned(parsed, scratch)
    # each copy has places of its own for the shared blocks; a block inside an article has none
    places = parsed.where(F.exists("places", lambda p: p >= 0)).select("row", "host", "whole", "places").join(shared, ["host", "whole"])
    found = F.array_sort(F.filter(F.transform("shared", lambda i: F.get("places", i)), lambda p: p >= 0))
    return places.select("row", found.alias("deleted")).where(F.size("deleted") > 0)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [sorted(shared_lines(ours, theirs)) for ours, theirs in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], names=["host", "whole", "shared"])


def _nearest(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, other): of each page of a saved table (row, host, path, id) the row with the nearest path on its host; none where it is alone."""
    columns = ["row", "host", "path", "id"]
    ordered = pages.select(*columns).repartitionByRange("host", "path", "id").sortWithinPartitions("host", "path", "id").withColumn("part", F.spark_partition_id())
    ordered = scratch.save(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    ends = ordered.groupBy("part").agg(F.min("at").alias("low"), F.max("at").alias("high")).collect()  # three numbers for each partition
    ends = sorted(ends, key=lambda r: r["part"])
    moves = [(a["high"], b["part"]) for a, b in zip(ends, ends[1:])] + [(b["low"], a["part"]) for a, b in zip(ends, ends[1:])]
    moves = F.broadcast(pages.sparkSession.createDataFrame(moves, "at long, to int"))
    carried = ordered.join(moves, "at").withColumn("part", F.col("to")).drop("to").withColumn("carried", F.lit(True))
    both = ordered.withColumn("carried", F.lit(False)).unionByName(carried)
    both = both.repartition("part").sortWithinPartitions("part", "at").select("row", "host", "path", "part", "carried")
    return both.mapInArrow(_neighbours, "row long, other long")


@dataclass
class _Page:
    row: int
    host: str
    path: str
    part: int
    carried: bool


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest of the neighbours of each page that was not carried here, from pages in order."""
    held = before = None  # the page that waits for its neighbour, and the page before it
    for b in batches:
        out = []
        for values in zip(*(c.to_pylist() for c in b.columns)):
            page = _Page(*values)
            out += _choose(held, before, page)
            before, held = held, page
        yield _as_batch(out)
    yield _as_batch(_choose(held, before, None))


def _as_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*found) if found else [(), ()])], names=["row", "other"])


def _choose(page: _Page | None, before: _Page | None, after: _Page | None) -> list[tuple[int, int]]:
    if page is None or page.carried:
        return []
    near = [other for other in (before, after) if other and other.part == page.part and other.host == page.host]
    return [(page.row, max(near, key=lambda other: len(os.path.commonprefix([page.path, other.path]))).row)] if near else []
