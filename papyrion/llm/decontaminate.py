"""Benchmark passages in training texts, found with a generalised suffix automaton.

The normalised words of all benchmark items go into one suffix automaton.  A
training text's words are streamed through it; the automaton's state and
matching length at a word say which item passages end there.  Most words never
reach the automaton: a passage needs a run of words in which every adjacent
pair also occurs in some item, and such runs are found beforehand by vectorised
hash lookups over the text's bytes.  The filter only skips what cannot match.

The automaton is broadcast.  Its size follows the benchmark, not the corpus, and
items beyond ``max_block_words`` go into further automata, one pass each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from papyrion.llm.bytewords import ALNUM, LOWER, Piece, pieces
from papyrion.llm.scratch import ship_package

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class DecontaminationConfig:
    """A window is ``window`` consecutive item words, or a whole shorter item."""

    window: int = 10
    #: A document is rejected when more than this percentage of its words is hit ...
    max_coverage_percent: int = 80
    #: ... or when one hit span is longer than this many words.
    max_span_words: int | None = None
    max_block_words: int = 1_000_000


def normalise(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


class SuffixAutomaton:
    """All substrings of several word sequences; each state knows its items."""

    def __init__(self, items: Sequence[tuple[object, list[str]]], window: int):
        self.window = window
        self.ids: list[str] = sorted({str(i) for i, w in items if w})
        number = {x: n for n, x in enumerate(self.ids)}
        self.words: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(number[str(i)], [self.words.setdefault(w, len(self.words)) for w in ws]) for i, ws in items if ws]
        for _, seq in sequences:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        self._annotate(sequences)
        pairs = {(a, b) for _, s in sequences for a, b in zip(s, s[1:])}
        self.shortest = min((min(len(s), window) for _, s in sequences), default=0)
        self._index(pairs)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[last] + 1 == length[q] else self._clone(last, q, w)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[p] + 1 == length[q] else self._clone(p, q, w)
        return new

    def _clone(self, p: int, q: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def _annotate(self, sequences: list[tuple[int, list[int]]]) -> None:
        """``windows[s]``: items with a window that is a suffix of s's strings, by window length; ``totals[s]``: all windows that are suffixes of s's longest string."""
        self.windows: dict[int, dict[int, set[int]]] = {}
        for item, seq in sequences:
            n, state, length = min(self.window, len(seq)), 0, 0
            for w in seq:
                state, length = self.step(state, length, w)
                if length >= n:  # the window's own state, from which the next word goes on
                    while self.length[self.link[state]] >= n:
                        state = self.link[state]
                    length = n
                    self.windows.setdefault(state, {}).setdefault(n, set()).add(item)
        # states without windows share what their suffix has; a chain has at most one state with windows for each window length
        self.totals: list[tuple[int, frozenset[int]]] = [(0, frozenset())] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            longest, items = self.totals[self.link[s]]
            if s in self.windows:
                longest, items = max(longest, *self.windows[s]), items.union(*self.windows[s].values())
            self.totals[s] = longest, items

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """After one more word: the state and the length of the longest match that ends here."""
        nxt, link = self.next, self.link
        while state and w not in nxt[state]:
            state = link[state]
            length = self.length[state]
        return (nxt[state][w], length + 1) if w in nxt[state] else (0, 0)

    def ending(self, state: int, length: int) -> tuple[int, frozenset[int]]:
        """Of the windows that end here: the greatest length, and all their items."""
        if length == self.length[state] or state not in self.windows:
            return self.totals[state]
        longest, items = self.totals[self.link[state]]  # shorter than the match, so all of them
        for n, found in self.windows[state].items():
            if n <= length:
                longest, items = max(longest, n), items | found
        return longest, items

    def _index(self, pairs: set[tuple[int, int]]) -> None:
        words = list(self.words)
        data = np.frombuffer("\n".join(words).encode(), np.uint8)
        piece = Piece(0, data, np.array([0, len(data)]))
        starts, ends, _ = piece.words(ALNUM)
        h = piece.hashes(starts, ends)
        self.word_hashes, self.order = np.sort(h), np.argsort(h)
        keys = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair_keys = np.sort(keys[:, 0] * len(words) + keys[:, 1])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hashed word, -1 where no item has it."""
        if not len(self.word_hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.word_hashes, hashes), len(self.word_hashes) - 1)
        return np.where(self.word_hashes[at] == hashes, self.order[at], -1)


def hits(piece: Piece, automaton: SuffixAutomaton) -> Iterator[tuple[int, int, int, np.ndarray | None, set[int]]]:
    """For each row of a piece: (row, first word, number of words, hit mask or None, items)."""
    starts, ends, offsets = piece.words(ALNUM)
    numbers = automaton.numbers(piece.hashes(starts, ends))
    rows: dict[int, tuple[np.ndarray, set[int]]] = {}
    if automaton.shortest and len(numbers):
        # joined[i]: words i and i + 1 of one row may stand next to each other in a window
        joined = (numbers[:-1] >= 0) & (numbers[1:] >= 0)
        inner = offsets[1:-1]
        joined[inner[(inner > 0) & (inner < len(numbers))] - 1] = False
        at = np.flatnonzero(joined)
        keys = numbers[at] * len(automaton.words) + numbers[at + 1]
        joined[at] = np.isin(keys, automaton.pair_keys)
        ok = np.concatenate([[False], joined, [False]])
        edges = np.flatnonzero(ok[1:] != ok[:-1])
        runs = [(a, b + 1) for a, b in edges.reshape(-1, 2) if b + 1 - a >= automaton.shortest]
        if automaton.shortest == 1:
            alone = (numbers >= 0) & ~np.append(joined, False) & ~np.append([False], joined)
            runs += [(i, i + 1) for i in np.flatnonzero(alone)]
        for a, b in runs:
            _stream(piece, automaton, starts, ends, numbers, offsets, int(a), int(b), rows)
    for r in range(piece.rows):
        mask, items = rows.get(r, (None, set()))
        yield r, int(offsets[r]), int(offsets[r + 1] - offsets[r]), mask, items


def _stream(piece, automaton, starts, ends, numbers, offsets, a, b, rows) -> None:
    row = int(np.searchsorted(offsets, a, "right")) - 1
    state, length, last = 0, 0, None
    for i in range(a, b):
        # the words themselves decide: a hash that another word shares ends the match
        word = LOWER[piece.data[starts[i] : ends[i]]].tobytes().decode("utf-8", "replace")
        number = automaton.words.get(word)
        if number is None:
            state, length = 0, 0
            continue
        state, length = automaton.step(state, length, number)
        if length < automaton.shortest:
            continue
        n, items = automaton.ending(state, length)
        if n:
            if row not in rows:
                rows[row] = np.zeros(offsets[row + 1] - offsets[row], bool), set()
            mask, found = rows[row]
            at = i - offsets[row]
            mask[at - n + 1 : at + 1] = True
            if items is not last:
                found |= items
                last = items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Items in blocks of about ``most`` words, so that no automaton outgrows a worker."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).where(F.col(item_col).isNotNull()).toLocalIterator():
        words = normalise(row[1])
        block.append((row[0], words))
        size += len(words)
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def _spans(mask: np.ndarray) -> list[int]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edges.tolist()


_HITS = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def find_contamination(docs: DataFrame, benchmark: DataFrame, config: DecontaminationConfig = DecontaminationConfig(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, spans, items.

    ``spans`` holds the first word and the word after the last of each hit span
    in turn; ``items`` the ids, as strings in order, of items with a window in
    the text.  A null or empty text has no words and no hits, as has every text
    when the benchmark is empty.  Items without an id or words are left out;
    items that share an id are one.
    """
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    shape = f"`{id_col}` {kind}, n_words long, spans array<long>, items array<string>"

    def scan(shared, df: DataFrame, carried: bool) -> DataFrame:
        def run(batches):
            automaton = shared.value
            for batch in batches:
                for piece in pieces(batch.column(1)):
                    at = batch.slice(piece.first, piece.rows)
                    n_words, spans, items = [], [], []
                    for r, _, n, mask, found in hits(piece, automaton):
                        ids = {automaton.ids[i] for i in found}
                        if carried:  # what earlier blocks of items have found
                            ids |= set(at.column(3)[r].as_py())
                            old = at.column(2)[r].as_py()
                            if old:
                                mask = np.zeros(n, bool) if mask is None else mask
                                for a, b in zip(old[::2], old[1::2]):
                                    mask[a:b] = True
                        n_words.append(n)
                        spans.append(_spans(mask) if mask is not None else [])
                        items.append(sorted(ids))
                    columns = [at.column(0), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
                    names = [id_col, "n_words", "spans", "items"]
                    if keep_text:
                        columns, names = [*columns[:1], at.column(1), *columns[2:]], [id_col, "text", "spans", "items"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        keep_text = not last
        return df.mapInArrow(run, f"`{id_col}` {kind}, text string, spans array<long>, items array<string>" if keep_text else shape)

    blocks = _blocks(benchmark, item_col, item_text_col, config.max_block_words)
    block, out, carried = next(blocks, []), source, False
    while True:
        following = next(blocks, None)
        last = following is None
        out = scan(spark.sparkContext.broadcast(SuffixAutomaton(block, config.window)), out, carried)
        if last:
            break
        block, carried = following, True
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda t, x: t + x)
    return out.select(id_col, "n_words", hit.alias("n_hit"), "spans", "items")


def item_digest(items: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def contamination_digests(docs: DataFrame, benchmark: DataFrame, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """``find_contamination`` with the items as a count and a digest."""
    found = find_contamination(docs, benchmark, config)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_contamination(docs: DataFrame, benchmark: DataFrame, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """``docs`` with hit spans cut out of ``text``, and without rows beyond the limits of ``config``.

    A span goes with the white space that parts it from the word before it.
    ``n_chars``, where there is such a column, counts the code points left.
    Texts without a hit, null ones included, stay as they are.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = docs.schema
    text_at = schema.fieldNames().index("text")
    blocks = _blocks(benchmark, "item_id", "text", config.max_block_words)
    block, out = next(blocks, []), docs
    while True:
        following = next(blocks, None)
        shared, carried = spark.sparkContext.broadcast(SuffixAutomaton(block, config.window)), _SPANS in out.columns
        if following is None:
            out = out.mapInArrow(_cut(shared, text_at, config, carried), schema)
            break
        # every block sees the whole text; what was found is cut when all of them have been
        out = out.mapInArrow(_mark(shared, text_at, carried), StructType([*schema.fields, StructField(_SPANS, ArrayType(LongType()))]))
        block = following
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(schema["n_chars"].dataType), "n_chars"))
    return out


#: The column with the spans that earlier blocks of items have found.
_SPANS = "papyrion_spans"


def _joined(mask: np.ndarray | None, n: int, spans: list[int] | None) -> np.ndarray | None:
    """A row's hit mask with spans found before."""
    if spans:
        mask = np.zeros(n, bool) if mask is None else mask
        for a, b in zip(spans[::2], spans[1::2]):
            mask[a:b] = True
    return mask


def _mark(shared, text_at: int, carried: bool):
    def run(batches):
        automaton = shared.value
        for batch in batches:
            for piece in pieces(batch.column(text_at)):
                rows = batch.slice(piece.first, piece.rows)
                columns, spans = rows.columns[: rows.num_columns - carried], []
                for r, _, n, mask, _ in hits(piece, automaton):
                    mask = _joined(mask, n, rows.column(rows.num_columns - 1)[r].as_py() if carried else None)
                    spans.append(_spans(mask) if mask is not None else [])
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.list_(pa.int64()))], names=[*rows.schema.names[: len(columns)], _SPANS])

    return run


def _cut(shared, text_at: int, config: DecontaminationConfig, carried: bool):
    def run(batches):
        automaton = shared.value
        for batch in batches:
            for piece in pieces(batch.column(text_at)):
                rows = batch.slice(piece.first, piece.rows)
                texts, keep, starts = {}, np.ones(piece.rows, bool), None
                if carried:
                    found, rows = rows.column(rows.num_columns - 1), rows.select(rows.schema.names[:-1])
                for r, first, n, mask, _ in hits(piece, automaton):
                    mask = _joined(mask, n, found[r].as_py() if carried else None)
                    if mask is None:
                        continue
                    if starts is None:
                        starts, ends, _ = piece.words(ALNUM)
                    edges, begin, parts = _spans(mask), int(piece.offsets[r]), []
                    longest = max(b - a for a, b in zip(edges[::2], edges[1::2]))
                    keep[r] = 100 * mask.sum() <= config.max_coverage_percent * n and (config.max_span_words is None or longest <= config.max_span_words)
                    for a, b in zip(edges[::2], edges[1::2]):
                        parts.append(piece.data[begin : int(starts[first + a])].tobytes().rstrip(b" \t\n\r\x0b\x0c") if a else b"")
                        begin = int(ends[first + b - 1])
                    parts.append(piece.data[begin : int(piece.offsets[r + 1])].tobytes())
                    texts[r] = b"".join(parts).decode("utf-8")
                if texts:
                    old = rows.column(text_at)
                    new = pa.array([texts[r] if r in texts else old[r].as_py() for r in range(piece.rows)], old.type)
                    columns = [new if i == text_at else c for i, c in enumerate(rows.columns)]
                    rows = pa.RecordBatch.from_arrays(columns, schema=rows.schema).filter(pa.array(keep))
                yield rows

    return run
