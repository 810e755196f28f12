"""Byte-pair encoding and decoding with a segment tree over pair ranks.

The rules come from a public tokenizer file whose words end with a suffix.  A
text is cut at the special tokens, normalised (NFC, white space, lower case),
split into pieces, and each piece is merged on its own:  leaves of a segment
tree hold the rank of each adjacent pair, the root yields the lowest rank and,
among equals, the leftmost pair, and each merge updates the three leaves that
it touches.  A piece of n symbols costs O(n log n), so a text without any white
space is as cheap per byte as any other.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrion.llm.scratch import ship_package

#: White space as the tokenizer's own patterns take it (Unicode White_Space).
_SPACE = r"\t-\r \x85\xa0  -     　"
_SPLIT = regex.compile(f"[{_SPACE}]+")
_PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Characters that str.split() takes for white space and the tokenizer does not.
_ODD = r"[\x1c-\x1f]"
_PIECE_OR_END = regex.compile(rf"{_PIECE.pattern}|\n")
_NO_RANK = 1 << 60
_ID = (1 << 20) - 1
#: Stands for a symbol that the vocabulary lacks; no pair with it has a rank.
_UNKNOWN = _ID
#: Pieces of at most so many bytes are merged together, longer ones each by itself.
_TOGETHER = 64
#: Characters of text that are encoded together, which bounds what a task holds.
_STRETCH = 2_000_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class SegmentTree:
    """Least value over positions, with the leftmost position of that value at the root."""

    def __init__(self, values: list[int]):
        size = 1
        while size < len(values):
            size *= 2
        self.size = size
        self.least = [_NO_RANK] * size + values + [_NO_RANK] * (size - len(values))
        for i in range(size - 1, 0, -1):
            a, b = self.least[2 * i], self.least[2 * i + 1]
            self.least[i] = a if a <= b else b

    def set(self, at: int, value: int) -> None:
        least, i = self.least, at + self.size
        least[i] = value
        i >>= 1
        while i:
            a, b = least[2 * i], least[2 * i + 1]
            now = a if a <= b else b
            if least[i] == now:
                break
            least[i] = now
            i >>= 1

    def leftmost_least(self) -> tuple[int, int]:
        """(position, value) of the leftmost least value."""
        least, i = self.least, 1
        value = least[1]
        while i < self.size:
            i *= 2
            if least[i] != value:
                i += 1
        return i - self.size, value


class SegmentTrees:
    """Segment trees of one size, a row each, that are read and changed together."""

    def __init__(self, values: np.ndarray):
        rows, self.size = values.shape
        self.least = np.full((rows, 2 * self.size), _NO_RANK, np.int64)
        self.least[:, self.size :] = values
        at = self.size
        while at > 1:
            half = at // 2
            self.least[:, half:at] = np.minimum(self.least[:, at : 2 * at : 2], self.least[:, at + 1 : 2 * at : 2])
            at = half

    def set(self, rows: np.ndarray, leaves: list[np.ndarray], values: list[np.ndarray]) -> None:
        """Write several leaves of each of ``rows``, the last one of equal leaves in the end."""
        flat, base = self.least.reshape(-1), rows * (2 * self.size)
        nodes = [leaf + self.size for leaf in leaves]
        for i, value in zip(nodes, values):
            flat[base + i] = value
        for _ in range(self.size.bit_length() - 1):
            nodes = [i >> 1 for i in nodes]
            for i in nodes:
                below = base + 2 * i
                flat[base + i] = np.minimum(flat[below], flat[below + 1])

    def leftmost_least(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, values) of the leftmost least value of each of ``rows``."""
        flat, base = self.least.reshape(-1), rows * (2 * self.size)
        value, i = flat[base + 1], np.ones(len(rows), np.int64)
        for _ in range(self.size.bit_length() - 1):
            i *= 2
            i += flat[base + i] != value
        return i - self.size, value


class WordBpe:
    """Encode and decode with the vocabulary and merges of one tokenizer file."""

    def __init__(self, definition: str):
        model = json.loads(definition)
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.suffix: str = model["model"]["end_of_word_suffix"]
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"])
        # a pair of ids is one integer, and so are a merge's rank and the id that it makes
        self.merges = {self.ids[a] << 20 | self.ids[b]: rank << 20 | self.ids[a + b] for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        alphabet = byte_alphabet()
        self._inner = np.array([self.ids.get(c, _UNKNOWN) for c in alphabet], np.int64)
        self._final = np.array([self.ids.get(c + self.suffix, _UNKNOWN) for c in alphabet], np.int64)
        self._pairs = np.array(sorted(self.merges) + [1 << 62], np.int64)
        self._ranks = np.array([self.merges[p] for p in self._pairs[:-1].tolist()] + [_NO_RANK], np.int64)
        most = max(self.tokens, default=0) + 1
        self._id_texts = pa.array(map(str, range(most)), pa.large_string())
        self._token_texts = pa.array([self.tokens.get(i) for i in range(most)], pa.large_string())
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def merge(self, at: list[int]) -> list[int]:
        """Apply merges to a list of ids in rank order, leftmost first, until no adjacent pair has a rank."""
        n, merges = len(at), self.merges.get
        if n < 2:
            return at
        values = [merges(a << 20 | b, _NO_RANK) for a, b in zip(at, at[1:])]
        if n == 2:
            return at if values[0] == _NO_RANK else [values[0] & _ID]
        tree = SegmentTree(values)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        while (least := tree.least[1]) < _NO_RANK:
            i, _ = tree.leftmost_least()
            j = following[i]
            at[i], at[j] = least & _ID, -1
            k = following[i] = following[j]
            if j < n - 1:
                tree.set(j, _NO_RANK)
            if k < n:
                previous[k] = i
                tree.set(i, merges(at[i] << 20 | at[k], _NO_RANK))
            else:
                tree.set(i, _NO_RANK)
            if (p := previous[i]) >= 0:
                tree.set(p, merges(at[p] << 20 | at[i], _NO_RANK))
        return [s for s in at if s >= 0]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a << 20 | b
        at = np.searchsorted(self._pairs, pair)
        return np.where(self._pairs[at] == pair, self._ranks[at], _NO_RANK)

    def merge_rows(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``merge`` of each row's first ``n`` ids, all rows at once; in place, with -1 where no id is left."""
        rows, size = at.shape
        place = np.arange(size)
        values = np.full((rows, size), _NO_RANK, np.int64)
        inner = place[None, :-1] < (n - 1)[:, None]
        values[:, :-1][inner] = self._rank(at[:, :-1][inner], at[:, 1:][inner])
        trees = SegmentTrees(values)
        # a place more on each side stands for "none"
        following, previous = np.tile(place + 1, (rows, 1)), np.tile(place - 1, (rows, 1))
        live, ids, following, previous = np.arange(rows), at.reshape(-1), following.reshape(-1), previous.reshape(-1)
        while True:
            live = live[trees.least[live, 1] < _NO_RANK]
            if not len(live):
                return at
            i, least = trees.leftmost_least(live)
            base, end, made = live * size, n[live], least & _ID
            j = following[base + i]
            k = following[base + j]
            ids[base + i], ids[base + j], following[base + i] = made, -1, k
            more = k < end
            k = np.where(more, k, i)
            previous[(base + k)[more]] = i[more]
            p = previous[base + i]
            first = p < 0
            p = np.where(first, i, p)
            ahead = np.where(more, self._rank(made, ids[base + k]), _NO_RANK)
            trees.set(live, [j, p, i], [np.full(len(live), _NO_RANK), np.where(first, _NO_RANK, self._rank(ids[base + p], made)), ahead])

    def _pieces(self, pieces: pa.StringArray) -> pa.ListArray:
        """The ids of each piece; symbols that the vocabulary lacks are left out."""
        starts = np.frombuffer(pieces.buffers()[1], np.int32, len(pieces) + 1, 4 * pieces.offset).astype(np.int64)
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        n = np.diff(starts)
        made, places = [], []
        size, done = 1, np.int64(0)
        while size <= _TOGETHER:
            here = np.flatnonzero((n > done) & (n <= size))
            if len(here):
                place = np.arange(size)
                held = place < n[here, None]
                at = np.full((len(here), size), -1, np.int64)
                at[held] = self._inner[data[(starts[here, None] + place)[held]]]
                at[np.arange(len(here)), n[here] - 1] = self._final[data[starts[here] + n[here] - 1]]
                if size > 1:
                    at = self.merge_rows(at, n[here])
                left = (at >= 0) & (at != _UNKNOWN)
                made.append(_lists(left.sum(axis=1), at[left]))
                places.append(here)
            size, done = 2 * size, size
        for x in np.flatnonzero(n > done).tolist():
            symbols = self._inner[data[starts[x] : starts[x + 1]]].tolist()
            symbols[-1] = int(self._final[data[starts[x + 1] - 1]])
            ids = [i for i in self.merge(symbols) if i != _UNKNOWN]
            made.append(_lists(np.array([len(ids)]), np.array(ids, np.int64)))
            places.append(np.array([x]))
        if not made:
            return _lists(np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.concat_arrays(made).take(pa.array(np.argsort(np.concatenate(places))))

    def _different_words(self, words: list[str]) -> pa.ListArray:
        """The ids of each run without white space; a special token stands for itself."""
        joined = "\n".join(["" if w in self.special else w for w in words])
        plain = joined if joined.isascii() else unicodedata.normalize("NFC", joined).replace("Σ", "σ")
        found = pa.array(_PIECE_OR_END.findall(plain.lower() + "\n"), pa.string()).dictionary_encode()
        pieces = self._pieces(found.dictionary)
        codes = found.indices.to_numpy()
        mark = pc.index(found.dictionary, "\n").as_py()
        ends = codes == mark
        taken = pieces.take(pa.array(np.where(ends, -1, codes), mask=ends))
        counts = pc.fill_null(pc.list_value_length(taken), 0).to_numpy()
        until = np.cumsum(counts)[ends]
        out = _lists(np.diff(until, prepend=0), taken.flatten())
        special = [i for i, w in enumerate(words) if w in self.special]
        if special:
            ids = _lists(np.ones(len(special), np.int64), np.array([self.special[words[i]] for i in special]))
            order = np.arange(len(words))
            order[special] = len(words) + np.arange(len(special))
            out = pa.concat_arrays([out, ids]).take(pa.array(order))
        return out

    def _runs(self, text: str) -> list[str]:
        """The words of a text in order, special tokens among them."""
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [*_SPLIT.split(text[at : m.start()]), m.group()]
            at = m.end()
        return [w for w in out + _SPLIT.split(text[at:]) if w]

    def encode_texts(self, texts: pa.StringArray) -> pa.ListArray:
        """The ids of each text; the words that differ are cut into pieces and merged once."""
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, _ODD)).to_numpy(zero_copy_only=False)
        words = pc.utf8_split_whitespace(texts)
        if odd.any():
            at = np.flatnonzero(odd)
            order = np.arange(len(texts))
            order[at] = len(texts) + np.arange(len(at))
            words = pa.concat_arrays([words, pa.array([self._runs(texts[i].as_py()) for i in at.tolist()], words.type)]).take(pa.array(order))
        coded = words.flatten().dictionary_encode()
        made = self._different_words(coded.dictionary.to_pylist()).take(coded.indices)
        until = np.concatenate([[0], np.cumsum(pc.list_value_length(made).to_numpy())])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        return _lists(np.diff(until[ends]), made.flatten())

    def texts_of(self, ids: pa.ListArray) -> tuple[pa.LargeStringArray, pa.LargeStringArray]:
        """Of each list, its ids and its tokens, joined by a space."""
        space = pa.scalar(" ", pa.large_string())
        joined = lambda texts: pc.binary_join(pa.ListArray.from_arrays(ids.offsets, texts.take(ids.values)), space)
        return joined(self._id_texts), joined(self._token_texts)

    def encode(self, text: str) -> list[int]:
        return self.encode_texts(pa.array([text], pa.string()))[0].as_py()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by a space, as the file names no decoder; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def _lists(counts: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    """Lists of ``counts`` values each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _stretches(text: str) -> list[str]:
    """``text`` in stretches of about ``_STRETCH`` characters, cut at white space, where no piece or special token goes on."""
    out, at = [], 0
    while len(text) - at > _STRETCH and (m := _SPLIT.search(text, at + _STRETCH)):
        out.append(text[at : m.start()])
        at = m.end()
    return [*out, text[at:]]


def _groups(texts: pa.StringArray) -> Iterator[pa.StringArray]:
    """Runs of texts of about ``_STRETCH`` characters together, one text at least."""
    until = np.cumsum(pc.utf8_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + _STRETCH, "right")))
        yield texts.slice(at, end - at)
        at = end


_LOADED: dict[str, WordBpe] = {}


def _tokenizer(definition: str) -> WordBpe:
    """One tokenizer a Python worker; it holds the vocabulary only, none of the data."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(definition)
    return _LOADED[key]


def tokenizer_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` array<int> and ``decoded`` string of each whole text.

    Null and empty texts have no tokens and decode to the empty string.  Rows
    keep their order and number; columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("token_ids", "decoded")]
    out = docs.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema) + ", token_ids array<int>, decoded string"
    return _mapped(out, path, text_col, schema, full=True)


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_tokens, and SHA-256 of the joined ids and of the decoded text."""
    out = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {out.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(out, path, "text", schema, full=False)


def _digests(parts: Iterable[tuple[pa.LargeStringArray, pa.LargeStringArray]], one: bool) -> list[pa.StringArray]:
    """SHA-256 of ids and tokens of each text, or of one text whose stretches are the parts."""
    if not one:
        return [pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in texts], pa.string()) for texts in next(iter(parts))]
    made, begun = [hashlib.sha256(), hashlib.sha256()], False
    for pair in parts:
        if len(pair[0][0].as_buffer()):
            for sha, texts in zip(made, pair):
                sha.update(b" " if begun else b"")
                sha.update(texts[0].as_buffer())
            begun = True
    return [pa.array([sha.hexdigest()], pa.string()) for sha in made]


def _mapped(df: DataFrame, path: str, text_col: str, schema: str, full: bool) -> DataFrame:
    ship_package(df.sparkSession)
    # The file of a vocabulary: about 1.7 MB, whatever the data.
    definition = df.sparkSession.sparkContext.broadcast(tokenizer_definition(path))

    def run(batches):
        bpe = _tokenizer(definition.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).fill_null("")
            at = 0
            for group in _groups(texts):
                part = batch.slice(at, len(group))
                at += len(group)
                # only a text that is a group by itself can be longer than a stretch
                stretches = _stretches(group[0].as_py()) if len(group) == 1 else []
                if len(stretches) > 1:
                    group = None
                    parts = [bpe.encode_texts(pa.array([s], pa.string())) for s in stretches]
                    ids = _lists(np.array([sum(len(p.values) for p in parts)]), pa.concat_arrays([p.values for p in parts]))
                else:
                    parts = [ids := bpe.encode_texts(group)]
                if full:
                    tokens = [bpe.texts_of(p)[1] for p in parts if len(parts) == 1 or len(p.values)]
                    decoded = tokens[0] if len(parts) == 1 else pa.array([" ".join(t[0].as_py() for t in tokens)])
                    columns = dict(zip(part.schema.names, part.columns)) | {"token_ids": ids, "decoded": decoded.cast(pa.string())}
                else:
                    digests = _digests(map(bpe.texts_of, parts), len(parts) > 1)
                    columns = {part.schema.names[0]: part.column(0), "n_tokens": pc.list_value_length(ids).cast(pa.int64()), "ids_sha256": digests[0], "decoded_sha256": digests[1]}
                yield pa.RecordBatch.from_pydict(columns)
                # what a group took is not kept beside the next stage's needs
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
