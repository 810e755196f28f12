"""Documents scored by masked pseudo-likelihood.

A small network predicts each word from the words in a window on both of its
sides, as if the word were masked; a document's score is the sum of those
conditional log-probabilities.

The vocabulary comes from the counts of all words of all documents: the
``most_words`` most frequent ones have an entry of their own, if they occur
``min_count`` times, and all others share hashed entries.  So the network has
the same size for every large corpus, while the counts grow with it.  A word of a shared entry has the entry's
log-probability plus the log of its own share of the entry's occurrences, so
the probabilities of all words add up to one.  Words are predicted in three
steps of a tree: one of the classes of like frequency, a part of it, and the
entry within that.  All three have about as many branches.

Training passes over every word of every document in a fixed number of rounds.
A document's round follows from a hash of its id and text.  Each round has the
gradient summed over all its words, wherever they lie, and takes one step from
it (Adam), which is the start of the next round.  Neither the number of steps
nor their size depends on how rows lie in files or partitions.  Gradients are
added in a tree of tasks, as many as the cluster has cores; the driver gets one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrion.llm.bytewords import SPACED, Piece, pieces
from papyrion.llm.scratch import Scratch, ship_package


@dataclass(frozen=True)
class WindowLmConfig:
    #: Branches of each of the tree's three steps, at least; a larger vocabulary has more.
    branches: int = 8
    #: Of the words that occur so often, the most frequent ones have an entry of their own.
    min_count: int = 100
    most_words: int = 4032
    #: Of the words that occur so often, the counts of the most frequent ones go to every task (16 bytes each); others are joined.
    known_count: int = 100
    most_known: int = 200_000
    #: Entries at the end of the vocabulary that rare words are hashed to.
    rare: int = 64
    dim: int = 16
    window: int = 2
    #: Words at a time.
    batch: int = 65536
    rounds: int = 24
    #: The first round's step; it falls to a tenth in the last.
    rate: float = 0.2
    seed: int = 11
    #: Gradients that one task adds up.
    fan_in: int = 32

    @property
    def size(self) -> int:
        return self.branches**3

    def holding(self, words: int) -> WindowLmConfig:
        """This with room for so many words of their own."""
        branches = self.branches
        while branches**3 < words + self.rare:
            branches += 1
        return replace(self, branches=branches)


#: Bits of a hash that are looked at first.
_PLACE_BITS = 21


class Vocabulary:
    """Word hashes to entries; entry ``size`` stands for what lies outside a document."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, rare_counts: np.ndarray, config: WindowLmConfig):
        """``hashes``: of the words with known counts, the most frequent first; ``rare_counts``: occurrences of all words of each hashed entry."""
        own = min(int((counts >= config.min_count).sum()), config.most_words)
        #: The last of the known words, where there may be more of them.
        self.last = (int(counts[-1]), int(hashes[-1:].view(np.int64)[0])) if len(counts) >= config.most_known else None
        c = self.config = config.holding(own)
        rare_counts = rare_counts - np.bincount(self._shared(hashes[:own]) - (c.size - c.rare), weights=counts[:own], minlength=c.rare).astype(np.int64)
        order = np.argsort(hashes)
        self.sorted, n = hashes[order], counts[order]
        shared = self._shared(self.sorted)
        self.entry = np.where(order < own, order, shared).astype(np.int32)
        #: Log of a word's share of its entry; one occurrence of an entry is kept for words that no document had.
        self.rare_logs = np.log(rare_counts + 1.0)
        self.share = np.where(order < own, 0.0, np.log(np.maximum(n, 1)) - self.rare_logs[shared - (c.size - c.rare)])
        self.totals = np.zeros(c.size)
        self.totals[:own] = counts[:own]
        self.totals[c.size - c.rare :] = rare_counts + 1.0

    def _shared(self, hashes: np.ndarray) -> np.ndarray:
        c = self.config
        return c.size - c.rare + (hashes >> np.uint64(58)).astype(np.int64) % c.rare

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entries, logs of shares, whether the count is known); an unknown count is taken for 1."""
        out, share, known = self._shared(hashes).astype(np.int32), np.zeros(len(hashes)), np.zeros(len(hashes), bool)
        if len(self.sorted) and len(hashes):
            # the first bits say where a word would be; only where two known words share them it is searched for
            at = self._places()[(hashes >> np.uint64(64 - _PLACE_BITS)).astype(np.int64)]
            many = np.flatnonzero(at == -2)
            at[many] = np.minimum(np.searchsorted(self.sorted, hashes[many]), len(self.sorted) - 1)
            known = (at >= 0) & (self.sorted[at] == hashes)
            out[known], share[known] = self.entry[at[known]], self.share[at[known]]
        share[~known] = -self.rare_logs[out[~known] - (self.config.size - self.config.rare)]
        return out, share, known

    def _places(self) -> np.ndarray:
        """For each value of a hash's first bits: the place of the one known word with it, -1 for none, -2 for several.  Made anew in each worker."""
        if self.__dict__.get("places") is None:
            first = (self.sorted >> np.uint64(64 - _PLACE_BITS)).astype(np.int64)
            self.places = np.full(1 << _PLACE_BITS, -1, np.int32)
            self.places[first] = np.arange(len(first))
            self.places[first[1:][first[1:] == first[:-1]]] = -2
        return self.places

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "places"}

    def entries(self, hashes: np.ndarray) -> np.ndarray:
        return self.look_up(hashes)[0]

    def contexts(self, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, contexts, offsets): each word's entry, and those around it, nearest first."""
        starts, ends, offsets = piece.words(SPACED)
        words = self.entries(piece.hashes(starts, ends))
        return words, self.around(words, offsets), offsets

    def around(self, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n, w, size = len(words), self.config.window, self.config.size
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        padded, rows = np.full(n + 2 * w, size, np.int32), np.full(n + 2 * w, -1)
        padded[w : w + n], rows[w : w + n] = words, row
        around = np.empty((2 * w, n), np.int32)
        for i, by in enumerate(d for k in range(1, w + 1) for d in (-k, k)):
            around[i] = np.where(rows[w + by : w + by + n] == row, padded[w + by : w + by + n], size)
        return around


def _exp(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(z) in place of z, and its sums by row."""
    np.exp(np.minimum(z, 80, out=z), out=z)
    return z, z.sum(axis=1)


def _log_picked(z: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The log-softmax of z at one column of each row."""
    at = z[np.arange(len(z)), picked]
    return at - np.log(_exp(z)[1])


def _softmax(z: np.ndarray) -> np.ndarray:
    z, sums = _exp(z)
    z /= sums[:, None]
    return z


class WindowLm:
    """h = tanh(sum over the window of E[place, word]); classes by C, a class's parts by S, entries within a part by W."""

    def __init__(self, config: WindowLmConfig, totals: np.ndarray | None = None):
        """``totals``: occurrences of each entry, whose frequencies are the start of the biases."""
        c = self.config = config
        rng, k = np.random.default_rng(c.seed), c.branches
        draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.E = draw(2 * c.window, c.size + 1, c.dim)
        self.C, self.Cb = draw(1, c.dim, k), np.zeros((1, k), np.float32)
        self.S, self.Sb = draw(k, c.dim, k), np.zeros((k, k), np.float32)
        self.W, self.Wb = draw(k * k, c.dim, k), np.zeros((k * k, k), np.float32)
        if totals is not None and totals.sum():
            n = totals.reshape(k, k, k)
            for bias, parts in ((self.Cb, n.sum(axis=(1, 2))), (self.Sb, n.sum(axis=2)), (self.Wb, n)):
                parts = parts.reshape(-1, k)
                with np.errstate(divide="ignore", invalid="ignore"):
                    logs = np.log(parts / parts.sum(axis=1, keepdims=True))
                bias[:] = np.maximum(np.nan_to_num(logs, nan=0.0, neginf=-30), -30)

    def parameters(self) -> list[np.ndarray]:
        return [self.E, self.C, self.Cb, self.S, self.Sb, self.W, self.Wb]

    def _steps(self) -> list[tuple[int, int, int]]:
        """(weights' place among the parameters, entries under a node, entries under a branch) of each step."""
        k = self.config.branches
        return [(1, k**3, k * k), (3, k * k, k), (5, k, 1)]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, flat: np.ndarray) -> WindowLm:
        at = 0
        for p in self.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def hidden(self, around: np.ndarray) -> np.ndarray:
        h = self.E[0][around[0]]
        for place in range(1, len(around)):
            h += self.E[place][around[place]]
        return np.tanh(h, out=h)

    def _sorted(self, words: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, words, hidden values), sorted so that the words under each node of the tree follow each other."""
        parts = words // self.config.branches
        order = np.argsort(parts.astype(np.uint16) if self.config.branches**2 < 1 << 16 else parts, kind="stable")
        return order, words[order], self.hidden(around[:, order])

    def _nodes(self, words: np.ndarray, under: int, most: int = 4096) -> Iterator[tuple[int, int, int]]:
        """(node, begin, end) of sorted words that are under one node, a bounded number at a time."""
        nodes = words // under
        edges = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else []
        for a, b in zip(edges, [*edges[1:], len(nodes)]):
            for at in range(a, b, most):
                yield int(nodes[a]), at, min(at + most, b)

    def log_probabilities(self, words: np.ndarray, around: np.ndarray) -> np.ndarray:
        order, words, h = self._sorted(words, around)
        sums, out = np.zeros(len(words), np.float32), np.empty(len(words), np.float32)
        for place, under, below in self._steps():
            weights, biases = self.parameters()[place : place + 2]
            picked = words % under // below
            for node, a, b in self._nodes(words, under):
                sums[a:b] += _log_picked(h[a:b] @ weights[node] + biases[node], picked[a:b])
        out[order] = sums
        return out

    def gradient(self, words: np.ndarray, around: np.ndarray) -> list[np.ndarray]:
        """Of the summed negative log-probability, in the order of ``parameters``."""
        out = [np.zeros_like(p) for p in self.parameters()]
        order, words, h = self._sorted(words, around)
        back = np.zeros_like(h)
        for place, under, below in self._steps():
            weights, biases = self.parameters()[place : place + 2]
            picked = words % under // below
            for node, a, b in self._nodes(words, under):
                p = _softmax(h[a:b] @ weights[node] + biases[node])
                p[np.arange(b - a), picked[a:b]] -= 1
                back[a:b] += p @ weights[node].T
                out[place][node] += h[a:b].T @ p
                out[place + 1][node] += p.sum(axis=0)
        back *= 1 - h * h
        for place, ids in enumerate(around[:, order]):
            self._add_rows(out[0][place], ids, back)
        return out

    @staticmethod
    def _add_rows(to: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Add each row to that of ``to`` with its id."""
        if len(ids):
            order = np.argsort(ids.astype(np.uint16) if len(to) < 1 << 16 else ids, kind="stable")
            ids = ids[order]
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            to[ids[first]] += np.add.reduceat(rows[order], first, axis=0)

    def train(self, words: np.ndarray, around: np.ndarray, rate: float) -> None:
        """One step of plain gradient descent on a batch."""
        for p, g in zip(self.parameters(), self.gradient(words, around)):
            p -= (rate / len(words) * g).astype(np.float32)


class Adam:
    """Steps of like size for each parameter, however rare its words are."""

    def __init__(self, config: WindowLmConfig, size: int):
        self.config, self.done = config, 0
        self.mean, self.square = np.zeros(size, np.float32), np.zeros(size, np.float32)

    def step(self, flat: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        rate = self.config.rate * (1 - 0.9 * self.done / max(1, self.config.rounds - 1))
        self.done += 1
        self.mean += 0.2 * (gradient - self.mean)
        self.square += 0.05 * (gradient * gradient - self.square)
        m, v = self.mean / (1 - 0.8**self.done), self.square / (1 - 0.95**self.done)
        return flat - rate * m / (np.sqrt(v) + 1e-9)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) for each distinct word of all texts, A-Z lower-cased, as a 64-bit hash."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            hashed = [p.hashes(*p.words(SPACED)[:2]) for p in pieces(batch.column(0))]
            words, n = np.unique(np.concatenate(hashed) if hashed else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_vocabulary(counts: DataFrame, config: WindowLmConfig = WindowLmConfig()) -> Vocabulary:
    """From ``word_counts``."""
    top = counts.where(F.col("n") >= min(config.known_count, config.min_count)).orderBy(F.desc("n"), "word").limit(config.most_known).toArrow()
    entry = (F.shiftrightunsigned("word", 58) % config.rare).alias("entry")
    rare = np.zeros(config.rare, np.int64)
    for entry_, n in counts.groupBy(entry).agg(F.sum("n")).collect():
        rare[entry_] = n
    return Vocabulary(top["word"].to_numpy().view(np.uint64), top["n"].to_numpy(), rare, config)


def _words_by_round(docs: DataFrame, vocabulary, config: WindowLmConfig, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """(words, lengths, round): the entries of the documents of each round, some at a time."""
    keys = [F.col(c).cast("string") for c in (id_col, text_col) if c in docs.columns]
    source = docs.select(F.col(text_col).cast("string"), F.pmod(F.xxhash64(*keys), F.lit(config.rounds)).cast("int"))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch.column(0)):
                words, _, offsets = piece_entries(vocabulary.value, piece)
                rounds = batch.column(1).slice(piece.first, piece.rows).to_numpy()
                lengths = np.diff(offsets).astype(np.int32)
                of_word = np.repeat(rounds, lengths)
                here = np.unique(rounds)
                columns = [[words[of_word == r].tobytes() for r in here], [lengths[rounds == r].tobytes() for r in here], here]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int32())], names=["words", "lengths", "round"])

    shape = "words binary, lengths binary, round int"
    # a task writes a file for each round, so a few partitions share one; a lost task repeats no more than those
    tasks = max(4 * docs.sparkSession.sparkContext.defaultParallelism, source.rdd.getNumPartitions() // 8)
    source.coalesce(tasks).mapInArrow(run, shape).write.partitionBy("round").parquet(scratch.path("words"))
    return docs.sparkSession.read.schema(shape).parquet(scratch.path("words"))


def piece_entries(vocabulary: Vocabulary, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries, hashes, offsets) of the words of a piece."""
    starts, ends, offsets = piece.words(SPACED)
    hashes = piece.hashes(starts, ends)
    return vocabulary.entries(hashes), hashes, offsets


def train(docs: DataFrame, config: WindowLmConfig = WindowLmConfig(), text_col: str = "text", id_col: str = "doc_id", counts: DataFrame | None = None) -> tuple[Vocabulary, WindowLm]:
    """Vocabulary and network of all texts.  With no words at all the network is the untrained start."""
    spark = docs.sparkSession
    sc, scratch = spark.sparkContext, Scratch(spark, "lm")
    counts = scratch.save(word_counts(docs, text_col), "counts") if counts is None else counts
    vocabulary = build_vocabulary(counts, config)
    sized = vocabulary.config
    model = WindowLm(sized, vocabulary.totals)
    # at most 16 bytes for each known word
    table = _words_by_round(docs, sc.broadcast(vocabulary), config, scratch, id_col, text_col)
    schema = pa.schema([("words", pa.int64()), ("gradient", pa.binary())])

    def result(n, total):
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], schema=schema)

    def fit(start):
        def run(batches):
            vocabulary, flat = start.value
            model, seen, total = WindowLm(sized).load(flat), 0, None
            held, size = [], 0

            def use():
                nonlocal seen, total, held, size
                words, lengths = (np.concatenate(x) for x in zip(*held))
                around = vocabulary.around(words, np.concatenate([[0], np.cumsum(lengths)]))
                for at in range(0, len(words), sized.batch):
                    parts = model.gradient(words[at : at + sized.batch], around[:, at : at + sized.batch])
                    # sums in double precision: their order hardly shows
                    total = [p.astype(np.float64) for p in parts] if total is None else [np.add(a, b, out=a) for a, b in zip(total, parts)]
                seen, held, size = seen + len(words), [], 0

            for batch in batches:
                for w, n in zip(batch.column(0), batch.column(1)):
                    held.append((np.frombuffer(w.as_py(), np.int32), np.frombuffer(n.as_py(), np.int32)))
                    size += len(held[-1][0])
                    if size >= sized.batch:
                        use()
            if size:
                use()
            yield from result(seen, np.concatenate([p.ravel() for p in total]) if seen else None)

        return run

    def add(batches):
        seen, total = 0, None
        for batch in batches:
            for n, one in zip(batch.column(0), batch.column(1)):
                flat = np.frombuffer(one.as_py(), np.float32)
                total = flat.astype(np.float64) if total is None else np.add(total, flat, out=total)
                seen += n.as_py()
        yield from result(seen, total)

    flat = model.flat()
    adam = Adam(sized, len(flat))
    around = _Around(sized)
    for i in range(config.rounds):
        start = sc.broadcast((around, flat))
        part = table.where(F.col("round") == i).select("words", "lengths")
        left = max(sc.defaultParallelism, part.rdd.getNumPartitions() // 8)
        summed = part.coalesce(left).mapInArrow(fit(start), "words long, gradient binary")
        while left > 1:
            left = -(-left // config.fan_in)
            summed = summed.repartition(left).mapInArrow(add, "words long, gradient binary")
        found = summed.collect()
        start.destroy()
        if found:
            flat = adam.step(flat, np.frombuffer(found[0]["gradient"], np.float32) / np.float32(found[0]["words"]))
    scratch.drop("words")
    return vocabulary, model.load(flat)


def score_documents(docs: DataFrame, vocabulary: Vocabulary, model: WindowLm, id_col: str = "doc_id", text_col: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """(id, n_words, log_likelihood, perplexity) of each whole text.

    ``log_likelihood`` sums the natural log-probability of each word given its
    window; ``perplexity`` is exp of its negated mean.  A null, empty or blank
    text has no words, a sum of 0 and a null perplexity.  ``counts`` are those
    of the corpus (``word_counts``); a word that is neither there nor known to
    the vocabulary counts as one occurrence.
    """
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    shared = spark.sparkContext.broadcast((vocabulary, model))
    shape = f"`{id_col}` {kind}, n_words long, log_likelihood double, rare array<long>"

    def run(batches):
        vocabulary, model = shared.value
        step = model.config.batch
        for batch in batches:
            for piece in pieces(batch.column(1)):
                starts, ends, offsets = piece.words(SPACED)
                hashes = piece.hashes(starts, ends)
                words, share, known = vocabulary.look_up(hashes)
                around = vocabulary.around(words, offsets)
                parts = [model.log_probabilities(words[at : at + step], around[:, at : at + step]) for at in range(0, len(words), step)]
                sums = np.concatenate([[0.0], np.cumsum(np.concatenate(parts) + share, dtype=np.float64)]) if parts else np.zeros(1)
                total, n = sums[offsets[1:]] - sums[offsets[:-1]], np.diff(offsets)
                ends_of = np.concatenate([[0], np.cumsum(~known)])[offsets]
                rare = pa.ListArray.from_arrays(pa.array(ends_of.astype(np.int32)), pa.array(hashes[~known].view(np.int64)))
                columns = [batch.column(0).slice(piece.first, piece.rows), pa.array(n.astype(np.int64)), pa.array(total), rare]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "log_likelihood", "rare"])

    scored = source.mapInArrow(run, shape)
    total = F.col("log_likelihood")
    if counts is not None:
        # the counts of words that are not in the vocabulary: each is rare, so no key is hot
        scored = Scratch(spark, "lm").save(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
        unknown = F.col("n") < min(vocabulary.config.known_count, vocabulary.config.min_count)
        if vocabulary.last:
            n, word = vocabulary.last
            unknown = (F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word))
        rest = counts.where((F.col("n") > 1) & unknown)
        more = scored.select("row", F.explode("rare").alias("word")).join(rest, "word").groupBy("row").agg(F.sum(F.log("n")).alias("more"))
        scored, total = scored.join(more, "row", "left"), total + F.coalesce("more", F.lit(0.0))
    out = scored.select(id_col, "n_words", total.alias("log_likelihood"))
    return out.withColumn("perplexity", F.when(F.col("n_words") > 0, F.exp(-F.col("log_likelihood") / F.col("n_words"))))


class _Around(Vocabulary):
    """Only what ``around`` needs."""

    def __init__(self, config: WindowLmConfig):
        self.config = config


def score_corpus(docs: DataFrame, config: WindowLmConfig = WindowLmConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score_documents`` by a network of the same documents."""
    counts = Scratch(docs.sparkSession, "lm").save(word_counts(docs, text_col), "counts")
    return score_documents(docs, *train(docs, config, text_col, id_col, counts), id_col, text_col, counts)
