"""Toxicity from a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, report, other).  Small
transducers rewrite the symbols of a clause one after another: negation weakens
what follows it, reported speech marks what is only quoted, a target nearby
strengthens an insult or a threat.  They are composed into one machine, whose
last step weighs the symbols that are left.  A document's score is a logistic
function of the sum over its clauses, so a word alone decides little: what
counts is the clause that it stands in.

Function words are fixed lists.  Insults are learned: beginnings of words that
mark labelled toxic documents and hardly ever occur in others, chosen so that
each toxic document is explained by several of them.  Some beginnings mark a
document only where two or three words have them; each such word weighs a half
or a third.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrion.llm.quality_classifier import sample_labelled, training_rows
from papyrion.llm.scratch import Scratch, ship_package

OTHER, INSULT, THREAT, TARGET, SUBJECT, NEGATION, REPORT = "other", "insult", "threat", "target", "subject", "negation", "report"

TARGETS = "you your yours u them him her dich dir ihr euch sie toi te vous usted ustedes".split()
#: Whom an insult may be aimed at, but who does what a threat says.
SUBJECTS = "they he she du tu ils elles ellos ellas".split()
NEGATIONS = "not no never isn't aren't don't doesn't wasn't nicht kein keine nie ne pas jamais nunca ni".split()
REPORTS = "said says quoted quote called wrote claimed reported alleged sagte schrieb nannte dit disait appelé dijo llamó escribió".split()
THREATS = "kill hurt destroy shoot stab strangle murder töten umbringen tuer mourir matar".split()


@dataclass(frozen=True)
class ToxicityConfig:
    """``max_sample`` bounds the documents that the insults are learned from."""

    max_sample: int = 8000
    min_prefix: int = 4
    max_prefix: int = 9
    min_documents: int = 3
    #: An insult is this much likelier in toxic documents (natural logarithm).
    min_log_odds: float = 3.0
    #: Of documents with an insult at most so many are not toxic, as a share of those that are; the second holds for insults that must recur.
    max_noise: tuple[float, float] = (0.05, 0.1)
    #: Words that one beginning may need to mark a document.
    max_need: int = 3
    #: So many insults should explain each toxic document.
    cover: int = 4
    slope: float = 2.0
    bias: float = -1.5
    #: How far a negation or a target reaches, in words.
    reach: int = 3
    weights: dict[str, float] = field(
        default_factory=lambda: {INSULT: 1.0, "aimed insult": 1.5, "negated insult": 0.2, "reported insult": 0.4, THREAT: 0.1, "aimed threat": 1.2, "negated threat": 0.0, "reported threat": 0.2}
    )


class Transducer:
    """A machine that reads a symbol and writes one; states and symbols are any hashable values."""

    def __init__(self, start, step):
        self.start, self._step, self._known = start, step, {}

    def step(self, state, symbol):
        key = state, symbol
        if key not in self._known:
            self._known[key] = self._step(state, symbol)
        return self._known[key]

    def then(self, other: Transducer) -> Transducer:
        """Their composition: ``other`` reads what this one writes."""

        def step(state, symbol):
            a, middle = self.step(state[0], symbol)
            b, out = other.step(state[1], middle)
            return (a, b), out

        return Transducer((self.start, other.start), step)

    def run(self, symbols: Iterable) -> list:
        state, out = self.start, []
        for s in symbols:
            state, o = self.step(state, s)
            out.append(o)
        return out


def _marks(symbol: str) -> bool:
    return symbol in (INSULT, THREAT)


def negation(reach: int) -> Transducer:
    def step(left: int, symbol: str):
        if symbol == NEGATION:
            return reach, symbol
        return max(0, left - 1), f"negated {symbol}" if left and _marks(symbol) else symbol

    return Transducer(0, step)


def reported_speech() -> Transducer:
    def step(reported: bool, symbol: str):
        return reported or symbol == REPORT, f"reported {symbol}" if reported and _marks(symbol) else symbol

    return Transducer(False, step)


def target(reach: int) -> Transducer:
    """Aims an insult at a target or a subject nearby, a threat at a target only."""

    def step(left: tuple[int, int], symbol: str):
        if symbol in (TARGET, SUBJECT):
            return (reach + 1, reach + 1 if symbol == TARGET else max(0, left[1] - 1)), symbol
        aimed = left[0] if symbol == INSULT else left[1] if symbol == THREAT else 0
        return (max(0, left[0] - 1), max(0, left[1] - 1)), f"aimed {symbol}" if aimed else symbol

    return Transducer((0, 0), step)


class ClauseGrammar:
    """The composed machine with its lexicon: word beginnings for insults, whole words for the rest."""

    _CLAUSE = re.compile(r"[^.!?;:\n]+")
    _TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

    def __init__(self, insults: dict[str, float], config: ToxicityConfig = ToxicityConfig()):
        self.insults, self.config = dict(insults), config
        self.words = {w: s for s, ws in ((THREAT, THREATS), (TARGET, TARGETS), (SUBJECT, SUBJECTS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        # a target may stand after its insult: the clause is read forwards, then backwards
        self.forwards = negation(config.reach).then(reported_speech()).then(target(config.reach))
        self.backwards = target(config.reach)
        self.finder = ahocorasick.Automaton()
        for w in [*insults, *THREATS]:
            self.finder.add_word(w, w)
        if len(self.finder):
            self.finder.make_automaton()

    def symbol(self, token: str) -> tuple[str, float]:
        if token in self.words:
            return self.words[token], 1.0
        for n in range(self.config.min_prefix, min(len(token), self.config.max_prefix) + 1):
            if token[:n] in self.insults:
                return INSULT, self.insults[token[:n]]
        return OTHER, 1.0

    def clause_weight(self, clause: str) -> float:
        """The weight of a lower-case clause: 0 where nothing matches."""
        found = [self.symbol(t) for t in self._TOKEN.findall(clause)]
        symbols = self.forwards.run([s for s, _ in found])
        symbols = self.backwards.run(reversed(symbols))[::-1]
        return sum(self.config.weights.get(s, 0.0) * w for s, (_, w) in zip(symbols, found))

    def matched_clauses(self, text: str) -> list[tuple[str, float]]:
        """The clauses of a text with an insult or a threat, and their weights."""
        low, out, done = text.lower(), [], -1
        if not len(self.finder):
            return out
        for end, word in self.finder.iter(low):
            begin = end - len(word) + 1
            if end < done or begin and low[begin - 1].isalpha():
                continue
            # the clause begins after the last separator since the one before it ended
            left = max(low.rfind(c, max(done, 0), begin) for c in ".!?;:\n") + 1
            m = self._CLAUSE.match(low, left)
            done = m.end()
            out.append((m.group(), self.clause_weight(m.group())))
        return out

    def score(self, text: str | None) -> float:
        """0 to 1; a null or empty text gets the score of a text without matches."""
        return self.score_clauses(self.matched_clauses(text or ""))

    def score_clauses(self, clauses: list[tuple[str, float]]) -> float:
        z = self.config.bias + self.config.slope * sum(w for _, w in clauses)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def learn_insults(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig(), label: str = "toxic") -> dict[str, float]:
    """Word beginnings that mark toxic documents, with weights from 0 to 1.

    Learned from a bounded sample of the labelled rows that are not held out.
    Near copies would make all their words look toxic, so of copies with one label
    one counts (``_without_copies``).  A beginning has to be rarer by chance
    than once among all beginnings tested; greedy multi-cover then takes as few
    as explain each document ``cover`` times.  No labels give no insults.
    """
    sample = sample_labelled(docs, labels, label, config.max_sample, training_rows())
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) >= config.min_prefix)
    scratch = Scratch(docs.sparkSession, "toxicity")
    kept = _without_copies(sample.select("label", words.alias("w"), _shingles(F.lower("text")).alias("s")).where(F.size("w") > 0), scratch)
    beginnings = F.flatten(F.transform("w", lambda w: F.transform(F.sequence(F.lit(config.min_prefix), F.least(F.length(w), F.lit(config.max_prefix))), lambda n: F.substring(w, F.lit(1), n))))
    each = kept.select("key", "label", F.explode(beginnings).alias("p")).groupBy("key", "label", "p").agg(F.count(F.lit(1)).alias("times"))
    needs = range(1, config.max_need + 1)
    sums = [F.sum(F.when(F.col("times") >= k, value)).alias(f"{name}{k}") for k in needs for name, value in (("pos", F.col("label")), ("n", F.lit(1)))]
    counts = scratch.save(each.groupBy("p").agg(*sums).where(f"pos1 >= {config.min_documents}"), "counts")
    totals = kept.agg(F.sum("label"), F.count(F.lit(1))).first()
    positives, everything = totals[0] or 0, totals[1]
    if not positives:
        return {}
    base, odds, tested = positives / everything, [], counts.count() * config.max_need
    noise = lambda k: config.max_noise[k > 1]
    rare = " or ".join(f"(pos{k} >= {config.min_documents} and n{k} - pos{k} <= {noise(k)} * pos{k})" for k in needs)
    # bounded by the sample's toxic words
    for row in counts.where(rare).collect():
        for k in needs:
            pos, n = row[f"pos{k}"] or 0, row[f"n{k}"] or 0
            if pos < config.min_documents or n - pos > noise(k) * pos:
                continue
            weight = math.log((pos + 0.5) / (positives + 1)) - math.log((n - pos + 0.5) / (everything - positives + 1))
            if weight >= config.min_log_odds and upper_tail(pos, n, base) * tested < 1:
                odds.append((row["p"], k, min(1.0, weight / 6 + 0.25) / k))
                break
    if not odds:
        return {}
    spark = docs.sparkSession
    marked = spark.createDataFrame(odds, "p string, need int, weight double")
    holders = each.where("label = 1").join(marked, "p").where("times >= need").groupBy("p").agg(F.first("weight"), F.collect_list("key")).collect()
    return _multi_cover({p: (w, frozenset(k)) for p, w, k in holders}, config.cover)


def upper_tail(least: int, n: int, chance: float) -> float:
    """The odds of ``least`` or more of n independent events of one chance."""
    if chance >= 1:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(least + 1) - math.lgamma(n - least + 1) + least * math.log(chance) + (n - least) * math.log1p(-chance)
    term = total = 1.0
    for i in range(least, n):
        term *= (n - i) / (i + 1) * chance / (1 - chance)
        total += term
        if term < 1e-12 * total:
            break
    return math.exp(min(0.0, log + math.log(total)))


def _shingles(text, k: int = 3):
    """Sorted distinct hashes of the k-word shingles of a text column; fewer words are one."""
    tokens = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda x: x != "")
    starts = lambda a: F.sequence(F.lit(1), F.greatest(F.size(a) - (k - 1), F.lit(1)))
    # the list of one keeps tokens from being split anew for each shingle
    found = F.flatten(F.transform(F.array(tokens), lambda a: F.transform(starts(a), lambda i: F.xxhash64(F.slice(a, i, k)))))
    return F.array_sort(F.array_distinct(found))


def _without_copies(rows: DataFrame, scratch: Scratch, least: float = 0.8, bands: int = 8, width: int = 3) -> DataFrame:
    """(key, label, w) of the rows (label, w, s), one for each shingle set ``s`` and label, less near copies of one that stays.

    Sets of one label that agree in a band of minimum hashes are compared with the
    largest of them, shingle by shingle; a set goes if its Jaccard index with that
    one, which itself stays, is ``least``.
    """
    one = rows.withColumn("key", F.xxhash64("s", "label")).groupBy("key").agg(F.first("label").alias("label"), F.first("w").alias("w"), F.first("s").alias("s"))
    one = scratch.save(one, "sets")
    least_hash = lambda i: F.array_min(F.transform("s", lambda x: F.xxhash64(x, F.lit(i))))
    keys = F.array(*(F.xxhash64(F.lit(b), "label", *(least_hash(b * width + j) for j in range(width))) for b in range(bands)))
    banded = one.select("key", F.size("s").alias("n"), F.explode(keys).alias("band"))
    pivots = banded.groupBy("band").agg(F.max(F.struct("n", "key")).alias("p")).select("band", F.col("p.key").alias("pivot"))
    pairs = banded.join(pivots, "band").where("key <> pivot").select("key", "pivot").distinct()
    both = pairs.join(one.select("key", "s"), "key").join(one.select(F.col("key").alias("pivot"), F.col("s").alias("t")), "pivot")
    shared = F.size(F.array_intersect("s", "t"))
    links = scratch.save(both.where(shared >= least * (F.size("s") + F.size("t") - shared)).select("key", "pivot"), "copies")
    gone = links.join(links.select(F.col("key").alias("pivot")), "pivot", "left_anti")
    return scratch.save(one.join(gone, "key", "left_anti").select("key", "label", "w"), "kept")


def _multi_cover(found: dict[str, tuple[float, frozenset[int]]], cover: int) -> dict[str, float]:
    need, out = {}, {}
    for _, (_, keys) in found.items():
        need.update(dict.fromkeys(keys, cover))
    left = dict(found)
    while left:
        # of beginnings with the same documents the longest says most exactly what was learned
        p, gain = max(((p, sum(need[k] > 0 for k in keys)) for p, (_, keys) in left.items()), key=lambda x: (x[1], len(x[0]), x[0]))
        if gain < 3:
            break
        out[p] = left[p][0]
        for k in left[p][1]:
            need[k] -= 1
        left = {q: v for q, v in left.items() if not (q.startswith(p) or p.startswith(q))}
    return out


def score_documents(docs: DataFrame, grammar: ClauseGrammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_clauses) of each row; null and empty texts have no clauses."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = source.schema[0].dataType.simpleString()
    # A lexicon of at most a few thousand words, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast((grammar.insults, grammar.config))

    def run(batches):
        machine = ClauseGrammar(*shared.value)
        for batch in batches:
            scores, clauses = [], []
            for text in batch.column(1):
                matched = machine.matched_clauses(text.as_py() or "")
                scores.append(machine.score_clauses(matched))
                clauses.append(len(matched))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(clauses, pa.int64())], names=[id_col, "score", "n_clauses"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, score double, n_clauses long")
