"""Chunk types learned from the corpus: chunks that the rules know teach which words mark a type.

A rule's phrase is a weak label.  Every chunk that the rules type is an example of
its type; of the others, those that refer to something are examples of "reference",
for which there is no rule.  A term's gain for a type says how much more often the
type's examples hold it than all examples do, smoothed towards no gain at all, so a
type with few examples has no advantage with words that it never met.  A chunk's
first paragraph is scored by its terms' gains.

Gains are whole thousandths, so sums do not depend on their order.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrion.functions import chunk_text
from papyrion.functions import text as T

#: All types that a chunk can be given, in order of precedence where scores are equal.
LABELS = [name for name, _ in chunk_text.CHUNK_TYPES] + ["reference"]


@dataclass(frozen=True)
class ChunkClassesConfig:
    #: Terms with gains; their table (about 150 bytes a term) is broadcast.
    terms: int = 8192
    min_chunks: int = 5
    #: Of how many further examples, spread like all of them, each type is given the terms.
    smoothing: int = 10
    #: Thousandths by which a type must lead the second one; else the rules decide.
    least_margin: int = 1000
    head_chars: int = 500


@dataclass(frozen=True)
class ChunkClasses:
    """What ``train`` has learned: types with examples, their priors, and (term, gains) with a gain for each."""

    labels: list[str]
    priors: list[int]
    gains: DataFrame
    config: ChunkClassesConfig


def weak_label(content: Column | str) -> Column:
    """The rules' type; "reference" for an untyped text that refers to something; else null."""
    refers = F.lit(False)
    for pattern in chunk_text.REFERENCES:
        refers = refers | F.coalesce(T.col(content).rlike(pattern), F.lit(False))
    by_rule = chunk_text.chunk_type(content)
    return F.when(by_rule != "unknown", by_rule).when(refers, "reference")


def first_paragraph(content: Column | str, most: int) -> Column:
    return F.substring(F.split(T.col(content), "\n\n", 2)[0], 1, most)


def _terms(content: Column | str) -> Column:
    return F.array_distinct(T.words(F.lower(T.col(content))))


def train(chunks: DataFrame, config: ChunkClassesConfig = ChunkClassesConfig(), text_col: str = "content") -> ChunkClasses:
    """Gains from all weakly labelled rows of ``chunks``; repeated rows count each.

    The number of examples of each type, eight at most, reach the driver.  Null
    and blank texts are no examples; without any example there are no types.
    """
    seeds = chunks.select(weak_label(text_col).alias("label"), _terms(text_col).alias("terms")).where("label is not null")
    held = {r["label"]: r["n"] for r in seeds.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels, total = [x for x in LABELS if x in held], sum(held.values())
    priors = [floor(1000 * log((held[x] + 1) / (total + len(labels)))) for x in labels]
    each = seeds.select("label", F.explode("terms").alias("term"))
    counted = each.groupBy("term").agg(F.count(F.lit(1)).alias("k"), *(F.count_if(F.col("label") == x).alias(f"k_{x}") for x in labels))
    known = counted.where(F.col("k") >= config.min_chunks).orderBy(F.desc("k"), "term").limit(config.terms)
    a = config.smoothing
    share = lambda x: (F.col(f"k_{x}") * total + a * F.col("k")) / (F.col("k") * (held[x] + a))
    gains = F.array(*(F.floor(1000 * F.log(share(x))).cast("long") for x in labels)).cast("array<bigint>")
    return ChunkClasses(labels, priors, known.select("term", gains.alias("gains")), config)


def classify(chunks: DataFrame, model: ChunkClasses, id_col: str = "chunk_id", text_col: str = "content") -> DataFrame:
    """``chunks`` with learned_type, margin and chunk_type; columns of these names are replaced.

    ``learned_type`` is the type with the highest score for the first paragraph,
    ``margin`` its lead over the second one in thousandths; 0 if there is one
    type only.  Both are null for a paragraph without known terms, and for a row
    without an id.  ``chunk_type`` is the learned one if it leads by
    ``least_margin``, else the rules' type of the whole text.  Ids are unique; rows
    that share one are scored together, by the sum over all of them.
    """
    kept = [c for c in chunks.columns if c not in ("learned_type", "margin", "chunk_type")]
    rules = F.coalesce(chunk_text.chunk_type(text_col), F.lit("unknown"))
    if not model.labels:
        return chunks.select(*kept, F.lit(None).cast("string").alias("learned_type"), F.lit(None).cast("long").alias("margin"), rules.alias("chunk_type"))
    asked = chunks.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("papyrion_id"), F.explode(_terms(first_paragraph(text_col, model.config.head_chars))).alias("term"))
    scores = [F.sum(F.get("gains", F.lit(i))) + p for i, p in enumerate(model.priors)]
    # ``array_sort`` puts the least first: the highest score, of equal ones the first type
    ranked = F.array_sort(F.array(*(F.struct((-s).alias("s"), F.lit(i).alias("i"), F.lit(x).alias("label")) for i, (s, x) in enumerate(zip(scores, model.labels)))))
    best = asked.join(F.broadcast(model.gains), "term").groupBy("papyrion_id").agg(ranked.alias("_r"))
    lead = F.coalesce(F.get("_r", F.lit(1))["s"], F.get("_r", F.lit(0))["s"]) - F.get("_r", F.lit(0))["s"]
    best = best.select("papyrion_id", F.get("_r", F.lit(0))["label"].alias("papyrion_label"), lead.alias("papyrion_margin"))
    learned = F.when(F.col("papyrion_margin") >= model.config.least_margin, F.col("papyrion_label"))
    out = chunks.select(*kept).join(best, F.col(id_col) == F.col("papyrion_id"), "left")
    return out.select(*kept, F.col("papyrion_label").alias("learned_type"), F.col("papyrion_margin").alias("margin"), F.coalesce(learned, rules).alias("chunk_type"))
