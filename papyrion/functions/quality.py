"""Seven deterministic checks of a chunk, each a score and a list of issues.

A check is a struct ``(score int, issues array<string>)``.  All are column
expressions; scores stay integers until the overall score divides them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrion.functions import text as T

# Fixed values.
CONNECTIVES = ["however", "therefore", "furthermore", "moreover", "consequently"]
FUNCTION_WORDS = ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by"]
CLOSING_WORDS = ["conclusion", "summary", "fazit"]
FULL_SCORE = 700


def _check(score: Column, *issues: tuple[Column, str]) -> Column:
    found = F.filter(F.array(*(F.when(c, text) for c, text in issues)), lambda x: x.isNotNull()) if issues else F.array().cast("array<string>")
    return F.struct(score.cast("int").alias("score"), found.alias("issues"))


def content_completeness(content: Column) -> Column:
    # a stripped sentence begins where its white space ends; only those with a capital are stripped
    whole = lambda s: s.rlike(r"^\s*+\p{Lu}") & (F.length(T.stripped(s)) > 10)
    share = T.let(F.split(content, r"[.!?]+"), lambda s: F.size(F.filter(s, whole)) / F.size(s))
    cut = content.rlike(r"(?:^|[^\p{L}\p{N}_])[A-Za-z]{2,}+-\s*$")

    def judge(x: Column) -> Column:
        size = x["size"]
        score = F.when(size < 50, 20).when(size < 100, 60).otherwise(100)
        score = F.when(x["share"] > 0.8, F.least(score + 20, F.lit(100))).otherwise(score)
        score = F.when(x["cut"], F.greatest(score - 30, F.lit(0))).otherwise(score)
        return _check(score, (size < 50, "Content too short"), ((size >= 50) & (size < 100), "Content quite short"), (x["cut"], "Content appears to be cut off"))

    return T.let(F.struct(F.length(T.stripped(content)).alias("size"), share.alias("share"), cut.alias("cut")), judge)


def repeats(content: Column, most: int) -> Column:
    """Whether some word of over three characters occurs more than ``most`` times."""
    long = F.sort_array(F.filter(T.words(F.lower(content)), lambda w: F.length(w) > 3))
    return T.let(long, lambda s: F.array_contains(F.transform(s, lambda w, i: F.coalesce(F.get(s, i + most) == w, F.lit(False))), True))


def content_coherence(content: Column) -> Column:
    linked = T.contains_any(F.lower(content), CONNECTIVES)
    broken = T.occurrences(content, "\n") > F.length(content) / 50

    def judge(x: Column) -> Column:
        score = 80 - F.when(x["repeated"], 20).otherwise(0) + F.when(x["linked"], 10).otherwise(0) - F.when(x["broken"], 15).otherwise(0)
        return _check(score, (x["repeated"], "Excessive word repetition detected"), (x["broken"], "Content appears fragmented"))

    return T.let(F.struct(repeats(content, 8).alias("repeated"), linked.alias("linked"), broken.alias("broken")), judge)


def information_density(content: Column) -> Column:
    def count(w: Column) -> Column:
        useful = F.size(F.filter(w, lambda x: (F.length(x) > 2) & ~x.isin(FUNCTION_WORDS)))
        nouns = F.size(F.filter(F.array_distinct(w), lambda x: (F.length(x) > 3) & x.rlike(r"^\p{L}+$")))
        return F.struct(F.try_divide(useful, F.size(w)).alias("share"), (nouns > F.size(w) * 0.15).alias("rich"))

    def judge(x: Column) -> Column:
        low = F.coalesce(x["share"] < 0.3, F.lit(False))
        score = 70 + F.when(x["share"] > 0.6, 20).when(low, -20).otherwise(0)
        score = F.when(x["rich"], F.least(score + 15, F.lit(100))).otherwise(score)
        return _check(score, (low, "Low information density"))

    return T.let(T.let(T.words(F.lower(content)), count), judge)


def context_consistency(content: Column, chapter: Column, section: Column, previous: Column, following: Column, kind: Column) -> Column:
    low = F.lower(content)
    lost = chapter.isNotNull() & (chapter != "") & ~low.contains(F.lower(chapter)) & (section.isNull() | (section == ""))
    open_end = previous.isNotNull() & following.isNull() & ~T.contains_any(low, CLOSING_WORDS)
    odd = ((kind == "example") & ~low.contains("example")) | ((kind == "warning") & ~T.contains_any(low, ["warning", "caution", "important"])) | ((kind == "procedure") & ~T.contains_any(low, ["step", "procedure", "how to"]))
    odd = F.coalesce(odd, F.lit(False))
    score = 85 - F.when(lost, 5).otherwise(0) - F.when(open_end, 10).otherwise(0) - F.when(odd, 15).otherwise(0)
    issue = F.when(odd, F.concat(F.lit("Chunk type '"), kind, F.lit("' inconsistent with content")))
    return F.struct(score.cast("int").alias("score"), F.filter(F.array(issue), lambda x: x.isNotNull()).alias("issues"))


def chunk_size(tokens: Column, chars: Column) -> Column:
    ratio = F.try_divide(chars, tokens)
    odd = F.coalesce((ratio < 3) | (ratio > 10), F.lit(False))
    score = F.when(tokens < 50, 30).when(tokens > 2000, 60).when(tokens.between(200, 1000), 100).otherwise(80) - F.when(odd, 10).otherwise(0)
    return _check(score, (tokens < 50, "Chunk too small"), (tokens > 2000, "Chunk too large"), (odd, "Unusual character-to-token ratio"))


def language_quality(content: Column) -> Column:
    special = T.let(T.lines(content), lambda a: F.size(F.filter(a, lambda x: ~x.rlike("[a-zA-Z]") & x.rlike(r"\S"))) > F.size(a) * 0.3)
    mean = T.let(T.words(content), lambda w: F.try_divide(F.length(F.array_join(w, "")), F.size(w)))

    def judge(x: Column) -> Column:
        short, long = F.coalesce(x["mean"] < 3, F.lit(False)), F.coalesce(x["mean"] > 8, F.lit(False))
        score = 80 - F.when(x["encoding"], 30).otherwise(0) - F.when(x["spaces"], 10).otherwise(0) - F.when(x["special"], 20).otherwise(0) - F.when(short, 15).when(long, 10).otherwise(0)
        return _check(score, (x["encoding"], "Encoding problems detected"), (x["spaces"], "Excessive whitespace"), (x["special"], "Too many lines with special characters only"), (short, "Average word length too short"), (long, "Average word length too long"))

    return T.let(F.struct(content.contains("\ufffd").alias("encoding"), content.rlike(r"\s{5,}").alias("spaces"), special.alias("special"), mean.alias("mean")), judge)


def structural_integrity(content: Column) -> Column:
    all_lines = T.lines(content)
    pipes = F.transform(F.filter(all_lines, lambda x: x.contains("|")), lambda x: T.occurrences(x, "|").cast("int"))
    table = (F.size(pipes) > 1) & (F.size(F.array_distinct(pipes)) > 2)
    at = F.filter(F.transform(all_lines, lambda x, i: F.when(x.rlike(r"^\s*[\d\-*•]\s+"), i)), lambda i: i.isNotNull())
    gaps = T.let(at, lambda s: F.exists(F.transform(s, lambda x, i: F.get(s, i + 1) - x), lambda g: g > 3))
    gaps = F.coalesce(gaps, F.lit(False))
    fence = T.occurrences(content, "```").cast("int") % 2 != 0
    score = 90 - F.when(table, 15).otherwise(0) - F.when(gaps, 10).otherwise(0) - F.when(fence, 20).otherwise(0)
    return _check(score, (table, "Inconsistent table structure"), (gaps, "Interrupted list structure"), (fence, "Incomplete code block"))


CHECKS: dict[str, Callable[[dict[str, Column]], Column]] = {
    "content_completeness": lambda c: content_completeness(c["content"]),
    "content_coherence": lambda c: content_coherence(c["content"]),
    "information_density": lambda c: information_density(c["content"]),
    "context_consistency": lambda c: context_consistency(c["content"], c["chapter"], c["section"], c["previous_chunk_id"], c["next_chunk_id"], c["chunk_type"]),
    "chunk_size": lambda c: chunk_size(c["token_count"], c["char_count"]),
    "language_quality": lambda c: language_quality(c["content"]),
    "structural_integrity": lambda c: structural_integrity(c["content"]),
}


def points(score: Column) -> Column:
    """The whole points of all checks that an overall score stands for."""
    return F.round(score * (FULL_SCORE // 100)).cast("long")


def grade(score: Column) -> Column:
    return F.when(score >= 90, "Excellent").when(score >= 80, "Good").when(score >= 70, "Acceptable").when(score >= 60, "Needs Improvement").otherwise("Poor")
