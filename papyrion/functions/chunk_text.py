"""Scores, classes and concepts of a chunk's text, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrion.functions import text as T

# Phrases that decide a chunk's type, in order of precedence.
CHUNK_TYPES = [
    ("example", ["example:", "for example", "e.g."]),
    ("warning", ["warning:", "caution:", "important:"]),
    ("best_practice", ["best practice", "recommended"]),
    ("procedure", ["step 1", "procedure:", "how to"]),
    ("definition", ["define", "definition", "what is"]),
    ("summary", ["summary", "conclusion", "in summary"]),
    ("introduction", ["introduction", "overview", "getting started"]),
]
# Phrases that decide a chunk's role, in order of precedence.
SEMANTIC_ROLES = [
    ("troubleshooting", ["error", "issue", "problem", "troubleshoot"]),
    ("prerequisite", ["prerequisite", "before you begin", "required"]),
    ("advanced", ["advanced", "expert", "detailed configuration"]),
    ("supporting", ["additional", "optional", "see also"]),
]
# Patterns of prerequisites and of references.
PREREQUISITES = [
    r"(?i)requires?\s+([^\n]+)",
    r"(?i)prerequisites?:\s*([^\n]+)",
    r"(?i)before\s+you\s+begin[,:]?\s*([^\n]+)",
    r"(?i)you\s+need\s+([^\n]+)",
    r"(?i)must\s+have\s+([^\n]+)",
]
REFERENCES = [
    r'(?i)see\s+(?:also\s+)?"([^"]+)"',
    r'(?i)refer\s+to\s+"([^"]+)"',
    r'(?i)described\s+in\s+"([^"]+)"',
    r"(?i)\(see\s+([^)]+)\)",
    r'(?i)documentation:\s*"([^"]+)"',
]
# Concepts of the simple profile.
SIMPLE_CONCEPTS = ["business", "intelligence", "data", "analysis", "management", "strategy", "process"]


def chunk_type(content: Column | str) -> Column:
    return T.first_rule(F.lower(T.col(content)), CHUNK_TYPES, "unknown")


def semantic_role(content: Column | str) -> Column:
    return T.first_rule(F.lower(T.col(content)), SEMANTIC_ROLES, "main_content")


def confidence(content: Column | str, tokens: Column, least: int = 100, most: int = 2000) -> Column:
    """Product of penalties for size, line breaks and a missing end; 0 for a blank text."""
    body = T.stripped(content)
    score = F.when(tokens < least // 10, 0.6).when(tokens > most, 0.8).otherwise(1.0)
    score = score * F.when(F.length(body) < 50, 0.7).otherwise(1.0)
    score = score * F.when(T.col(content).contains("\n"), 1.0).otherwise(0.9)
    score = score * F.when(body.rlike("[.!?:;]$"), 1.0).otherwise(0.9)
    return F.when(F.length(body) == 0, 0.0).otherwise(F.least(score, F.lit(1.0)))


def completeness(content: Column | str) -> Column:
    c = T.col(content)
    cut = F.when(T.stripped(c).rlike("[.!?:;]$"), 0).otherwise(2)
    short = F.when(T.word_count(c) < 50, 1).otherwise(0)
    fences = F.when(T.occurrences(c, "```").cast("int") % 2 != 0, 3).otherwise(0)
    return (10 - cut - short - fences) / 10.0


def key_concepts(content: Column | str, most: int = 10) -> Column:
    """Capitalised ASCII words, and lower-case ones of over three letters met twice; sorted, the first ``most``."""
    repeated = lambda low: T.let(low, lambda s: F.filter(F.transform(s, lambda w, i: F.when(F.get(s, i + 1) == w, w)), lambda w: w.isNotNull()))

    def choose(tokens: Column) -> Column:
        # each different word meets a pattern once
        proper = F.filter(F.array_distinct(tokens), lambda w: w.rlike("^[A-Z][a-z]+$"))
        twice = F.filter(F.array_distinct(repeated(F.sort_array(F.transform(tokens, F.lower)))), lambda w: w.rlike("^[a-z]{4,}$"))
        return F.slice(F.array_sort(F.array_distinct(F.concat(proper, twice))), 1, most)

    return T.let(T.all_matches(content, r"[\p{L}\p{N}_]+", 0), choose)


def prerequisites(content: Column | str, most: int = 5) -> Column:
    found = F.concat(*(T.all_matches(content, p) for p in PREREQUISITES))
    return F.slice(F.filter(F.transform(found, T.stripped), lambda p: F.length(p) < 100), 1, most)


def references(content: Column | str) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.concat(*(T.all_matches(content, p) for p in REFERENCES)), T.stripped)))


def complexity(content: Column | str) -> Column:
    w = T.words(content)
    mean = F.try_divide(F.aggregate(w, F.lit(0), lambda t, x: t + F.length(x)), F.size(w))
    return F.least(F.coalesce(mean, F.lit(0.0)) / 10, F.lit(1.0))


def density(content: Column | str) -> Column:
    w = T.words(content)
    return F.coalesce(F.try_divide(F.size(F.array_distinct(F.transform(w, F.lower))), F.size(w)), F.lit(0.0))


def simple_concepts(content: Column | str, most: int = 5) -> Column:
    low = F.lower(T.col(content))
    return F.slice(F.filter(F.array(*map(F.lit, SIMPLE_CONCEPTS)), lambda k: low.contains(k)), 1, most)


def context_summary(title: Column, chapter: Column, section: Column, kind: Column, concepts: Column) -> Column:
    part = lambda label, c: F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"{label}: "), c))
    three = F.when(F.size(concepts) > 0, F.array_join(F.slice(concepts, 1, 3), ", "))
    return F.concat_ws(" | ", part("Document", title), part("Chapter", chapter), part("Section", section), F.when(kind != "unknown", F.concat(F.lit("Type: "), kind)), part("Key concepts", three))
