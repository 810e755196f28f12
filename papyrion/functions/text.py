"""Column builders for words, lines and counts inside one string."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: Column | str) -> Column:
    """Runs without white space; an empty or null text has none."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\s+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c))


def lines(c: Column | str) -> Column:
    return F.split(col(c), "\n")


def stripped(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def occurrences(c: Column | str, needle: str) -> Column:
    """How often ``needle`` occurs without overlap."""
    c = col(c)
    return (F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / len(needle)


def contains_any(c: Column | str, needles: Sequence[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | col(c).contains(n)
    return out


def count_contained(c: Column | str, needles: Sequence[str]) -> Column:
    """How many of ``needles`` occur in the text."""
    out = F.lit(0)
    for n in needles:
        out = out + col(c).contains(n).cast("int")
    return out


def first_rule(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The name of the first rule of which some phrase occurs in the text."""
    out = None
    for name, phrases in rules:
        hit = contains_any(c, phrases)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def all_matches(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), group)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]
