"""Line-first quality rules, as column expressions only.

Each line of a text is held against punctuation, navigation and boilerplate
rules; lines that fail are removed, and a document that loses too much of its
text is rejected.  Whole-document counts (few words, repeated windows) reject
before that.  Everything is one projection over the scan: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
#: A sentence ends somewhere in the line.
SENTENCE_END = r"""[.!?…。！？]["”»')\]]*(?:[\x20\x09-\x0D]|$)"""
#: Words that only part the entries of a menu or table.
SEPARATORS = ["|", "»", "›", ">", "·", "•", "/", "::"]
NOISE = r"#*$%&|<>{}=~^!?"
BOILERPLATE = r"(?i)cookie|javascript|privacy policy|terms of (?:use|service)|all rights reserved|lorem ipsum|subscribe"


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    #: Reject when more than this share of the words lies in repeated 3-word windows.
    max_repeat_percent: int = 50
    #: A line fails when at least 1 of so many words is a separator ...
    words_per_separator: int = 5
    #: ... or 1 of so many characters is noise.
    chars_per_noise: int = 10
    #: Reject when failed lines hold more than this share of the characters.
    max_lost_percent: int = 50


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_fails(line: Column, rules: QualityRules) -> Column:
    """True for a line with words that breaks a navigation, noise, boilerplate or punctuation rule."""
    words = words_of(line)
    separators = F.size(F.filter(words, lambda w: w.isin(SEPARATORS)))
    navigation = line.rlike("[|»›>·•/:]") & (rules.words_per_separator * separators >= F.size(words))
    noise_class = "[" + "".join("\\" + c for c in NOISE) + "]"
    noise = line.rlike(noise_class) & (rules.chars_per_noise * F.length(_without(line, noise_class.replace("[", "[^") + "+")) >= F.length(_without(line, SPACE + "+")))
    return ~line.rlike(SENTENCE_END) | navigation | noise | line.rlike(BOILERPLATE)


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more.

    Windows are first compared by hash: with no hash twice there is no window
    twice.  Only otherwise are the windows themselves sorted and compared.
    """
    last = F.size(words) - 2

    def windows(of):
        return F.transform(F.slice(words, 1, F.greatest(last, F.lit(0))), lambda w, i: of(w, F.get(words, i + 1), F.get(words, i + 2), i))

    def covered(s: Column) -> Column:
        twice = F.transform(s, lambda e, i: F.when((F.get(s, i - 1)["w"] == e["w"]) | (F.get(s, i + 1)["w"] == e["w"]), e["i"]))
        return F.size(F.array_distinct(F.flatten(F.transform(F.filter(twice, lambda p: p.isNotNull()), lambda p: F.array(p, p + 1, p + 2)))))

    hashes = windows(lambda a, b, c, i: F.xxhash64(a, b, c))
    unique = _let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    exact = _let(F.array_sort(windows(lambda a, b, c, i: F.struct(F.concat_ws(" ", a, b, c).alias("w"), i.alias("i")))), covered)
    return F.when(unique, 0).otherwise(exact).cast("long")


def judge_documents(docs: DataFrame, rules: QualityRules = QualityRules(), text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars,
    base_failed, kept and clean_text; columns of these names are replaced.

    Words are maximal runs without white space, lines are parted by ``\\n``, and
    characters are code points.  A null text counts as empty: no words, base
    failed, not kept, and its clean text is null.  ``lost_chars`` counts the
    characters in words of failed lines; ``clean_text`` is the text without
    those lines.

    The columns come out of a generator (one row in, one row out).  A filter on
    them stays above it; pushed below, it would inline the split of the text
    into the functions that run for each word.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept", "clean_text"]
    own = [c for c in docs.columns if c not in made]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(*own, text.alias("_t"), words_of(text).alias("_w"))
    lines = F.filter(F.split("_t", "\n"), has_word)
    out = out.select("*", lines.alias("_lines"), F.transform(F.split("_t", "\n"), lambda x: F.struct(x.alias("x"), (has_word(x) & line_fails(x, rules)).alias("bad"))).alias("_judged"))
    bad = F.transform(F.filter("_judged", lambda j: j["bad"]), lambda j: j["x"])
    counted = out.select(
        *own,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(_without(F.col("_t"), "[^#*$%&|<>]+")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        F.length(_without(F.array_join(bad, ""), SPACE + "+")).cast("long").alias("lost_chars"),
        F.when(F.col(text_col).isNotNull(), F.array_join(F.transform(F.filter("_judged", lambda j: ~j["bad"]), lambda j: j["x"]), "\n")).alias("clean_text"),
    )
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    counted = counted.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= rules.max_lost_percent * F.col("word_chars")))
    return counted.select(*own, F.inline(F.array(F.struct(*made))))


def keep_clean_documents(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The kept rows of ``docs`` with failed lines taken out of ``text``; ``n_chars``, where
    there is such a column, counts the code points left.  Other columns stay as they are."""
    judged = judge_documents(docs, rules).where("kept")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return judged.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
