"""Document metadata from the text of the first pages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyrion.functions import text as T

# Phrases that decide the document type, in order of precedence.
DOCUMENT_TYPES = [
    ("manual", ["manual", "handbook", "guide", "instructions"]),
    ("reference", ["reference", "api", "documentation", "spec", "specification"]),
    ("tutorial", ["tutorial", "walkthrough", "getting started", "quick start"]),
    ("policy", ["policy", "procedure", "process", "standard"]),
    ("report", ["report", "analysis", "study", "findings"]),
    ("presentation", ["presentation", "slides", "overview"]),
    ("whitepaper", ["whitepaper", "white paper", "research"]),
    ("faq", ["faq", "frequently asked", "questions and answers"]),
    ("readme", ["readme", "read me", "getting started"]),
    ("changelog", ["changelog", "change log", "release notes", "version history"]),
]
# Words that hint at a language.
ENGLISH = ["the", "and", "for", "are", "with", "this", "that", "have", "from"]
GERMAN = ["der", "die", "das", "und", "für", "sind", "mit", "dass", "haben", "von"]
# Phrases of a document's parts.
PARTS = {
    "has_table_of_contents": ["table of contents", "contents", "inhaltsverzeichnis"],
    "has_index": ["index", "stichwortverzeichnis"],
    "has_references": ["references", "bibliography", "literatur"],
    "has_appendix": ["appendix", "anhang"],
}
# Technical terms that become tags by themselves.
TECHNICAL_TERMS = [
    "api|rest|http|json|xml|sql|database|server|client|web|mobile|app|application",
    "security|authentication|authorization|encryption|ssl|tls",
    "cloud|aws|azure|google cloud|docker|kubernetes|microservices",
    "python|java|javascript|php|ruby|go|rust",
    "react|angular|vue|node\\.js|django|flask|spring|laravel",
]
# Date formats in the order in which they are tried.
DATE_FORMATS = ["d/M/yyyy", "M/d/yyyy", "yyyy/M/d", "d-M-yyyy", "M-d-yyyy", "yyyy-M-d", "d.M.yyyy", "M.d.yyyy", "yyyy.M.d", "d MMMM yyyy", "MMMM d, yyyy", "MMMM d yyyy"]
# Labels and forms of dates, of those forms in the order in which the last readable one wins.
CREATED, MODIFIED = "Created|Date|Published", "Last updated|Modified|Revised"
NUMERIC_DATES = [r"(\d{1,2}[/.\-]\d{1,2}[/.\-]\d{2,4})", r"(\d{4}[/.\-]\d{1,2}[/.\-]\d{1,2})"]
_MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
WORDED_DATES = [rf"(\d{{1,2}}\s+{_MONTH}\s+\d{{4}})", rf"({_MONTH}\s+\d{{1,2}},?\s+\d{{4}})"]
# Forms in which authors are named, and what parts several.
AUTHORS = [
    (r"(?i)(?:Author|Authors|By|Written by|Created by):\s*([^\n]+)", 1),
    (r"(?i)(?:Author|Authors|By)\s*\n\s*([^\n]+)", 1),
    (r"(?i)(?:©|Copyright)[^\n]*?(\d{4})[^\n]*?([A-Z][a-z]+ [A-Z][a-z]+)", 2),
]
AUTHOR_SPLIT = r"[,;&]|\sand\s"
# Forms in which a version is named.
VERSIONS = [
    r"(?i)version\s*[:=]?\s*([0-9]+\.[0-9]+(?:\.[0-9]+)?)",
    r"(?i)v\.?\s*([0-9]+\.[0-9]+(?:\.[0-9]+)?)",
    r"(?i)release\s*[:=]?\s*([0-9]+\.[0-9]+(?:\.[0-9]+)?)",
]


def title(content: Column | str) -> Column:
    """A line that ends like a manual's title, else a labelled one, else the first long line."""
    head = F.transform(F.slice(T.lines(content), 1, 10), T.stripped)

    def first(pattern: str) -> Column:
        found = F.transform(head, lambda x: F.when(x.rlike(pattern), T.stripped(F.regexp_extract(x, pattern, 1))))
        return F.filter(found, lambda t: t.isNotNull() & F.length(t).between(3, 100))

    plain = F.filter(head, lambda x: (F.length(x) > 10) & ~x.rlike("^(?:Page|Chapter|Section)"))
    choices = F.concat(first(r"^([A-Za-z][A-Za-z\s]+(?i:Guide|Manual|Documentation|Handbook|Reference))"), first(r"(?i)Title:\s*(.+)"), F.transform(plain, lambda x: F.substring(x, 1, 100)))
    return F.coalesce(F.get(choices, F.lit(0)), F.lit("Untitled Document"))


def _labelled(content: Column | str, labels: str, splitter: str) -> Column:
    found = T.all_matches(content, rf"(?i)(?:{labels}):\s*([^\n]+)")
    return F.transform(F.flatten(F.transform(found, lambda x: F.split(x, splitter))), T.stripped)


def authors(content: Column | str) -> Column:
    """Names after an author label, in its line or the next one, or in a copyright line; sorted, each once."""
    found = F.concat(*(T.all_matches(content, p, group) for p, group in AUTHORS))
    names = F.transform(F.flatten(F.transform(found, lambda x: F.split(x, AUTHOR_SPLIT))), T.stripped)
    return F.array_sort(F.array_distinct(F.filter(names, lambda a: F.length(a).between(3, 50) & a.rlike("[a-zA-Z]"))))


def parse_date(text: Column | str) -> Column:
    """The first format that fits; day before month, four-digit years only; else null."""
    plain = F.initcap(F.regexp_replace(T.col(text), r"\s+", " "))  # months are read in any case
    return F.coalesce(*(F.when(plain.rlike(r"(?:^|\D)\d{4}(?:\D|$)"), F.try_to_timestamp(plain, F.lit(f))) for f in DATE_FORMATS)).cast("date")


def _last_date(content: Column | str, patterns: list[str]) -> Column:
    """The last readable date, where all of one pattern come before those of the next."""
    found = F.concat(*(T.all_matches(content, f"(?i){p}") for p in patterns))
    return T.let(F.filter(F.transform(found, parse_date), lambda d: d.isNotNull()), lambda dates: F.get(dates, F.size(dates) - 1))


def created_on(content: Column | str) -> Column:
    """From a labelled date, or rather from any date in words."""
    return _last_date(content, [rf"(?:{CREATED}):\s*{p}" for p in NUMERIC_DATES] + WORDED_DATES)


def modified_on(content: Column | str) -> Column:
    return _last_date(content, [rf"(?:{MODIFIED}):\s*{p}" for p in NUMERIC_DATES])


def document_type(content: Column | str) -> Column:
    return T.first_rule(F.lower(T.col(content)), DOCUMENT_TYPES, "unknown")


def version(content: Column | str) -> Column:
    return F.coalesce(*(F.nullif(F.regexp_extract(T.col(content), p, 1), F.lit("")) for p in VERSIONS))


def automatic_tags(content: Column | str, most: int = 10) -> Column:
    low = F.lower(T.col(content))
    found = F.concat(*(T.all_matches(low, rf"(?<![\p{{L}}\p{{N}}_])({p})(?![\p{{L}}\p{{N}}_])") for p in TECHNICAL_TERMS))
    return F.slice(F.array_sort(F.array_distinct(found)), 1, most)


# Labels of tags.
TAG_LABELS = "Tags|Keywords|Topics|Category|Categories|Subject|Subjects"


def tags(content: Column | str) -> Column:
    named = F.transform(F.filter(_labelled(content, TAG_LABELS, r"[,;]|\sand\s"), lambda t: F.length(t).between(2, 30)), F.lower)
    return F.array_sort(F.array_distinct(F.concat(named, automatic_tags(content))))


def language(content: Column | str) -> Column:
    low = F.lower(T.col(content))
    en, de = T.count_contained(low, ENGLISH), T.count_contained(low, GERMAN)
    return F.when(en > de, "en").when(de > en, "de").otherwise("unknown")


def part_flags(content: Column | str) -> dict[str, Column]:
    return {name: T.contains_any(F.lower(T.col(content)), phrases) for name, phrases in PARTS.items()}


def chapter_count(content: Column | str) -> Column:
    return F.size(T.all_matches(content, r"(?im)^\s*(?:Chapter|Kapitel)\s+\d+", 0))


def section_count(content: Column | str) -> Column:
    return F.size(T.all_matches(content, r"(?m)^\s*\d+\.\d+\s+", 0))


def reading_minutes(words: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(words / 200).cast("int"))


def structure_of(pages, key: str = "doc_id", content: str = "content"):
    """Flags, counts and reading time of each document over all its pages."""
    flags = [F.bool_or(c).alias(n) for n, c in part_flags(content).items()]
    return pages.groupBy(key).agg(*flags, F.sum(chapter_count(content)).alias("chapter_count"), F.sum(section_count(content)).alias("section_count"), reading_minutes(F.sum(T.word_count(content))).alias("estimated_reading_time"))
