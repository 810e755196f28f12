"""Queries on texts: chunking, scores, classes, metadata and structure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrion.functions import chunk_text, metadata, quality
from papyrion.functions import text as T
from papyrion.operators import chunking, enrich
from papyrion.plans.inputs import MANUALS, frame, manuals
from papyrion.plans.registry import QUERIES, ORACLES, query, table

_W = r"list_filter(regexp_split_to_array({c}, '\s+'), lambda w: w <> '')"
W = _W.format(c="content")
STRIP = r"regexp_replace(content, '^\s+|\s+$', '', 'g')"
WITH = f"WITH manuals AS ({MANUALS})"
CONF = f"""CASE WHEN length({STRIP}) = 0 THEN 0.0 ELSE least(CAST(CASE WHEN token_count < 10 THEN 0.6 WHEN token_count > 2000 THEN 0.8 ELSE 1.0 END AS DOUBLE)
  * CASE WHEN length({STRIP}) < 50 THEN 0.7 ELSE 1.0 END * CASE WHEN contains(content, chr(10)) THEN 1.0 ELSE 0.9 END * CASE WHEN regexp_matches({STRIP}, '[.!?:;]$') THEN 1.0 ELSE 0.9 END, 1.0) END"""
COMPLETE = f"(10 - CASE WHEN regexp_matches({STRIP}, '[.!?:;]$') THEN 0 ELSE 2 END - CASE WHEN len({W}) < 50 THEN 1 ELSE 0 END - CASE WHEN ((length(content) - length(replace(content, '```', ''))) // 3) % 2 <> 0 THEN 3 ELSE 0 END) / 10.0"
SIZE = """CASE WHEN token_count < 50 THEN 30 WHEN token_count > 2000 THEN 60 WHEN token_count BETWEEN 200 AND 1000 THEN 100 ELSE 80 END
  - CASE WHEN token_count > 0 AND (length(content) / token_count < 3 OR length(content) / token_count > 10) THEN 10 ELSE 0 END"""


def _windows(source: str, size: int, step: int, least: int) -> str:
    return f"""SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INT) AS chunk_index, array_to_string(w[s + 1:s + {size}], ' ') AS content, len(w[s + 1:s + {size}]) AS token_count
  FROM (SELECT doc_id, lang, w, unnest(range(0, greatest(len(w), 1), {step})) AS s FROM (SELECT doc_id, lang, {W} AS w FROM {source})) WHERE len(w[s + 1:s + {size}]) >= {least}"""


SMALL = chunking.ChunkingConfig(size=100, overlap=20)
CHUNKS = _windows("manuals", 100, 80, 10)
WITH_CHUNKS = f"{WITH}, chunks AS ({CHUNKS})"


def manual_chunks(spark, folder) -> DataFrame:
    out = chunking.fixed(manuals(spark, folder), SMALL)
    return out.withColumn("chunk_id", F.concat(F.col("doc_id").cast("string"), F.lit("_chunk_"), F.col("chunk_index").cast("string")))


@query("flagship", f"""WITH raw AS (SELECT doc_id, lang, text AS content FROM documents), chunks AS ({_windows("raw", 100, 80, 10)}),
scored AS (SELECT lang, token_count, {CONF} AS conf, {COMPLETE} AS complete, {SIZE} AS size FROM chunks)
SELECT lang, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS tokens, round(avg(conf), 6) AS avg_confidence, round(avg(complete), 6) AS avg_completeness, round(avg(size), 6) AS avg_size_score FROM scored GROUP BY lang""")
def _flagship(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", F.col("text").alias("content"))
    parts = chunking.window_texts("content", 100, 80, 10)
    chunks = docs.select("lang", F.explode(parts).alias("content")).withColumns({"token_count": T.word_count("content"), "char_count": F.length("content")})
    scored = chunks.select("lang", "token_count", chunk_text.confidence("content", F.col("token_count")).alias("conf"), chunk_text.completeness("content").alias("complete"), quality.chunk_size(F.col("token_count"), F.col("char_count"))["score"].alias("size"))
    mean = lambda c: F.round(F.avg(c), 6)
    return scored.groupBy("lang").agg(F.count(F.lit(1)).alias("chunks"), F.sum("token_count").alias("tokens"), mean("conf").alias("avg_confidence"), mean("complete").alias("avg_completeness"), mean("size").alias("avg_size_score"))


def _digest(df: DataFrame) -> DataFrame:
    """Chunks with their content as a digest, which keeps results small and exact."""
    return df.select("doc_id", F.col("chunk_index").cast("int").alias("chunk_index"), F.col("token_count").cast("int").alias("token_count"), F.sha2("content", 256).alias("content_sha256"))


def _windowed(name: str, size: int, overlap: int, least: int, make):
    sql = f"{WITH} SELECT doc_id, chunk_index, CAST(token_count AS INT) AS token_count, sha256(content) AS content_sha256 FROM ({_windows('manuals', size, size - overlap, least)})"
    query(name, sql)(lambda spark, folder: _digest(make(manuals(spark, folder))))


_windowed("chunk_overlap", 1000, 200, 10, chunking.overlapping)
_windowed("chunk_fixed", 100, 20, 10, lambda d: chunking.fixed(d, SMALL))
_windowed("chunk_simple", 1000, 0, 1, chunking.simple)

ELEMENT = r"""CASE WHEN regexp_matches(s, '(?i)^(?:chapter|kapitel)\s+\d+\.?\s*:?\s*.+') THEN 'chapter' WHEN regexp_matches(s, '(?i)^\d+\.\s+[a-z][^.]+') THEN 'section'
  WHEN regexp_matches(s, '(?i)^\d+\.\d+\s+[a-z][^.]+') THEN 'subsection' WHEN regexp_matches(s, '(?i)^\d+\.\d+\.\d+\s+[a-z][^.]+') THEN 'subsubsection' WHEN regexp_matches(s, '(?i)^[a-z][a-z\s]+$') THEN 'header'
  WHEN regexp_matches(s, '^(?:\d+\.|-|\*|•)\s+.+') THEN 'list_item' WHEN regexp_matches(s, '(?i)^(?:abstract|summary|zusammenfassung|introduction|einleitung|conclusion|fazit)') THEN 'special_section' END"""
LINES = rf"""SELECT doc_id, i - 1 AS line_number, all_lines[i] AS raw, regexp_replace(all_lines[i], '^\s+|\s+$', '', 'g') AS s, len(all_lines) AS n
  FROM (SELECT doc_id, all_lines, unnest(range(1, len(all_lines) + 1)) AS i FROM (SELECT doc_id, string_split(content, chr(10)) AS all_lines FROM manuals))"""


@query("structure_elements", f"{WITH}, lines AS ({LINES}), typed AS (SELECT doc_id, CAST(line_number AS INT) AS line_number, s AS text, {ELEMENT} AS type FROM lines WHERE s <> '') SELECT * FROM typed WHERE type IS NOT NULL")
def _structure_elements(spark, folder):
    return chunking.structure_elements(manuals(spark, folder))


SECTIONS = f"""{WITH}, lines AS ({LINES}), typed AS (SELECT *, {ELEMENT} AS type FROM lines),
starts AS (SELECT doc_id, line_number, s, type IN ('chapter', 'section', 'subsection', 'special_section') AS b, n FROM typed),
cuts AS (SELECT doc_id, line_number AS start_line, CASE WHEN b THEN s ELSE '' END AS header, lead(line_number, 1, n) OVER (PARTITION BY doc_id ORDER BY line_number) AS end_line FROM starts WHERE coalesce(b, false) OR line_number = 0),
sections AS (SELECT c.doc_id, start_line, end_line, coalesce(max(header), '') AS header, string_agg(l.raw, chr(10) ORDER BY l.line_number) AS content FROM cuts c JOIN lines l ON c.doc_id = l.doc_id AND l.line_number >= start_line AND l.line_number < end_line GROUP BY ALL)"""


@query("section_bounds", f"{SECTIONS} SELECT doc_id, CAST(start_line AS INT) AS start_line, CAST(end_line AS INT) AS end_line, coalesce(header, '') AS header, sha256(content) AS content_sha256 FROM sections")
def _section_bounds(spark, folder):
    return chunking.sections(manuals(spark, folder)).select("doc_id", "start_line", "end_line", "header", F.sha2("content", 256).alias("content_sha256"))


@query("chunk_structure", f"{SECTIONS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start_line) - 1 AS INT) AS chunk_index, CAST(len({W}) AS INT) AS token_count, sha256(content) AS content_sha256 FROM sections WHERE length({STRIP}) >= 100")
def _chunk_structure(spark, folder):
    return _digest(chunking.structured(manuals(spark, folder), chunking.ChunkingConfig(max_size=10_000_000)))


@query("paragraphs", r"""SELECT doc_id, CAST(len(p) AS INT) AS paragraphs, sha256(array_to_string(p, '|')) AS digest FROM (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(text, chr(10), chr(10) || ' ' || chr(10)), '\n\s*\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS p FROM documents)""")
def _paragraphs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", chunking.paragraphs(F.replace("text", F.lit("\n"), F.lit("\n \n"))).alias("p"))
    return docs.select("doc_id", F.size("p").alias("paragraphs"), F.sha2(F.array_join("p", "|"), 256).alias("digest"))


PAGES = "SELECT source AS doc_id, doc_id AS page_number, text AS content FROM documents"


@query("page_offsets", f"""WITH pages AS ({PAGES}) SELECT doc_id, page_number, CAST(coalesce(sum(length(content) + 2) OVER w, 0) AS BIGINT) AS start_offset, CAST(coalesce(sum(length(content) + 2) OVER w, 0) + length(content) AS BIGINT) AS end_offset
FROM pages WINDOW w AS (PARTITION BY doc_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _page_offsets(spark, folder):
    return chunking.page_offsets(frame(spark, folder, PAGES))


@query("page_span", f"""WITH pages AS ({PAGES}), offsets AS (SELECT doc_id, page_number, coalesce(sum(length(content) + 2) OVER w, 0) AS a, coalesce(sum(length(content) + 2) OVER w, 0) + length(content) AS b
  FROM pages WINDOW w AS (PARTITION BY doc_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
spans AS (SELECT concat(doc_id, '_', page_number) AS chunk_id, doc_id, b - 50 AS a, b + 100 AS b FROM offsets)
SELECT chunk_id, string_agg(CAST(o.page_number AS VARCHAR), ',' ORDER BY o.page_number) AS page_numbers FROM spans s JOIN offsets o ON s.doc_id = o.doc_id AND s.a <= o.b AND s.b >= o.a GROUP BY chunk_id""")
def _page_span(spark, folder):
    offsets = chunking.page_offsets(frame(spark, folder, PAGES))
    spans = offsets.select(F.concat_ws("_", "doc_id", "page_number").alias("chunk_id"), "doc_id", (F.col("end_offset") - 50).alias("start_offset"), (F.col("end_offset") + 100).alias("end_offset"))
    return chunking.page_spans(spans, offsets).select("chunk_id", F.array_join(F.transform("page_numbers", lambda x: x.cast("string")), ",").alias("page_numbers"))


def _scalar(name: str, value, sql: str, extra: str = "") -> None:
    """A query of one computed column over all manuals."""
    query(name, f"{WITH} SELECT doc_id, {sql} AS value FROM (SELECT *, CAST(len({W}) AS INT) AS token_count FROM manuals)")(lambda spark, folder: manuals(spark, folder).withColumn("token_count", T.word_count("content")).select("doc_id", value().alias("value")))


def case_of(rules, default: str) -> str:
    parts = " ".join("WHEN " + " OR ".join(f"contains(lower(content), '{p}')" for p in phrases) + f" THEN '{name}'" for name, phrases in rules)
    return f"CASE {parts} ELSE '{default}' END"


_scalar("chunk_conf", lambda: chunk_text.confidence("content", F.col("token_count")), CONF)
_scalar("completeness", lambda: chunk_text.completeness("content"), COMPLETE)
_scalar("chunk_type", lambda: chunk_text.chunk_type("content"), case_of(chunk_text.CHUNK_TYPES, "unknown"))
_scalar("semantic_role", lambda: chunk_text.semantic_role("content"), case_of(chunk_text.SEMANTIC_ROLES, "main_content"))
_scalar("md_doctype", lambda: metadata.document_type("content"), case_of(metadata.DOCUMENT_TYPES, "unknown"))
_scalar("complexity", lambda: F.floor(chunk_text.complexity("content") * 1000000), f"CAST(floor(least(coalesce(length(array_to_string({W}, '')) / nullif(len({W}), 0), 0) / 10, 1.0) * 1000000) AS BIGINT)")
_scalar("density", lambda: F.round(chunk_text.density("content"), 6), f"round(coalesce(len(list_distinct(list_transform({W}, lambda w: lower(w)))) / nullif(len({W}), 0), 0), 6)")
_scalar("prod_concepts", lambda: F.array_join(chunk_text.simple_concepts("content"), ","), "array_to_string(list_filter(['business', 'intelligence', 'data', 'analysis', 'management', 'strategy', 'process'], lambda k: contains(lower(content), k))[1:5], ',')")
_TOK = r"regexp_extract_all(content, '[\p{L}\p{N}_]+')"
_scalar("key_concepts", lambda: F.array_join(chunk_text.key_concepts("content"), ","), f"""array_to_string(list_sort(list_distinct(list_concat(list_filter({_TOK}, lambda w: regexp_full_match(w, '[A-Z][a-z]+')),
  list_filter(map_keys(histogram_of), lambda w: regexp_full_match(w, '[a-z]{{4,}}') AND histogram_of[w] >= 2))))[1:10], ',')""")
ORACLES["key_concepts"] = f"""{WITH}, tokens AS (SELECT doc_id, unnest({_TOK}) AS t FROM manuals),
proper AS (SELECT DISTINCT doc_id, t FROM tokens WHERE regexp_full_match(t, '[A-Z][a-z]+')), twice AS (SELECT doc_id, lower(t) AS t FROM tokens WHERE regexp_full_match(lower(t), '[a-z]{{4,}}') GROUP BY ALL HAVING count(*) >= 2),
ranked AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY t) AS k FROM (SELECT * FROM proper UNION SELECT * FROM twice))
SELECT m.doc_id, coalesce(string_agg(t, ',' ORDER BY t), '') AS value FROM manuals m LEFT JOIN ranked r ON m.doc_id = r.doc_id AND k <= 10 GROUP BY m.doc_id"""


def extract_all(patterns) -> str:
    out = f"regexp_extract_all(content, '{patterns[0]}', 1)"
    for p in patterns[1:]:
        out = f"list_concat({out}, regexp_extract_all(content, '{p}', 1))"
    return out


_TRIM = r"regexp_replace(x, '^\s+|\s+$', '', 'g')"
_scalar("prereqs", lambda: F.array_join(chunk_text.prerequisites("content"), "|"), f"array_to_string(list_filter(list_transform({extract_all(chunk_text.PREREQUISITES)}, lambda x: {_TRIM}), lambda x: length(x) < 100)[1:5], '|')")
_scalar("refs", lambda: F.array_join(chunk_text.references("content"), "|"), f"array_to_string(list_sort(list_distinct(list_transform({extract_all(chunk_text.REFERENCES)}, lambda x: {_TRIM}))), '|')")
_N = f"len({W})"
_en = " + ".join(f"CAST(contains(lower(content), '{w}') AS INT)" for w in metadata.ENGLISH)
_de = " + ".join(f"CAST(contains(lower(content), '{w}') AS INT)" for w in metadata.GERMAN)
_scalar("md_language", lambda: metadata.language("content"), f"CASE WHEN {_en} > {_de} THEN 'en' WHEN {_de} > {_en} THEN 'de' ELSE 'unknown' END")
_scalar("md_version", lambda: metadata.version("content"), "coalesce(" + ", ".join(f"nullif(regexp_extract(content, '{p}', 1), '')" for p in metadata.VERSIONS) + ")")
_HEAD = rf"list_transform(string_split(content, chr(10))[1:10], lambda x: {_TRIM})"


def _heads(p: str) -> str:
    return f"list_filter(list_transform(list_filter({_HEAD}, lambda x: regexp_matches(x, '{p}')), lambda x: trim(regexp_extract(x, '{p}', 1))), lambda x: length(x) BETWEEN 3 AND 100)"


_GUIDE = r"^([A-Za-z][A-Za-z\s]+(?i:Guide|Manual|Documentation|Handbook|Reference))"
_LABEL = r"(?i)Title:\s*(.+)"
_scalar("md_title", lambda: metadata.title("content"), rf"coalesce({_heads(_GUIDE)}[1], {_heads(_LABEL)}[1], list_filter({_HEAD}, lambda x: length(x) > 10 AND NOT regexp_matches(x, '^(?:Page|Chapter|Section)'))[1][1:100], 'Untitled Document')")
_LAB = lambda labels, split: rf"list_transform(flatten(list_transform(regexp_extract_all(content, '(?i)(?:{labels}):\s*([^\n]+)', 1), lambda x: regexp_split_to_array(x, '{split}'))), lambda x: {_TRIM})"
_NAMES = "list_concat(list_concat({0}, {1}), {2})".format(*(f"regexp_extract_all(content, '{p}', {g})" for p, g in metadata.AUTHORS))
_AUTHORS = rf"""array_to_string(list_sort(list_distinct(list_filter(list_transform(flatten(list_transform({_NAMES}, lambda x: regexp_split_to_array(x, '{metadata.AUTHOR_SPLIT}'))), lambda x: {_TRIM}),
  lambda x: length(x) BETWEEN 3 AND 50 AND regexp_matches(x, '[a-zA-Z]')))), ',')"""
_scalar("md_authors", lambda: F.array_join(metadata.authors("content"), ","), _AUTHORS)
_TECH = "list_concat(" * 4 + "{0}, {1}), {2}), {3}), {4})"
_auto = _TECH.format(*(rf"list_filter(regexp_extract_all(lower(content), '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '{p}'))" for p in metadata.TECHNICAL_TERMS))
_scalar("md_autotags", lambda: F.array_join(metadata.automatic_tags("content"), ","), f"array_to_string(list_sort(list_distinct({_auto}))[1:10], ',')")
_named = f"list_transform(list_filter({_LAB('Tags|Keywords|Topics|Category|Categories|Subject|Subjects', r'[,;]|' + chr(92) + 'sand' + chr(92) + 's')}, lambda x: length(x) BETWEEN 2 AND 30), lambda x: lower(x))"
_scalar("md_tags", lambda: F.array_join(metadata.tags("content"), ","), f"array_to_string(list_sort(list_distinct(list_concat({_named}, list_sort(list_distinct({_auto}))[1:10]))), ',')")
_FORMATS = "'%d/%m/%Y', '%m/%d/%Y', '%Y/%m/%d', '%d-%m-%Y', '%m-%d-%Y', '%Y-%m-%d', '%d.%m.%Y', '%m.%d.%Y', '%Y.%m.%d', '%d %B %Y', '%B %d, %Y', '%B %d %Y'"


def _dates(patterns: list[str]) -> str:
    """The last readable date; all of one pattern come before those of the next."""
    found = "[]"
    for p in patterns:
        found = f"list_concat({found}, regexp_extract_all(content, '(?i){p}', 1))"
    parsed = rf"list_transform({found}, lambda x: CASE WHEN regexp_matches(x, '(?:^|\D)\d{{4}}(?:\D|$)') THEN try_strptime(regexp_replace(x, '\s+', ' ', 'g'), [{_FORMATS}]) END)"
    return f"coalesce(CAST(CAST(list_filter({parsed}, lambda d: d IS NOT NULL)[-1] AS DATE) AS VARCHAR), '-')"


_CREATED = _dates([rf"(?:{metadata.CREATED}):\s*{p}" for p in metadata.NUMERIC_DATES] + metadata.WORDED_DATES)
_MODIFIED = _dates([rf"(?:{metadata.MODIFIED}):\s*{p}" for p in metadata.NUMERIC_DATES])
_both = lambda: F.concat_ws("/", *(F.coalesce(f("content").cast("string"), F.lit("-")) for f in (metadata.created_on, metadata.modified_on)))
_scalar("md_dates", _both, f"concat_ws('/', {_CREATED}, {_MODIFIED})")


def _any(phrases) -> str:
    return "bool_or(" + " OR ".join(f"contains(lower(content), '{p}')" for p in phrases) + ")"


@query("md_structure", rf"""{WITH} SELECT doc_id, {', '.join(f'{_any(v)} AS {k}' for k, v in metadata.PARTS.items())},
  CAST(sum(len(regexp_extract_all(content, '(?im)^\s*(?:Chapter|Kapitel)\s+\d+'))) AS BIGINT) AS chapter_count, CAST(sum(len(regexp_extract_all(content, '(?m)^\s*\d+\.\d+\s+'))) AS BIGINT) AS section_count,
  CAST(greatest(1, sum(len({W})) // 200) AS INT) AS estimated_reading_time FROM manuals GROUP BY doc_id""")
def _md_structure(spark, folder):
    return metadata.structure_of(manuals(spark, folder))


@query("md_base", "SELECT source, count(*) AS total_pages, CAST(sum(length(text)) AS BIGINT) AS total_chars FROM documents GROUP BY source")
def _md_base(spark, folder):
    d = table(spark, folder, "documents")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("total_pages"), F.sum(F.length("text")).alias("total_chars"))


@query("word_freq", rf"SELECT w AS word, count(*) AS n FROM (SELECT unnest({_W.format(c='lower(text)')}) AS w FROM documents) GROUP BY w")
def _word_freq(spark, folder):
    return table(spark, folder, "documents").select(F.explode(T.words(F.lower("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- quality checks -------------------------------------------------------

_low = "lower(content)"
_lw = _W.format(c="lower(content)")
_fw = ", ".join(f"'{w}'" for w in quality.FUNCTION_WORDS)
_max = f"(SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM (SELECT unnest({_lw}) AS w) WHERE length(w) > 3 GROUP BY w))"
_sent = r"list_transform(regexp_split_to_array(content, '[.!?]+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))"
_base = f"CASE WHEN length({STRIP}) < 50 THEN 20 WHEN length({STRIP}) < 100 THEN 60 ELSE 100 END"
_q1 = rf"CASE WHEN len(list_filter({_sent}, lambda s: length(s) > 10 AND regexp_matches(s, '^\p{{Lu}}'))) / len({_sent}) > 0.8 THEN least({_base} + 20, 100) ELSE {_base} END"
_items = r"list_filter(range(1, len(string_split(content, chr(10))) + 1), lambda i: regexp_matches(string_split(content, chr(10))[i], '^\s*[\d\-*•]\s+'))"
#: Two list items are more than three lines apart.
LIST_GAPS = f"len(list_filter(range(1, len({_items})), lambda i: {_items}[i + 1] - {_items}[i] > 3)) > 0"
CHECK_SQL = {
    "content_completeness": rf"CASE WHEN regexp_matches(content, '(?:^|[^\p{{L}}\p{{N}}_])[A-Za-z]{{2,}}-\s*$') THEN greatest({_q1} - 30, 0) ELSE {_q1} END",
    "content_coherence": f"80 - CASE WHEN {_max} > 8 THEN 20 ELSE 0 END + CASE WHEN {' OR '.join(f'contains({_low}, {chr(39)}{w}{chr(39)})' for w in quality.CONNECTIVES)} THEN 10 ELSE 0 END - CASE WHEN length(content) - length(replace(content, chr(10), '')) > length(content) / 50 THEN 15 ELSE 0 END",
    "information_density": rf"CASE WHEN len(list_distinct(list_filter({_lw}, lambda w: length(w) > 3 AND regexp_full_match(w, '\p{{L}}+')))) > len({_lw}) * 0.15 THEN least(d + 15, 100) ELSE d END",
    "chunk_size": SIZE,
    "language_quality": rf"""80 - CASE WHEN contains(content, '�') THEN 30 ELSE 0 END - CASE WHEN regexp_matches(content, '\s{{5,}}') THEN 10 ELSE 0 END
  - CASE WHEN len(list_filter(string_split(content, chr(10)), lambda x: regexp_matches(x, '\S') AND NOT regexp_matches(x, '[a-zA-Z]'))) > len(string_split(content, chr(10))) * 0.3 THEN 20 ELSE 0 END
  - CASE WHEN length(array_to_string({W}, '')) / len({W}) < 3 THEN 15 WHEN length(array_to_string({W}, '')) / len({W}) > 8 THEN 10 ELSE 0 END""",
    "structural_integrity": rf"""90 - CASE WHEN len(list_filter(string_split(content, chr(10)), lambda x: contains(x, '|'))) > 1 AND len(list_distinct(list_transform(list_filter(string_split(content, chr(10)), lambda x: contains(x, '|')), lambda x: length(x) - length(replace(x, '|', ''))))) > 2 THEN 15 ELSE 0 END
  - CASE WHEN {LIST_GAPS} THEN 10 ELSE 0 END - CASE WHEN ((length(content) - length(replace(content, '```', ''))) // 3) % 2 <> 0 THEN 20 ELSE 0 END""",
}
_dens = f"(SELECT *, CAST(len({W}) AS INT) AS token_count, 70 + CASE WHEN len(list_filter({_lw}, lambda w: w NOT IN ({_fw}) AND length(w) > 2)) / nullif(len({_lw}), 0) > 0.6 THEN 20 WHEN len(list_filter({_lw}, lambda w: w NOT IN ({_fw}) AND length(w) > 2)) / nullif(len({_lw}), 0) < 0.3 THEN -20 ELSE 0 END AS d FROM manuals)"


def _quality_query(op: str, name: str) -> None:
    def run(spark, folder):
        m = manuals(spark, folder).withColumns({"token_count": T.word_count("content"), "char_count": F.length("content")})
        check = quality.CHECKS[name]({c: F.col(c) for c in ("content", "token_count", "char_count")} | {c: F.lit(None).cast("string") for c in ("chapter", "section", "previous_chunk_id", "next_chunk_id", "chunk_type")})
        return m.select("doc_id", check["score"].alias("score"), F.size(check["issues"]).alias("issues"))

    QUERIES[op] = lambda spark, folder: run(spark, folder).select("doc_id", "score")
    ORACLES[op] = f"{WITH} SELECT doc_id, CAST({CHECK_SQL[name]} AS INT) AS score FROM {_dens}"


for _op, _name in (("q_completeness", "content_completeness"), ("q_coherence", "content_coherence"), ("q_density", "information_density"), ("q_size", "chunk_size"), ("q_language", "language_quality"), ("q_structure", "structural_integrity")):
    _quality_query(_op, _name)


# --- context of chunks ----------------------------------------------------


@query("nav_links", f"{WITH_CHUNKS} SELECT concat(doc_id, '_chunk_', chunk_index) AS chunk_id, concat(doc_id, '_chunk_', lag(chunk_index) OVER w) AS p0, lag(chunk_index) OVER w AS p1 FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)")
def _nav_links(spark, folder):
    return enrich.navigation(manual_chunks(spark, folder)).select("chunk_id", "previous_chunk_id", "next_chunk_id", F.round("position", 6).alias("position"))


ORACLES["nav_links"] = f"""{WITH_CHUNKS}, named AS (SELECT doc_id, chunk_index, concat(doc_id, '_chunk_', chunk_index) AS chunk_id FROM chunks)
SELECT chunk_id, lag(chunk_id) OVER w AS previous_chunk_id, lead(chunk_id) OVER w AS next_chunk_id, round(chunk_index / count(*) OVER (PARTITION BY doc_id), 6) AS position FROM named WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)"""


@query("related_chunks", f"""{WITH_CHUNKS}, tokens AS (SELECT doc_id, chunk_index, unnest({_TOK}) AS t FROM chunks),
concepts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_index ORDER BY t) AS k FROM (
  SELECT DISTINCT doc_id, chunk_index, t FROM tokens WHERE regexp_full_match(t, '[A-Z][a-z]+') UNION SELECT doc_id, chunk_index, lower(t) FROM tokens WHERE regexp_full_match(lower(t), '[a-z]{{4,}}') GROUP BY ALL HAVING count(*) >= 2)) WHERE k <= 10)
SELECT concat(a.doc_id, '_chunk_', a.chunk_index) AS chunk_id, concat(b.doc_id, '_chunk_', b.chunk_index) AS related_id, count(*) AS strength
FROM concepts a JOIN concepts b ON a.doc_id = b.doc_id AND a.t = b.t AND a.chunk_index <> b.chunk_index GROUP BY ALL HAVING count(*) >= 3""")
def _related(spark, folder):
    return enrich.related_chunks(manual_chunks(spark, folder)).select("chunk_id", "related_id", "strength")


@query("dist_chunk_types", f"{WITH_CHUNKS} SELECT doc_id, {case_of(chunk_text.CHUNK_TYPES, 'unknown')} AS chunk_type, count(*) AS n FROM chunks GROUP BY ALL")
def _dist_chunk_types(spark, folder):
    return manual_chunks(spark, folder).groupBy("doc_id", chunk_text.chunk_type("content").alias("chunk_type")).agg(F.count(F.lit(1)).alias("n"))


@query("context_summary", f"{WITH} SELECT doc_id, concat_ws(' | ', concat('Document: ', source), concat('Chapter: ', lang), CASE WHEN ({case_of(chunk_text.CHUNK_TYPES, 'unknown')}) <> 'unknown' THEN concat('Type: ', {case_of(chunk_text.CHUNK_TYPES, 'unknown')}) END) AS summary FROM manuals")
def _context_summary(spark, folder):
    none = F.array().cast("array<string>")
    return manuals(spark, folder).select("doc_id", chunk_text.context_summary(F.col("source"), F.col("lang"), F.lit(None).cast("string"), chunk_text.chunk_type("content"), none).alias("summary"))


@query("chunk_hq", f"{WITH_CHUNKS} SELECT doc_id, chunk_index FROM chunks WHERE {CONF} >= 0.7 AND {COMPLETE} >= 0.7 AND length({STRIP}) > 100")
def _chunk_hq(spark, folder):
    c = manual_chunks(spark, folder)
    good = (chunk_text.confidence("content", F.col("token_count")) >= 0.7) & (chunk_text.completeness("content") >= 0.7) & (F.length(T.stripped("content")) > 100)
    return c.where(good).select("doc_id", F.col("chunk_index").cast("int").alias("chunk_index"))
