"""Queries on enriched and validated chunks, with the whole chain of rules in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrion.functions import chunk_text, metadata, quality
from papyrion.operators import chunking, enrich, vector
from papyrion.plans.inputs import manuals
from papyrion.plans.registry import ORACLES, query, table
from papyrion.plans.text_queries import COMPLETE, CONF, SECTIONS, STRIP, WITH, WITH_CHUNKS, W, case_of, extract_all, manual_chunks
from papyrion.session import saved

# --- chunking with packing ------------------------------------------------


def _packed(paragraphs: str, size: int, start: str = "0") -> str:
    """Texts of a list of paragraphs, packed greedily up to ``size`` words of which ``start`` are taken."""
    count = r"len(list_filter(regexp_split_to_array(p, '\s+'), lambda w: w <> ''))"
    return f"""list_transform([list_reduce(list_transform({paragraphs}, lambda p: {{'done': CAST([] AS VARCHAR[]), 'last': p, 'n': {count}}}),
  lambda one, two: CASE WHEN one.n + two.n + {start} > {size} THEN {{'done': list_append(one.done, one.last), 'last': two.last, 'n': two.n}}
    ELSE {{'done': one.done, 'last': concat(one.last, chr(10), chr(10), two.last), 'n': one.n + two.n}} END)], lambda r: list_append(r.done, r.last))[1]"""


_PARAGRAPHS = r"list_filter(list_transform(regexp_split_to_array(content, '\n\s*\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"
_DIGEST = "CAST(row_number() OVER (PARTITION BY doc_id ORDER BY a, b) - 1 AS INT) AS chunk_index, CAST(len({w}) AS INT) AS token_count, sha256(c) AS content_sha256"


def _structured(size: int) -> str:
    header_words = r"len(list_filter(regexp_split_to_array(header, '\s+'), lambda w: w <> ''))"
    return f"""{SECTIONS}, large AS (SELECT *, len({W}) > {size} AS large FROM sections WHERE length({STRIP}) >= 100),
bodies AS (SELECT doc_id, start_line AS a, CASE WHEN large THEN list_transform({_packed(_PARAGRAPHS, size, header_words)}, lambda t: concat(header, chr(10), chr(10), t)) ELSE [content] END AS body FROM large),
parts AS (SELECT doc_id, a, unnest(body) AS c, generate_subscripts(body, 1) AS b FROM bodies)
SELECT doc_id, {_DIGEST.format(w=W.replace("content", "c"))} FROM parts"""


def _digest(chunks):
    return chunks.select("doc_id", F.col("chunk_index").cast("int").alias("chunk_index"), F.col("token_count").cast("int").alias("token_count"), F.sha2("content", 256).alias("content_sha256"))


@query("split_large", _structured(200))
def _split_large(spark, folder):
    return _digest(chunking.structured(manuals(spark, folder), chunking.ChunkingConfig(max_size=200)))


@query("chunk_contextual", _structured(2000))
def _chunk_contextual(spark, folder):
    return _digest(chunking.create_chunks(manuals(spark, folder)))


@query("chunk_semantic", f"""WITH pages AS (SELECT source AS doc_id, doc_id AS a, replace(text, chr(10), chr(10) || chr(10)) AS content FROM documents),
bodies AS (SELECT doc_id, a, {_packed(_PARAGRAPHS, 200)} AS body FROM pages WHERE len({_PARAGRAPHS}) > 0),
parts AS (SELECT doc_id, a, unnest(body) AS c, generate_subscripts(body, 1) AS b FROM bodies)
SELECT doc_id, {_DIGEST.format(w=W.replace("content", "c"))} FROM parts""")
def _chunk_semantic(spark, folder):
    pages = table(spark, folder, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page_number"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("content"))
    return _digest(chunking.semantic(pages, chunking.ChunkingConfig(size=200)))


# --- headings, neighbours and hierarchy -----------------------------------


def _section_chunks(spark, folder):
    out = chunking.structured(manuals(spark, folder), chunking.ChunkingConfig(min_size=1, max_size=10_000_000))
    return out.withColumn("chunk_id", F.concat_ws("_chunk_", "doc_id", "chunk_index"))


_CHUNKS = f"""{SECTIONS}, chunks AS (SELECT *, concat(doc_id, '_chunk_', chunk_index) AS chunk_id FROM (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start_line) - 1 AS INT) AS chunk_index, content FROM sections WHERE length({STRIP}) >= 1))"""
_MANUAL_AS_CHUNK = f"{WITH}, chunks AS (SELECT doc_id, 0 AS chunk_index, CAST(doc_id AS VARCHAR) AS chunk_id, content FROM manuals)"


def _group(pattern: str, group: int) -> str:
    return f"regexp_extract(s, '{pattern}', {group})"


def _of_level(group: int) -> str:
    return f"CASE level WHEN 'chapter' THEN {_group(enrich.CHAPTER, group)} WHEN 'section' THEN {_group(enrich.SECTION, group)} ELSE {_group(enrich.SUBSECTION, group)} END"


_BEFORE = "OVER (PARTITION BY doc_id ORDER BY chunk_index, line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_HEADINGS = rf"""headed_lines AS (
  SELECT doc_id, chunk_index, chunk_id, line - 1 AS line, regexp_replace(l[line], '^\s+|\s+$', '', 'g') AS s
  FROM (SELECT *, unnest(range(1, least(len(l), 5) + 1)) AS line FROM (SELECT doc_id, chunk_index, chunk_id, string_split(content, chr(10)) AS l FROM chunks))),
with_chapter AS (
  SELECT *, regexp_matches(s, '{enrich.CHAPTER}') AS is_chapter, last_value(CASE WHEN regexp_matches(s, '{enrich.CHAPTER}') THEN {_group(enrich.CHAPTER, 1)} END IGNORE NULLS) {_BEFORE} AS chapter FROM headed_lines),
with_section AS (
  SELECT *, NOT is_chapter AND chapter IS NOT NULL AND regexp_matches(s, '{enrich.SECTION}') AS is_section,
    last_value(CASE WHEN NOT is_chapter AND chapter IS NOT NULL AND regexp_matches(s, '{enrich.SECTION}') THEN {_group(enrich.SECTION, 1)} END IGNORE NULLS) {_BEFORE} AS section FROM with_chapter),
leveled AS (
  SELECT *, CASE WHEN is_chapter THEN 'chapter' WHEN is_section THEN 'section' WHEN section IS NOT NULL AND regexp_matches(s, '{enrich.SUBSECTION}') THEN 'subsection' END AS level FROM with_section),
headings AS (
  SELECT doc_id, chunk_index, chunk_id, line, level, {_of_level(1)} AS number, {_of_level(2)} AS title, chapter FROM leveled WHERE level IS NOT NULL)"""


def _last(what: str, level: str) -> str:
    return f"arg_max({what}, line) FILTER (level = '{level}')"


_HIERARCHY = f"""{_HEADINGS},
own AS (
  SELECT doc_id, chunk_id, coalesce({_last('number', 'chapter')}, {_last('chapter', 'section')}) AS chapter_number, {_last('title', 'section')} AS section, {_last('number', 'section')} AS section_number,
    {_last('title', 'subsection')} AS subsection FROM headings GROUP BY doc_id, chunk_id),
titles AS (
  SELECT doc_id, number, title FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, number ORDER BY chunk_index, line) AS k FROM headings WHERE level = 'chapter') WHERE k = 1),
placed AS (
  SELECT c.*, o.chapter_number, t.title AS chapter, o.section, o.section_number, o.subsection FROM chunks c LEFT JOIN own o USING (doc_id, chunk_id) LEFT JOIN titles t ON t.doc_id = c.doc_id AND t.number = o.chapter_number)"""


@query("hierarchy_scan", f"{_MANUAL_AS_CHUNK}, {_HEADINGS} SELECT doc_id, CAST(line AS INT) AS line, level, number, title FROM headings")
def _hierarchy_scan(spark, folder):
    whole = manuals(spark, folder).select("doc_id", F.col("doc_id").cast("string").alias("chunk_id"), F.lit(0).alias("chunk_index"), "content")
    return enrich.headings(whole).select("doc_id", "line", "level", "number", "title")


@query("hierarchy_ctx", f"""{_CHUNKS}, {_HIERARCHY}
SELECT chunk_id, chapter, chapter_number, section, section_number, subsection, CAST(CASE WHEN subsection IS NOT NULL THEN 3 WHEN section IS NOT NULL THEN 2 ELSE 1 END AS INT) AS depth_level FROM placed""")
def _hierarchy_ctx(spark, folder):
    return enrich.hierarchy(_section_chunks(spark, folder)).select("chunk_id", "chapter", "chapter_number", "section", "section_number", "subsection", "depth_level")


ORACLES["related_top5"] = f"""SELECT chunk_id, related_id, strength, place FROM (
  SELECT chunk_id, related_id, strength, CAST(row_number() OVER (PARTITION BY chunk_id ORDER BY strength DESC, CAST(split_part(related_id, '_chunk_', 2) AS INT)) AS INT) AS place
  FROM ({ORACLES["related_chunks"]})) WHERE place <= 5"""


@query("related_top5", ORACLES["related_top5"])
def _related_top5(spark, folder):
    return enrich.strongest_related(enrich.related_chunks(manual_chunks(spark, folder))).select("chunk_id", "related_id", "strength", "place")


# --- validation -----------------------------------------------------------


def _validated(spark, folder):
    """Chunks with all that the checks look at, and their scores."""
    # the headings of a chunk are read twice beside the chunk itself, so chunks are made once and saved
    chunks = saved(enrich.navigation(_section_chunks(spark, folder)), "chunks")
    chunks = enrich.content_context(enrich.hierarchy(chunks))
    return enrich.validate_chunks(chunks)


_LINES = "string_split(content, chr(10))"
_PIPES = f"list_transform(list_filter({_LINES}, lambda x: contains(x, '|')), lambda x: length(x) - length(replace(x, '|', '')))"
_ITEMS = rf"list_filter(range(1, len({_LINES}) + 1), lambda i: regexp_matches({_LINES}[i], '^\s*[\d\-*•]\s+'))"
_FUNCTION_WORDS = ", ".join(f"'{w}'" for w in quality.FUNCTION_WORDS)


def _has(words) -> str:
    return "(" + " OR ".join(f"contains(low, '{w}')" for w in words) + ")"


_FACTS = rf"""facts AS (
  SELECT p.*, lower(content) AS low, {STRIP} AS body, {W} AS w, list_transform({W}, lambda x: lower(x)) AS lw, CAST(len({W}) AS INT) AS token_count, {_PIPES} AS pipes, {_ITEMS} AS items, {case_of(chunk_text.CHUNK_TYPES, 'unknown')} AS chunk_type,
    list_transform(regexp_split_to_array(content, '[.!?]+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS sentences,
    lag(chunk_id) OVER (PARTITION BY doc_id ORDER BY chunk_index) AS previous_chunk_id, lead(chunk_id) OVER (PARTITION BY doc_id ORDER BY chunk_index) AS next_chunk_id FROM placed p),
repeated AS (SELECT chunk_id, max(n) AS most FROM (SELECT chunk_id, x, count(*) AS n FROM (SELECT chunk_id, unnest(lw) AS x FROM facts) WHERE length(x) > 3 GROUP BY ALL) GROUP BY chunk_id),
signs AS (
  SELECT f.*, coalesce(most, 0) > 8 AS repeats, length(body) AS size, regexp_matches(content, '(?:^|[^\p{{L}}\p{{N}}_])[A-Za-z]{{2,}}-\s*$') AS cut,
    length(content) - length(replace(content, chr(10), '')) > length(content) / 50 AS broken,
    len(list_filter(lw, lambda x: x NOT IN ({_FUNCTION_WORDS}) AND length(x) > 2)) / nullif(len(w), 0) AS share,
    len(list_distinct(list_filter(lw, lambda x: length(x) > 3 AND regexp_full_match(x, '\p{{L}}+')))) > len(w) * 0.15 AS nouns,
    coalesce(chapter, '') <> '' AND NOT contains(low, lower(chapter)) AND coalesce(section, '') = '' AS lost,
    previous_chunk_id IS NOT NULL AND next_chunk_id IS NULL AND NOT {_has(quality.CLOSING_WORDS)} AS open_end,
    (chunk_type = 'example' AND NOT contains(low, 'example')) OR (chunk_type = 'warning' AND NOT {_has(['warning', 'caution', 'important'])}) OR (chunk_type = 'procedure' AND NOT {_has(['step', 'procedure', 'how to'])}) AS odd_type,
    coalesce(length(content) / nullif(token_count, 0) < 3 OR length(content) / nullif(token_count, 0) > 10, false) AS odd_ratio,
    contains(content, chr(65533)) AS encoding, regexp_matches(content, '\s{{5,}}') AS spaces,
    len(list_filter({_LINES}, lambda x: regexp_matches(x, '\S') AND NOT regexp_matches(x, '[a-zA-Z]'))) > len({_LINES}) * 0.3 AS special,
    length(array_to_string(w, '')) / nullif(len(w), 0) AS word_length,
    len(pipes) > 1 AND len(list_distinct(pipes)) > 2 AS table_broken, len(list_filter(range(1, len(items)), lambda i: items[i + 1] - items[i] > 3)) > 0 AS gaps,
    ((length(content) - length(replace(content, '```', ''))) // 3) % 2 <> 0 AS fence
  FROM facts f LEFT JOIN repeated USING (chunk_id)),
complete AS (
  SELECT *, CASE WHEN size < 50 THEN 20 WHEN size < 100 THEN 60 ELSE 100 END AS base, len(list_filter(sentences, lambda s: length(s) > 10 AND regexp_matches(s, '^\p{{Lu}}'))) / len(sentences) > 0.8 AS whole FROM signs),
scored AS (
  SELECT *, (greatest(CASE WHEN whole THEN least(base + 20, 100) ELSE base END - CASE WHEN cut THEN 30 ELSE 0 END, 0)
    + 80 - CASE WHEN repeats THEN 20 ELSE 0 END + CASE WHEN {_has(quality.CONNECTIVES)} THEN 10 ELSE 0 END - CASE WHEN broken THEN 15 ELSE 0 END
    + CASE WHEN nouns THEN least(70 + CASE WHEN share > 0.6 THEN 20 WHEN share < 0.3 THEN -20 ELSE 0 END + 15, 100) ELSE 70 + CASE WHEN share > 0.6 THEN 20 WHEN share < 0.3 THEN -20 ELSE 0 END END
    + 85 - CASE WHEN lost THEN 5 ELSE 0 END - CASE WHEN open_end THEN 10 ELSE 0 END - CASE WHEN odd_type THEN 15 ELSE 0 END
    + CASE WHEN token_count < 50 THEN 30 WHEN token_count > 2000 THEN 60 WHEN token_count BETWEEN 200 AND 1000 THEN 100 ELSE 80 END - CASE WHEN odd_ratio THEN 10 ELSE 0 END
    + 80 - CASE WHEN encoding THEN 30 ELSE 0 END - CASE WHEN spaces THEN 10 ELSE 0 END - CASE WHEN special THEN 20 ELSE 0 END - CASE WHEN word_length < 3 THEN 15 WHEN word_length > 8 THEN 10 ELSE 0 END
    + 90 - CASE WHEN table_broken THEN 15 ELSE 0 END - CASE WHEN gaps THEN 10 ELSE 0 END - CASE WHEN fence THEN 20 ELSE 0 END) / 700 * 100 AS score,
  list_filter([CASE WHEN size < 50 THEN 'Content too short' END, CASE WHEN size BETWEEN 50 AND 99 THEN 'Content quite short' END, CASE WHEN cut THEN 'Content appears to be cut off' END,
    CASE WHEN repeats THEN 'Excessive word repetition detected' END, CASE WHEN broken THEN 'Content appears fragmented' END, CASE WHEN share < 0.3 THEN 'Low information density' END,
    CASE WHEN odd_type THEN concat('Chunk type ''', chunk_type, ''' inconsistent with content') END, CASE WHEN token_count < 50 THEN 'Chunk too small' END, CASE WHEN token_count > 2000 THEN 'Chunk too large' END,
    CASE WHEN odd_ratio THEN 'Unusual character-to-token ratio' END, CASE WHEN encoding THEN 'Encoding problems detected' END, CASE WHEN spaces THEN 'Excessive whitespace' END,
    CASE WHEN special THEN 'Too many lines with special characters only' END, CASE WHEN word_length < 3 THEN 'Average word length too short' END, CASE WHEN word_length > 8 THEN 'Average word length too long' END,
    CASE WHEN table_broken THEN 'Inconsistent table structure' END, CASE WHEN gaps THEN 'Interrupted list structure' END, CASE WHEN fence THEN 'Incomplete code block' END], lambda x: x IS NOT NULL) AS issues FROM complete)"""
_SCORED = f"{_CHUNKS}, {_HIERARCHY}, {_FACTS}"
_GRADE = "CASE WHEN s >= 90 THEN 'Excellent' WHEN s >= 80 THEN 'Good' WHEN s >= 70 THEN 'Acceptable' WHEN s >= 60 THEN 'Needs Improvement' ELSE 'Poor' END"
_DOCUMENTS = "documents_judged AS (SELECT doc_id, count(*) AS chunks, sum(CAST(round(score * 7) AS BIGINT)) / (7 * count(*)) AS s, count(*) FILTER (score >= 80) AS good FROM scored GROUP BY doc_id)"
_ISSUES = """counted AS (SELECT doc_id, issue, count(*) AS n FROM (SELECT doc_id, unnest(issues) AS issue FROM scored) GROUP BY ALL),
frequent AS (SELECT doc_id, place, concat(issue, ' (', n, ' chunks)') AS text FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, issue) AS INT) AS place FROM counted) WHERE place <= 3)"""


@query("q_validate", f"{_SCORED} SELECT chunk_id, round(score, 6) AS score, array_to_string(issues, '; ') AS issues FROM scored")
def _q_validate(spark, folder):
    return _validated(spark, folder).select("chunk_id", F.round("score", 6).alias("score"), F.array_join("issues", "; ").alias("issues"))


@query("quality_gate", f"{_SCORED}, {_DOCUMENTS} SELECT doc_id, chunks, round(s, 6) AS overall_score, {_GRADE} AS grade, s >= 70 AS accepted FROM documents_judged")
def _quality_gate(spark, folder):
    return enrich.document_quality(_validated(spark, folder), 70.0).select("doc_id", "chunks", F.round("overall_score", 6).alias("overall_score"), "grade", "accepted")


@query("issue_counts", f"{_SCORED}, {_ISSUES} SELECT doc_id, place, text FROM frequent")
def _issue_counts(spark, folder):
    return enrich.frequent_issues(_validated(spark, folder)).select("doc_id", "place", "text")


@query("q_summary", f"""{_SCORED}, {_DOCUMENTS}, {_ISSUES}, told AS (SELECT doc_id, string_agg(text, '; ' ORDER BY place) AS major_issues FROM frequent GROUP BY doc_id)
SELECT doc_id, {_GRADE} AS grade, major_issues, good > 0.8 * chunks AS mostly_good FROM documents_judged LEFT JOIN told USING (doc_id)""")
def _q_summary(spark, folder):
    # both sides come from one row a chunk, which is small
    scored = _validated(spark, folder).select("doc_id", "score", "issues")
    top = enrich.frequent_issues(scored).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "; ").alias("major_issues"))
    return enrich.document_quality(scored, 70.0).join(top, "doc_id", "left").select("doc_id", "grade", "major_issues", (F.col("good_chunks") > 0.8 * F.col("chunks")).alias("mostly_good"))


# --- flat rows beside vectors ---------------------------------------------

_TOKENS = r"regexp_extract_all(content, '[\p{L}\p{N}_]+')"
_CONCEPTS = f"""tokens AS (SELECT chunk_id, unnest({_TOKENS}) AS t FROM chunks),
concepts AS (SELECT chunk_id, string_agg(t, ',' ORDER BY t) AS key_concepts FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY t) AS k FROM (
  SELECT DISTINCT chunk_id, t FROM tokens WHERE regexp_full_match(t, '[A-Z][a-z]+')
  UNION SELECT chunk_id, lower(t) FROM tokens WHERE regexp_full_match(lower(t), '[a-z]{{4,}}') GROUP BY chunk_id, lower(t) HAVING count(*) >= 2)) WHERE k <= 10 GROUP BY chunk_id)"""
_PREREQUISITES = rf"array_to_string(list_filter(list_transform({extract_all(chunk_text.PREREQUISITES)}, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) < 100)[1:5], ',')"


@query("vec_meta", f"""{_CHUNKS}, {_HIERARCHY}, {_CONCEPTS}, titled AS ({ORACLES["md_title"]}), typed_docs AS ({ORACLES["md_doctype"]}),
measured AS (SELECT *, CAST(len({W}) AS INT) AS token_count FROM placed)
SELECT chunk_id, doc_id AS document_id, coalesce(t.value, '') AS document_title, coalesce(d.value, '') AS document_type, {case_of(chunk_text.CHUNK_TYPES, 'unknown')} AS chunk_type,
  {case_of(chunk_text.SEMANTIC_ROLES, 'main_content')} AS semantic_role, coalesce(chapter, '') AS chapter, coalesce(section, '') AS section, coalesce(key_concepts, '') AS key_concepts, {_PREREQUISITES} AS prerequisites,
  round(chunk_index / count(*) OVER (PARTITION BY doc_id), 6) AS position, token_count, round({CONF}, 6) AS extraction_confidence
FROM measured LEFT JOIN concepts USING (chunk_id) LEFT JOIN titled t USING (doc_id) LEFT JOIN typed_docs d USING (doc_id)""")
def _vec_meta(spark, folder):
    docs = manuals(spark, folder).select("doc_id", metadata.title("content").alias("title"), metadata.document_type("content").alias("doc_type"))
    rows = vector.flat_metadata(enrich.enrich_chunks(saved(_section_chunks(spark, folder), "chunks"), docs, related=False))
    return rows.withColumns({c: F.round(c, 6) for c in ("position", "extraction_confidence")})


@query("doc_context", f"""{WITH_CHUNKS}, titled AS ({ORACLES["md_title"]}), described AS (
  SELECT concat(doc_id, '_chunk_', chunk_index) AS chunk_id, CASE WHEN doc_id % 2 = 0 THEN value END AS title, {COMPLETE} AS completeness FROM chunks JOIN titled USING (doc_id))
SELECT chunk_id, coalesce(title, 'Untitled') AS title, 'unknown' AS doc_type, CAST(0 AS INT) AS total_pages, round(completeness, 6) AS completeness FROM described""")
def _doc_context(spark, folder):
    docs = manuals(spark, folder).where("doc_id % 2 = 0").select("doc_id", metadata.title("content").alias("title"), F.lit(None).cast("string").alias("doc_type"), F.lit(None).cast("int").alias("total_pages"))
    out = enrich.with_document_context(manual_chunks(spark, folder), docs)
    return out.select("chunk_id", "title", "doc_type", "total_pages", F.round(chunk_text.completeness("content"), 6).alias("completeness"))
