"""Queries of the extensions, and of checks that need a whole document's chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrion.functions import quality
from papyrion.operators import chunking, cross_references, enrich, extensions, graph, incremental, vector
from papyrion.plans import pipeline
from papyrion.plans.inputs import LISTING, STATE, frame, manuals, nodes
from papyrion.plans.registry import query, table
from papyrion.plans.text_queries import LIST_GAPS, WITH, WITH_CHUNKS, manual_chunks
from papyrion.sources import files


@query("filter_ops", "SELECT event_id, value FROM events WHERE value >= 20 AND value <= 80 AND event_type IN ('click', 'view', 'purchase') AND user_id <> 3")
def _filter_ops(spark, folder):
    return extensions.where(table(spark, folder, "events"), {"value": {"$gte": 20, "$lte": 80}, "event_type": {"$in": ["click", "view", "purchase"]}, "user_id": {"$ne": 3}}).select("event_id", "value")


@query("rag_query", f"""{WITH_CHUNKS}, hits AS (SELECT doc_id, chunk_index FROM chunks WHERE chunk_index % 7 = 3)
SELECT h.doc_id, h.chunk_index, sha256(string_agg(c.content, chr(10) ORDER BY c.chunk_index)) AS context_sha256 FROM hits h JOIN chunks c ON c.doc_id = h.doc_id AND abs(c.chunk_index - h.chunk_index) <= 1 GROUP BY ALL""")
def _rag_query(spark, folder):
    c = manual_chunks(spark, folder).withColumn("chunk_index", F.col("chunk_index").cast("int"))
    found = extensions.with_neighbours(c.where("chunk_index % 7 = 3").select("doc_id", "chunk_index"), c)
    return found.select("doc_id", "chunk_index", F.sha2("context", 256).alias("context_sha256"))


@query("support_categories", f"""{WITH} SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(lower(content), 'install') OR contains(lower(content), 'setup') THEN 'setup' END, CASE WHEN contains(lower(content), 'error') THEN 'fault' END, CASE WHEN contains(lower(content), 'cloud') THEN 'hosting' END], lambda c: c IS NOT NULL), ',') AS categories FROM manuals""")
def _support(spark, folder):
    rules = {"setup": ["install", "setup"], "fault": ["error"], "hosting": ["cloud"]}
    return manuals(spark, folder).select("doc_id", F.array_join(extensions.categories(F.col("content"), rules), ",").alias("categories"))


@query("classifier_agent", f"""{WITH}, s AS (SELECT doc_id, CAST(contains(lower(content), 'error') AS INT) / 2 + CAST(contains(lower(content), 'problem') AS INT) / 2 AS a, CAST(contains(lower(content), 'cloud') AS INT) / 2 + CAST(contains(lower(content), 'docker') AS INT) / 2 AS b FROM manuals)
SELECT doc_id, CASE WHEN a >= b AND a >= 0.3 THEN 'fault' WHEN b >= 0.3 THEN 'hosting' ELSE 'unknown' END AS category FROM s""")
def _classifier_agent(spark, folder):
    return manuals(spark, folder).select("doc_id", extensions.best_category(F.col("content"), {"fault": ["error", "problem"], "hosting": ["cloud", "docker"]}).alias("category"))


@query("query_expand", "SELECT conv_id, turn, concat_ws(' ', text, CASE WHEN contains(lower(text), 'the') THEN 'guide' END, CASE WHEN contains(lower(text), 'for') THEN 'reason' END) AS expanded FROM conversations")
def _query_expand(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", extensions.expanded(F.col("text"), {"the": "guide", "for": "reason"}).alias("expanded"))


@query("compliance_stats", "SELECT event_type, count(*) AS n, count(*) FILTER (value >= 50) AS passed, round(100 * count(*) FILTER (value >= 50) / count(*), 4) AS percent FROM events GROUP BY 1")
def _compliance(spark, folder):
    return extensions.rate(table(spark, folder, "events"), F.col("value") >= 50, "event_type")


@query("onboarding_rates", "SELECT event_type, CAST(ts AS DATE) AS day, round(avg(value), 6) AS mean FROM events GROUP BY ALL")
def _onboarding(spark, folder):
    return table(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.round(F.avg("value"), 6).alias("mean"))


@query("content_roi", "SELECT l_partkey AS doc_id, round(sum(l_extendedprice), 2) AS value, round(sum(l_quantity * 1000), 2) AS cost, round((sum(l_extendedprice) - sum(l_quantity * 1000)) / sum(l_quantity * 1000), 6) AS roi FROM lineitem GROUP BY 1 ORDER BY roi DESC, doc_id LIMIT 10")
def _content_roi(spark, folder):
    usage = table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "doc_id")
    out = extensions.return_on_content(usage, F.col("l_extendedprice"), F.col("l_quantity") * 1000)
    return out.select("doc_id", F.round("value", 2).alias("value"), F.round("cost", 2).alias("cost"), F.round("roi", 6).alias("roi"))


@query("tfidf_kmeans")
def _tfidf_kmeans(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"))
    return extensions.topics(docs, max(2, min(20, docs.count() // 10)))


@query("hybrid_query", """WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0),
dots AS (SELECT vec_id, label, list_sum(list_transform(range(1, len(e) + 1), lambda i: CAST(embedding[i] AS DOUBLE) * e[i])) AS d,
  list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)) AS a, list_sum(list_transform(e, lambda x: CAST(x AS DOUBLE) * x)) AS b FROM embeddings, q)
SELECT vec_id, round(0.7 * d / (sqrt(a) * sqrt(b)) + 0.3 * (1 + CAST(contains(CAST(label AS VARCHAR), '1') AS INT)) / 2, 6) AS score FROM dots""")
def _hybrid(spark, folder):
    e = table(spark, folder, "embeddings").withColumn("content", F.concat(F.lit("label "), F.col("label").cast("string")))
    first = e.where("vec_id = 0").first()["embedding"]
    score = extensions.hybrid_score(F.col("content"), F.col("embedding"), first, ["label", "1"])
    return e.select("vec_id", F.round(score, 6).alias("score"))


@query("extract_valid", r"""SELECT doc_id, length(text) >= 100 AND NOT (length(text) > 1000
  AND len(list_filter(list_distinct(string_split(text, '')), lambda c: regexp_matches(c, '\p{L}') AND length(text) - length(replace(text, c, '')) = 1)) > 0.3 * length(text)) AS valid FROM documents""")
def _extract_valid(spark, folder):
    return files.valid_extractions(table(spark, folder, "documents").select("doc_id", F.col("text").alias("content")))


_CONTEXT = f"""{WITH_CHUNKS}, placed AS (SELECT *, lag(chunk_index) OVER w AS p, lead(chunk_index) OVER w AS f FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index))
SELECT concat(doc_id, '_chunk_', chunk_index) AS chunk_id, CAST(85 - CASE WHEN p IS NOT NULL AND f IS NULL AND NOT (contains(lower(content), 'conclusion') OR contains(lower(content), 'summary') OR contains(lower(content), 'fazit')) THEN 10 ELSE 0 END AS INT) AS score FROM placed"""


@query("q_context", _CONTEXT)
def _q_context(spark, folder):
    c = enrich.navigation(manual_chunks(spark, folder))
    none = F.lit(None).cast("string")
    return c.select("chunk_id", quality.context_consistency(F.col("content"), none, none, F.col("previous_chunk_id"), F.col("next_chunk_id"), F.lit("unknown"))["score"].alias("score"))


@query("nav_integrity", f"""{WITH_CHUNKS}, linked AS (SELECT doc_id, chunk_index, CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE CAST(lag(chunk_index) OVER w AS VARCHAR) END AS p, CASE WHEN doc_id % 4 = 0 THEN 'x' ELSE CAST(lead(chunk_index) OVER w AS VARCHAR) END AS n,
  row_number() OVER w AS k, count(*) OVER (PARTITION BY doc_id) AS total FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index))
SELECT doc_id, count(*) AS chunks, count(*) FILTER (p IS NOT NULL OR n IS NOT NULL) AS linked, count(*) FILTER (k = 1 AND p IS NOT NULL) AS first_with_previous, count(*) FILTER (k = total AND n IS NOT NULL) AS last_with_next FROM linked GROUP BY doc_id""")
def _nav_integrity(spark, folder):
    c = enrich.navigation(manual_chunks(spark, folder))
    broken = {"previous_chunk_id": F.when(F.col("doc_id") % 3 == 0, "x").otherwise(F.col("previous_chunk_id")), "next_chunk_id": F.when(F.col("doc_id") % 4 == 0, "x").otherwise(F.col("next_chunk_id"))}
    return enrich.navigation_integrity(c.withColumns(broken))


@query("coverage", "SELECT source AS doc_id, CAST(sum(length(text)) AS BIGINT) AS total_chars, count(DISTINCT doc_id * doc_id % 37) AS pages_covered, round(count(DISTINCT doc_id * doc_id % 37) / 50, 6) AS coverage_ratio FROM documents GROUP BY 1")
def _coverage(spark, folder):
    c = table(spark, folder, "documents").select(F.col("source").alias("doc_id"), F.length("text").alias("char_count"), F.array(F.col("doc_id") * F.col("doc_id") % 37).alias("page_numbers"))
    total = c.select("doc_id").distinct().withColumn("total_pages", F.lit(50))
    return enrich.coverage(c, total).withColumn("coverage_ratio", F.round("coverage_ratio", 6))


_SIMPLE = rf"""{WITH}, words AS (SELECT doc_id, list_filter(regexp_split_to_array(content, '\s+'), lambda w: w <> '') AS w FROM manuals),
parts AS (SELECT doc_id, CAST(i // 1000 AS INT) AS chunk_index, array_to_string(w[i + 1:i + 1000], ' ') AS content FROM (SELECT doc_id, w, unnest(range(0, len(w), 1000)) AS i FROM words))"""


@query("prod_report", f"{_SIMPLE} SELECT doc_id, count(*) AS chunks, CAST(sum(length(content)) // count(*) AS BIGINT) AS average_chunk_size, CAST(85 AS DOUBLE) AS quality_score FROM parts GROUP BY doc_id")
def _prod_report(spark, folder):
    return pipeline.simple_report(chunking.simple(manuals(spark, folder)))


@query("prod_nav", f"""{_SIMPLE}, named AS (SELECT doc_id, chunk_index, concat(doc_id, '_chunk_', chunk_index) AS chunk_id FROM parts)
SELECT chunk_id, lag(chunk_id) OVER w AS previous_chunk_id, lead(chunk_id) OVER w AS next_chunk_id FROM named WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)""")
def _prod_nav(spark, folder):
    c = chunking.simple(manuals(spark, folder)).withColumn("chunk_id", F.concat_ws("_chunk_", "doc_id", "chunk_index"))
    return enrich.navigation(c).select("chunk_id", "previous_chunk_id", "next_chunk_id")


@query("last_processing", f"WITH state AS ({STATE}) SELECT max(processed_at) AS last_processing FROM state")
def _last_processing(spark, folder):
    return incremental.statistics(frame(spark, folder, STATE)).select("last_processing")


@query("list_gaps", f"{WITH} SELECT doc_id, {LIST_GAPS} AS interrupted FROM manuals")
def _list_gaps(spark, folder):
    check = quality.structural_integrity(F.col("content"))
    return manuals(spark, folder).select("doc_id", F.array_contains(check["issues"], "Interrupted list structure").alias("interrupted"))


@query("pages_union", f"{WITH} SELECT source, count(DISTINCT doc_id * doc_id % 31) AS pages FROM manuals GROUP BY 1")
def _pages_union(spark, folder):
    arrays = manuals(spark, folder).select("source", F.array(F.col("doc_id") * F.col("doc_id") % 31, F.col("doc_id") * F.col("doc_id") % 31).alias("p"))
    return arrays.select("source", F.explode("p").alias("p")).groupBy("source").agg(F.countDistinct("p").alias("pages"))


@query("page_span_fixed", r"""WITH pages AS (SELECT source AS doc_id, doc_id AS page_number, text AS content FROM documents),
offsets AS (SELECT doc_id, page_number, coalesce(sum(length(content) + 1) OVER w, 0) AS a, coalesce(sum(length(content) + 1) OVER w, 0) + length(content) AS b
  FROM pages WINDOW w AS (PARTITION BY doc_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
texts AS (SELECT doc_id, list_filter(regexp_split_to_array(string_agg(content, ' ' ORDER BY page_number), '\s+'), lambda w: w <> '') AS w FROM pages GROUP BY doc_id),
starts AS (SELECT doc_id, w, unnest(range(0, len(w), 800)) AS s FROM texts),
spans AS (SELECT doc_id, s, length(array_to_string(w[1:s], ' ')) AS a, length(array_to_string(w[s + 1:s + 1000], ' ')) AS n FROM starts WHERE len(w[s + 1:s + 1000]) >= 10),
numbered AS (SELECT concat(doc_id, '_chunk_', row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1) AS chunk_id, * FROM spans)
SELECT chunk_id, string_agg(CAST(o.page_number AS VARCHAR), ',' ORDER BY o.page_number) AS page_numbers FROM numbered n JOIN offsets o ON n.doc_id = o.doc_id AND n.a <= o.b AND n.a + n.n - 1 >= o.a GROUP BY chunk_id""")
def _page_span_fixed(spark, folder):
    pages = frame(spark, folder, "SELECT source AS doc_id, doc_id AS page_number, text AS content FROM documents")
    chunks = chunking.page_spans(chunking.named(chunking.window_offsets(pages)), chunking.spaced_offsets(pages))
    return chunks.select("chunk_id", F.array_join(F.transform("page_numbers", lambda x: x.cast("string")), ",").alias("page_numbers"))


@query("compliance", f"""{WITH}, counted AS (SELECT doc_id, lower(content) AS low FROM manuals)
SELECT doc_id, {" + ".join("CASE WHEN " + " OR ".join(f"contains(low, '{w}')" for w in words) + " THEN CAST(25 AS DOUBLE) ELSE 0 END" for words in extensions.PRIVACY.values())} AS privacy_percent,
  CAST(20 AS DOUBLE) * ({" + ".join(f"CAST(contains(low, '{w}') AS INT)" for w in extensions.SECURITY)}) AS security_percent, CAST({" + ".join(f"CAST(contains(low, '{w}') AS INT)" for w in extensions.RISKS)} AS INT) AS risk_score,
  CASE WHEN risk_score >= 5 THEN 'high' WHEN risk_score >= 3 THEN 'medium' ELSE 'low' END AS risk_level FROM counted""")
def _compliance_report(spark, folder):
    found = manuals(spark, folder).select("doc_id", extensions.compliance(F.col("content")).alias("c"))
    return found.select("doc_id", "c.privacy_percent", "c.security_percent", "c.risk_score", "c.risk_level")


@query("inc_report", f"""WITH state AS ({STATE}), listing AS ({LISTING}), worst AS (SELECT file_key, quality_score, chunks_created FROM state WHERE quality_score < 70 ORDER BY quality_score, file_key LIMIT 10)
SELECT count(*) AS processed_files_count, CAST(sum(chunks_created) AS BIGINT) AS total_chunks, max(processed_at) AS last_processing, '2.0.0' AS pipeline_version, (SELECT count(*) FROM state WHERE file_key NOT IN (SELECT file_key FROM listing)) AS deleted_files_pending,
  (SELECT string_agg(file_key, ',' ORDER BY quality_score, file_key) FROM worst) AS low_quality_files FROM state""")
def _inc_report(spark, folder):
    state = frame(spark, folder, STATE)
    gone = incremental.plan(frame(spark, folder, LISTING), state).where("status = 'deleted'")
    out = incremental.inc_report(state, gone, "2.0.0")
    worst = F.array_join(F.from_json("low_quality_files", "array<struct<quality_score: double, file_key: string>>")["file_key"], ",")
    return out.select("processed_files_count", "total_chunks", "last_processing", "pipeline_version", "deleted_files_pending", worst.alias("low_quality_files"))


@query("chunk_by_id", f"{WITH_CHUNKS} SELECT doc_id, chunk_index, sha256(content) AS content_sha256 FROM chunks WHERE concat(doc_id, '_chunk_', chunk_index) = '7_chunk_0'")
def _chunk_by_id(spark, folder):
    return vector.chunk_by_id(manual_chunks(spark, folder), "7_chunk_0").select("doc_id", F.col("chunk_index").cast("int").alias("chunk_index"), F.sha2("content", 256).alias("content_sha256"))


@query("graph_doc", "SELECT p_partkey AS doc_id, p_name AS title, p_type AS doc_type FROM part WHERE p_partkey = 7")
def _graph_doc(spark, folder):
    return graph.document(nodes(spark, folder), 7).select("doc_id", "title", "doc_type")


@query("cross_references")
def _cross_references(spark, folder):
    """Where the references of all manuals' chunks point, dangling ones included; held against loops in the tests."""
    chunks = chunking.named(manual_chunks(spark, folder).select("doc_id", "chunk_index", "content"))
    titles = manuals(spark, folder).select("doc_id", F.regexp_extract("content", r"Chapter \d: (Topic [^\n]+)", 1).alias("title"))
    return cross_references.resolve(chunks, titles)
