"""Queries of keyword and substring search, by indexes in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrion.functions import quality
from papyrion.operators import embedding, phrases, substring_index, text_index, vector
from papyrion.plans import table_queries
from papyrion.plans.inputs import AUTHORS, REGISTRY, frame
from papyrion.plans.registry import ORACLES, query, table
from papyrion.session import scratch_folder

_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda w: w <> '')"
_BM25 = rf"""words AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
totals AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS average FROM words),
counted AS MATERIALIZED (SELECT doc_id, term, len, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term, len(w) AS len FROM words) GROUP BY ALL),
known AS (SELECT term, count(*) AS documents FROM counted GROUP BY 1),
asked AS (SELECT item_id AS query_id, unnest(list_distinct({_WORDS})) AS term FROM benchmark),
scored AS MATERIALIZED (
  SELECT query_id, doc_id, CAST(sum(CAST(floor(ln(1 + (n - documents + 0.5) / (documents + 0.5)) * (tf * 2.2e0 / (tf + 1.2e0 * (1 - 0.75e0 + 0.75e0 * len / average))) * 1e6 + 0.5) AS BIGINT)) AS BIGINT) AS score
  FROM asked JOIN known USING (term) JOIN counted USING (term), totals GROUP BY ALL)"""
_PLACED = "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT)"


def _bm25(spark, folder, n):
    path = scratch_folder(spark, "words")
    text_index.build(table(spark, folder, "documents").select("doc_id", F.col("text").alias("content")), path)
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return text_index.search(spark, path, asked, n)


@query("keyword_search", f"WITH {_BM25} SELECT query_id, doc_id, score, place FROM (SELECT *, {_PLACED} AS place FROM scored) WHERE place <= 10")
def _keyword_search(spark, folder):
    return _bm25(spark, folder, 10)


@query("hybrid_search", f"""WITH {_BM25},
pairs AS (SELECT item_id AS query_id, v.vec_id, list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i: (CAST(v.embedding[i] AS DOUBLE) - q.embedding[i]) * (CAST(v.embedding[i] AS DOUBLE) - q.embedding[i]))) AS d
  FROM benchmark JOIN embeddings q ON q.vec_id = item_id, embeddings v),
ranked AS (SELECT query_id, doc_id, {_PLACED} AS place FROM scored UNION ALL SELECT query_id, vec_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS INT) FROM pairs),
fused AS (SELECT query_id, doc_id, CAST(sum(1000000 // (60 + place)) AS BIGINT) AS score FROM ranked WHERE place <= 20 GROUP BY ALL)
SELECT query_id, doc_id, score, place FROM (SELECT *, {_PLACED} AS place FROM fused) WHERE place <= 10""")
def _hybrid_search(spark, folder):
    """Words and vectors together: benchmark items against documents, an item's vector being the one with its number."""
    v = table(spark, folder, "embeddings")
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("vec_id"))
    near = vector.nearest_batch(v, v.join(asked, "vec_id").select(F.col("vec_id").alias("query_id"), "embedding"), 20)
    return text_index.fuse([_bm25(spark, folder, 20), near.select("query_id", F.col("vec_id").alias("doc_id"), "place")], 10)


_PATTERNS = ["%der 12%gui%", "%9_7 note%", "Order 1_ %", "%zzz%", "%e", "%12%", "%ORDER 777%"]


@query("like_search", f"WITH docs AS ({REGISTRY}) " + " UNION ALL ".join(f"SELECT {i} AS pattern, doc_id, title FROM docs WHERE title ILIKE '{p}'" for i, p in enumerate(_PATTERNS)))
def _like_search(spark, folder):
    path, out = scratch_folder(spark, "substrings"), None
    substring_index.build(frame(spark, folder, REGISTRY), path, id_col="doc_id", text_col="title")
    for i, pattern in enumerate(_PATTERNS):
        found = substring_index.search(spark, path, pattern).select(F.lit(i).alias("pattern"), F.col("id").alias("doc_id"), F.col("text").alias("title"))
        out = found if out is None else out.unionByName(found)
    return out


@query("semi_author_index", ORACLES["semi_author"])
def _semi_author_index(spark, folder):
    """``semi_author`` by an index of the distinct names."""
    path, authors = scratch_folder(spark, "names"), frame(spark, folder, AUTHORS)
    names = authors.select(F.col("author_name").alias("id"), F.col("author_name").alias("text")).distinct()
    substring_index.build(names, path)
    met = authors.join(substring_index.search(spark, path, "%supplier 7%").select(F.col("id").alias("author_name")), "author_name", "left_semi")
    return table_queries._registry(spark, folder).join(met, "doc_id", "left_semi").select("doc_id", "title")


_STOP = ", ".join(f"'{w}'" for w in quality.FUNCTION_WORDS)
_TERMS = rf"""stretches AS (SELECT doc_id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '[.!?;:,()\n]+')) AS s FROM documents),
worded AS (SELECT doc_id, list_filter(regexp_split_to_array(s, '\s+'), lambda w: w <> '') AS w FROM stretches),
starts AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM worded),
runs AS (SELECT doc_id, w[i:i + n - 1] AS p FROM starts, (SELECT unnest([2, 3, 4]) AS n) WHERE i + n - 1 <= len(w)),
found AS MATERIALIZED (SELECT doc_id, array_to_string(p, ' ') AS term, p FROM runs WHERE p[1] NOT IN ({_STOP}) AND p[-1] NOT IN ({_STOP}) AND len(list_filter(p, lambda x: NOT regexp_full_match(x, '\p{{L}}{{2,}}'))) = 0),
counted AS MATERIALIZED (SELECT term, p, count(*) AS occurrences FROM found GROUP BY ALL HAVING count(*) >= 5),
inner_terms AS (SELECT DISTINCT term, occurrences, array_to_string(p[i:i + n - 1], ' ') AS part FROM (SELECT *, unnest(range(1, len(p))) AS i FROM counted), (SELECT unnest([2, 3]) AS n) WHERE n < len(p) AND i + n - 1 <= len(p)),
told AS (SELECT part AS term, count(*) AS nested_in, sum(occurrences) AS within FROM inner_terms GROUP BY 1),
terms AS MATERIALIZED (SELECT c.term, CAST(len(p) AS INT) AS words, occurrences, coalesce(nested_in, 0) AS nested_in,
  CAST(floor(log2(len(p)) * (occurrences - CASE WHEN nested_in > 0 THEN CAST(within AS DOUBLE) / nested_in ELSE 0 END) * 1e4 + 0.5) AS BIGINT) AS c_value FROM counted c LEFT JOIN told USING (term))"""


@query("noun_phrases", f"WITH {_TERMS} SELECT term, words, occurrences, nested_in, c_value FROM terms")
def _noun_phrases(spark, folder):
    return phrases.terms(table(spark, folder, "documents"), text_col="text")


@query("noun_phrase_concepts", f"""WITH {_TERMS}, held AS (SELECT DISTINCT doc_id, term FROM found),
placed AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY c_value DESC, term) AS k FROM held JOIN terms USING (term) WHERE c_value > 0)
SELECT doc_id, string_agg(term, ',' ORDER BY k) AS concepts FROM placed WHERE k <= 10 GROUP BY 1""")
def _noun_phrase_concepts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"))
    return phrases.concepts(docs, phrases.terms(docs)).select("doc_id", F.array_join("concepts", ",").alias("concepts"))


_SIGN = lambda j: f"(2 * ((h{j // 32} >> {j % 32}) & 1) - 1)"
_VECTORS = rf"""worded AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
known AS MATERIALIZED (SELECT term, count(*) AS documents FROM (SELECT unnest(list_distinct(w)) AS term FROM worded) GROUP BY 1 HAVING count(*) >= 2 ORDER BY 2 DESC, 1 LIMIT 2048),
starts AS (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM worded),
one_way AS MATERIALIZED (SELECT w[i] AS a, w[i + k] AS b, count(*) AS n FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k <= len(w) AND w[i] IN (SELECT term FROM known) AND w[i + k] IN (SELECT term FROM known) GROUP BY ALL),
both_ways AS MATERIALIZED (SELECT a, b, sum(n) AS n FROM (SELECT a, b, n FROM one_way UNION ALL SELECT b, a, n FROM one_way) GROUP BY ALL),
sums AS MATERIALIZED (SELECT a, sum(n) AS of_a FROM both_ways GROUP BY 1),
rated AS (SELECT x.a, x.b, CAST(floor(1000 * ln(CAST(x.n AS DOUBLE) * (SELECT sum(of_a) FROM sums) / (CAST(s.of_a AS DOUBLE) * t.of_a))) AS BIGINT) AS v,
  CAST('0x' || substr(sha256(x.b), 1, 8) AS BIGINT) AS h0, CAST('0x' || substr(sha256(x.b), 9, 8) AS BIGINT) AS h1 FROM both_ways x JOIN sums s ON s.a = x.a JOIN sums t ON t.a = x.b),
summed AS (SELECT a AS term, [{", ".join(f"CAST(sum(v * {_SIGN(j)}) AS BIGINT)" for j in range(64))}] AS vector FROM rated WHERE v > 0 GROUP BY 1)
SELECT term, documents, array_to_string(coalesce(vector, list_transform(range(64), lambda x: 0)), ',') AS vector FROM known LEFT JOIN summed USING (term)"""


@query("term_vectors", f"WITH {_VECTORS}")
def _term_vectors(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"))
    return embedding.term_vectors(docs).select("term", "documents", F.array_join(F.col("vector").cast("array<string>"), ",").alias("vector"))
