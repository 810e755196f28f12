"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.llm import bpe, decontaminate, fingerprints, hard_negatives, html_extract, lm_scoring, near_dedup, quality_classifier, quality_rules, resampling, toxicity, url_filter, warc

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge_documents(_table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")


ORACLES["op1_quality_rules"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
parts AS MATERIALIZED (
  SELECT doc_id, t, w, row_number() OVER () AS k, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, x) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT k, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY k),
judged AS (
  SELECT p.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, coalesce(r.n, 0) AS n_repeat_words,
    list_filter(lines, lambda l: NOT regexp_matches(l, '[.!?…。！？]["”»'')\]]*([\x20\x09-\x0D]|$)')
      OR regexp_matches(l, '(?i)cookie|javascript|privacy policy|terms of (use|service)|all rights reserved|lorem ipsum|subscribe')
      OR (10 * length(regexp_replace(l, '[^#*$%&|<>{}=~^!?]+', '', 'g')) >= length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')))
      OR (5 * len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w IN ('|', '»', '›', '>', '·', '•', '/', '::')))
          >= len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')))) AS bad
  FROM parts p LEFT JOIN repeats r USING (k)),
counted AS (
  SELECT *, length(regexp_replace(array_to_string(bad, ''), '[\x20\x09-\x0D]+', '', 'g')) AS lost,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM judged)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  base_failed, NOT base_failed AND 100 * lost <= 50 * word_chars AS kept, CAST(lost AS BIGINT) AS lost_chars FROM counted
"""


@_query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, folder, "pages"))


ORACLES["op2_url_filter"] = r"""
WITH located AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN '.' || host LIKE '%.example.net' AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN '.' || host LIKE '%.org' AND starts_with(path, '/es/') THEN 'org/es/' END AS rule FROM located)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/en/', 'net/de/', 'example.net/de/8', 'org/es/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


@_query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality_classifier.train(docs, _table(spark, folder, "labels"))
    scored = quality_classifier.score_documents(docs, model)
    predicted = (F.col("score") >= model.config.accept).cast("int")
    return scored.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", predicted.alias("predicted"))


@_query
def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, folder, "documents"), near_dedup.NearDedupConfig(shingle_words=2))


ORACLES["op4_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) WHEN len(w) = 1 THEN w ELSE [] END) AS s
  FROM words),
items AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.x = b.x AND a.doc_id > b.doc_id
  AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT e.v, r.root FROM reach r JOIN both_ways e ON e.u = r.doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.root) AS component_id, s.doc_id = min(r.root) AS kept
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.s
"""


@_query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    grammar = toxicity.ClauseGrammar(toxicity.learn_insults(docs, _table(spark, folder, "labels")))
    scored = toxicity.score_documents(docs, grammar)
    return scored.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")


@_query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, folder, "pages"))


ORACLES["op6_warc"] = r"""
WITH digests AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS h FROM pages),
grouped AS (SELECT page_id, octet_length(payload) AS n, h, min(page_id) OVER (PARTITION BY h) AS first FROM digests),
five AS (SELECT h, g, CAST('0x' || substr(h, 5 * g + 1, 5) AS BIGINT) AS v FROM (SELECT DISTINCT h FROM grouped), (SELECT unnest(range(0, 8)) AS g)),
base32 AS (
  SELECT h, string_agg(array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((v >> s) & 31) + 1 AS BIGINT), 1)), ''), '' ORDER BY g) AS b FROM five GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, b AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM grouped JOIN base32 USING (h)
"""


@_query
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_corpus(_table(spark, folder, "documents"))


@_query
def op8_bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_digests(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_digests(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


ORACLES["op9_benchmark_decontamination"] = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS MATERIALIZED (
  SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT d.k, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) AS i FROM docs d, (SELECT DISTINCT n FROM windows) l)),
found AS MATERIALIZED (SELECT p.k, p.i, p.n, w.item_id FROM places p JOIN windows w ON p.n = w.n AND p.x = w.x),
hit AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT k, i, n FROM found)) GROUP BY k),
named AS (SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (k) LEFT JOIN named USING (k)
"""


@_query
def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, folder, "pages"))


@_query
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


ORACLES["op11_importance_resampling"] = r"""
WITH crc_table AS MATERIALIZED (
  SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
wanted AS MATERIALIZED (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
words AS MATERIALIZED (SELECT k, x, count(*) AS n FROM (SELECT k, unnest(w) AS x FROM texts) GROUP BY k, x),
target_words AS MATERIALIZED (SELECT x, count(*) AS n FROM (SELECT unnest(w) AS x FROM wanted) GROUP BY x),
bytes AS (
  SELECT x, list_transform(range(0, octet_length(encode(x))), lambda i: CAST('0x' || substr(hex(encode(x)), 2 * i + 1, 2) AS BIGINT)) AS b
  FROM (SELECT x FROM words UNION SELECT x FROM target_words)),
hashed AS MATERIALIZED (
  SELECT x, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc_table),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS n FROM words JOIN hashed USING (x) GROUP BY bucket),
t AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS n FROM target_words JOIN hashed USING (x) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
gains AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (CAST(s_all AS DOUBLE) + 10000) / ((CAST(s.n AS DOUBLE) + 1) * (CAST(t_all AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT k, CAST(sum(n * gain) AS BIGINT) AS weight FROM words JOIN hashed USING (x) JOIN gains USING (bucket) GROUP BY k),
noise AS (SELECT k, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM texts),
scored AS (
  SELECT doc_id, n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM noise LEFT JOIN weights USING (k)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""


@_query
def op12_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(_table(spark, folder, "documents"))


@_query
def op13_hard_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, folder, "embeddings"))


ORACLES["op13_hard_negative_mining"] = r"""
WITH taken AS MATERIALIZED (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM taken a JOIN taken b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negatives AS (
  SELECT p.*, n.id AS negative_id, n.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""
