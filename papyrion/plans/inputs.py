"""Frames of the document model, made from the given tables in plain SQL.

The SQL is common to Spark and other engines, so a query and its SQL form can
share it word for word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrion.plans.registry import table

#: Documents with headings, labels, lists, fences and rule phrases around their whole text.
MANUALS = r"""SELECT doc_id, lang, source, concat(
  CASE doc_id % 4
    WHEN 0 THEN concat('User Manual', chr(10), 'Author: Ann Lee and Bob Ray; Cy Dee', chr(10), 'Version 2.', doc_id % 7, chr(10), 'Created: 05/0', doc_id % 9 + 1, '/2024', chr(10), 'Tags: Data, Spark and SQL', chr(10))
    WHEN 1 THEN concat('Release notes', chr(10), 'Title: Change log ', doc_id, chr(10), 'By: Dee Fox', chr(10), 'Last updated: 2023-0', doc_id % 9 + 1, '-15', chr(10))
    WHEN 2 THEN concat('Research report for the cloud', chr(10), 'Author', chr(10), ' Max Moe, Lia Poe', chr(10), 'Copyright 2021 by Eve Stone', chr(10), 'Date: 2024/03/0', doc_id % 9 + 1, chr(10),
      CASE WHEN doc_id % 8 = 2 THEN 'Issued 9 March 2023, again march 5, 2022' ELSE 'Revised: 05.1.24 Modified: 31-12-2023' END, chr(10), 'Keywords: api; docker', chr(10), 'Table of contents', chr(10))
    ELSE '' END,
  'Chapter ', doc_id % 5 + 1, ': Topic ', source, chr(10),
  CASE WHEN doc_id % 3 = 0 THEN concat('Introduction: scope', chr(10), 'for example however the best practice', chr(10)) ELSE concat('Warning: mind this', chr(10)) END,
  text, chr(10),
  '1.', doc_id % 3 + 1, ' Install the Server', chr(10), 'It requires a server. See also "Handout ', doc_id % 5, '".', chr(10),
  CASE doc_id % 5 WHEN 0 THEN concat('- one', chr(10), 'a|b', chr(10), 'a|b|c', chr(10), '- two', chr(10), '|||', chr(10), 'x', chr(10), 'y', chr(10), '- three', chr(10))
    WHEN 1 THEN concat('```', chr(10), 'code', chr(10)) WHEN 2 THEN concat('an error and a problem     here', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 2 = 0 THEN 'In summary: the end.' ELSE 'cut of-' END) AS content
FROM documents"""

REGISTRY = """SELECT o_orderkey AS doc_id, concat('Order ', o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' Guide' ELSE ' Note' END) AS title,
  o_orderpriority AS doc_type, CASE o_orderkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN '' END AS language,
  o_totalprice / 5000.0 AS quality_score, CAST(o_orderkey % 9 AS DOUBLE) - 2 AS processing_time, o_orderdate AS processed_at FROM orders"""
AUTHORS = "SELECT DISTINCT l_orderkey AS doc_id, concat('Supplier ', l_suppkey) AS author_name FROM lineitem"
TAGS = "SELECT DISTINCT l_orderkey AS doc_id, concat('tag', l_partkey % 50) AS tag_name FROM lineitem"
EDGES = """SELECT l_partkey AS source_doc_id, (l_orderkey * 7 + l_suppkey) % 2500 AS target_doc_id,
  CASE l_linenumber % 3 WHEN 0 THEN 'references' WHEN 1 THEN 'prerequisite' ELSE 'related' END AS relation_type, l_quantity / 50.0 AS strength FROM lineitem"""
#: Files of the last run (state) and of this one (listing), from events.
STATE = """SELECT concat('f', event_id, '.pdf') AS file_key, concat('h', event_id % 10) AS hash, concat('doc', event_id) AS doc_id, ts AS processed_at,
  CAST(user_id % 20 AS INT) AS chunks_created, CAST(event_id % 11 AS DOUBLE) AS processing_time, CAST(value AS DOUBLE) AS quality_score FROM events WHERE event_id % 5 <> 0"""
LISTING = "SELECT concat('f', event_id, '.pdf') AS file_key, CASE WHEN event_id % 7 = 0 THEN 'changed' ELSE concat('h', event_id % 10) END AS hash FROM events WHERE event_id % 6 <> 0"

SOURCES = ("documents", "orders", "lineitem", "events", "part", "embeddings", "conversations", "pages", "customer")


def frame(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """``sql`` with its one table name resolved below ``folder``."""
    for name in SOURCES:
        if f"FROM {name}" in sql:
            return spark.sql(sql.replace(f"FROM {name}", "FROM {t}"), t=table(spark, folder, name))
    raise ValueError("no known table in the SQL")


def manuals(spark: SparkSession, folder: str) -> DataFrame:
    return frame(spark, folder, MANUALS)


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("title"), F.col("p_type").alias("doc_type"), F.array(F.concat(F.lit("a"), (F.col("p_partkey") % 7).cast("string"))).alias("authors"),
        F.array("p_brand", F.concat(F.lit("size"), (F.col("p_size") % 5).cast("string")), F.concat(F.lit("k"), (F.col("p_partkey") % 40).cast("string"))).alias("tags"), F.col("p_retailprice").alias("quality_score"),
    )


NODES = "SELECT p_partkey AS doc_id, p_name AS title, p_type AS doc_type, [concat('a', p_partkey % 7)] AS authors, [p_brand, concat('size', p_size % 5), concat('k', p_partkey % 40)] AS tags, p_retailprice AS quality_score FROM part"
