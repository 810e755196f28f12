"""The query of learned chunk types, with its SQL."""

from __future__ import annotations

from papyrion.functions import chunk_text
from papyrion.operators import chunk_classes
from papyrion.plans.inputs import frame
from papyrion.plans.registry import query
from papyrion.plans.text_queries import case_of

#: Whole texts as chunks; every second one has a phrase that the rules or references know, by language.
PHRASED = """SELECT doc_id AS chunk_id, concat(text, CASE WHEN doc_id % 2 = 1 THEN '' WHEN doc_id % 10 = 0 THEN ' (see page 2)'
  WHEN lang = 'en' THEN ' For example this.' WHEN lang = 'de' THEN ' Warning: mind this.' WHEN lang = 'fr' THEN ' An overview.' ELSE ' A definition.' END) AS content FROM documents"""

_CONFIG = chunk_classes.ChunkClassesConfig()
_REFERS = " OR ".join(f"regexp_matches(content, '{p}')" for p in chunk_text.REFERENCES)
_PLACES = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(chunk_classes.LABELS))


def _terms(text: str) -> str:
    return rf"list_distinct(list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '\s+'), lambda w: w <> ''))"


@query("chunk_classes", f"""WITH chunks AS MATERIALIZED (SELECT *, {case_of(chunk_text.CHUNK_TYPES, 'unknown')} AS by_rule FROM ({PHRASED})),
seeds AS MATERIALIZED (
  SELECT CASE WHEN by_rule <> 'unknown' THEN by_rule ELSE 'reference' END AS label, {_terms('content')} AS terms
  FROM chunks WHERE by_rule <> 'unknown' OR {_REFERS}),
held AS (SELECT label, unnest(terms) AS term FROM seeds),
classes AS (SELECT label, count(*) AS n FROM seeds GROUP BY 1),
totals AS (SELECT sum(n) AS n, count(*) AS kinds FROM classes),
known AS MATERIALIZED (SELECT term, count(*) AS k FROM held GROUP BY 1 HAVING count(*) >= {_CONFIG.min_chunks} ORDER BY k DESC, term LIMIT {_CONFIG.terms}),
counted AS (SELECT term, label, count(*) AS k FROM held GROUP BY ALL),
gains AS MATERIALIZED (
  SELECT term, label, CAST(floor(1000 * ln(CAST(coalesce(c.k, 0) * t.n + {_CONFIG.smoothing} * w.k AS DOUBLE) / CAST(w.k * (s.n + {_CONFIG.smoothing}) AS DOUBLE))) AS BIGINT) AS gain
  FROM known w CROSS JOIN classes s CROSS JOIN totals t LEFT JOIN counted c USING (term, label)),
asked AS (SELECT chunk_id, unnest({_terms(f"left(split_part(content, chr(10) || chr(10), 1), {_CONFIG.head_chars})")}) AS term FROM chunks),
summed AS (SELECT chunk_id, label, sum(gain) AS gain FROM asked JOIN gains USING (term) GROUP BY ALL),
scored AS (
  SELECT chunk_id, label, CAST(gain + floor(1000 * ln(CAST(s.n + 1 AS DOUBLE) / (t.n + t.kinds))) AS BIGINT) AS score
  FROM summed JOIN classes s USING (label), totals t),
placed AS (SELECT *, row_number() OVER w AS place, lead(score) OVER w AS second FROM scored WINDOW w AS (PARTITION BY chunk_id ORDER BY score DESC, CASE label {_PLACES} END)),
best AS (SELECT chunk_id, label, score - coalesce(second, score) AS margin FROM placed WHERE place = 1)
SELECT chunk_id, label AS learned_type, margin, CASE WHEN margin >= {_CONFIG.least_margin} THEN label ELSE coalesce(by_rule, 'unknown') END AS chunk_type
FROM chunks LEFT JOIN best USING (chunk_id)""")
def _chunk_classes(spark, folder):
    chunks = frame(spark, folder, PHRASED)
    return chunk_classes.classify(chunks, chunk_classes.train(chunks)).drop("content")
