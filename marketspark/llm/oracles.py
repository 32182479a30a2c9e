"""SQL for the queries that SQL can state, as DuckDB runs it on the same tables."""

from __future__ import annotations

from marketspark.llm.archives import LEAST_DUPLICATE
from marketspark.llm.decontamination import LOWER, UPPER

ARCHIVES = f"""
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (
  SELECT payload_digest, min(page_id) AS first_id FROM rows
  WHERE payload_bytes >= {LEAST_DUPLICATE} GROUP BY payload_digest)
SELECT page_id, payload_bytes, r.payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM rows r LEFT JOIN first f ON r.payload_digest = f.payload_digest"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '{}')"
_BENCHMARK_WORDS = _WORDS.format(UPPER, LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_BENCHMARK_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
phrase AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[start:start + 9], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS start FROM item WHERE len(words) > 0)),
doc AS (SELECT doc_id, {_BENCHMARK_WORDS} AS words FROM documents),
place AS (
  SELECT doc_id, size, start, array_to_string(words[start:start + size - 1], ' ') AS words
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start
        FROM doc, (SELECT DISTINCT size FROM phrase))),
found AS (SELECT doc_id, item_id, start, p.size FROM place p JOIN phrase f ON p.words = f.words AND p.size = f.size),
hit AS (SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(start, start + size)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id),
word AS MATERIALIZED (SELECT doc_id, unnest(words) AS term, unnest(range(1, len(words) + 1)) AS position FROM doc),
counted AS (SELECT term, count(*) AS n FROM word GROUP BY term),
part AS (
  SELECT words, unnest(string_split(words, ' ')) AS term, unnest(range(0, size)) AS place
  FROM (SELECT DISTINCT words, size FROM phrase)),
rarest AS (
  SELECT words, arg_min(p.term, (coalesce(n, 0), p.term, place)) AS term FROM part p LEFT JOIN counted c ON p.term = c.term GROUP BY words),
around AS (
  SELECT w.doc_id, term, d.words[greatest(1, position - 9):position + 9] AS near
  FROM word w JOIN doc d ON w.doc_id = d.doc_id WHERE term IN (SELECT term FROM rarest)),
close AS (
  SELECT DISTINCT a.doc_id, CAST(p.item_id AS VARCHAR) AS item_id
  FROM around a JOIN rarest r ON a.term = r.term JOIN phrase p ON p.words = r.words
  WHERE list_has_all(near, string_split(r.words, ' '))),
near AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM close c
  WHERE NOT EXISTS (FROM found f WHERE f.doc_id = c.doc_id AND CAST(f.item_id AS VARCHAR) = c.item_id) GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated,
       coalesce(r.n, 0) AS n_near_items, coalesce(r.ids, '') AS near_items
FROM doc d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id LEFT JOIN near r ON d.doc_id = r.doc_id"""

_SHINGLE_WORDS = _WORDS.format(UPPER, LOWER, r"[^\x20\x09-\x0D]+")

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_SHINGLE_WORDS} AS words FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, words[start:start + 2] AS words
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS start FROM doc WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.words = b.words AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared s JOIN size x ON s.a = x.doc_id JOIN size y ON s.b = y.doc_id
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN size s ON d.doc_id = s.doc_id"""

REPEATED_STRINGS = """
WITH doc AS MATERIALIZED (SELECT doc_id, any_value(encode(coalesce(text, ''))) AS raw, any_value(strlen(coalesce(text, ''))) AS n
  FROM documents GROUP BY doc_id),
string AS MATERIALIZED (
  SELECT doc_id, pos, md5(raw[pos + 1:pos + 50]) AS id
  FROM (SELECT *, unnest(range(n - 49)) AS pos FROM doc WHERE n >= 50)),
owner AS MATERIALIZED (SELECT id, min(doc_id) AS first_id FROM string GROUP BY id),
start AS MATERIALIZED (SELECT doc_id, pos FROM string JOIN owner USING (id) WHERE doc_id > first_id),
run AS MATERIALIZED (
  SELECT doc_id, pos, pos > 50 + lag(pos) OVER own OR lag(pos) OVER own IS NULL AS fresh FROM start
  WINDOW own AS (PARTITION BY doc_id ORDER BY pos)),
numbered AS MATERIALIZED (SELECT doc_id, pos, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM run),
span AS MATERIALIZED (SELECT doc_id, run, min(pos) AS low, max(pos) + 50 AS high FROM numbered GROUP BY 1, 2),
gap AS MATERIALIZED (
  SELECT doc_id, coalesce(lag(high) OVER own, 0) AS low, low AS high FROM span WINDOW own AS (PARTITION BY doc_id ORDER BY low)
  UNION ALL SELECT doc_id, max(high), NULL FROM span GROUP BY doc_id),
kept AS MATERIALIZED (
  SELECT g.doc_id, string_agg(hex(raw[low + 1:coalesce(high, n)]), '' ORDER BY low) AS raw
  FROM gap g JOIN doc d ON g.doc_id = d.doc_id GROUP BY g.doc_id),
lost AS MATERIALIZED (SELECT doc_id, CAST(sum(high - low) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(unhex(k.raw), d.raw)) AS kept_sha256
FROM doc d LEFT JOIN lost l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id"""

MARKS_IN_TEXT = r"\### Assistant: </turn> ok"

# A turn is 17 code points of marks, its role, and its text with one more for each backslash and mark inside.
CONVERSATIONS = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '{MARKS_IN_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(17 + length(url_encode(role)) + length(regexp_replace(text, '\\|</?turn', '_\0', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def clusters(clusters: int, rounds: int) -> str:
    """Exact integer centroids: assign and move ``rounds`` times, then assign once more."""
    parts = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
centroid_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, x AS c
  FROM (SELECT sha256('1:' || vec_id) AS h, x FROM kept ORDER BY h LIMIT {clusters}))"""]
    for k in range(rounds + 1):
        parts.append(f"""
place_{k} AS MATERIALIZED (
  SELECT vec_id, x, cluster, distance FROM (
    SELECT vec_id, x, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
    FROM kept, centroid_{k})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if k < rounds:
            parts.append(f"""
sum_{k} AS (
  SELECT cluster, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(x) AS v, unnest(range(1, 65)) AS i FROM place_{k}) GROUP BY cluster, i),
mean_{k} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sum_{k} GROUP BY cluster),
centroid_{k + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, o.c) AS c FROM centroid_{k} o LEFT JOIN mean_{k} m USING (cluster))""")
    return f"""WITH {",".join(parts)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM place_{rounds} JOIN centroid_{rounds} USING (cluster)"""
