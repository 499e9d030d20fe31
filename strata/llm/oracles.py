"""DuckDB SQL of the queries that SQL can express, from their definitions."""

from __future__ import annotations

import string

from strata.llm.merkle import FIELDS

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

DECONTAM = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0) x, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) y),
doc_windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM item_windows) x, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) y),
hits AS (SELECT doc_id, i, n, CAST(item_id AS VARCHAR) AS item FROM doc_windows JOIN item_windows USING (n, s)),
words_hit AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) x GROUP BY 1),
items_hit AS (SELECT doc_id, COUNT(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)"""

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, least(5, len(w)) AS n FROM d WHERE len(w) > 0) x, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) y),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY 1),
links AS (SELECT x.a, x.b FROM (SELECT l.doc_id AS a, r.doc_id AS b, COUNT(*) AS common FROM sets l JOIN sets r USING (s)
                                WHERE l.doc_id <> r.doc_id GROUP BY 1, 2) x
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common >= 75 * (p.n + q.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY 1) c USING (doc_id)"""


EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (SELECT doc_id, norm, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, COUNT(*) OVER (PARTITION BY norm) AS group_size
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g"""



def _leaf(text: str) -> str:
    fields = [(text if f == "text" else f"CAST({f} AS VARCHAR)") for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in fields) + ")"


#: CRC-32 bit by bit: a list of the bytes, each followed by eight shifts (-1).
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten([[CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
    FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

# Nodes (t, l, i): tree, level, place. A group's tree is its number, the tree over the subroots is -1.
# Steps of a leaf: in its own tree, then in the top tree; the siblings are the other nodes of a run of 8.
MERKLE = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_leaf("text")} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(_LOWER.replace("coalesce(text, '')", "text"))}
    ELSE {_leaf("text")} END AS shown, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, lang FROM documents),
leaves AS (SELECT doc_id, leaf, shown, t, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    COUNT(*) OVER (PARTITION BY t) AS n FROM d),
tree AS (SELECT t, 0 AS l, i, n, leaf AS digest FROM leaves
  UNION ALL SELECT t, l + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY t, l, i // 8),
subroots AS (SELECT t, digest FROM tree WHERE n = 1),
top AS (SELECT -1 AS t, 0 AS l, t AS i, COUNT(*) OVER () AS n, digest FROM subroots
  UNION ALL SELECT t, l + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY t, l, i // 8),
nodes AS (SELECT * FROM tree WHERE n > 1 UNION ALL SELECT * FROM top WHERE n > 1),
steps AS (SELECT x.t, x.l, x.i, coalesce(string_agg(y.digest, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS a,
    coalesce(string_agg(y.digest, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS b
  FROM nodes x JOIN nodes y ON x.t = y.t AND x.l = y.l AND x.i // 8 = y.i // 8 GROUP BY 1, 2, 3),
paths AS (SELECT leaves.t, leaves.i, s.l AS o, s.a, s.b FROM leaves JOIN steps s ON s.t = leaves.t AND s.i = leaves.i // CAST(8 ** s.l AS BIGINT)
  UNION ALL SELECT leaves.t, leaves.i, 1000 + s.l, s.a, s.b FROM leaves JOIN steps s ON s.t = -1 AND s.i = leaves.t // CAST(8 ** s.l AS BIGINT)),
proofs AS (SELECT t, i, string_agg(a || b, '' ORDER BY o) AS proof, list({{'a': a, 'b': b}} ORDER BY o) AS way FROM paths GROUP BY 1, 2),
folds AS (SELECT doc_id, leaf, leaves.t, sha256(coalesce(proof, '')) AS proof_sha256, list_reduce(list_concat([{{'a': shown, 'b': ''}}], coalesce(way, [])),
    lambda x, s: {{'a': sha256(s.a || x.a || s.b), 'b': ''}}).a AS folded_root FROM leaves LEFT JOIN proofs USING (t, i))
SELECT doc_id, leaf, s.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root, proof_sha256, folded_root,
  folded_root = (SELECT digest FROM top WHERE n = 1) AS verified FROM folds JOIN subroots s USING (t)"""

_BASE32 = string.ascii_uppercase + "234567"

# five hexadecimal digits make up four of base32
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, payload, sha1(payload) AS h, MIN(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string([substr('{_BASE32}', 1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)
                   FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM d"""
