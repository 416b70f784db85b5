"""SQL counterparts of the package's queries, for an independent engine."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    """Runs of 0-9, a-z and characters beyond ASCII, A-Z lower-cased."""
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


#: CRC-32, byte by byte through its table of 256 entries.
_CRC_TABLE = """
entries AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
  FROM range(256) r(i)),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM entries)"""


def _crc(text: str) -> str:
    """The CRC-32 of a text, where ``crc_table`` is joined."""
    return f"""xor(list_reduce(
      list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""


_CRC = f"""{_CRC_TABLE},
summed AS (
  SELECT d.*, {_crc("coalesce(text, '')")} AS text_crc32
  FROM documents d, crc_table)"""

_SHARDING = f"""
WITH {_CRC},
drawn AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, text_crc32,
    CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS stratum,
    ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS draw
  FROM summed),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY draw, doc_id, text_crc32) - 0.5::DOUBLE)
            / count(*) OVER (PARTITION BY stratum) AS fraction FROM drawn),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, draw, doc_id, text_crc32) - 1 AS r, count(*) OVER () AS n
  FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (r * 16 // n)::INTEGER AS shard,
  (r - ((r * 16 // n) * n + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed"""

_DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, {_words('text')} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT item, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0))),
docs AS (SELECT doc_id, {_words('text')} AS w FROM documents),
windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM phrases) WHERE len(w) >= k)),
found AS (SELECT doc_id, i, k, item FROM windows JOIN phrases USING (k, phrase)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS word FROM found) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

#: The smallest node reachable by links, from a table ``links(a, b)`` that holds both directions.
_REACH = """
reach AS (
  SELECT DISTINCT a AS node, a AS other FROM links
  UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other),
least_node AS (SELECT node, min(other) AS top FROM reach GROUP BY 1),
degree AS (SELECT a AS node, count(*) AS n FROM links GROUP BY 1)"""

_JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words('text')} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE common::DOUBLE / (x.n + y.n - common) >= 0.8::DOUBLE),{_REACH}
SELECT doc_id, coalesce(top, doc_id) AS class_id, coalesce(n, 0)::BIGINT AS n_links
FROM docs LEFT JOIN least_node l ON l.node = doc_id LEFT JOIN degree d ON d.node = doc_id"""

_VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x, usable y
  WHERE x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95::DOUBLE),{_REACH}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(top, vec_id) AS component_id, coalesce(top, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least_node l ON l.node = vec_id LEFT JOIN degree d ON d.node = vec_id"""

_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Cheapest edits from the first message on: per message and state the least (cost, audit); 0 is the
#: start, 1 after system, 2 after user, 3 after assistant.
_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE},
kinds AS (
  SELECT coalesce(conv_id::VARCHAR, 'none') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc_table),
hurt AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds),
placed AS (
  SELECT *, rtrim(text, {_SPACES}) AS e, left(role, 1) AS c,
    row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS i,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS r
  FROM hurt),
judged AS (
  SELECT *, e = '' AS is_blank, e <> '' AND r > 1 AS is_duplicate,
    e <> '' AND r = 1 AND right(e, 1) NOT IN ('.', '!', '?') AS is_truncated,
    lag(c) OVER (PARTITION BY conv ORDER BY i) || c AS pair
  FROM placed),
counts AS (
  SELECT conv, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_duplicate) AS duplicate,
    count(*) FILTER (is_truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY 1),
edits(letter, was, c, now, price) AS (
  VALUES ('K', 0, 's', 1, 0), ('K', 0, 'u', 2, 0), ('K', 1, 'u', 2, 0), ('K', 2, 'a', 3, 0), ('K', 3, 'u', 2, 0),
    ('R', 0, NULL, 2, 1), ('R', 1, NULL, 2, 1), ('R', 2, NULL, 3, 1), ('R', 3, NULL, 2, 1),
    ('D', 0, NULL, 0, 2), ('D', 1, NULL, 1, 2), ('D', 2, NULL, 2, 2), ('D', 3, NULL, 3, 2)),
inserts(was, now, letters, price) AS (
  VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 5), (0, 3, 'II', 10), (1, 2, 'I', 5),
    (1, 3, 'II', 10), (2, 3, 'I', 5), (3, 2, 'I', 5)),
steps AS (
  SELECT conv, 0::BIGINT AS i, now AS state, price AS cost, letters AS audit FROM counts, inserts WHERE was = 0
  UNION ALL
  SELECT conv, i, state, best.cost, best.audit
  FROM (
    SELECT s.conv, j.i, n.now AS state, min({{'cost': s.cost + d.price + n.price
        + CASE WHEN j.is_truncated AND d.letter <> 'D' THEN 5 ELSE 0 END, 'audit': s.audit || d.letter || n.letters}}) AS best
    FROM steps s JOIN judged j ON j.conv = s.conv AND j.i = s.i + 1
      JOIN edits d ON d.was = s.state AND (d.c IS NULL OR d.c = j.c) AND (d.letter = 'D' OR NOT (j.is_blank OR j.is_duplicate))
      JOIN inserts n ON n.was = d.now
    GROUP BY 1, 2, 3)),
chosen AS (
  SELECT conv, best.cost AS cost, best.audit AS audit
  FROM (SELECT s.conv, min({{'cost': s.cost, 'audit': s.audit}}) AS best
        FROM steps s JOIN counts c ON c.conv = s.conv AND c.n = s.i WHERE state IN (0, 3) GROUP BY 1)),
spelled AS (
  SELECT conv, p, audit[p] AS letter FROM (SELECT conv, audit, unnest(range(1, length(audit) + 1)) AS p FROM chosen)),
numbered AS (
  SELECT *, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w AS line FROM spelled
  WINDOW w AS (PARTITION BY conv ORDER BY p)),
lines AS (
  SELECT n.conv, p, line, letter, j.role, j.text,
    max((line = 1 AND letter = 'K' AND j.c = 's')::INT) OVER (PARTITION BY n.conv) AS offset_by
  FROM numbered n LEFT JOIN judged j ON j.conv = n.conv AND j.i = n.i AND letter <> 'I' WHERE letter <> 'D'),
written AS (
  SELECT conv, string_agg(CASE WHEN letter = 'K' THEN role WHEN (line - coalesce(offset_by, 0)) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole
  FROM lines GROUP BY 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'none') AS conv FROM conversations) o
LEFT JOIN counts USING (conv) LEFT JOIN chosen USING (conv) LEFT JOIN written USING (conv)"""

#: For pages as the given tables hold them: one article each, of headings, paragraphs, breaks and bold text.
_PAGES = r"""
WITH articles AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS inner_html FROM pages),
plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(inner_html, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS raw FROM articles),
decoded AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(replace(raw, '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'),
    '&gt;', '>'), '&amp;?', '&', 'g') AS raw FROM plain),
texts AS (SELECT page_id, url, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS text FROM decoded)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts"""


ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": _JACCARD,
    "op2_sharding": _SHARDING,
    "op4_decontamination": _DECONTAMINATION,
    "op9_vectors": _VECTORS,
    "op11_hard_negatives": _NEGATIVES,
    "op12_conversation_repair": _REPAIR,
    "op13_page_text": _PAGES,
}
