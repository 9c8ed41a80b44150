"""DuckDB SQL of the queries that SQL can express. The others are held against brute force in tests/llm."""

from __future__ import annotations

from . import chat, licenses, sharding
from .permutation import permuted_sql

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"[^\x20\x09-\x0D]+"

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) t(i)),
sized AS (SELECT *, len(regexp_extract_all(text, '{SPACED}')) + {chat.OVERHEAD} AS tokens FROM turns),
placed AS (SELECT *, CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) - tokens AS BIGINT) AS start FROM sized),
lead AS (SELECT conv_id, min(start) AS at, arg_min(tokens, start) AS tokens FROM placed WHERE role = 'system' GROUP BY conv_id),
sizes AS (SELECT p.conv_id, max(p.tokens) AS most, max(CASE WHEN l.tokens <= least({chat.SYSTEM}, {chat.BUDGET // 2}) THEN l.tokens ELSE 0 END) AS kept
  FROM placed p LEFT JOIN lead l ON p.conv_id = l.conv_id GROUP BY p.conv_id),
rooms AS (SELECT *, greatest({chat.BUDGET - chat.HISTORY} - kept, ({chat.BUDGET} - kept) // 2) AS room FROM sizes),
rows AS (SELECT p.*, kept, start // (room - least(most, room // 2)) AS bucket, tokens > room // 2 AS long,
  12 + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11 AS chars FROM placed p JOIN rooms USING (conv_id)),
spans AS (SELECT conv_id, bucket, long, min(start) AS first, CAST(sum(tokens) AS BIGINT) AS total,
  CASE WHEN sum(tokens) + max(kept) <= {chat.BUDGET} THEN max(kept) ELSE 0 END AS kept FROM rows GROUP BY ALL),
parts AS (
  SELECT conv_id, chars FROM rows
  UNION ALL SELECT r.conv_id, r.chars FROM rows r JOIN spans s ON r.conv_id = s.conv_id AND r.start < s.first
      AND s.first - r.start <= least({chat.HISTORY}, {chat.BUDGET} - s.total - s.kept)
    LEFT JOIN lead l ON r.conv_id = l.conv_id WHERE l.at IS NULL OR r.start <> l.at
  UNION ALL SELECT s.conv_id, r.chars FROM spans s JOIN lead l ON s.conv_id = l.conv_id JOIN rows r ON r.conv_id = l.conv_id AND r.start = l.at
    WHERE l.at < s.first AND s.kept > 0),
total AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM parts GROUP BY conv_id),
own AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY start) AS turns,
  coalesce(string_agg(text, '' ORDER BY start) FILTER (WHERE role = 'assistant'), '') AS loss FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM own JOIN total USING (conv_id)"""

TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score FROM v q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5"""

NEAR = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
groups AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM groups LEFT JOIN sizes USING (doc_id)"""


def license_sql() -> str:
    phrases = ", ".join(f"([{', '.join(repr(w) for w in p.split())}], '{label}')" for p, label in licenses.PHRASES.items())
    sets = [(i, label, sorted(set(t.split())), n.split(), licenses.block_step(t)) for i, (label, t, n) in enumerate(licenses.TEMPLATES)]
    templates = ", ".join(f"({i}, '{label}', '{w}', {len(s)}, {licenses._needed(len(s), licenses.THRESHOLD)}, {int(w in n)}, {len(n)}, {step})"
                          for i, label, s, n, step in sets for w in s)
    return rf"""
WITH words AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases(p, label) AS (VALUES {phrases}),
places AS (SELECT doc_id, label, unnest([i - 1 FOR i IN range(1, len(w) - len(p) + 2) IF w[i:i + len(p) - 1] = p]) AS spot FROM words, phrases),
base AS (SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word FROM places GROUP BY doc_id),
tokens AS (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS p FROM words),
templates(id, label, w, m, o, named, names, step) AS (VALUES {templates}),
hits AS (SELECT DISTINCT doc_id, id, label, w, m, o, named, names, unnest(CASE WHEN p >= step THEN [p // step, p // step - 1] ELSE [p // step] END) AS block FROM tokens JOIN templates USING (w)),
met AS (SELECT doc_id, label, count(*) / any_value(m) AS share FROM hits GROUP BY doc_id, id, label, block HAVING count(*) >= any_value(o) AND sum(named) = any_value(names)),
every AS (SELECT doc_id, label, 'base' AS kind FROM places UNION SELECT doc_id, label, 'method' FROM met),
named AS (SELECT doc_id, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE kind = 'base'), '') AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM every GROUP BY doc_id),
best AS (SELECT doc_id, max(share) AS share FROM met GROUP BY doc_id)
SELECT doc_id, len(words.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)"""


def shard_sql() -> str:
    # the checksum's table: eight shifts of each byte, the reversed polynomial where a 1 falls out
    shift = "list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)"
    return f"""
WITH steps AS MATERIALIZED (SELECT [{shift} FOR i IN range(256)] AS t),
bodies AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (SELECT doc_id, length(h) // 2 + 8 AS size, xor(list_reduce([('0x' || x)::BIGINT FOR x IN regexp_extract_all(h, '..')],
  lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM bodies, steps),
rows_ AS (SELECT *, row_number() OVER (ORDER BY doc_id, text_crc32, size) - 1 AS row_no FROM sums),
one AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a, CAST(ceil(count(*) / ceil(sqrt(count(*)))) AS BIGINT) AS b FROM documents),
{permuted_sql("one", "rows_", sharding.SEED)}
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(slot % {sharding.SHARDS} AS INTEGER) AS shard, slot // {sharding.SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM slots"""


MIDDLE = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('7:', CAST(doc_id AS VARCHAR))) AS h FROM documents),
units AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
  [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS r FROM texts),
cuts AS (SELECT *, len(u) AS n, least(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS x, greatest(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS y FROM units),
pieces AS (SELECT *, array_to_string(u[1:x], '') AS p, array_to_string(u[x + 1:y], '') AS m, array_to_string(u[y + 1:n], '') AS s,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
    WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM pieces"""

NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.v, v.v) AS BIGINT) AS score FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS r, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 10"""


ORACLE = {"op1_chat": CHAT, "op2_top_products": TOP, "op3_near_dedup": NEAR, "op4_licenses": license_sql(), "op6_sharding": shard_sql(),
          "op11_fill_middle": MIDDLE, "op12_hard_negatives": NEGATIVES}
