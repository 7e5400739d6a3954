"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = ("list_filter(regexp_split_to_array(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')")

_OP9 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text='text')} AS ws FROM documents),
w AS (SELECT doc_id, i, list_slice(ws, i, i + 12) AS k FROM d, LATERAL (SELECT unnest(range(1, len(ws) - 11)) AS i) t),
m AS (SELECT k, min(doc_id) AS least FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM w JOIN m USING (k), LATERAL (SELECT unnest(range(0, 13)) AS j) t
         WHERE doc_id > least),
p AS (SELECT doc_id, p, ws[p] AS word FROM d, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS p) t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM p ANTI JOIN gone USING (doc_id, p)
         GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=_LOWER.format(text='text'))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [ws]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: list_slice(ws, i, i + 2)) END) AS k FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id
      GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS label FROM documents UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.label) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id
"""

_OP7 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, min(page_id) AS head FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM p LEFT JOIN m ON p.d = m.d
"""

_OP10 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

_OP13 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                            (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
e AS (SELECT *, regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') AS role_out,
             regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS text_out,
             lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM c),
d AS (SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
             string_agg(CASE role WHEN 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text) AS learned,
             CAST(sum(24 + length(role_out) + length(text_out)) AS BIGINT) AS formatted_chars,
             count(*) FILTER (NOT CASE role WHEN 'system' THEN before IS NULL WHEN 'assistant' THEN coalesce(before, '') = 'user'
                              WHEN 'user' THEN coalesce(before, 'system') <> 'user' ELSE false END) AS n_faults,
             arg_max(role, struct_pack(a := turn, b := role, c := text)) = 'assistant' AS answered FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars,
       n_faults, n_faults = 0 AND answered AS complete
FROM d
"""

_TURNS = f"""
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS s FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(struct_pack(r := r, s := s) ORDER BY turn NULLS FIRST, r, sha256(length(r) || ':' || r || s)) AS seq
      FROM t GROUP BY conv_id),
h AS (SELECT *, CAST(xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END),
                4294967295) % 4 AS INTEGER) AS h FROM l),
b AS (SELECT h.conv_id, list_concat(coalesce(list_slice(o.seq, 1, h.h), []), list_slice(h.seq, h.h + 1, len(h.seq))) AS seq
      FROM h LEFT JOIN l o ON o.conv_id = h.conv_id - h.conv_id % 20)"""
_OP11 = f"""
WITH {_TURNS},
m AS (SELECT conv_id, list_slice(seq, 1, d) AS p, d, len(seq) AS n FROM b, LATERAL (SELECT unnest(range(0, len(seq) + 1)) AS d) t),
g AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
      FROM m GROUP BY p, d),
k AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
w AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children,
             CASE WHEN d > 0 THEN (n_convs - 1) * {_WORDS.format(text="g.p[d].s").join(["len(", ")"])} ELSE 0 END AS saved
      FROM g LEFT JOIN k ON k.p = g.p),
u AS (SELECT list_slice(p, 1, a) AS p, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM w, LATERAL (SELECT unnest(range(0, d + 1)) AS a) t GROUP BY 1)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, u.n_leaves,
       CAST(u.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN u ON u.p = w.p LEFT JOIN g up ON w.d > 0 AND up.p = list_slice(w.p, 1, w.d - 1)
"""

_OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT q.vec_id AS anchor_id, c.vec_id, c.label = q.label AS same, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5
"""

SQL: dict[str, str] = {"op3_jaccard_join": _OP3, "op7_warc": _OP7, "op9_substring_dedup": _OP9, "op10_exact_top_k": _OP10,
                       "op11_prefix_trie": _OP11, "op12_hard_negatives": _OP12,
                       "op13_chat_formatting": _OP13}
