"""The operators that SQL can express, over the same tables."""

OP6 = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP3 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE (SELECT bool_and(coalesce(isfinite(x), false)) AND bool_or(x <> 0) FROM unnest(embedding) t(x))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT m.vec_id, (SELECT count(*) FROM links l WHERE l.a = m.vec_id) AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = m.vec_id
"""

OP7 = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)) + len(regexp_extract_all(text,
    '[<\[]\\*(?:s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|endoftext\|>|\|im_start\|>|\|im_end\|>)')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

#: Anchors against all rows; whole numbers of this size are exact in doubles.
OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND (SELECT bool_and(coalesce(isfinite(x), false)) FROM unnest(embedding) t(x))),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 3
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM words, range(1, 5) t(k)),
c AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY 1),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND f >= 30),
parts AS MATERIALIZED (
  SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS head, array_to_string(w[cut + 1 :], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)),
heads AS MATERIALIZED (SELECT p.*, x.f AS l FROM parts p LEFT JOIN c x ON x.lang = p.lang AND x.phrase = p.head),
cuts AS (
  SELECT p.lang, p.phrase, a, cut, l, y.f AS r, ((2000000::HUGEINT * a) // (l + y.f))::BIGINT AS score
  FROM heads p LEFT JOIN c y ON y.lang = p.lang AND y.phrase = p.tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + z - 1], ' ') AS phrase, max(a) AS outside
  FROM cand, range(2, 4) s(z), range(1, 4) t(i) WHERE z < k AND i + z - 1 <= k GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best JOIN total USING (lang) LEFT JOIN inside USING (lang, phrase)
WHERE outside IS NULL OR 100 * outside < 80 * a
QUALIFY rank <= 2000
"""

SQL = {"op11_hard_negatives": OP11, "op12_phrases": OP12, "op3_embedding_dedup": OP3, "op6_exact_dedup": OP6, "op7_chat_format": OP7}
