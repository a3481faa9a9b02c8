"""DuckDB statements that answer the queries of this folder independently, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n_a, any_value(b.n) AS n_b, count(*) AS both_have
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs WHERE 100 * both_have >= 85 * (n_a + n_b - both_have)
), ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, w.b FROM reached r JOIN ways w ON r.other = w.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reached r ON r.doc_id = s.doc_id
GROUP BY s.doc_id, s.s
"""

ORACLES["op4_quotations"] = r"""
WITH RECURSIVE messages AS (
    SELECT row_number() OVER () AS id, conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), lines AS (
    SELECT id, text, generate_subscripts(l, 1) AS i, unnest(l) AS line
    FROM (SELECT id, text, regexp_split_to_array(text, '\r\n|\r|\n') AS l FROM messages)
), levels AS (
    SELECT id, i, length(regexp_replace(regexp_extract(line, '^([ \t]{0,3}>[> \t]*)', 1), '[^>]', '', 'g')) AS level,
        regexp_replace(line, '^[ \t]{0,3}>[> \t]*', '') AS line
    FROM lines
), changes AS (
    SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY id ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM levels
), runs AS (
    SELECT *, sum(fresh) OVER (PARTITION BY id ORDER BY i) AS run FROM changes
), passages AS (
    SELECT id, run, level, string_agg(line, chr(10) ORDER BY i) AS text, run < max(max(run)) OVER (PARTITION BY id) AS leads
    FROM runs GROUP BY id, run, level
), stripped AS (
    SELECT id, run, regexp_replace(CASE WHEN leads THEN regexp_replace(text,
        '(?i)(?:^|\n)[^\n]*\b(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*$', '') ELSE text END,
        '^\s+|\s+$', '', 'g') AS text
    FROM passages WHERE level = 0
), own AS (
    SELECT m.id, m.conv_id, m.turn, m.role, coalesce(q.quotes, 0) AS n_quotes,
        CASE WHEN q.quotes > 0 THEN coalesce(o.text, '') ELSE m.text END AS text
    FROM messages m
    LEFT JOIN (SELECT id, count(*) FILTER (level > 0) AS quotes FROM passages GROUP BY id) q ON q.id = m.id
    LEFT JOIN (SELECT id, string_agg(text, chr(10) ORDER BY run) AS text FROM stripped WHERE text <> '' GROUP BY id) o ON o.id = m.id
), quoted_texts AS (
    SELECT DISTINCT m.conv_id, m.turn, p.level, p.text, trim(regexp_replace(lower(p.text), '\s+', ' ', 'g')) AS passage
    FROM passages p JOIN messages m ON m.id = p.id WHERE p.level > 0 AND m.conv_id IS NOT NULL AND m.turn IS NOT NULL
), quoted AS (
    SELECT conv_id, turn, passage, min(level) AS level FROM quoted_texts WHERE passage <> '' GROUP BY conv_id, turn, passage
), ways AS (
    SELECT text, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), '[\r\n]+'),
            lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> '') AS units
    FROM (SELECT text FROM quoted_texts UNION SELECT text FROM own)
    UNION
    SELECT text, list_filter(regexp_split_to_array(regexp_replace(
            trim(regexp_replace(lower(text), '\s+', ' ', 'g')), '([.!?]) +', '\1' || chr(10), 'g'), chr(10)), lambda x: x <> '')
    FROM (SELECT text FROM quoted_texts UNION SELECT text FROM own)
), starts AS (
    SELECT DISTINCT w.units[1] AS first, len(w.units) AS length
    FROM ways w JOIN quoted_texts q ON q.text = w.text WHERE q.passage <> '' AND len(w.units) > 0
), stretches AS (
    SELECT u.text, array_to_string(u.units[u.at:u.at + s.length - 1], ' ') AS passage
    FROM (SELECT text, units, generate_subscripts(units, 1) AS at, unnest(units) AS unit FROM ways) u
    JOIN starts s ON s.first = u.unit AND u.at + s.length - 1 <= len(u.units)
), held AS (
    SELECT DISTINCT conv_id, turn, passage FROM (
        SELECT conv_id, turn, trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS passage
        FROM (SELECT conv_id, turn, unnest(list_concat([text], list_concat(
            regexp_split_to_array(text, '\n[ \t]*\n'), regexp_split_to_array(text, '\n')))) AS part FROM own)
        UNION ALL SELECT o.conv_id, o.turn, r.passage FROM own o JOIN stretches r ON r.text = o.text)
    WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND passage IN (SELECT passage FROM quoted)
), hits AS (
    SELECT q.conv_id, q.turn, q.level, max(h.turn) AS reply_turn
    FROM quoted q JOIN held h ON h.passage = q.passage AND h.conv_id = q.conv_id AND h.turn < q.turn
    GROUP BY q.conv_id, q.turn, q.level
), inside AS (
    SELECT conv_id, turn, arg_min(reply_turn, level) AS reply_turn, conv_id AS reply_conv FROM hits GROUP BY conv_id, turn
), outside AS (
    SELECT q.conv_id, q.turn, min({'level': q.level, 'conv_id': h.conv_id, 'turn': h.turn}) AS o
    FROM quoted q JOIN held h ON h.passage = q.passage AND h.conv_id <> q.conv_id
    WHERE (q.conv_id, q.turn) NOT IN (SELECT (conv_id, turn) FROM inside)
    GROUP BY q.conv_id, q.turn
), links AS (
    SELECT conv_id, turn, reply_turn, reply_conv FROM inside
    UNION ALL SELECT conv_id, turn, o.turn, o.conv_id FROM outside
), chains AS (
    SELECT conv_id, turn, reply_turn AS goal, 1 AS depth FROM inside
    UNION ALL
    SELECT c.conv_id, c.turn, i.reply_turn, c.depth + 1 FROM chains c JOIN inside i ON i.conv_id = c.conv_id AND i.turn = c.goal
), roots AS (
    SELECT conv_id, turn, min(goal) AS thread_turn, max(depth) AS depth FROM chains GROUP BY conv_id, turn
)
SELECT o.conv_id, o.turn, o.role, o.text, o.n_quotes, l.reply_conv, l.reply_turn,
    coalesce(r.thread_turn, o.turn) AS thread_turn, CAST(coalesce(r.depth, 0) AS BIGINT) AS depth,
    '<|im_start|>' || replace(coalesce(o.role, ''), '<|', '< |') || chr(10) || replace(o.text, '<|', '< |') || '<|im_end|>' AS chat
FROM own o
LEFT JOIN links l ON l.conv_id = o.conv_id AND l.turn = o.turn
LEFT JOIN roots r ON r.conv_id = o.conv_id AND r.turn = o.turn
"""

ORACLES["op5_embeddings"] = r"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), classes AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), counts AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM classes c LEFT JOIN counts n ON n.a = c.vec_id
"""

ORACLES["op13_ranked_search"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), wanted AS (
  SELECT item_id, term, count(*) AS often FROM asked GROUP BY ALL
), totals AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM words
), postings AS (
  SELECT row_id, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM words)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, n_docs
), gains AS (
  SELECT row_id, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS gain
  FROM postings JOIN weights USING (term), totals
), scored AS (
  SELECT item_id, row_id, doc_id, sum(often * gain)::BIGINT AS score
  FROM wanted JOIN gains USING (term) GROUP BY item_id, row_id, doc_id HAVING sum(often * gain) > 0
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored)
WHERE rank <= 20
"""
