"""SQL twins of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

#: Tool calls of plain conversations, their chains by recursion.
TOOL_CALLS = """
WITH RECURSIVE
calls AS (
    SELECT conv_id, 'c' || turn AS call_id, 'c' || (turn - 2) AS after, min(turn) AS call_position,
           min(text) AS text, count(*) AS n_calls
    FROM conversations WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
results AS (
    SELECT conv_id, 'c' || (turn - 1) AS call_id, min(turn) AS result_position, min(text) AS content, count(*) AS n_results
    FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
chains AS (
    SELECT conv_id, call_id, 0 AS depth FROM calls c
    WHERE NOT EXISTS (FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
    UNION ALL
    SELECT c.conv_id, c.call_id, p.depth + 1 FROM calls c JOIN chains p ON c.conv_id = p.conv_id AND c.after = p.call_id)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       CAST(h.depth AS BIGINT) AS depth, CAST(call_position AS BIGINT) AS call_position, CAST(result_position AS BIGINT) AS result_position,
       coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
       c.call_id IS NOT NULL AND c.text IS NOT NULL AS valid,
       CASE WHEN c.call_id IS NOT NULL AND c.text IS NULL THEN 'missing message' ELSE '' END AS errors,
       '{"call":' || CASE WHEN c.call_id IS NULL THEN 'null' ELSE
           '{"arguments":{' || CASE WHEN c.text IS NULL THEN '' ELSE '"message":' || to_json(c.text)::VARCHAR || ',' END
           || '"turn":' || call_position || '},"name":"reply"}' END
       || ',"id":' || to_json(coalesce(c.call_id, r.call_id))::VARCHAR
       || ',"result":' || coalesce(to_json(r.content)::VARCHAR, 'null') || '}' AS canonical
FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
LEFT JOIN chains h ON h.conv_id = c.conv_id AND h.call_id = c.call_id
UNION ALL
SELECT conv_id, 'c' || turn, 'unidentified', NULL, CAST(turn AS BIGINT), NULL, 1, 0, text IS NOT NULL AND turn IS NOT NULL,
       array_to_string(list_filter([CASE WHEN text IS NULL THEN 'missing message' END, CASE WHEN turn IS NULL THEN 'missing turn' END], lambda x: x IS NOT NULL), '; '),
       '{"call":{"arguments":{' || array_to_string(list_filter(['"message":' || to_json(text)::VARCHAR, '"turn":' || turn], lambda x: x IS NOT NULL), ',') || '},"name":"reply"},"id":'
       || coalesce('"c' || turn || '"', 'null') || ',"result":null}'
FROM conversations WHERE role = 'user' AND (conv_id IS NULL OR turn IS NULL)
UNION ALL
SELECT conv_id, 'c' || (turn - 1), 'unidentified', NULL, NULL, CAST(turn AS BIGINT), 0, 1, false, '',
       '{"call":null,"id":' || coalesce('"c' || (turn - 1) || '"', 'null') || ',"result":' || coalesce(to_json(text)::VARCHAR, 'null') || '}'
FROM conversations WHERE role = 'assistant' AND (conv_id IS NULL OR turn IS NULL)
UNION ALL
SELECT conv_id, NULL, 'context', NULL, CAST(turn AS BIGINT), NULL, 0, 0, true, '',
       '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"position":' || coalesce(turn::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""

#: Classes of documents whose 3-word shingle sets overlap by nine tenths of their union, by comparing all that share one.
NGRAM_JOIN = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS ss FROM w),
n AS (SELECT doc_id, len(ss) AS n FROM s),
x AS (SELECT doc_id, unnest(ss) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * shared >= 90 * (u.n + v.n - shared)),
r AS (SELECT doc_id, doc_id AS hit FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.hit = e.a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, min(hit) AS component_id, (SELECT count(*) FROM e WHERE e.a = doc_id) AS n_links FROM n JOIN r USING (doc_id) GROUP BY doc_id, n
"""
