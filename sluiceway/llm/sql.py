"""SQL (DuckDB) of the training-data queries whose results are exact functions of the texts."""

from __future__ import annotations

#: Words as letter runs; CRC-32 over UTF-8 bytes from a table made by its rule; pairs one edit apart share a word
#: with one letter less (replaced: at the same place).
OP12 = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
  SELECT doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs WHERE length(run) >= 7 GROUP BY 1, 2
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END))),
    lambda s, b: xor(tab[1 + (xor(s, b) & 255)], s >> 8))) AS h
  FROM lowered, crc
), cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2
), shorter AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS m FROM pairs GROUP BY 1
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n,
    CASE WHEN b.m >= 10 * w.n THEN (SELECT min(p.near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.m) END AS form
  FROM words w LEFT JOIN best b USING (word)
), steps AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT s.word, s.root FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r USING (word)
"""

#: Depths along needs tell circles: seven identifiers have no longer path than six steps.
OP7 = """
WITH RECURSIVE rows AS (
  SELECT conv_id, turn, text AS content, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, role IN ('user', 'system') AS is_call
  FROM conversations WHERE role IS NOT NULL
), shaped AS (
  SELECT conv_id, turn, content, text, n, is_call, CASE WHEN is_call AND n % 11 = 0 THEN NULL ELSE 'c' || (n % 7) END AS id,
    CASE WHEN is_call AND n % 3 <> 0 THEN 'c' || (n // 7 % 7) END AS need,
    CASE WHEN n % 5 = 4 THEN 'other' WHEN n % 2 = 0 THEN 'reply' ELSE 'follow' END AS name, n // 5 % 6 AS form
  FROM rows
), ends AS (
  SELECT conv_id, id, min(turn) FILTER (WHERE is_call) AS call_turn, min(turn) FILTER (WHERE NOT is_call) AS result_turn
  FROM shaped WHERE id IS NOT NULL GROUP BY ALL
), needs AS (
  SELECT DISTINCT s.conv_id, s.id, s.need FROM shaped s
  JOIN ends e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.id = s.need AND e.call_turn IS NOT NULL
  WHERE s.is_call AND s.id IS NOT NULL
), walk AS (
  SELECT DISTINCT conv_id, id, id AS at, 0 AS depth FROM shaped WHERE is_call AND id IS NOT NULL
  UNION SELECT w.conv_id, w.id, n.need, w.depth + 1 FROM walk w JOIN needs n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.id = w.at WHERE w.depth < 7
), layers AS (
  SELECT conv_id, id, CASE WHEN max(depth) < 7 THEN max(depth) END AS layer FROM walk GROUP BY ALL
), joined AS (
  SELECT s.*, e.call_turn, e.result_turn, l.layer FROM shaped s
  LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.id = s.id
  LEFT JOIN layers l ON l.conv_id IS NOT DISTINCT FROM s.conv_id AND l.id = s.id AND s.is_call
)
SELECT conv_id, turn, CASE WHEN is_call THEN 'call' ELSE 'result' END AS kind, id,
  CASE WHEN is_call AND call_turn <> turn OR NOT is_call AND result_turn <> turn THEN 'repeated'
       WHEN call_turn IS NOT NULL AND result_turn IS NOT NULL THEN 'linked' WHEN is_call THEN 'pending' ELSE 'orphan' END AS status,
  CASE WHEN NOT is_call THEN NULL WHEN form = 3 THEN 'malformed' WHEN name = 'other' THEN 'unknown_tool'
       WHEN form = 4 OR form = 1 THEN 'missing'
       WHEN form IN (2, 5) THEN 'mistyped' ELSE 'valid' END AS validity,
  layer, CASE WHEN NOT is_call AND call_turn IS NOT NULL THEN call_turn ELSE turn END AS anchor,
  (NOT is_call AND call_turn IS NOT NULL)::INTEGER AS step,
  CASE WHEN is_call THEN '{"arguments":' || CASE form WHEN 0 THEN '{"text":' || to_json(text)::VARCHAR || ',"turn":' || turn || '}'
         WHEN 1 THEN '{"turn":' || turn || '}' WHEN 2 THEN '{"text":' || n || ',"turn":' || turn || '}' WHEN 3 THEN 'null' WHEN 4 THEN '{}'
         ELSE '{"extra":' || n || ',"text":' || to_json(text)::VARCHAR || ',"turn":' || turn || '}' END
         || ',"id":' || coalesce('"' || id || '"', 'null') || ',"name":"' || name || '"}'
       ELSE '{"content":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"role":"tool","tool_call_id":"' || id || '"}' END AS json
FROM joined
"""

#: Pairs that share a shingle, links by full sets, and everything reachable over links.
OP8 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
    WHEN len(words) >= 1 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), reached AS (
  SELECT x AS doc_id, x AS other FROM links UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN components USING (doc_id)
"""

#: Passages of 50 words named by digests of 2, 4, 8, 16 and 32 words; a missing id is the least of all, as one document.
OP6 = r"""
WITH docs AS (
  SELECT *, row_number() OVER () AS key FROM (SELECT DISTINCT coalesce(doc_id, -9223372036854775808)::BIGINT AS id, coalesce(text, '') AS text FROM documents)
), words AS (
  SELECT id, key, unnest(w) AS word, unnest(range(len(w))) AS place
  FROM (SELECT id, key, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM docs)
), w2 AS (
  SELECT id, key, place, md5(word || ' ' || lead(word) OVER o) AS h2 FROM words WINDOW o AS (PARTITION BY key ORDER BY place)
), w4 AS (
  SELECT *, md5(h2 || lead(h2, 2) OVER o) AS h4 FROM w2 WINDOW o AS (PARTITION BY key ORDER BY place)
), w8 AS (
  SELECT *, md5(h4 || lead(h4, 4) OVER o) AS h8 FROM w4 WINDOW o AS (PARTITION BY key ORDER BY place)
), w16 AS (
  SELECT *, md5(h8 || lead(h8, 8) OVER o) AS h16 FROM w8 WINDOW o AS (PARTITION BY key ORDER BY place)
), w32 AS (
  SELECT *, md5(h16 || lead(h16, 16) OVER o) AS h32 FROM w16 WINDOW o AS (PARTITION BY key ORDER BY place)
), passages AS (
  SELECT id, key, place, md5(h32 || lead(h16, 32) OVER o || lead(h2, 48) OVER o) AS h FROM w32 WINDOW o AS (PARTITION BY key ORDER BY place)
), held AS (
  SELECT h, min(id) AS least FROM passages WHERE h IS NOT NULL GROUP BY h HAVING min(id) < max(id)
), found AS (
  SELECT id, key, place, id = least AS first FROM passages JOIN held USING (h)
), cut AS (
  SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY key, first ORDER BY place) <= 50 THEN 0 ELSE 1 END AS opens FROM found
), islands AS (
  SELECT *, sum(opens) OVER (PARTITION BY key, first ORDER BY place) AS island FROM cut
)
SELECT nullif(id, -9223372036854775808) AS doc_id, min(place) AS start_word, max(place) + 50 AS end_word, first AS first_holder
FROM islands GROUP BY id, key, first, island
"""

ORACLES = {"op6_repeated_passages": OP6, "op7_tool_calls": OP7, "op8_near_dups": OP8, "op12_spelling_variants": OP12}
