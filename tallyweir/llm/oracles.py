"""Plain SQL for the operators whose rows DuckDB can make in another way: exact counts, and all pairs of windows."""

LINE_SPREAD = r"""
WITH docs AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, text, coalesce(source, chr(0)) AS site, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
plain AS (
  SELECT doc_id, text, site, pos,
         trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}', '0', 'g'), '\s+', ' ', 'g')) AS line FROM lines),
spread AS (
  SELECT line, min(doc_id) AS keeper FROM plain WHERE regexp_matches(line, '[\p{L}\p{Nd}]')
  GROUP BY line HAVING count(DISTINCT site) >= 5),
removed AS (
  SELECT doc_id, text, pos FROM plain JOIN spread USING (line) WHERE doc_id IS DISTINCT FROM keeper
  GROUP BY ALL),
left_over AS (
  SELECT l.doc_id, l.text, string_agg(l.line, chr(10) ORDER BY l.pos) AS kept, count(*) AS n
  FROM (SELECT DISTINCT doc_id, text, pos, line FROM lines) l
  ANTI JOIN removed r ON l.doc_id = r.doc_id AND l.text = r.text AND l.pos = r.pos GROUP BY ALL)
SELECT d.doc_id, CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(d.lines) - coalesce(k.n, 0), 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text
FROM docs d LEFT JOIN left_over k ON d.doc_id = k.doc_id AND d.text = k.text
"""

SPACED_SEEDS = r"""
WITH items AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS item FROM benchmark),
docs AS (
  SELECT doc_id, hash(text) AS h,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS words FROM documents),
-- every pair of a document and an item that share a token triple, with the diagonal on which they do
item_triples AS (
  SELECT DISTINCT item_id, q, item[q] || ' ' || item[q + 1] AS t
  FROM (SELECT item_id, item, unnest(range(1, len(item))) AS q FROM items)),
doc_triples AS (
  SELECT doc_id, h, p, words[p] || ' ' || words[p + 1] AS t
  FROM (SELECT doc_id, h, words, unnest(range(1, len(words))) AS p FROM docs)),
diagonals AS (
  SELECT doc_id, h, item_id, p - q AS d FROM doc_triples JOIN item_triples USING (t)
  GROUP BY ALL HAVING count(*) >= 2),
equal AS (
  SELECT x.doc_id, x.h, x.item_id, d,
         list_transform(range(1, len(item) + 1),
           lambda k: CASE WHEN k + d >= 1 AND words[k + d] = item[k] THEN 1 ELSE 0 END) AS e
  FROM diagonals x JOIN items USING (item_id)
  JOIN docs y ON x.doc_id = y.doc_id AND x.h = y.h),
best AS (
  SELECT doc_id, item_id, least(13, len(e)) AS compared,
         list_max(list_transform(range(0, greatest(len(e) - 13, 0) + 1), lambda s: list_sum(e[s + 1:s + 13]))) AS matched
  FROM equal)
SELECT doc_id, item_id, CAST(max(matched) AS INTEGER) AS matched, CAST(max(compared) AS INTEGER) AS compared
FROM best GROUP BY doc_id, item_id
HAVING max(matched) >= max(compared) - (max(compared) * 2) // 13
"""
