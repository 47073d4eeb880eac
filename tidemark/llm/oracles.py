"""DuckDB SQL for the queries that SQL can express, over whole tables."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
tests AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + 9], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM tests),
windows AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM windows JOIN tests USING (size, words)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, i, t.item_id, t.size, t.j FROM windows JOIN
  (SELECT item_id, i AS j, least(10, len(w)) AS size, array_to_string(w[i : i + 9], ' ') AS words FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)) t USING (size, words)),
runs AS (SELECT doc_id, item_id, min(i) - 1 AS longest_at, count(*) - 1 + max(size) AS longest_words
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, size, i - j ORDER BY i) AS run FROM found) GROUP BY doc_id, item_id, size, i - j, run),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY longest_words DESC, longest_at, CAST(item_id AS VARCHAR)) = 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(longest_words, 0) AS longest_words, longest_at, CAST(best.item_id AS VARCHAR) AS longest_item
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN best USING (doc_id)"""

OP5 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS n FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE n > 1),
listed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM listed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * same >= 75 * (p.n + q.n - same)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
components AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN sizes USING (doc_id) JOIN components USING (doc_id)"""

OP12 = r"""
WITH RECURSIVE steps AS (SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(256) r(b)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
named AS (SELECT doc_id, w, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS name FROM runs GROUP BY doc_id, w),
summed AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    flatten(list_transform(string_split(name, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) - 64 AS BIGINT)] END))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM named, steps),
damaged AS (SELECT n, CASE WHEN h % 97 = 0 THEN w[: h % length(w)] || w[h % length(w) + 2 :] ELSE w END AS word FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (SELECT word, n, i, word[: i - 1] AS a, word[i + 1 :] AS b, length(word) AS size FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT x.word, y.word AS other, y.n AS m FROM holes x JOIN holes y ON x.a = y.a AND x.b = y.b AND x.size = y.size AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON x.a || x.b = y.word),
best AS (SELECT word, count(*) AS n_near, arg_min({'form': other, 'm': m}, {'less': -m, 'form': other}) AS b FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.m >= 2 * n THEN b.form END AS form, CASE WHEN b.m >= 2 * n THEN b.m END AS form_n FROM words LEFT JOIN best USING (word)),
way AS (SELECT word, form, 1 AS steps FROM forms WHERE form IS NOT NULL UNION ALL SELECT way.word, forms.form, steps + 1 FROM way JOIN forms ON forms.word = way.form WHERE forms.form IS NOT NULL),
ends AS (SELECT word, arg_max(form, steps) AS root FROM way GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)"""

OP13 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({LOWER.replace("text", "coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w,
  row_number() OVER () AS row FROM documents),
listed AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM listed GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM listed SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
sized AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
of_group AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * CAST(coalesce(n, 0) + 5 AS HUGEINT)) // (coalesce(total, 0) + 5 * v) AS p
  FROM groups JOIN kept USING (lang) JOIN sized USING (lang) LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
of_lang AS (SELECT lang, term, 1 + (1000000000 * CAST(sum(n) + 5 AS HUGEINT)) // ((SELECT sum(n) FROM counts c WHERE c.lang = counts.lang) + 5 * v) AS q
  FROM counts JOIN sized USING (lang) GROUP BY lang, term, v),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM of_group a JOIN of_group b USING (lang, term) WHERE a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM of_group JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""

SQL = {"op13_source_divergence": OP13, "op12_spelling_variants": OP12, "op3_decontamination": OP3, "op5_substring_dedup": OP5, "op8_jaccard_join": OP8}
