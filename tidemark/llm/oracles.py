"""DuckDB SQL for the queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

#: words of each text, 13-word windows by their text, words that a window with an earlier copy covers
ORACLE_SQL["op8_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, k, array_to_string(words[k:k + 12], ' ') AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS k FROM w WHERE len(words) >= 13)
), dup AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY win) AS least FROM win) WHERE doc_id > least
), gone AS (
  SELECT DISTINCT doc_id, k + i AS pos FROM dup, (SELECT unnest(generate_series(0, 12)) AS i)
), word AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, pos)
  GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

#: byte strings as hex digits of the text; spans are runs of uncovered or covered bytes
ORACLE_SQL["op9_suffix_dedup"] = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), part AS (  -- 1,000 starts at a time: cutting short strings out of long ones is slow
  SELECT doc_id, base, substr(h, 2 * base + 1, 2398) AS p
  FROM (SELECT doc_id, h, unnest(generate_series(0, n - 200, 1000)) AS base FROM d WHERE n >= 200)
), s AS (
  SELECT doc_id, base + i AS k, md5_number(substr(p, 2 * i + 1, 400)) AS m
  FROM (SELECT doc_id, base, p, unnest(generate_series(0, length(p) // 2 - 200)) AS i FROM part)
), rep AS (
  SELECT doc_id, k FROM s SEMI JOIN (SELECT m FROM s GROUP BY m HAVING count(*) > 1) USING (m)
), runs AS (
  SELECT doc_id, k, CASE WHEN k <= lag(k) OVER w + 200 THEN 0 ELSE 1 END AS new FROM rep
  WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), spans AS (
  SELECT doc_id, min(k) AS a, max(k) + 200 AS b
  FROM (SELECT doc_id, k, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM runs) GROUP BY doc_id, g
), pieces AS (
  SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a, b), n) AS b
  FROM (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, 0, 0 FROM d) JOIN d USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h, CAST(sum(b - a) AS BIGINT) AS n
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, d.n AS n_bytes, d.n - kept.n AS n_removed, coalesce(x.c, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS c FROM spans GROUP BY doc_id) x USING (doc_id)
"""

#: sets of two-word shingles, links by their sizes, components as what links reach
ORACLE_SQL["op4_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) = 1 THEN words[1] ELSE words[k] || ' ' || words[k + 1] END AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 1, 1))) AS k FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edge AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.other = edge.a
)
SELECT doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

#: all sequences of one to five words of a piece, counted as strings
ORACLE_SQL["op12_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM piece
), total AS (
  SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang
), gram AS (
  SELECT lang, m, unnest(list_transform(generate_series(1, len(words) - m + 1), lambda i: array_to_string(words[i:i + m - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3), (4), (5)) AS s(m) WHERE len(words) >= m
), f AS (
  SELECT lang, phrase, m, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100
), cut AS (
  SELECT lang, phrase, f AS a, m, unnest(generate_series(1, m - 1)) AS k, string_split(phrase, ' ') AS words FROM f WHERE m > 1
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.m, c.k, x.f AS l, y.f AS r, n,
         CAST(1000 AS HUGEINT) * c.a * n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:], ' ') JOIN total t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = b.lang AND q.m > b.m AND 100 * q.f >= 100 * b.a
    AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
