"""SQL twins of the queries that SQL can express, for DuckDB over whole tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORD = r"[^\x20\x09-\x0D]+"

OP5 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
it AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("text")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws
       FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
pat AS (SELECT DISTINCT item, m, array_to_string(ws[i:i + m - 1], ' ') AS g
        FROM (SELECT item, ws, least(13, len(ws)) AS m, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM it WHERE len(ws) > 0) x),
sizes AS (SELECT DISTINCT m FROM pat),
win AS (SELECT r, m, i, array_to_string(ws[i:i + m - 1], ' ') AS g
        FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d CROSS JOIN sizes WHERE len(ws) >= m) x),
hits AS (SELECT r, i, win.m, item FROM win JOIN pat ON win.g = pat.g AND win.m = pat.m),
covered AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, unnest(range(0, m)) AS k FROM hits) x GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""

OP7 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACE_WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM d WHERE len(ws) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c ON c.doc_id = d.doc_id"""

OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}') AS ws FROM documents),
three AS (SELECT r, i, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) > 2) x),
often AS (SELECT r, g FROM three GROUP BY r, g HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT three.r, i, unnest([0, 1, 2]) AS k FROM three JOIN often ON three.r = often.r AND three.g = often.g) x GROUP BY r),
raw AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM raw WHERE regexp_matches(line, '{_SPACE_WORD}') GROUP BY r),
key AS (SELECT min(r) AS k, source, t FROM d WHERE len(ws) > 0 GROUP BY source, t),
line AS (SELECT k, source, array_to_string(regexp_extract_all({_LOWER.format("line")}, '{_SPACE_WORD}'), ' ') AS norm,
                len(regexp_extract_all(line, '{_SPACE_WORD}')) AS n FROM key JOIN raw ON raw.r = key.k),
found AS (SELECT source, norm, count(DISTINCT k) AS c FROM line WHERE n > 0 GROUP BY source, norm),
frequent AS (SELECT source, norm FROM found WHERE c > 20),
gone AS (SELECT k, sum(n) AS n FROM line JOIN frequent ON line.norm = frequent.norm AND line.source IS NOT DISTINCT FROM frequent.source GROUP BY k),
sums AS (SELECT d.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, source, t
         FROM d LEFT JOIN dup ON dup.r = d.r LEFT JOIN rep ON rep.r = d.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - coalesce(gone.n, 0)) >= 30 * n_words AS kept,
       CAST(n_words - coalesce(gone.n, 0) AS BIGINT) AS left_words
FROM sums LEFT JOIN key ON key.source IS NOT DISTINCT FROM sums.source AND key.t = sums.t LEFT JOIN gone ON gone.k = key.k"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
p AS (SELECT lang, r, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
      FROM (SELECT lang, r, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d) x),
tok AS (SELECT lang, p, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM p),
three AS (SELECT lang, w AS a, lead(w) OVER q AS b, lead(w, 2) OVER q AS c FROM tok WINDOW q AS (PARTITION BY p ORDER BY i)),
f1 AS (SELECT lang, a, CAST(count(*) AS HUGEINT) AS f FROM three GROUP BY ALL),
f2 AS (SELECT lang, a, b, CAST(count(*) AS HUGEINT) AS f FROM three WHERE b IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, a, b, c, CAST(count(*) AS HUGEINT) AS f FROM three WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cut AS (SELECT x.lang, x.a || ' ' || x.b AS phrase, 1 AS k, x.f AS a, y.f AS l, z.f AS r FROM f2 x JOIN f1 y ON y.lang = x.lang AND y.a = x.a
          JOIN f1 z ON z.lang = x.lang AND z.a = x.b
          WHERE x.f >= 10 AND NOT EXISTS (FROM f3 g WHERE g.lang = x.lang AND (g.a = x.a AND g.b = x.b OR g.b = x.a AND g.c = x.b) AND 100 * g.f >= 50 * x.f)
        UNION ALL
        SELECT x.lang, concat_ws(' ', x.a, x.b, x.c), 1, x.f, y.f, z.f FROM f3 x JOIN f1 y ON y.lang = x.lang AND y.a = x.a
          JOIN f2 z ON z.lang = x.lang AND z.a = x.b AND z.b = x.c
        UNION ALL
        SELECT x.lang, concat_ws(' ', x.a, x.b, x.c), 2, x.f, y.f, z.f FROM f3 x JOIN f2 y ON y.lang = x.lang AND y.a = x.a AND y.b = x.b
          JOIN f1 z ON z.lang = x.lang AND z.a = x.c),
scored AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM cut),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
