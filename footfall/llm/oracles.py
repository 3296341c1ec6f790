"""The same results as DuckDB SQL, written from the definitions."""

QUALITY = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT doc_id, pos, array_to_string(w[pos:pos + 7], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS pos FROM d)
), twice AS (
    SELECT doc_id, pos FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
    SELECT doc_id, sum(step) AS n
    FROM (SELECT doc_id, least(8, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - pos, 8)) AS step
          FROM twice)
    GROUP BY doc_id
), m AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
           coalesce(covered.n, 0)::bigint AS n_repeat_words,
           len(list_filter(list_zip(w[2:], w[:-2]), lambda p: p[1] = p[2])) AS n_runs,
           length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
           length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) AS n_letters
    FROM d LEFT JOIN covered USING (doc_id)
), f AS (
    SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
        + (CASE WHEN n_repeat_words > 0.3 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN n_symbols > 0.1 * n_words THEN 4 ELSE 0 END)
        + (CASE WHEN n_dup_lines > 0.5 * n_lines THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
        + (CASE WHEN n_upper > 0.5 * n_letters THEN 32 ELSE 0 END)
        + (CASE WHEN n_runs > 0.2 * n_words THEN 64 ELSE 0 END) AS failed
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed % 4 <> 0 AS base_failed, failed = 0 AS kept, failed::int AS failed
FROM f
"""

LINES = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), common AS (
    SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10
    GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT doc_id, pos, line, common.first IS NOT NULL AND common.first <> doc_id AS gone
    FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

AUDIT = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), failed AS (
    SELECT doc_id, part, [
        CASE WHEN len(w) < 100 THEN 'A' END,
        CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
        CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' END,
        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
        CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END] AS fails
    FROM d
), cells AS (
    SELECT part, list_filter(fails, lambda x: x IS NOT NULL) AS fails, count(*) AS n,
           count(*) FILTER (labels.quality = 1) AS good, count(*) FILTER (labels.toxic = 1) AS toxic
    FROM failed LEFT JOIN labels USING (doc_id) GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT o, s::int AS step, o[s] AS f, o[:s - 1] AS earlier FROM orders, range(1, 6) AS r(s)
), rows AS (
    SELECT part, array_to_string(o, '') AS filter_order, step, f, n, good, toxic, fails,
           list_contains(fails, f) AS here, len(list_intersect(fails, earlier)) > 0 AS gone
    FROM cells, steps
), counted AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (NOT gone AND NOT here), 0)::bigint AS kept,
           coalesce(sum(n) FILTER (NOT gone AND here), 0)::bigint AS removed,
           coalesce(sum(n) FILTER (gone AND here), 0)::bigint AS redundant,
           coalesce(sum(n) FILTER (here AND len(fails) = 1), 0)::bigint AS unique_fails,
           coalesce(sum(good) FILTER (NOT gone AND here), 0)::bigint AS good_lost,
           coalesce(sum(toxic) FILTER (NOT gone AND here), 0)::bigint AS toxic_lost
    FROM rows GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::bigint AS shapley
FROM counted
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), runs AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM cut, range(1, 6) AS s(size)
), f AS (
    SELECT lang, size, phrase, count(*) AS n FROM runs GROUP BY ALL HAVING count(*) >= 100
), total AS (
    SELECT lang, sum(len(w))::hugeint AS n FROM cut GROUP BY lang
), cuts AS (
    SELECT f.lang, f.phrase, f.n AS a, l.n AS l, r.n AS r, total.n AS n, k,
           1000::hugeint * f.n * total.n // (l.n::hugeint * r.n) AS score
    FROM f JOIN range(1, 5) AS c(k) ON k < size JOIN total ON total.lang = f.lang
    JOIN f AS l ON l.lang = f.lang AND l.phrase = array_to_string(string_split(f.phrase, ' ')[:k], ' ')
    JOIN f AS r ON r.lang = f.lang AND r.phrase = array_to_string(string_split(f.phrase, ' ')[k + 1:], ' ')
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), free AS (
    SELECT * FROM lowest AS p WHERE NOT EXISTS (
        SELECT 1 FROM f WHERE f.lang = p.lang AND f.n >= p.a AND f.phrase <> p.phrase
        AND contains(' ' || f.phrase || ' ', ' ' || p.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n::bigint AS n, score::bigint AS score
FROM free QUALIFY rank <= 2000
"""
