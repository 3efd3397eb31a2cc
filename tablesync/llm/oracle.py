"""The same results in DuckDB's SQL, for the operators that SQL can express."""

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

QUALITY_MEASURES = rf"""
t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM {{docs}}),
w AS (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM t),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
marked AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS v(k) GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
          WHERE regexp_matches(line, '{WORD}') GROUP BY r),
m AS (SELECT t.doc_id, t.source, t.r, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(lines.dup, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(marked.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(lines.n, 0) AS n_lines
      FROM t JOIN w USING (r) LEFT JOIN lines USING (r) LEFT JOIN marked USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             100 * n_symbols > 10 * n_words AS bad1,
             100 * n_dup_lines > 50 * n_lines AS bad2,
             word_chars < 2 * n_words OR word_chars > 12 * n_words AS bad3
      FROM m),
h AS (SELECT source, count(*) AS n, v.k, sum(CAST([bad1, bad2, bad3][v.k] AS INT)) AS bad
      FROM f, (VALUES (1), (2), (3)) AS v(k) GROUP BY source, v.k),
p AS (SELECT k, sum(bad) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts FROM h GROUP BY k),
e AS (SELECT k, any_value(mean) AS mean,
             sum(h.n * (h.bad / h.n - mean) ** 2) / any_value(p.n)
             - any_value(mean * (1 - mean) * hosts / p.n) AS excess
      FROM h JOIN p USING (k) GROUP BY k),
prior AS (SELECT k, mean, CASE WHEN excess <= 0 THEN 1e6
             ELSE least(1e6, greatest(2.0, mean * (1 - mean) / excess - 1)) END AS weight FROM e),
rates AS (SELECT source, k, (bad + mean * weight) / (n + weight) >= 0.02 AS enforced FROM h JOIN prior USING (k)),
verdict AS (SELECT source, bool_or(enforced AND k = 1) AS e1, bool_or(enforced AND k = 2) AS e2,
                   bool_or(enforced AND k = 3) AS e3 FROM rates GROUP BY source),
judged AS (SELECT f.*, NOT base_failed AND NOT (bad1 AND e1 OR bad2 AND e2 OR bad3 AND e3) AS kept
           FROM f JOIN verdict ON f.source IS NOT DISTINCT FROM verdict.source)
"""

QUALITY = f"""
WITH {QUALITY_MEASURES.format(docs="documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""

LINE_DEDUP_STEPS = rf"""
ld AS (SELECT row_number() OVER () AS r, * FROM {{docs}}),
li AS (SELECT r, coalesce('=' || source, '-') AS site, pos, lines[pos] AS line
       FROM (SELECT r, source, lines, unnest(range(1, len(lines) + 1)) AS pos
             FROM (SELECT r, source, string_split(text, chr(10)) AS lines FROM ld))),
trimmed AS (SELECT r, site, pos, line, regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g') AS k,
                   len(regexp_extract_all(line, '{WORD}')) >= 3 AS long FROM li),
boiler AS (SELECT k FROM trimmed WHERE long GROUP BY k HAVING count(DISTINCT site) >= 10),
kept_lines AS (SELECT r, pos, line, NOT (long AND k IN (SELECT k FROM boiler)) AS stays FROM trimmed),
clean AS (SELECT r, count(*) FILTER (NOT stays) AS n_removed,
                 coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '') AS text
          FROM kept_lines GROUP BY r)
"""

LINE_DEDUP = f"""
WITH {LINE_DEDUP_STEPS.format(docs="documents")}
SELECT doc_id, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, clean.text
FROM ld LEFT JOIN clean USING (r)
"""

JACCARD_STEPS = rf"""
ja AS (SELECT row_number() OVER () AS r, doc_id,
              regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
       FROM {{docs}}),
jb AS (SELECT DISTINCT r, array_to_string(ws[i:i + 4], ' ') AS s
       FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM ja WHERE len(ws) > 0)),
jn AS (SELECT r, count(*) AS n FROM jb GROUP BY r),
jp AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM jb a JOIN jb b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
jl AS (SELECT x, y FROM jp JOIN jn p ON p.r = x JOIN jn q ON q.r = y WHERE 100 * common >= 80 * (p.n + q.n - common)),
je AS (SELECT x, y FROM jl UNION SELECT y, x FROM jl),
jr AS (SELECT r AS node, r AS reach FROM ja
       UNION
       SELECT jr.node, je.y FROM jr JOIN je ON je.x = jr.reach),
jc AS (SELECT node, min(doc_id) AS component_id FROM jr JOIN ja ON ja.r = jr.reach GROUP BY node)
"""

JACCARD = f"""
WITH RECURSIVE {JACCARD_STEPS.format(docs="documents")}
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM ja LEFT JOIN jn USING (r) JOIN jc ON jc.node = ja.r
"""

#: The CRC-32 of bytes by its table of 256 values; near words by what is left without one letter.
SPELLING = r"""
WITH RECURSIVE
tab AS (SELECT list(c ORDER BY i) AS tab FROM (
  SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i))),
runs AS (SELECT d, run, count(*) AS n FROM (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (SELECT run, n, flatten(list_transform(string_split(d || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                         ELSE [(192 + unicode(c) // 64)::BIGINT, (128 + unicode(c) % 64)::BIGINT] END)) AS b FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)])), 4294967295) AS h
           FROM bytes, tab),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
         FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near, max(m) AS m FROM pairs GROUP BY word),
best AS (SELECT near.word, n_near, near.m, min(other) AS other FROM near JOIN pairs ON near.word = pairs.word AND near.m = pairs.m GROUP BY ALL),
forms AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
          FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, form AS root FROM forms WHERE form IS NOT NULL
         UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, root FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)
"""

COLLOCATIONS = r"""
WITH
p AS (SELECT lang, row_number() OVER () AS p, words FROM (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x{0B}\x{0C}\r]')) AS piece
    FROM documents)) WHERE len(words) > 0),
spots AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM p),
g AS (SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase FROM spots, range(1, 6) AS t(k) WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE a >= 100),
cuts AS (SELECT lang, k, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS first, array_to_string(w[cut + 1 : k], ' ') AS rest
         FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM often WHERE k > 1)),
scored AS (SELECT c.lang, c.k, c.phrase, c.a, cut, x.a AS l, y.a AS r, n,
                  CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
           FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = c.first JOIN often y ON y.lang = c.lang AND y.phrase = c.rest
                JOIN totals ON totals.lang = c.lang),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM least_cut s WHERE NOT EXISTS (
  SELECT 1 FROM often o WHERE o.lang = s.lang AND o.k > s.k AND o.a >= s.a AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

ORACLE = {
    "op3_line_dedup": LINE_DEDUP,
    "op5_quality_rules": QUALITY,
    "op7_ngram_jaccard_join": JACCARD,
    "op11_spelling_variants": SPELLING,
    "op12_collocations": COLLOCATIONS,
}
