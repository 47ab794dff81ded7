"""DuckDB SQL for the operators that SQL can express."""

_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

SQL = {
    "op7_line_quality": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source,
             {_WORDS} AS w FROM documents),
g AS (SELECT r, i, len(w) AS n, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
        FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
l AS (SELECT r, source, unnest(string_split(t, chr(10))) AS line FROM d),
l2 AS (SELECT *, lower(regexp_replace(regexp_replace(
          trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)), '[0-9]', '0', 'g'),
          '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS p,
          length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
       FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l2 GROUP BY r),
hosts AS (SELECT source, count(*) AS total FROM d GROUP BY source),
freq AS (SELECT f.source, p FROM (SELECT source, p, count(DISTINCT r) AS n FROM l2 GROUP BY source, p) f
         JOIN hosts ON hosts.source IS NOT DISTINCT FROM f.source
         WHERE n >= 1000 OR (n >= 20 AND n * 100 >= total)),
lost AS (SELECT r, sum(chars) AS lost FROM l2 JOIN freq ON l2.p = freq.p
           AND l2.source IS NOT DISTINCT FROM freq.source GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
        length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
        coalesce(cov.n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(lost.lost, 0)::BIGINT AS line_chars_removed
      FROM d LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN lost USING (r)),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT *, (NOT base_failed AND line_chars_removed <= 0.5 * word_chars) AS kept FROM f""",
    "op9_repeats": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS c FROM s) WHERE c > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM rep, (SELECT unnest(generate_series(0, 34)) AS k)),
words AS (SELECT r, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0),
kept AS (SELECT r, count(gone.p) AS n_removed,
           coalesce(string_agg(x, ' ' ORDER BY words.p) FILTER (gone.p IS NULL), '') AS k
         FROM words LEFT JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
    "op11_lexical_search": r"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id,
    list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
      lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
size AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM split WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM split) GROUP BY r, term),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
           FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), total),
item AS (SELECT i, item_id, term FROM (SELECT i, item_id, unnest(list_distinct(list_transform(
    regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
      lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS term
    FROM (SELECT row_number() OVER () AS i, * FROM benchmark))),
score AS (SELECT i, item_id, tf.r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN size ON size.r = tf.r, total
  GROUP BY i, item_id, tf.r, doc_id HAVING score > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER
             AS rank FROM score)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
