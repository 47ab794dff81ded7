"""Independent ANSI SQL (DuckDB dialect) for every bound query.

Tables are the pre-registered views ``region nation customer supplier part
orders lineitem events documents embeddings pages benchmark labels
conversations``.  Column names and types match the Spark results.
"""

from __future__ import annotations

from tessera.plans import bindings as B
from tessera.plans.ingest import MALFORMED_LINES

_Q = "'"


def _lit_list(words) -> str:
    return "[" + ", ".join(_Q + w.replace(_Q, _Q * 2) + _Q for w in words) + "]"


STOP = _lit_list(sorted(set(B.STOPWORDS)))

# the tables with the few added rows that make the defaults fire
RATINGS = ("(SELECT l_orderkey AS user_id, l_partkey AS item_id, l_quantity AS score, "
           "year(l_shipdate)::VARCHAR AS year FROM lineitem UNION ALL "
           "SELECT -1 - i % 2, -1, CAST(1 + i % 5 AS DOUBLE), NULL FROM range(30) r(i) UNION ALL "
           "SELECT -4, -9, NULL, '1970')")
USERS = ("(SELECT o_orderkey AS user_id, o_orderstatus AS segment, o_totalprice AS age, "
         "o_custkey AS code FROM orders UNION ALL SELECT -2, 'F', NULL, -7 "
         "UNION ALL SELECT -4, 'F', NULL, -8)")
ITEMS = ("(SELECT p_partkey AS item_id, min(p_name) AS title FROM (SELECT p_partkey, p_name "
         "FROM part UNION ALL SELECT -9, 'part without scores') GROUP BY p_partkey)")
ITEM_STATS = (f"(SELECT item_id, sum(score) AS s, count(score) AS n FROM {RATINGS} "
              f"GROUP BY item_id HAVING count(score) > 0)")
RATED = (f"(SELECT r.item_id, u.segment, u.age, r.score FROM {RATINGS} r "
         f"JOIN {USERS} u USING (user_id))")

_T = B.MIN_SUPPORT
UNKNOWN_TITLE = "Không rõ tên"

# Review text: doubled quote -> space; quote/punctuation/CR/LF -> space; Java
# trim (chars <= U+0020); lower.  Then tokens split on a single space.
CLEAN = (r"""lower(regexp_replace(regexp_replace(regexp_replace(text, '""', ' ', 'g'), """
         r"""'["\n\r,.!?:;()\[\]+\-*/]', ' ', 'g'), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'))""")
TOKENS = "list_filter(string_split(review, ' '), lambda x: x <> '' AND x <> ' ')"
WORDS = f"list_filter(toks, lambda x: NOT list_contains({STOP}, x))"

SENT = ("(SELECT CAST(doc_id AS VARCHAR) AS id, min(CASE WHEN quality = 1 THEN 'positive' "
        "WHEN quality = 0 THEN 'negative' END) AS sentiment FROM labels GROUP BY doc_id)")
CLEANED = (f"(SELECT CAST(doc_id AS VARCHAR) AS id, {CLEAN} AS review, source AS aspect, "
           f"lang AS category FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)")
WORD_ROWS = (f"(SELECT id, aspect, category, {WORDS} AS words FROM "
             f"(SELECT id, aspect, category, {TOKENS} AS toks FROM {CLEANED}))")
TOKEN_ROWS = (f"(SELECT id, aspect, category, sentiment, CAST(pos AS INTEGER) AS pos, word FROM "
              f"(SELECT id, aspect, category, sentiment, unnest(range(len(toks))) AS pos, "
              f"unnest(toks) AS word FROM (SELECT c.id, c.aspect, c.category, s.sentiment, "
              f"{TOKENS} AS toks FROM {CLEANED} c LEFT JOIN {SENT} s USING (id))))")
KEYS = f"(SELECT DISTINCT id, aspect, category FROM {WORD_ROWS} WHERE len(words) > 0)"
KEYS_SENT = f"(SELECT k.*, s.sentiment FROM {KEYS} k LEFT JOIN {SENT} s USING (id))"
WORD_ROWS_SENT = f"(SELECT w.*, s.sentiment FROM {WORD_ROWS} w LEFT JOIN {SENT} s USING (id))"


def _cat_top(sentiment: str | None) -> str:
    filt = "" if sentiment is None else f" AND sentiment = '{sentiment}'"
    src = WORD_ROWS if sentiment is None else WORD_ROWS_SENT
    return (f"SELECT category, word, freq FROM (SELECT category, word, freq, row_number() OVER "
            f"(PARTITION BY category ORDER BY freq DESC, word ASC) AS rn FROM "
            f"(SELECT category, word, count(*) AS freq FROM "
            f"(SELECT category, unnest(words) AS word FROM {src} "
            f"WHERE words IS NOT NULL AND category IS NOT NULL{filt}) "
            f"GROUP BY category, word)) WHERE rn <= {B.TOP_WORDS_K}")


def _seg_cols(labels, names, value="segment") -> tuple[str, str]:
    aggs, outs = [], []
    for v, name in zip(labels, names):
        aggs.append(f"sum(CASE WHEN {value} = '{v}' THEN score END) AS {name}__s, "
                    f"count(CASE WHEN {value} = '{v}' THEN score END) AS {name}__n")
        outs.append(f"CASE WHEN {name}__n > 0 THEN round({name}__s / {name}__n, 4) END AS {name}")
    return ", ".join(aggs), ", ".join(outs)


_SEG_AGG, _SEG_OUT = _seg_cols(B.STATUS_SEGMENTS, B.STATUS_COLUMNS)
_BAND_RIGHT = ("CASE WHEN age <= 100000 THEN '0-100k' WHEN age <= 200000 THEN '100k-200k' "
               "WHEN age <= 300000 THEN '200k-300k' WHEN age > 300000 THEN '300k+' END")
_BAND_LEFT = ("CASE WHEN age < 100000 THEN 'under 100k' WHEN age < 200000 THEN '100k-199k' "
              "WHEN age < 300000 THEN '200k-299k' WHEN age >= 300000 THEN '300k+' "
              "ELSE 'Unknown' END")
_BAND_AGG, _BAND_OUT = _seg_cols(B.PRICE_BANDS_RIGHT, B.PRICE_BAND_COLUMNS, "band")

BAND_LONG = (f"SELECT st.item_id, st.band, round(st.s / st.n, 4) AS avg_score, "
             f"coalesce(i.title, 'Unknown') AS title FROM (SELECT item_id, {_BAND_LEFT} AS band, "
             f"sum(score) AS s, count(score) AS n FROM {RATED} GROUP BY ALL HAVING n > 0) st "
             f"LEFT JOIN {ITEMS} i USING (item_id)")

# Means as text.  Scores are whole numbers, so Java's half-up cents are exact in
# whole numbers; Python's are those of C.
def _half_up(s: str, n: str) -> str:
    cents = f"((200 * CAST({s} AS BIGINT) + {n}) // (2 * {n}))"
    return f"printf('%d.%02d', {cents} // 100, {cents} % 100)"


def _wide_text(name: str, missing: str) -> str:
    return f"CASE WHEN {name}__n > 0 THEN {_half_up(name + '__s', name + '__n')} ELSE '{missing}' END"


_REPORT_FMT = "ID: %-5s | Nhóm tuổi: %-8s | Điểm TB: %.2f | Phim: %s"
_BEST = (f"(SELECT st.item_id, i.title, st.s, st.n FROM {ITEM_STATS} st JOIN {ITEMS} i "
         f"USING (item_id) WHERE st.n >= {_T} ORDER BY st.s / st.n DESC, st.item_id LIMIT 1)")
_TAGS = (f"(SELECT tag, sum(s) AS s, CAST(sum(n) AS BIGINT) AS n FROM (SELECT st.s, st.n, "
         f"unnest(coalesce(list_filter(string_split(i.title, ' '), lambda x: x <> ''), "
         f"['Unknown'])) AS tag, i.item_id FROM {ITEM_STATS} st LEFT JOIN {ITEMS} i "
         f"USING (item_id)) WHERE tag <> 'Unknown' OR KEEP GROUP BY tag)")
_LINE_RULE = "--------------------------------------------------"

SQL: dict[str, str] = {
    # ---------------------------------------------------------- ratings
    "item_avg_score": (
        f"SELECT st.item_id, i.title, round(st.s / st.n, 4) AS avg_score, st.n AS n_scores "
        f"FROM {ITEM_STATS} st JOIN {ITEMS} i USING (item_id)"),
    "best_item_min_support": (
        f"SELECT st.item_id, i.title, round(st.s / st.n, 4) AS avg_score, st.n AS n_scores "
        f"FROM {ITEM_STATS} st JOIN {ITEMS} i USING (item_id) WHERE st.n >= {_T} "
        f"ORDER BY st.s / st.n DESC, st.item_id LIMIT 1"),
    "item_ranking_min_support": (
        f"SELECT st.item_id, coalesce(i.title, '{UNKNOWN_TITLE}') AS title, "
        f"round(st.s / st.n, 4) AS avg_score, st.n AS n_scores FROM {ITEM_STATS} st "
        f"LEFT JOIN {ITEMS} i USING (item_id) WHERE st.n >= {_T}"),
    "ranking_with_summary": (
        f"WITH r AS (SELECT st.item_id, coalesce(i.title, '{UNKNOWN_TITLE}') AS title, "
        f"st.s / st.n AS m, st.n AS n_scores FROM {ITEM_STATS} st "
        f"LEFT JOIN {ITEMS} i USING (item_id) WHERE st.n >= {_T}) "
        f"SELECT 'ranking' AS section, item_id, title, round(m, 4) AS avg_score, n_scores FROM r "
        f"UNION ALL (SELECT 'best' AS section, item_id, title, round(m, 4) AS avg_score, n_scores "
        f"FROM r ORDER BY m DESC, item_id LIMIT 1)"),
    "tag_avg_score": (
        f"SELECT tag, round(sum(s) / sum(n), 4) AS avg_score, CAST(sum(n) AS BIGINT) AS n_scores "
        f"FROM (SELECT st.s, st.n, "
        f"unnest(list_filter(string_split(i.title, ' '), lambda x: x <> '')) "
        f"AS tag FROM {ITEM_STATS} st JOIN {ITEMS} i USING (item_id)) GROUP BY tag"),
    "tag_avg_score_default": (
        f"SELECT tag, round(sum(s) / sum(n), 4) AS avg_score, CAST(sum(n) AS BIGINT) AS n_scores "
        f"FROM (SELECT st.s, st.n, unnest(coalesce(list_filter(string_split(i.title, ' '), "
        f"lambda x: x <> ''), ['Unknown'])) AS tag FROM {ITEM_STATS} st "
        f"LEFT JOIN {ITEMS} i USING (item_id)) GROUP BY tag"),
    "item_avg_by_segment_wide": (
        f"SELECT i.item_id, i.title, {_SEG_OUT} FROM {ITEMS} i LEFT JOIN "
        f"(SELECT item_id, {_SEG_AGG} FROM {RATED} GROUP BY item_id) st USING (item_id)"),
    "item_avg_by_segment_once": (
        f"SELECT i.item_id, i.title, {_SEG_OUT} FROM {ITEMS} i LEFT JOIN "
        f"(SELECT r.item_id, {_SEG_AGG} FROM {RATINGS} r JOIN orders o ON o.o_orderkey = r.user_id "
        f"JOIN (SELECT o_custkey, min(o_orderstatus) AS segment FROM orders GROUP BY o_custkey) u "
        f"ON u.o_custkey = o.o_custkey GROUP BY r.item_id) st USING (item_id)"),
    "item_avg_by_segment_long": (
        f"SELECT st.item_id, st.segment, round(st.s / st.n, 4) AS avg_score, "
        f"coalesce(i.title, 'Unknown') AS title FROM (SELECT item_id, segment, sum(score) AS s, "
        f"count(score) AS n FROM {RATED} GROUP BY item_id, segment HAVING n > 0) st "
        f"LEFT JOIN {ITEMS} i USING (item_id)"),
    "item_avg_by_band_wide": (
        f"SELECT i.item_id, i.title, {_BAND_OUT} FROM {ITEMS} i LEFT JOIN "
        f"(SELECT item_id, {_BAND_AGG} FROM (SELECT item_id, score, {_BAND_RIGHT} AS band "
        f"FROM {RATED}) GROUP BY item_id) st USING (item_id)"),
    "item_avg_by_band_long": BAND_LONG,
    "avg_score_by_two_hop_label": (
        "SELECT label, round(sum(s) / sum(n), 4) AS avg_score, CAST(sum(n) AS BIGINT) AS n_scores "
        "FROM (SELECT st.s, st.n, CASE WHEN u.user_id IS NULL THEN 'Unknown' ELSE "
        "coalesce(c.name, CAST(u.code AS VARCHAR), 'Unknown') END AS label "
        f"FROM (SELECT user_id, sum(score) AS s, count(score) AS n "
        f"FROM {RATINGS} GROUP BY user_id) st "
        f"LEFT JOIN (SELECT user_id, min(code) AS code FROM {USERS} "
        f"GROUP BY user_id) u USING (user_id) "
        "LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS code_s, min(c_mktsegment) AS name "
        "FROM customer GROUP BY c_custkey) c "
        "ON CAST(u.code AS VARCHAR) = c.code_s) GROUP BY label HAVING sum(n) > 0"),
    "avg_score_by_epoch_year": (
        "SELECT coalesce(year, 'Unknown') AS year, round(sum(score) / count(score), 4) AS avg_score, "
        f"count(score) AS n_scores FROM {RATINGS} GROUP BY 1 HAVING count(score) > 0"),
    # ---------------------------------------------------------- reviews
    "clean_text": (
        f"SELECT c.id, c.review, c.aspect, c.category, s.sentiment FROM {CLEANED} c "
        f"LEFT JOIN {SENT} s USING (id)"),
    "tokenize_reviews": f"SELECT * FROM {TOKEN_ROWS}",
    "remove_stopwords": f"SELECT * FROM {TOKEN_ROWS} WHERE NOT list_contains({STOP}, word)",
    "rebuild_clean_text": (
        f"SELECT id, string_agg(t, ',' ORDER BY t) AS review, aspect, category, sentiment FROM "
        f"(SELECT w.id, w.aspect, w.category, w.sentiment, array_to_string(w.words, ',') AS t "
        f"FROM {WORD_ROWS_SENT} w WHERE len(w.words) > 0) "
        f"GROUP BY id, aspect, category, sentiment"),
    "word_count": (
        f"SELECT word, count(*) AS freq FROM (SELECT unnest(words) AS word FROM {WORD_ROWS} "
        f"WHERE words IS NOT NULL AND category IS NOT NULL AND aspect IS NOT NULL) GROUP BY word"),
    "top_words": (
        f"SELECT word, count(*) AS freq FROM (SELECT unnest(words) AS word FROM {WORD_ROWS} "
        f"WHERE words IS NOT NULL AND category IS NOT NULL AND aspect IS NOT NULL) GROUP BY word "
        f"ORDER BY freq DESC, word ASC LIMIT {B.TOP_WORDS_K}"),
    "count_by_category": (
        f"SELECT category, count(id) AS total FROM {KEYS} "
        f"WHERE category IS NOT NULL AND aspect IS NOT NULL GROUP BY category"),
    "count_by_aspect": (
        f"SELECT aspect, count(id) AS total FROM {KEYS} "
        f"WHERE category IS NOT NULL AND aspect IS NOT NULL GROUP BY aspect"),
    "count_by_aspect_sentiment": (
        f"SELECT aspect, sentiment, count(*) AS total FROM {KEYS_SENT} "
        f"WHERE aspect IS NOT NULL AND sentiment IS NOT NULL GROUP BY aspect, sentiment"),
    "top_aspect_negative": (
        f"SELECT aspect, sentiment, count(*) AS total FROM {KEYS_SENT} "
        f"WHERE aspect IS NOT NULL AND sentiment = 'negative' GROUP BY aspect, sentiment "
        f"ORDER BY total DESC, aspect ASC LIMIT 1"),
    "top_aspect_positive": (
        f"SELECT aspect, sentiment, count(*) AS total FROM {KEYS_SENT} "
        f"WHERE aspect IS NOT NULL AND sentiment = 'positive' GROUP BY aspect, sentiment "
        f"ORDER BY total DESC, aspect ASC LIMIT 1"),
    "top_words_by_category_positive": _cat_top("positive"),
    "top_words_by_category_negative": _cat_top("negative"),
    "top_words_by_category": _cat_top(None),
    # ---------------------------------------------------------- commerce
    "schema_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS data_type, true AS nullable, "
        f"count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct FROM orders"
        for i, (c, t) in enumerate([
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string")], start=1)),
    "entity_counts": (
        "SELECT 'orders' AS entity, count(DISTINCT o_orderkey) AS n FROM orders UNION ALL "
        "SELECT 'customers', count(DISTINCT c_custkey) FROM customer UNION ALL "
        "SELECT 'sellers', count(DISTINCT l_suppkey) FROM lineitem"),
    "orders_by_country": (
        "SELECT n.n_name AS country, count(o.o_orderkey) AS total_orders FROM orders o "
        "JOIN customer c ON o.o_custkey = c.c_custkey "
        "LEFT JOIN (SELECT n_nationkey, min(n_name) AS n_name FROM nation GROUP BY n_nationkey) n "
        "ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name ORDER BY total_orders DESC, country"),
    "orders_by_year_month": (
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, "
        "CAST(month(o_orderdate) AS INTEGER) AS order_month, count(o_orderkey) AS total_orders "
        "FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2 ORDER BY 1 ASC, 2 DESC"),
    "average_valid_score": (
        "SELECT round(avg(score), 4) AS avg_score, count(*) AS n_valid FROM "
        "(SELECT TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS score FROM lineitem) "
        "WHERE score BETWEEN 1 AND 5"),
    "score_distribution": (
        "SELECT score, count(*) AS total_reviews FROM "
        "(SELECT TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS score FROM lineitem) "
        "WHERE score BETWEEN 1 AND 5 GROUP BY score ORDER BY score"),
    "seller_ranking": (
        "SELECT l_suppkey AS seller_id, "
        "CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS total_revenue, "
        "count(DISTINCT l_orderkey) AS order_count FROM lineitem GROUP BY l_suppkey "
        "ORDER BY sum(CAST(l_extendedprice AS DECIMAL(15,2))) DESC, order_count DESC, seller_id "
        f"LIMIT {B.TOP_SELLERS_K}"),
    # ---------------------------------------------------------- ingest / report
    "read_delimited_tolerant": (
        "SELECT p_partkey AS item_id, p_name AS title, p_size AS size FROM part"),
    "read_quoted_multiline": "SELECT doc_id, text, lang, source FROM documents",
    # every injected line is malformed; every part line parses
    "malformed_count": (
        f"SELECT count(*) AS kept, CAST({len(MALFORMED_LINES)} AS BIGINT) AS malformed "
        f"FROM part"),
    # as CSV the two blank lines are no records and "1,2," has its three fields, the last one null
    "bad_record_counts": (
        f"SELECT count(*) + 1 AS n_good, CAST({len(MALFORMED_LINES) - 3} AS BIGINT) AS n_bad "
        f"FROM part"),
    "key_value_hand_over": (
        f"SELECT st.item_id, st.n AS n_scores FROM {ITEM_STATS} st JOIN {ITEMS} i "
        f"USING (item_id)"),
    "read_glob": (
        "SELECT l_orderkey AS user_id, l_partkey AS item_id, l_linenumber AS line, "
        "l_quantity AS score, CAST(epoch(l_shipdate) AS BIGINT) AS epoch, "
        "CASE WHEN year(l_shipdate) <= 1998 THEN 'ratings_1' ELSE 'ratings_2' END AS source "
        "FROM lineitem"),
    "read_header_inferred": (
        "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, "
        "c_mktsegment FROM customer"),
    "format_report": (
        f"SELECT st.item_id, st.band, "
        f"printf('{_REPORT_FMT}', CAST(st.item_id AS VARCHAR), st.band, "
        f"st.s / st.n, coalesce(i.title, 'Unknown')) AS line "
        f"FROM (SELECT item_id, {_BAND_LEFT} AS band, sum(score) AS s, count(score) AS n "
        f"FROM {RATED} GROUP BY ALL HAVING n > 0) st LEFT JOIN {ITEMS} i USING (item_id)"),
}
SQL |= {
    # --------------------------------------------------- report lines and files
    "report_item_means": (
        f"SELECT st.item_id, i.title || chr(9) || 'Average Rating: ' || {_half_up('st.s', 'st.n')} "
        f"|| ' (Total Ratings: ' || st.n || ')' AS line FROM {ITEM_STATS} st "
        f"JOIN {ITEMS} i USING (item_id)"),
    "report_best_item": (
        f"SELECT title || chr(9) || 'is the highest rated movie with an average rating of ' || "
        f"{_half_up('s', 'n')} || ' among movies with at least {_T} ratings' AS line FROM {_BEST}"),
    "report_best_item_unmet": "SELECT CAST(l_partkey AS VARCHAR) AS line FROM lineitem WHERE false",
    "report_tag_means": (
        f"SELECT tag, tag || ' ' || chr(9) || 'Avg: ' || {_half_up('s', 'n')} || ',  Count: ' || n "
        f"AS line FROM {_TAGS.replace('KEEP', 'false')}"),
    "report_segment_means": (
        f"SELECT i.item_id, i.title || ':' || chr(9) || 'Male: ' || "
        f"{_wide_text(B.STATUS_COLUMNS[0], '0.00')} || ', Female: ' || "
        f"{_wide_text(B.STATUS_COLUMNS[1], '0.00')} AS line FROM {ITEMS} i LEFT JOIN "
        f"(SELECT item_id, {_SEG_AGG} FROM {RATED} GROUP BY item_id) st USING (item_id)"),
    "report_band_means": (
        "SELECT i.item_id, i.title || ':' || chr(9) || '[' || " + " || ', ' || ".join(
            f"'{band}: ' || {_wide_text(name, 'NA')}"
            for band, name in zip(B.PRICE_BANDS_RIGHT, B.PRICE_BAND_COLUMNS))
        + f" || ']' AS line FROM {ITEMS} i LEFT JOIN (SELECT item_id, {_BAND_AGG} FROM "
        f"(SELECT item_id, score, {_BAND_RIGHT} AS band FROM {RATED}) GROUP BY item_id) st "
        f"USING (item_id)"),
    "report_ranking": (
        f"SELECT st.item_id, printf('%d, %s, %.2f, %d', st.item_id, "
        f"coalesce(i.title, '{UNKNOWN_TITLE}'), st.s / st.n, st.n) AS line FROM {ITEM_STATS} st "
        f"LEFT JOIN {ITEMS} i USING (item_id) WHERE st.n >= {_T}"),
    "report_summary": " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS line_no, {text} AS line FROM {_BEST}"
        for i, text in enumerate((
            "''", f"'{_LINE_RULE}'", "'KET QUA: PHIM CO DIEM TRUNG BINH CAO NHAT'",
            "'ID phim: ' || item_id", "'Ten phim: ' || title",
            "printf('Diem trung binh: %.2f / 5.0', s / n)",
            "printf('So luot danh gia: %d luot', n)", f"'{_LINE_RULE}'"))),
    "report_tags": (
        f"SELECT tag, printf('Thể loại: %-15s | Điểm TB: %.2f | Tổng lượt rating: %d', tag, s / n, n) "
        f"AS line FROM {_TAGS.replace('KEEP', 'true')}"),
    "report_segments": (
        f"SELECT st.item_id, st.segment, printf('ID: %-5s | Giới tính: %s | Điểm TB: %.2f | "
        f"Phim: %s', CAST(st.item_id AS VARCHAR), st.segment, st.s / st.n, "
        f"coalesce(i.title, 'Unknown')) AS line FROM (SELECT item_id, segment, sum(score) AS s, "
        f"count(score) AS n FROM {RATED} GROUP BY item_id, segment HAVING n > 0) st "
        f"LEFT JOIN {ITEMS} i USING (item_id)"),
    "report_labels": (
        "SELECT label, printf('Nghề nghiệp: %-15s | Điểm TB: %.2f | Tổng số lượt đánh giá: ', label, "
        "sum(score) / count(score)) || format('{:,}', count(score)) AS line FROM (SELECT r.score, "
        "CASE WHEN u.user_id IS NULL THEN 'Unknown' ELSE coalesce(c.name, "
        "CAST(u.code AS VARCHAR), 'Unknown') END AS label "
        f"FROM {RATINGS} r LEFT JOIN {USERS} u USING (user_id) LEFT JOIN (SELECT c_custkey AS code, "
        "min(c_mktsegment) AS name FROM customer GROUP BY c_custkey) c ON u.code = c.code) "
        "GROUP BY label HAVING count(score) > 0"),
    "report_years": (
        "SELECT coalesce(year, 'Unknown') AS year, printf('Năm: %s | Điểm TB: %.2f | "
        "Tổng số lượt đánh giá: ', coalesce(year, 'Unknown'), sum(score) / count(score)) "
        f"|| format('{{:,}}', count(score)) AS line FROM {RATINGS} GROUP BY 1, coalesce(year, 'Unknown') "
        "HAVING count(score) > 0"),
    "staged_category_counts": SQL["count_by_category"],
    "rebuild_with_stopword_file": SQL["rebuild_clean_text"],
    "read_limited_split": (
        "SELECT p_partkey AS item_id, p_name AS title, p_type || ',' || p_brand AS rest FROM part"),
    "title_with_commas": (
        "SELECT p_partkey AS item_id, p_name || ',' || p_brand AS title, "
        "replace(p_name, ' ', '|') AS tags, "
        "unnest(list_filter(string_split(p_name, ' '), lambda x: x <> '')) AS tag FROM part"),
}
SQL["read_header_one_pass"] = SQL["read_header_inferred"]
SQL["inferred_types"] = """
SELECT t AS table_name, c AS column_name, k AS data_type,
  CASE t WHEN 'orders' THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM customer) END AS n_rows
FROM (VALUES ('orders', 'o_orderkey', 'int'), ('orders', 'o_custkey', 'int'),
  ('orders', 'o_orderstatus', 'string'), ('orders', 'o_totalprice', 'double'),
  ('orders', 'o_orderdate', 'timestamp'), ('orders', 'o_orderpriority', 'string'),
  ('customer', 'c_custkey', 'int'), ('customer', 'c_name', 'string'), ('customer', 'c_nationkey', 'int'),
  ('customer', 'c_acctbal', 'double'), ('customer', 'c_mktsegment', 'string')) v(t, c, k)"""
SQL["read_quoted_split"] = SQL["read_quoted_multiline"]
SQL["single_file_report"] = f"SELECT line FROM ({SQL['report_years']})"
# the stored cleaned table gives the same word counts as the in-plan pipeline
SQL["cleaned_table_hand_over"] = SQL["word_count"]
# so does the incremental (Structured Streaming) word count over review files
SQL["streaming_word_count"] = SQL["word_count"]
