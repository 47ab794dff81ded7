"""Review text pipeline on an edge-case fixture, checked against a brute-force
pure-Python implementation of the same rules."""

import re
from collections import Counter

import pytest

from tessera.operators import text as T

from conftest import rows

STOP = ["và", "là", "the", "of"]

# id, review, aspect, category, sentiment
REVIEWS = [
    ("id", "review", "aspect", "category", "sentiment"),               # header row
    ("1", 'Phòng ""rất"" sạch; giá rẻ!\nNhân viên (thân thiện)', "ROOMS", "HOTEL", "positive"),
    ("2", None, "ROOMS", "HOTEL", "negative"),                          # NULL review
    ("3", "", "SERVICE", "HOTEL", "negative"),                          # empty review
    ("4", "và là the of", "SERVICE", "HOTEL", "positive"),              # only stopwords
    ("5", "!!! ... ;;; ()", "PRICES", "HOTEL", "negative"),             # only punctuation
    ("6", "Giá\tcao, phục vụ CHẬM\r\nkhông tốt", "PRICES", "SERVICE", "negative"),
    ("6", "giá cao quá", "PRICES", "SERVICE", "negative"),              # same key twice
    ("6", "giá cao quá", "PRICES", "SERVICE", "negative"),              # an exact copy
    ("7", "ĐẸP và SẠCH", "COMFORT", "ROOMS", None),                     # NULL sentiment
    ("8", "sạch sẽ, đẹp", None, "ROOMS", "positive"),                   # NULL aspect
    ("9", "sạch đẹp rẻ", "COMFORT", None, "positive"),                  # NULL category
    (None, "không có id", "COMFORT", "ROOMS", "positive"),              # NULL id
]


def py_clean(s):
    s = s.replace('""', " ")
    s = re.sub(r'["\n\r,.!?:;()\[\]+\-*/]', " ", s)
    s = s.strip("".join(chr(i) for i in range(33)))
    return s.lower()


def py_tokens(s):
    return [t for t in s.split(" ") if t not in ("", " ")]


def py_cleaned():
    out = []
    for r in REVIEWS:
        if r[0] is None or r[1] is None or r[0] == "id":
            continue
        out.append((r[0], py_clean(r[1]), r[2], r[3], r[4]))
    return out


def py_cleaned_table():
    groups = {}
    for i, rev, a, c, s in py_cleaned():
        words = [w for w in py_tokens(rev) if w not in STOP]
        if words:
            groups.setdefault((i, a, c, s), []).append(",".join(words))
    return {k: ",".join(sorted(v)) for k, v in groups.items()}


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(REVIEWS[1:] + [REVIEWS[0]],
                                 "id string, review string, aspect string, category string, "
                                 "sentiment string")


@pytest.fixture(scope="module")
def token_rows(reviews):
    return T.review_tokens(T.clean_reviews(reviews))


def test_clean_reviews(reviews):
    got = [tuple(r) for r in T.clean_reviews(reviews)
           .select("id", "review", "aspect", "category", "sentiment").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, py_cleaned()))


def test_tokenize_and_remove_stopwords(spark, reviews):
    toks = T.tokenize_reviews(T.clean_reviews(reviews))
    expect = [(i, p, w) for i, rev, *_ in py_cleaned() for p, w in enumerate(py_tokens(rev))]
    assert sorted(rows(toks, "id", "pos", "word")) == sorted(expect)
    stop_df = spark.createDataFrame([(w,) for w in STOP] + [(None,)], "stopword string")
    kept = T.remove_stopwords(toks, stop_df)
    assert sorted(rows(kept, "id", "pos", "word")) == sorted(e for e in expect if e[2] not in STOP)
    # the literal-list form gives the same rows
    assert rows(T.remove_stopwords(toks, STOP), "id", "pos", "word") == rows(kept, "id", "pos", "word")


@pytest.mark.parametrize("as_table", [False, True])
def test_rebuild_clean_text(spark, token_rows, as_table):
    stop = spark.createDataFrame([(w,) for w in STOP], "stopword string") if as_table else STOP
    got = {(r["id"], r["aspect"], r["category"], r["sentiment"]): r["review"]
           for r in T.rebuild_clean_text(token_rows, stop).collect()}
    assert got == py_cleaned_table()
    assert ("4", "SERVICE", "HOTEL", "positive") not in got      # only stopwords: gone
    # two rows with one key merge, ordered by their text ("\t" sorts before ",")
    assert got[("6", "PRICES", "SERVICE", "negative")] == (
        "giá\tcao,phục,vụ,chậm,không,tốt,giá,cao,quá,giá,cao,quá")


@pytest.mark.parametrize("broadcast", [False, True])
def test_rebuild_with_a_stopword_table(spark, broadcast):
    # null and repeated keys, equal rows, rows and keys of stopwords alone, null and empty words
    token_rows = spark.createDataFrame(
        [("1", "a", "c", None, ["the", "b", "the", "a", "b"]), ("1", "a", "c", None, ["b"]),
         ("1", "a", "c", None, ["b"]), ("1", "a", "c", None, ["the"]), ("2", None, None, None, ["la", "the"]),
         ("2", None, "c", "p", ["", "x", None]), ("2", None, "c", "p", None), ("3", None, "c", "p", [])],
        "id string, aspect string, category string, sentiment string, words array<string>")
    stop = spark.createDataFrame([("the",), ("la",), ("the",), (None,), ("unused",)], "stopword string")
    table = T.rebuild_clean_text(token_rows, stop, broadcast=broadcast)
    assert sorted(rows(table), key=str) == [("1", "b,b,b,a,b", "a", "c", None), ("2", ",x", None, "c", "p")]
    assert rows(table) == rows(T.rebuild_clean_text(token_rows, ["the", "la"]))
    # no word is sorted or grouped as a row of its own
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "posexplode" not in plan


def py_table_rows():
    return [(k[0], v, k[1], k[2], k[3]) for k, v in py_cleaned_table().items()]


def test_word_counts_and_top_words(token_rows):
    words = Counter(w for i, rev, a, c, s in py_table_rows() if a is not None and c is not None
                    for w in rev.split(","))
    assert dict(rows(T.word_count(token_rows, STOP))) == dict(words)
    top = sorted(words.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [tuple(r) for r in T.top_words(token_rows, STOP, 3).collect()] == top


@pytest.mark.parametrize("as_table", [False, True])
def test_row_counts(spark, token_rows, as_table):
    stop = spark.createDataFrame([(w,) for w in STOP], "stopword string") if as_table else STOP
    table = py_table_rows()
    keys = T.cleaned_keys(token_rows, stop)
    by_cat = Counter(c for i, _, a, c, s in table if a is not None and c is not None)
    by_asp = Counter(a for i, _, a, c, s in table if a is not None and c is not None)
    by_as = Counter((a, s) for i, _, a, c, s in table if a is not None and s is not None)
    assert dict(rows(T.count_rows_by(keys, "category"))) == dict(by_cat)
    assert dict(rows(T.count_rows_by(keys, "aspect"))) == dict(by_asp)
    got = {(r["aspect"], r["sentiment"]): r["total"]
           for r in T.count_by_aspect_sentiment(keys).collect()}
    assert got == dict(by_as)
    best_neg = sorted(((a, s, n) for (a, s), n in by_as.items() if s == "negative"),
                      key=lambda t: (-t[2], t[0]))[0]
    assert tuple(T.top_aspect(keys, "negative").first()) == best_neg


@pytest.mark.parametrize("sentiment", [None, "positive", "negative"])
def test_top_words_by_category(token_rows, sentiment):
    counts = Counter()
    for i, rev, a, c, s in py_table_rows():
        if c is None or (sentiment is not None and s != sentiment):
            continue
        for w in rev.split(","):
            counts[(c, w)] += 1
    expect = []
    for cat in sorted({c for c, _ in counts}):
        ranked = sorted(((w, n) for (c, w), n in counts.items() if c == cat),
                        key=lambda t: (-t[1], t[0]))[:2]
        expect += [(cat, w, n) for w, n in ranked]
    got = rows(T.top_words_by_category(token_rows, STOP, 2, sentiment), "category", "word", "freq")
    assert got == sorted(expect)


def test_cleaned_table_round_trip(spark, token_rows):
    table = T.rebuild_clean_text(token_rows, STOP)
    again = T.tokens_of_cleaned_table(table)
    assert rows(T.word_count(again, STOP)) == rows(T.word_count(token_rows, STOP))
