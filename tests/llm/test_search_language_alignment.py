"""Lexical search, language identification and tokenizer alignment against
brute force, on small inputs with nulls, empty and long texts, ties, repeated
rows, empty tables and columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tessera.llm import alignment, blocks, language, lexical, queries

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ------------------------------------------------------------ 11 lexical search
def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute_search(docs, items, k=10):
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, length = len(own), sum(x for _, _, x in own)
    df = Counter(t for _, c, _ in own for t in c)
    for item, text in items:
        found = []
        for i, c, size in own:
            m = 10 + (90 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i, s))
        for rank, (_, _, i, s) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1):
            yield item, rank, i, s


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2, "x", 3.0) for i, t in docs],
                              "doc_id long, text string, rank int, term long, at string, score double")
    q = spark.createDataFrame([(i, t, 7, 8) for i, t in items],
                              "item_id long, text string, doc_id long, rank int")
    return d, q


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 4))) for _ in range(60)]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 50)))) for i in range(150)]
    docs += [(1000 + i, "Tie-breaking Words, here") for i in range(40)]
    docs += [(5, "tie words"), (5, "tie words"), (None, "Tie-breaking Words, here"), (200, None), (201, ""),
             (202, " .,;\x00 "), (203, "tie " + "long text of many words " * 4000), (204, "É漢字 ÉCOLE 1a")]
    items = [(1, "tie WORDS words"), (1, "tie WORDS words"), (2, None), (3, "?!"), (4, "no-such-term zzz"),
             (None, docs[3][1]), (6, "École É漢字 1A"), (7, " ".join(words)), (8, "here")]
    return docs, items


def test_search_against_brute_force(spark, corpus):
    docs, items = corpus
    d, q = tables(spark, docs, items)
    expect = sorted(brute_search(docs, items), key=repr)
    out = lexical.search(d, q)
    assert got(out, "item_id", "rank", "doc_id", "score") == expect
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(d, q.where("false")).count() == 0
    assert lexical.search(d.where("false"), q).count() == 0
    assert lexical.search(d.where("text IS NULL"), q).count() == 0


def test_search_in_small_blocks_and_tiles(spark, corpus, monkeypatch):
    docs, items = corpus
    d, q = tables(spark, docs, items)
    monkeypatch.setattr(lexical, "TILE_ITEMS", 2)
    monkeypatch.setattr(lexical, "TILE_TERMS", 3)
    monkeypatch.setattr(lexical, "TILE_DOCS", 4)
    out = lexical.search(d, q, k=3, block_bytes=100)
    assert got(out, "item_id", "rank", "doc_id", "score") == sorted(brute_search(docs, items, 3), key=repr)


def test_runs_of_terms_stay_exact(monkeypatch):
    weight = np.full(1000, 10 ** 8)
    runs = list(lexical.exact_runs(weight))
    assert [a for a, _ in runs] == [0, *[b for _, b in runs][:-1]] and runs[-1][1] == 1000
    assert all(weight[a:b].sum() * lexical.IMPACT_BOUND < lexical.EXACT for a, b in runs)
    assert len(runs) > 10 and max(b - a for a, b in lexical.exact_runs(np.ones(10000, int))) == lexical.TILE_TERMS


def test_tile_top_keeps_all_ties():
    score = np.array([[5, 9, 5, 5, 0, 5], [0, 0, 0, 0, 0, 0], [1, 2, 3, 4, 5, 6]])
    item, doc, s = lexical.best_of(score, np.array([9, 8, 3, 7, 1, 2]), 3)
    assert list(zip(item, doc, s)) == [(0, 8, 9), (0, 2, 5), (0, 3, 5), (2, 2, 6), (2, 1, 5), (2, 7, 4)]


def test_search_equals_its_sql(spark, corpus):
    docs, items = corpus
    d, q = tables(spark, docs, items)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()),
                                        "text": pa.array([t for _, t in docs], pa.string())}))
    con.register("benchmark", pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()),
                                        "text": pa.array([t for _, t in items], pa.string())}))
    cur = con.execute(queries.ORACLE_SQL["op11_lexical_search"])
    cols = [c[0] for c in cur.description]
    assert Counter(tuple(r[c] for c in cols) for r in lexical.search(d, q).collect()) == Counter(cur.fetchall())


# --------------------------------------------------------------- 12 language
def brute_grams(text):
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    low = re.sub(" +", " ", f" {low} ")
    return Counter(low[i:i + n] for n in language.GRAMS for i in range(len(low) - n + 1)) if low != " " else Counter()


def brute_bucket(gram):
    code = 0
    for c in gram:
        code = ((code ^ ord(c)) * 0x9E3779B97F4A7C15) % (1 << 64)
        code ^= code >> 29
    return (code >> 7) % language.BUCKETS


TEXTS = ["", " ", "a", "Ab", "12 !!", "Der Hund, der Hund!", "éÉß漢字 İ x", "a\n\nb  c", "ab " * 5000, "Z9z"]


def test_grams_against_brute_force():
    buf, off = blocks.buffer_of(pa.array(TEXTS, pa.string()))
    per_row = [Counter() for _ in TEXTS]
    for row, bucket in language.grams(buf, off):
        for r, b in zip(row.tolist(), bucket.tolist()):
            per_row[r][b] += 1
    for text, found in zip(TEXTS, per_row):
        expect = Counter()
        for g, k in brute_grams(text).items():
            expect[brute_bucket(g)] += k
        assert found == expect
    assert language.lettered(buf, off).tolist() == [any(c.isalpha() for c in t) for t in TEXTS]
    # a row's n-grams do not depend on its neighbours
    for text, found in zip(TEXTS, per_row):
        one = Counter(b for _, bucket in language.grams(*blocks.buffer_of(pa.array([text])))
                      for b in bucket.tolist())
        assert one == found


def test_document_frequencies_and_logits(spark):
    rows = [(t,) for t in TEXTS + [None, "der Hund"]]
    n, df = language.document_frequencies(spark.createDataFrame(rows, "text string"))
    expect = Counter()
    for (t,) in rows:
        buf, off = blocks.buffer_of(pa.array([t or ""]))
        expect.update({b for _, bucket in language.grams(buf, off) for b in bucket.tolist()})
    assert n == len(rows) and {i: int(df[i]) for i in np.flatnonzero(df)} == dict(expect)
    # a document's logits are the product of its TF-IDF features and the weights
    rnd = np.random.default_rng(3)
    w = rnd.normal(size=(language.BUCKETS, 3))
    idf = np.log((1 + n) / (1 + df)) + 1
    model = language.Model(["a", "b", "c"], idf, w, 1.0)
    buf, off = blocks.buffer_of(pa.array(TEXTS))
    first, at, n = language.counted(buf, off)
    rows = [language.unpacked(language.packed(at[a:b], n[a:b]), idf) for a, b in zip(first[:-1], first[1:])]
    assert all(x.sum() == pytest.approx((language.SCALE * k / k.sum() * idf[b]).sum()) for (b, x), k in zip(
        rows, (n[a:b] for a, b in zip(first[:-1], first[1:]))) if len(b))
    direct = [x @ w[b] for b, x in rows]
    assert model.logits(buf, off) == pytest.approx(np.array(direct), abs=1e-9)


def test_ftrl_against_the_plain_rule():
    rnd = random.Random(5)
    state = language.Ftrl(np.zeros((language.BUCKETS, 2)), np.zeros((language.BUCKETS, 2)))
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        if abs(z[k]) <= language.L1:
            return 0.0
        return -(z[k] - math.copysign(language.L1, z[k])) / (
            (language.BETA + math.sqrt(n[k])) / language.ALPHA + language.L2)

    for _ in range(200):
        at = sorted(rnd.sample(range(20), 5))
        x = [rnd.random() for _ in at]
        label = int(at[0] < 4)
        state.learn(np.array(at), np.array(x), label)
        logits = [sum(v * weight((i, c)) for i, v in zip(at, x)) for c in range(2)]
        e = [math.exp(v - max(logits)) for v in logits]
        old = {(i, c): weight((i, c)) for i in at for c in range(2)}
        for i, v in zip(at, x):
            for c in range(2):
                g = v * (e[c] / sum(e) - (c == label))
                z[i, c] += g - (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / language.ALPHA * old[i, c]
                n[i, c] += g * g
    for i in range(20):
        for c in range(2):
            assert state.weights()[i, c] == pytest.approx(weight((i, c)), abs=1e-12)
    assert not state.weights()[20:].any()


def test_language_on_held_out_rows(spark):
    rnd = random.Random(8)
    sounds = {"xx": "ba be bi bo".split(), "yy": "kla kle kli".split(), "zz": "šu šo ša".split()}
    rows = [(i, " ".join("".join(rnd.choice(sounds[k]) for _ in range(3)) for _ in range(rnd.randrange(1, 30))), k)
            for i in range(400) for k in [rnd.choice(list(sounds))]]
    extra = [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 !", "zz"), (None, "kla kle", "yy"), (0, *rows[0][1:]),
             (1003, "BABE " * 30000, None), (1004, "kla", None)]
    d = spark.createDataFrame([(*r, "s", 1, 0.5, 2) for r in rows + extra],
                              "doc_id long, text string, lang string, source string, place int, score double, label int")
    out = language.language(d)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = out.collect()
    assert len(found) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in found}
    for r in found:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == "xx" and by_id[1004].lang_pred == "yy" and by_id[None].lang_pred == "yy"
    held = [by_id[i].lang_pred == k for i, _, k in rows if by_id[i].held_out]
    assert len(held) > 50 and sum(held) >= 0.97 * len(held)
    # the same rows dealt otherwise give the same model
    again = language.language(d.repartition(5)).collect()
    assert {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in again} == \
        {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in found}
    one = language.language(d.where("lang = 'xx' OR lang IS NULL")).collect()
    assert {r.lang_pred for r in one} == {"xx", "und"} and {r.score for r in one} == {0.0, 1.0}
    none = language.language(d.withColumn("lang", d.lang.substr(1, 0)).where("lang <> ''")).collect()
    assert none == [] and language.language(d.where("false")).count() == 0
    nothing = language.predict(d, language.train(d.where("lang IS NULL"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


# -------------------------------------------------------------- 13 alignment
@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(PATH_A, PATH_B)


def brute_alignment(t, text):
    if not text:
        return None
    a = t.a.encode(" " + text, add_special_tokens=False).ids
    b = t.b.encode(text)
    words = [t.spell_a.words[i] for i in a], [t.spell_b.words[i] for i in b]
    raw = (" " + text).encode()
    if any(b"".join(w) != raw for w in words):
        return None
    spans = []
    for w in words:
        end = np.cumsum([len(x) for x in w]).tolist()
        spans.append(list(zip([0, *end[:-1]], end)))
    both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups = [",".join(str(i) for i, (s, e) in zip(a, spans[0]) if lo <= s and e <= hi) + "|"
              + ",".join(str(i) for i, (s, e) in zip(b, spans[1]) if lo <= s and e <= hi)
              for lo, hi in zip([0, *both[:-1]], both)]
    links, j = [], 0
    for i, (s, e) in zip(a, spans[0]):
        links += [(i, k) for k, (u, v) in zip(b, spans[1]) if u < e and v > s]
    return len(a), len(b), groups, links


def brute_table(t, rows):
    own = [(i, brute_alignment(t, x)) for i, x in rows]
    count = Counter(p for _, x in own if x for p in set(x[3]))
    best = defaultdict(int)
    for (a, _), c in count.items():
        best[a] = max(best[a], c)
    return sorted(((i, 0, 0, 0, 0, 0, 0, "") if x is None else (
        i, x[0], x[1], len(x[2]), len(x[3]), sum(count[p] == best[p[0]] for p in x[3]),
        sum(count[p] for p in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest())
        for i, x in own), key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignment_rows():
    rnd = random.Random(13)
    alphabet = ["a", "the", " ", "  ", "\n", "é", "12", "'s", " ", "<|endoftext|>", "<s>", "!", "漢", "▁", "ing",
                "aaaa", "\t", " ", "\U0001F600", "\r\n", "Zürich ", "<0x41>", "\x00"]
    rows = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 40)))) for i in range(250)]
    return rows + [(300, None), (301, ""), (302, " "), (303, "   "), (304, "a "), (305, "marked ▁ text"),
                   (None, "no id here"), (1, rows[1][1]), (1, "another text"), (306, "the same words again " * 400),
                   (307, "x" * 2000), (308, "hello world"), (309, "hello world")]


def test_alignment_against_brute_force(spark, tokenizers):
    rows = alignment_rows()
    d = spark.createDataFrame([(i, x, 1, 2, "p", 3) for i, x in rows],
                              "doc_id long, text string, chunk long, n_a long, pairs string, a long")
    out = alignment.alignment(d, PATH_A, PATH_B)
    assert out.columns == list(COLUMNS)
    assert got(out, *COLUMNS) == brute_table(tokenizers, rows)
    assert alignment.alignment(d.where("false"), PATH_A, PATH_B).count() == 0
    assert got(alignment.alignment(d.where("text IS NULL"), PATH_A, PATH_B), *COLUMNS) == [
        (300, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_over_many_small_chunks(spark, tokenizers, monkeypatch):
    rows = alignment_rows()
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 500)
    monkeypatch.setattr(alignment, "CACHE_PARTS", 40)
    monkeypatch.setattr(alignment, "LEARN_BYTES", 60)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(alignment.alignment(d, PATH_A, PATH_B), *COLUMNS) == brute_table(tokenizers, rows)


def test_only_pairs_off_the_map_are_shuffled(spark, tokenizers):
    d = spark.createDataFrame([(1, "the house of the cat"), (2, "the the")], "doc_id long, text string")
    row = alignment._chunks(d.coalesce(1), PATH_A, PATH_B).collect()[0]
    width = len(tokenizers.spell_b.words)
    for pair in row.pairs:
        assert tokenizers.same[pair // width] != pair % width
    the = tokenizers.a.encode(" the", add_special_tokens=False).ids[0]
    assert dict(zip(row.same, row.same_held))[the] == 2


def test_decimals_of_ids():
    ids = np.array([0, 9, 10, 99, 100, 50256, 7])
    digits, end = alignment.decimals(ids, np.full(len(ids), ord(",")))
    assert digits.tobytes() == b"0,9,10,99,100,50256,7," and end[-1] == len(digits)
