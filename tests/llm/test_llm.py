"""The training-data operators against brute force on small inputs with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import time
import weakref
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash

from tokenizers import Tokenizer

from tessera.llm import (blocks, decontam, html_text, line_quality, pieces, pii, ppm, queries,
                         repeats, simhash, token_count, toxicity)

WORD = re.compile("[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet " * 3000
PASSAGE = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, "The cat sat on the mat. " * 4), (2, None), (3, ""), (4, "  \t\n "), (5, LONG),
        (6, "x " + PASSAGE + " tail one"), (7, PASSAGE + " other end"), (8, "one two"),
        (9, "one two"), (9, "one two"), (None, "no id é ß 漢字 \U0001F600"),
        (10, " ".join(f"v{i}" for i in range(40)) + "  twice  spaced"),
        (11, "mail a.b@c.example.org, 10.0.0.1, +1 (269) 555-3296 and 4111 1111 1111 1111"),
        (12, " ".join(f"v{i}" for i in range(40)) + " twice spaced")]


@pytest.fixture(scope="module")
def docs(spark):
    # further columns, with names that the operators use themselves
    return spark.createDataFrame([(i, t, None, "s", 0, 1, "c") for i, t in ROWS],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long, fp long, chunk string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def want(rows):
    return sorted(rows, key=repr)


def low(text):
    return (text or "").encode().lower()


# ------------------------------------------------------------- 1 HTML text
@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>one", "one"), ("<p>a<b", "a"),
    ("<nav>a<nav>b</nav>c</nav>t", "t"),
    ("<div class='menu'><a href=x>Home</a></div><p>Main &amp; text</p><p>More\n here</p>"
     "<div id=comments><p>nice</p></div><footer>x</footer>", "Main & text\nMore here"),
    ("<div class=ad>open <article><h1>T</h1><p>Body</article><p>after</p>", "T\nBody"),
    *[(f"<div {name}><article><p>Keep A</p><p>Keep B</p></article></div>", "Keep A\nKeep B") for name in (
        "class='has-sidebar'", "class='content no-sidebar'", "id='page-header-wrapper'", "id='social-history'",
        "class=sidebar")],
    ("<div id='social-history'><p>Keep A</p></div>", "Keep A"),
    ("<div class='page sidebar'><p>Most of the page's text.</p></div><p>x</p>", "Most of the page's text.\nx"),
    ("<article><p>A</p><div class='search-tips'>B</div><div class='search-box'>no</div></article>", "A\nB"),
    ("<article><p class='share'>share<p>Keep B<p>Keep C</article>", "Keep B\nKeep C"),
    ("<p>Keep A</p><form>name <input><p>Keep B</p>", "Keep A\nKeep B"),
    ("<ul><li class='social'>x<li>Keep B</ul><p>Keep C</p>", "Keep B\nKeep C"),
    ("<p>foo<!-- x -->bar</p>", "foobar"), ("<p>a<!-- <nav> --> b", "a b"),
    ("<p>" + "Long text. " * 40 + "</p><div class='ad'>Buy</div><p>The end.</p>", "Long text. " * 39 + "Long text.\nThe end."),
    ("<p>same</p><nav>m</nav><p>same</p>", "same\nsame"),
    ("<p>" + "word " * 60000 + "</p>", "word " * 59999 + "word"),
    ("<script>var t='</p>';</script><main><p>x &lt;b&gt; y</p></main><aside>s</aside>", "x <b> y"),
    # a block of links apart from the text is a menu; beside it, short, or alone it is kept
    *[(f"<article><p>Keep A</p></div></div><div><div><ul>{items}</ul></article>", text) for items, text in (
        ("<li><a>x</a>" * 3, "Keep A"), ("<li><a>x</a>" * 2, "Keep A\nx\nx"),
        ("<li><a>x</a>" * 3 + "<li>Keep B", "Keep A\nx\nx\nx\nKeep B"))],
    ("<article><p>Keep A</p><ul>" + "<li><a>x</a>" * 4 + "</ul></article>", "Keep A" + "\nx" * 4),
    ("<article><h1><a>T</a></h1><ul>" + "<li><a>x</a>" * 4 + "</ul></article>", "T" + "\nx" * 4),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_main_texts_of_a_table(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x", 5), (1, "u", "<p>a</p>", "x", 5),
                                   (None, None, None, None, None)],
                                  "page_id long, url string, html string, text string, n_chars long")
    assert got(html_text.main_texts(pages), "page_id", "text", "n_chars") == want(
        [(1, "a", 1), (1, "a", 1), (None, "", 0)])
    assert html_text.main_texts(pages.where("false")).count() == 0


# ------------------------------------------------------- 2 decontamination
def brute_tiles(p, t, least):
    """Greedy tiling by trying every pair of positions; of equal runs the first in p, then in t."""
    up, ut, tiles = set(), {j for j, v in enumerate(t) if v < 0}, []
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while (i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k]
                       and i + k not in up and j + k not in ut):
                    k += 1
                best = max(best, (k, -i, -j))
        if best[0] < least:
            return tiles
        k, i, j = best[0], -best[1], -best[2]
        up |= set(range(i, i + k))
        ut |= set(range(j, j + k))
        tiles.append((i, j, k))


@pytest.mark.parametrize("words", [1, 2, 3, 9])
def test_greedy_tiles_against_all_pairs(words):
    rnd = random.Random(words)
    for least in [1, 2, 3, 4] * 40:
        p = [rnd.randrange(words) for _ in range(rnd.randrange(1, 22))]
        t = [rnd.choice([-1, *range(words)]) for _ in range(rnd.randrange(1, 30))] + p[3:9]
        assert decontam.greedy_tiles(p, t, least) == brute_tiles(p, t, least)


def test_tiling_of_repeated_tokens_costs_places_not_pairs():
    for cycle in ([5], [5, 6, 7]):
        begun = time.process_time()
        assert decontam.greedy_tiles(cycle * 900, cycle * 9000, 4) == [(0, 0, 900 * len(cycle))]
        assert time.process_time() - begun < 5      # pairs of places: minutes


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontam, "_MOD", 3)
    rnd = random.Random(1)
    for _ in range(60):
        p = [rnd.randrange(9) for _ in range(12)]
        t = [rnd.randrange(9) for _ in range(12)] + p[2:8]
        tiles = decontam.greedy_tiles(p, t, 2)
        assert all(p[i:i + k] == t[j:j + k] and k >= 2 for i, j, k in tiles)


def test_leaks_against_brute_force(spark):
    rnd = random.Random(8)
    some = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choice(some) for _ in range(rnd.randrange(1, 16)))) for i in range(12)]
    items += [(12, None), (13, ""), (14, items[3][1])]
    texts = []
    for i in range(60):
        words = [rnd.choice(some) for _ in range(rnd.randrange(0, 20))]
        for _ in range(rnd.randrange(3)):
            own = (rnd.choice(items[:12])[1]).split()
            cut = rnd.randrange(len(own))
            words += own[cut:] + own[:cut]
        texts.append((i, " ".join(words)))
    texts += [(60, None), (61, " ".join(some * 3000) + " " + items[5][1])]
    expect = []
    for d, text in texts[:61]:
        for i, item in items:
            t, p = (text or "").split(), (item or "").split()
            number = {w: n for n, w in enumerate(some)}
            tiles = brute_tiles([number[w] for w in p], [number[w] for w in t], min(4, len(p))) if p else []
            share = sum(k for *_, k in tiles) / len(p) if p else 0
            if share >= 0.5:
                expect.append((d, i, share, len(tiles), max(k for *_, k in tiles)))
    d = spark.createDataFrame([(i, t, "x", 0) for i, t in texts], "doc_id long, text string, item_id string, _text int")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.leaks(d, b)
    rows = got(found, "doc_id", "item_id", "coverage", "n_tiles", "longest")
    assert [r for r in rows if r[0] != 61] == want(expect) and any(r[:2] == (61, 5) for r in rows)


def test_leaks_are_found_also_reordered(spark):
    item = [f"q{i}" for i in range(20)]
    moved = " ".join(item[10:] + ["between"] + item[:10])
    d = spark.createDataFrame(
        [(1, "pre " + " ".join(item).upper() + " post"), (2, moved), (3, " ".join(item[:6])),
         (4, None), (5, ""), (1, "pre " + " ".join(item).upper() + " post"), (6, "tiny item")],
        "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "?!"), (10, "Tiny, item")],
                              "item_id long, text string")
    out = decontam.leaks(d, b)
    assert got(out, "doc_id", "item_id", "coverage") == want(
        [(1, 7, 1.0), (1, 7, 1.0), (2, 7, 1.0), (6, 10, 1.0)])
    assert sorted(r.doc_id for r in decontam.without_leaks(d, b).collect()) == [3, 4, 5]
    assert decontam.leaks(d, b.where("false")).count() == 0
    assert decontam.leaks(d.where("false"), b).count() == 0


def test_one_block_of_the_benchmark_is_held_at_a_time(spark, monkeypatch):
    alive, most, sizes, own = set(), [], [], decontam.Items.__init__

    def begin(self, ids, texts):
        own(self, ids, texts)
        sizes.append(sum(len(t) for t in texts))
        mark = object()
        alive.add(id(mark))
        weakref.finalize(self, lambda m=mark: alive.discard(id(m)))
        most.append(len(alive))

    item = " ".join(f"q{i}" for i in range(20))
    other = [" ".join(f"o{k}x{i}" for i in range(20)) for k in range(30)]
    d = spark.createDataFrame([(1, "pre " + item), (1, other[3]), (2, other[29]), (3, "clean text of words"),
                               (None, other[5]), (None, None)], "doc_id long, text string")
    b = spark.createDataFrame([(7, item)] * 40 + list(enumerate(other)), "item_id long, text string")
    once = [decontam.leaks(d, b), decontam.without_leaks(d, b)]
    once = [got(f, *f.columns) for f in once]
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 600)
    monkeypatch.setattr(decontam.Items, "__init__", begin)
    many = [decontam.leaks(d, b), decontam.without_leaks(d, b)]
    assert len(sizes) > 8 and max(sizes) < 600 + max(map(len, [item, *other]))
    assert max(most) == 1
    assert [got(f, *f.columns) for f in many] == once
    assert once[1] == want([(3, "clean text of words"), (None, None)]) and len(once[0]) == 43


# ------------------------------------------------------------ 3 token counts
def test_token_counts_equal_the_library(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rnd = random.Random(2)
    alphabet = ["a", "the", " ", "  ", "\n", "é", "12", "'s", " ", "<|endoftext|>", "!", "漢"]
    extra = [(100 + i, "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))))
             for i in range(300)]
    d = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string"))
    expect = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False)))
              for i, t in ROWS + extra]
    out = token_count.token_counts(d, path)
    assert got(out, "doc_id", "n_bytes", "n_tokens") == want(expect)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in out.collect())
    assert token_count.token_counts(empty, path).count() == 0


# ---------------------------------------------------------------- 4 PPM
def test_ppm_scores_against_brute_force(docs, empty):
    k_max = ppm.ORDER
    seen = [defaultdict(Counter) for _ in range(k_max + 1)]
    words = Counter()
    for i, t in ROWS:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            b = b"\xff" * k_max + low(t) + b"\xff"
            for j in range(k_max, len(b)):
                for k in range(k_max + 1):
                    seen[k][b[j - k:j]][b[j]] += 1
            words.update([*low(t).split(), None])
    n, v = sum(words.values()), len(words)

    def probability(context, s):
        out, gone = 0.0, set()
        for k in range(k_max, -1, -1):
            left = {a: c for a, c in seen[k].get(context[k_max - k:], {}).items() if a not in gone}
            if left:
                total = sum(left.values()) + len(left)
                if s in left:
                    return out + math.log10(left[s] / total)
                out += math.log10(len(left) / total)
                gone |= set(left)
        return out - math.log10(256 - len(gone))

    expect = []
    for i, t in ROWS:
        b = b"\xff" * k_max + low(t) + b"\xff"
        own = [*low(t).split(), None]
        expect.append((i, len(own), sum(w in words for w in own), n,
                       sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own),
                       sum(probability(b[j - k_max:j], b[j]) for j in range(k_max, len(b)))))
    out = got(ppm.scores(docs), "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for a, b in zip(out, want(expect)):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)
    assert ppm.scores(empty).count() == 0


# ------------------------------------------------------------ 5 SentencePiece
def test_pieces_against_dynamic_programming(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    p = pieces.load_pieces(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    vocabulary = {model.id_to_piece(i): i for i in range(model.vocab_size())
                  if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}

    def best(text):
        s = pieces.MARK + text.replace(" ", pieces.MARK)
        score = [0.0] + [-math.inf] * len(s)
        for i in range(len(s)):
            for k in range(1, min(17, len(s) - i + 1)):
                w = vocabulary.get(s[i:i + k])
                g = p.score[w] if w is not None else p.unknown if k == 1 else -math.inf
                score[i + k] = max(score[i + k], score[i] + g)
        return score[-1] if text else 0.0

    rnd = random.Random(3)
    texts = [t or "" for _, t in ROWS] + ["x" * 300, "a▁b"] + [
        "".join(rnd.choice("abc theionéß  \n漢1.") for _ in range(rnd.randrange(150)))
        for _ in range(150)]
    buf, off = blocks.buffer_of(pa.array(texts, pa.string()))
    ids, first, score = pieces.encode_rows(buf, off, p)
    assert score.tolist() == pytest.approx([best(t) for t in texts])
    assert pieces.decode_rows(ids, first, p) == [t.replace(pieces.MARK, " ") for t in texts]
    out = pieces.encode_and_check(docs, path).collect()
    assert len(out) == len(ROWS) and all(r.round_trip and len(r.ids) == r.n_pieces for r in out)
    assert pieces.encode_and_check(empty, path).count() == 0


def test_decoding_of_any_ids(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    e_acute = [model.piece_to_id("<0xC3>"), model.piece_to_id("<0xA9>")]
    rows = [(1, model.encode("Hello world")), (2, e_acute), (3, e_acute[:1]), (4, None), (5, []),
            (6, [1, 2, None, 10 ** 9])]
    d = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    assert got(pieces.decode(d, path), "doc_id", "text") == [
        (1, "Hello world"), (2, "é"), (3, "�"), (4, ""), (5, ""), (6, "")]


# ------------------------------------------------------------------ 6 SimHash
def fingerprint(text):
    w = [x.decode() for x in low(text).split()]
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42)
         for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(prints, radius=2):
    """Smallest label that each can reach, by all pairs."""
    root = {f: f for f in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    own = sorted(root)
    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= radius and top(a) != top(b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {f: top(f) for f in own}


def test_near_duplicates_against_all_pairs(docs, empty):
    prints = [(i, fingerprint(t)) for i, t in ROWS]
    root = groups({f for _, f in prints})
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[root[f]].append(i)
    expect = [(i, f"{f:016x}", min(least[root[f]], default=None)) for i, f in prints]
    assert got(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want(expect)
    assert simhash.near_duplicates(empty).count() == 0
    kept = [r.doc_id for r in simhash.one_of_each_group(docs).collect()]
    assert sorted(k for k in kept if k is not None) == sorted(
        {c for i, _, c in expect if i is not None}) and kept.count(None) == 1


def test_one_row_of_each_group_whatever_the_ids(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(5, x, "a"), (5, y, "a"), (1, z, "a"), (3, z, "b"), (3, z + " " + x, "b"), (3, z, "c"),
            (None, y + " " + z, "a"), (None, y + " " + z, "b"), (None, y + " " + z, "b"),
            (None, x, "a"), (7, None, "a"), (7, "", "a"), (None, None, "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [(r.doc_id, r.text or "") for r in simhash.one_of_each_group(d).collect()]
    assert sorted(kept, key=repr) == want(
        [(5, x), (5, y), (1, z), (3, z + " " + x), (None, y + " " + z), (7, "")])
    assert simhash.one_of_each_group(d.where("false")).count() == 0
    plan = simhash.one_of_each_group(d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2      # one before the shuffle


def test_links_join_what_all_pairs_join(spark, monkeypatch):
    rnd = random.Random(9)
    near = set()
    for _ in range(30):
        x = rnd.getrandbits(64)
        for _ in range(12):
            near.add(x)
            for _ in range(rnd.randrange(1, 4)):
                x ^= 1 << rnd.randrange(64)
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = groups(near)
    for most in (simhash.SHARD_ROWS, 3):      # 3: shards are divided again
        monkeypatch.setattr(simhash, "SHARD_ROWS", most)
        found = simhash.components(simhash.links(fps, spark), spark).collect()
        class_of = {r.node & (2 ** 64 - 1): r.root for r in found}
        for a in near:
            mates = {b for b in near if root[b] == root[a]}
            assert {b for b in near if b in class_of and class_of[b] == class_of.get(a)} == (
                mates if len(mates) > 1 else set())


def test_xxh64_of_every_length():
    raw = random.Random(1).randbytes(4000)
    start = np.arange(0, 3000, 11)
    size = np.arange(len(start)) % 260
    out = blocks.xxh64_spans(np.frombuffer(raw, np.uint8), start, size, 42)
    assert [int(x) for x in out] == [xxhash.xxh64_intdigest(raw[s:s + n], 42)
                                     for s, n in zip(start, size)]


# ------------------------------------------------------- 7 and 9, by their SQL
@pytest.mark.parametrize("name, run", [("op7_line_quality", line_quality.line_quality),
                                       ("op9_repeats", repeats.repeat_spans)])
def test_operators_equal_their_sql(spark, docs, empty, name, run):
    boiler = [(200 + i, f"shared line of host {i % 2}\nown text {i} " + "word " * (i % 70) + f"\n{PASSAGE} {i}")
              for i in range(60)]
    d = docs.unionByName(spark.createDataFrame(
        [(i, t, None, "h" if i % 3 else None, 0, 1, "c") for i, t in boiler], docs.schema))
    con = duckdb.connect()
    documents = pa.table({c: [r[c] for r in d.collect()] for c in ("doc_id", "text", "source")},
                         pa.schema([("doc_id", pa.int64()), ("text", pa.string()),
                                    ("source", pa.string())]))
    con.register("documents", documents)
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert Counter(tuple(r[c] for c in cols) for r in run(d).collect()) == Counter(cur.fetchall())
    assert run(empty).count() == 0


def test_texts_without_frequent_lines(spark):
    rows = [(i, f"Shared  Line {i}\n\n" + " ".join(chr(97 + i % 26) * (i + 1) + "abcdefghij"[k % 10] * k for k in range(60))
             + "\n shared line 7 ", "h" if i % 2 else None) for i in range(60)]
    rows += [rows[4], (100, "shared line 1", "h"), (101, "Shared line 1\nlone " + rows[0][1].split("\n")[2], "z"),
             (102, None, "h")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plain = line_quality.line_quality(d)
    full = line_quality.line_quality(d, keep_text=True)
    assert got(full, *plain.columns) == got(plain, *plain.columns) and "clean_text" not in plain.columns
    texts = {i: t for i, t, _ in rows}
    for r in full.collect():
        expect = "\n".join(texts[r.doc_id].split("\n")[1:3]) if r.doc_id < 60 else texts[r.doc_id]
        assert r.clean_text == (expect if r.kept else None)
        if r.kept:
            assert r.line_chars_removed == r.word_chars - len("".join(WORD.findall(r.clean_text)))
    assert sum(r.kept for r in full.collect()) == 62


def test_frequent_lines_of_hot_hosts_and_of_copies(spark):
    own = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"own {chr(97 + i % 26) * (1 + i // 26)} {own}" + ("\nwith kind regards" if i % 12 == 0 else ""), "hot") for i in range(480)]
    rows += [(1000 + i, "Copied whole " + own, "hot") for i in range(25)]         # copies are documents
    rows += [(2000 + i, f"alone {chr(97 + i)} {own}\nlast line" + "\nlast line" * (i % 2), "b") for i in range(19)]
    rows += [(3000, f"spread {own}\nwith kind regards", "c")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in line_quality.line_quality(d).collect()}
    regards = len("withkindregards")
    assert all(out[i].line_chars_removed == (regards if i % 12 == 0 else 0) and out[i].kept for i in range(480))
    assert all(out[1000 + i].line_chars_removed == out[1000 + i].word_chars and not out[1000 + i].kept
               for i in range(25))
    assert all(out[i].line_chars_removed == 0 for i in out if i >= 2000)       # 19 documents, one of another host
    # one document in a hundred is not reached, the absolute limit is
    far = line_quality.line_quality(d, one_in=2, max_docs=40).collect()
    assert {r.doc_id for r in far if r.line_chars_removed} == {i for i in range(480) if i % 12 == 0}


def thue_morse(k, a, b):
    """Two texts of 2^k symbols whose polynomial hashes of any odd base agree modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(1 << k)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def test_hashes_of_built_pairs_differ():
    for k in (5, 10, 11, 12):
        for x, y in (thue_morse(k, "a", "b"), thue_morse(k, "ab", "cd")):
            buf, off = blocks.buffer_of(pa.array([x, y]))
            h = blocks.span_hash(buf, off[:-1], off[1:])
            assert h[0] != h[1]
        words = np.array([blocks.span_hash(*blocks.buffer_of(pa.array([w]))[:1], np.array([0]), np.array([1]))[0]
                          for w in "ab"])
        p, q = (words[np.array([int(c) for c in t])] for t in thue_morse(k, "0", "1"))
        _, w = blocks.window_hash(np.concatenate((p, q)), np.array([0, len(p), 2 * len(p)]), len(p))
        assert len(w) == 2 and w[0] != w[1]


def test_window_hashes_depend_on_the_words_alone():
    rnd = np.random.default_rng(2)
    for k in (1, 2, 3, 4, 7, 18, 35, 64):
        h = rnd.integers(0, 3, 400).astype(np.uint64)
        h[200:200 + k + 20] = h[10:30 + k]
        first = np.array([0, 150, 150, 400])
        at, w = blocks.window_hash(h, first, k)
        assert at.tolist() == [i for a, b in ((0, 150), (150, 400)) for i in range(a, b - k + 1)]
        by = defaultdict(set)
        for i, x in zip(at.tolist(), w.tolist()):
            by[tuple(h[i:i + k].tolist())].add(x)
        assert all(len(v) == 1 for v in by.values()) and len(set(w.tolist())) == len(by)


def test_built_pairs_in_the_operators(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    common = " ".join(f"c{i}" for i in range(34))
    for k in (10, 11):
        x, y = thue_morse(k, "a", "b")
        d = spark.createDataFrame([(1, f"{x} {common}"), (2, f"{y} {common}")], "doc_id long, text string")
        assert [r.n_removed for r in repeats.repeat_spans(d).collect()] == [0, 0]
        assert all(r.round_trip for r in pieces.encode_and_check(d.coalesce(1), path).collect())
        items = spark.createDataFrame([(1, x)], "item_id long, text string")
        assert [r.doc_id for r in decontam.leaks(d.where("doc_id = 2"), items).collect()] == []
        own, other = [i for i in range(20) if not ppm.is_held_out(i)][0], [i for i in range(20) if ppm.is_held_out(i)][0]
        known = {r.doc_id: r.n_known for r in ppm.scores(spark.createDataFrame(
            [(own, x), (other, y)], "doc_id long, text string")).collect()}
        assert known == {own: 2, other: 1}       # the other word is not known, the end is


def test_segments_of_one_hash_are_kept_apart(spark, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    monkeypatch.setattr(pieces, "span_hash", lambda buf, start, end: np.zeros(len(start), np.uint64))
    p = pieces.load_pieces(path)
    texts = ["one two", "two one", "one one", "", " x ", "two"]
    buf, off = blocks.buffer_of(pa.array(texts))
    ids, first, _ = pieces.encode_rows(buf, off, p)
    assert pieces.decode_rows(ids, first, p) == texts


def test_kept_text_of_repeats(docs):
    for r in repeats.repeat_spans(docs, keep_text=True).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


# -------------------------------------------------------------------- 8 PII
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    for kind in pii.KINDS:
        for m in re.finditer(BASE[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip"
                else False, "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                    "phone": 9 <= len(digits) <= 15}[kind]:
                yield kind, *m.span()


def test_base_spans_against_the_patterns():
    rnd = random.Random(1)
    for _ in range(20000):
        text = "".join(rnd.choice("a1@.+- 05(9)%-4.@") for _ in range(rnd.randrange(60)))
        assert pii.base_spans(text) == list(brute_spans(text))


@pytest.mark.parametrize("text, found", [
    ("mail john.doe (at) example [dot] com now", "john.doe (at) example [dot] com"),
    ("write john at mail dot example dot com", "john at mail dot example dot com"),
    ("аdmin@exаmple.com ok", "аdmin@exаmple.com"),
    ("call plus one two six nine five five five three two nine six x",
     "plus one two six nine five five five three two nine six"),
    ("ip one nine two dot one six eight dot one dot five.", "one nine two dot one six eight dot one dot five"),
    ("max (at) firma punkt de", "max (at) firma punkt de"),
    ("+1 (269) 555-32​96 z", "+1 (269) 555-32​96"),
    ("we met at noon and the cat sat on one mat", None)])
def test_disguised_identifiers(text, found):
    base, spans = pii.find(text)
    extra = [text[a:b] for k, a, b in spans if (k, a, b) not in base]
    assert extra == ([found] if found else [])


@pytest.mark.parametrize("text, found", [
    ("x +1 four 1 five 5 five 5 zero 1 nine 9 y", "+1 four 1 five 5 five 5 zero 1 nine 9"),
    ("call +1 415 555 013 nine now", "+1 415 555 013 nine"),
    ("call +1 (415) five55-0139 now", "+1 (415) five55-0139"),
    ("card 4111 1111 one111 1111 x", "4111 1111 one111 1111"),
    ("ip 10.zero.0.1 x", "10.zero.0.1"), ("ip one92 dot 168 dot 0 dot 7 x", "one92 dot 168 dot 0 dot 7"),
    ("mail alice at example [dot] com x", "alice at example [dot] com"),
    ("mail alice at mail.example.com x", "alice at mail.example.com"),
    ("mail alice at mail dot example.com x", "alice at mail dot example.com"),
    ("mail alice @ example.com x", "alice @ example.com"),
    ("mail alice @example [dot] com x", "alice @example [dot] com"),
    ("call +1 4OO-555-O199 x", "+1 4OO-555-O199"), ("call +1 4OO-OOO-O199 x", "+1 4OO-OOO-O199"),
    ("card 4lll-llII-1I1l-llll x", "4lll-llII-1I1l-llll"), ("ip lO.O.O.1 x", "lO.O.O.1"),
    ("call @first.second or one 5 two 6", None), ("four 1 one 1 one 2 or 1999 one more", None),
    ("+1 (848) 555-1373 Un autre", None), ("call +1 848 un 555 1373", "+1 848 un 555 1373"),
    ("at 10.30 we met at noon. The six of 12 left", None), ("in 5 I saw 12 Oo and l1l", None)])
def test_disguised_identifiers_of_mixed_forms(text, found):
    base, spans = pii.find(text)
    assert [text[a:b] for k, a, b in spans if (k, a, b) not in base] == ([found] if found else [])


def test_no_sign_of_disguise_means_no_change():
    rnd = random.Random(6)
    parts = ["one", "five", "un", "5", "41", "O", "l", "I", "|", " ", " ", "-", ".", ",", " at ", "@", "dot",
             " dot ", "mail", "com", "+1", "[dot]", "(at)", "а", "plus"]
    for _ in range(20000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        if not pii.disguised(text):
            t = pii.normalise(text)
            changed = [s for s in pii.base_spans(t.text) if any(t.new[s[1]:s[2]])]
            base = pii.base_spans(text)
            assert all((k, t.span[a][0], t.span[b - 1][1]) in base for k, a, b in changed), text


@pytest.mark.parametrize("text", [
    "I bought it at amazon.com yesterday", "We met at work.The next day", "look at example.com",
    "available at shop.example.co.uk", "They laughed at me.So I left", "open at noon.de",
    "She works at Example.org. Good", "arrive at 10.30 at city.centre"])
def test_at_before_a_domain_is_no_address(text):
    assert pii.find(text) == ([], []) and pii.redact(text, pii.find(text)[1]) == text


@pytest.mark.parametrize("text, found", [
    ("reach me: alice at example.com", "alice at example.com"), ("alice.b at example.com", "alice.b at example.com"),
    ("bob77 at example.org said", "bob77 at example.org"), ("Contact our team, carol at firm.de", "carol at firm.de"),
    ("dave at example dot com", "dave at example dot com")])
def test_at_before_a_domain_with_a_second_sign(text, found):
    assert [text[a:b] for _, a, b in pii.find(text)[1]] == [found]


def test_long_white_space_takes_time_in_proportion():
    took = []
    for n in (20000, 160000):
        begin = time.perf_counter()
        for gap in (" ", "\n", " \t"):
            pii.find("a (at) b [dot] com" + gap * n + "(at)" + gap * n + "x dot" + gap * n + "y")
        took.append(time.perf_counter() - begin)
    assert took[1] < 30 * took[0]      # eight times the text; sixty-four times if quadratic


def test_long_unbroken_texts_are_searched_in_one_pass():
    for text in ("x" * 200000 + " at y.z", "a at " + "b." * 100000 + "1", "4O" * 100000 + "x", "O-" * 100000):
        pii.find(text)


def test_personal_data_of_a_table(docs, empty):
    out = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert (out[11].n_email, out[11].n_ip, out[11].n_card, out[11].n_phone) == (1, 1, 1, 1)
    assert out[2].spans == "" and pii.personal_data(empty).count() == 0
    clean = {r.doc_id: r for r in pii.without_personal_data(docs).collect()}
    assert clean[11].text == "mail [EMAIL], [IP], [PHONE] and [CARD]"
    assert clean[2].text is None and clean[11].n_chars == len(clean[11].text)


# --------------------------------------------------------------- 10 toxicity
def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(4)
    plain = ["".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randrange(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(1200):
        words = [rnd.choice(plain) for _ in range(rnd.randrange(5, 60))]
        bad = i % 6 == 0
        if bad:
            words[rnd.randrange(len(words))] = rnd.choice(["grumph", "zorkling", "zorkled", "You grumph"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(5000, None), (5001, ""), (None, "a b"), (0, rows[0][1])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(7000, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(d, lab).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [(r.predicted, dict(labels)[r.doc_id]) for r in out
            if r.held_out and r.doc_id is not None and r.doc_id < 1200]
    assert len(held) > 200 and sum(p == y for p, y in held) / len(held) > 0.95
    none = toxicity.toxicity(d, lab.where("false"))
    assert {r.score for r in none.collect()} == {0.0}
    assert toxicity.toxicity(d.where("false"), lab).count() == 0
    assert toxicity.without_toxic(d, lab).columns == d.columns
    clash = d.selectExpr("*", "1 weight", "2D score", "'x' rate", "3 hits", "4 vector", "5 probability",
                         "6 prediction", "7 `a b`", "8 `__row`", "9 toxic", "10 part")
    kept = toxicity.without_toxic(clash, lab)
    assert kept.columns == clash.columns
    bad = {r.doc_id for r in out if r.predicted}
    assert {r.doc_id for r in kept.collect()} >= {r.doc_id for r in out if r.doc_id not in bad and r.doc_id}
    assert all(tuple(r)[2:] == (1, 2.0, "x", 3, 4, 5, 6, 7, 8, 9, 10) for r in kept.collect())


def test_stages_keep_columns_of_clashing_names(spark):
    words = " ".join(f"w{i}" for i in range(40))
    d = spark.createDataFrame([(1, words, "r", "k", "t", 1), (2, words, "r", "k", "t", 1), (3, "other text", "r", "k", "t", 1)],
                              "doc_id long, text string, _row string, _key string, _text string, row int")
    for out, ids in ((simhash.one_of_each_group(d), [1, 3]),
                     (decontam.without_leaks(d, spark.createDataFrame([(1, words)], "item_id long, text string")), [3])):
        assert out.columns == d.columns
        assert sorted(r.doc_id for r in out.collect()) == ids
        assert {tuple(r)[2:] for r in out.collect()} == {("r", "k", "t", 1)}


def test_toxic_features_against_plain_counts(spark):
    terms = ["grumph", "zork"]
    lexicon = toxicity.Lexicon(toxicity._text_hash([t.encode() for t in terms]).view(np.int64).tolist(),
                               [2.0, 3.0], [True, False])
    texts = ["", "GRUMPH you fool!!", "a calm text, with words.", "zork zork grumph", "you are far from it all today grumph"]
    raw = pa.array(texts)
    f = np.concatenate([toxicity.features_of(*s, lexicon) for s in toxicity._slices(raw)])
    of = {k: f[:, i] for i, k in enumerate(toxicity.FEATURES)}
    for i, t in enumerate(texts):
        own = re.findall("[A-Za-z]+", t)
        low = [w.lower() for w in own]
        n = max(1, len(own))
        assert of["hits"][i] == low.count("grumph") and of["weak_hits"][i] == low.count("zork")
        assert of["hit_density"][i] == pytest.approx(low.count("grumph") / n)
        assert of["top_weight"][i] == max([0, *(2 * (w == "grumph") + 3 * (w == "zork") for w in low)])
        assert of["second_person"][i] == pytest.approx(low.count("you") / n)
        assert of["capitals"][i] == pytest.approx(sum(c.isupper() for c in t) / max(1, len(t)))
        assert of["shouts"][i] == pytest.approx(sum(c in "!?" for c in t) / max(1, len(t)))
        assert of["log_words"][i] == pytest.approx(math.log1p(len(own)))
    assert of["near_second_person"].tolist() == [0, 1, 0, 0, 0]



# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_keep_their_contract(spark, sf_small):
    import corpus_pipeline as c
    from tessera.sources.tables import load

    docs = load(spark, sf_small, "documents")
    benchmark = load(spark, sf_small, "benchmark")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in c.STAGES:
        out = stage(spark, docs, sf_small).cache()
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left <= ids
        if name == "near_duplicates":
            found = simhash.near_duplicates(docs).collect()
            assert left == {r.component_id for r in found}
        if name == "decontamination":
            assert ids - left == {r.doc_id for r in decontam.leaks(docs, benchmark).collect()}
        if name == "personal_data":
            assert left == ids and not any(
                pii.base_spans(r.text or "") for r in out.collect())
        if name != "encoding":
            assert out.columns == columns
        else:
            assert left == ids and all(r.round_trip for r in out.collect())
        docs, ids = out, left
