"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces come from a public SentencePiece model file, which is read and never
trained.  That file's scores are merge ranks, so the log score of a piece is
that of its rank under Zipf's law, -ln(rank + 2) - ln(sum of 1 / (rank + 2)).
A character that no piece covers costs the lowest score less ``UNKNOWN`` and is
written as its UTF-8 bytes (byte fallback).  As in the library, a space is the
marker U+2581 and one marker is put before the text.

No piece has a marker after another character, so the best path of a text is
made of those of its segments, a run of markers with the word after it.  Each
distinct segment of a slice is matched against the trie at all positions at
once and solved once; paths of like offset are extended together.

Decoding joins the pieces, turns markers into spaces, bytes into characters
(invalid ones into U+FFFD), drops the space of the first marker, and skips
control pieces; the unknown piece reads " \\u2047 ".

Defined results: null and empty texts have no pieces and decode to the empty
text; of equal paths the one whose last piece is longest wins; a marker
character in a text reads as a space after the round trip; rows of equal
doc_id are encoded one by one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import (U64, as_strings, bound_tables, bounded_batches, buffer_of, mix,
                                row_slices, slices_of, span_hash, words_of)

MARK = "▁"
UNKNOWN = 10.0
LONG = 96                  # segments of more bytes are solved one by one
SLICE_BYTES = 4 << 20      # text whose distinct segments are solved once
SOLVE_BYTES = 1 << 19      # segments solved at a time
_MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)
#: bytes of the character that a leading byte begins
_LEAD = np.where(np.arange(256) < 0x80, 1, np.where(np.arange(256) < 0xE0, 2, np.where(
    np.arange(256) < 0xF0, 3, 4)))
_ONLY_SPACE = np.zeros(256, bool)
_ONLY_SPACE[0x20] = True


@dataclass
class Pieces:
    """The pieces as arrays: trie (base, check, piece at each node), scores and surfaces."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    unknown: float
    byte_id: np.ndarray
    surface: np.ndarray
    surface_off: np.ndarray


def build_trie(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Double-array trie of distinct keys: the child of node s by byte c is
    t = base[s] + c + 1 where check[t] = s; ``piece[t]`` is the key's value or -1."""
    children: list[dict[int, int]] = [{}]
    value = [-1]
    for key, v in keys:
        s = 0
        for c in key:
            if c not in children[s]:
                children[s][c] = len(children)
                children.append({})
                value.append(-1)
            s = children[s][c]
        value[s] = v
    # nodes of many children first, while there is room; single children fill the gaps
    size = 4 * len(children) + 4096
    taken = np.zeros(size, bool)
    taken[0] = True
    first_cell = np.zeros(len(children), np.int64)      # base of each node
    place = np.zeros(len(children), np.int64)           # cell of each node; the root's is 0
    free, block, tried = 1, 1024, {}      # tried: where nodes of as many children last fitted
    for s in sorted(range(len(children)), key=lambda s: -len(children[s])):
        if not children[s]:
            break
        codes = np.sort(np.array(list(children[s]))) + 1
        if len(taken) - free < 65536:
            taken = np.append(taken, np.zeros(size, bool))
        while taken[free]:
            free += 1
        at = max(free, tried.get(len(codes), 0))
        while True:
            cells = at + np.flatnonzero(~taken[at:at + block])
            cells = cells[cells >= codes[0]]
            fit = ~taken[(cells - codes[0])[:, None] + codes].any(axis=1)
            if fit.any():
                first_cell[s] = cells[np.argmax(fit)] - codes[0]
                break
            at += block
        tried[len(codes)] = at
        taken[first_cell[s] + codes] = True
        for c, child in children[s].items():
            place[child] = first_cell[s] + c + 1
    end = int(np.flatnonzero(taken)[-1]) + 300     # any byte from any node stays inside
    base, check, piece = np.zeros(end, np.int32), np.full(end, -1, np.int32), np.full(end, -1, np.int32)
    base[place] = first_cell
    piece[place] = value
    for s, own in enumerate(children):
        for child in own.values():
            check[place[child]] = place[s]
    return base, check, piece


def load_pieces(path: str) -> Pieces:
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    rank = np.zeros(n)
    keys, surfaces, byte_id = [], [], np.zeros(256, np.int32)
    for i in range(n):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_id[int(text[3:-1], 16)] = i
            surfaces.append(bytes([int(text[3:-1], 16)]))
        elif model.is_unknown(i):
            surfaces.append(" ⁇ ".encode())
        elif model.is_control(i):
            surfaces.append(b"")
        else:
            keys.append((text.encode(), i))
            rank[i] = -model.get_score(i)
            surfaces.append(text.replace(MARK, " ").encode())
    if any(MARK in k.decode().lstrip(MARK) for k, _ in keys):
        raise ValueError("a piece has a marker after another character: segments cannot be solved apart")
    if max((len(k) for k, _ in keys), default=0) >= 64:
        raise ValueError("a piece of 64 bytes or more: its length does not fit the search's keys")
    own = np.array([i for _, i in keys])
    score = np.zeros(n)
    score[own] = -np.log(rank[own] + 2) - math.log((1 / (rank[own] + 2)).sum())
    return Pieces(*build_trie(keys), score, float(score[own].min()) - UNKNOWN, byte_id,
                  np.frombuffer(b"".join(surfaces), np.uint8),
                  np.concatenate(([0], np.cumsum([len(s) for s in surfaces]))).astype(np.int64))


def _matches(buf: np.ndarray, end: np.ndarray, p: Pieces):
    """(start, length, piece) of every piece, and of every character that is none (piece -1).

    ``end[i]`` is the end of the segment that byte i is in.
    """
    at = np.flatnonzero((buf & 0xC0) != 0x80).astype(np.int32)
    width = np.diff(np.append(at, len(buf)))
    alone = np.zeros(len(buf) + 1, bool)           # characters that are pieces
    starts, lengths, found = [], [], []
    here, room, node = at, end[at] - at, np.zeros(len(at), np.int32)
    code = buf.astype(np.int32) + 1
    depth = 0
    while len(here):
        to = p.base[node] + code[here + depth]
        depth += 1
        ok = np.flatnonzero(p.check[to] == node)
        here, room, node = here[ok], room[ok], to[ok]
        piece = p.piece[node]
        hit = np.flatnonzero(piece >= 0)
        starts.append(here[hit])
        lengths.append(np.full(len(hit), depth, np.int32))
        found.append(piece[hit])
        if depth <= 4:
            alone[here[hit]] |= _LEAD[buf[here[hit]]] == depth
        ok = np.flatnonzero(room > depth)
        here, room, node = here[ok], room[ok], node[ok]
    lost = np.flatnonzero(~alone[at])
    starts.append(at[lost])
    lengths.append(width[lost].astype(np.int32))
    found.append(np.full(len(lost), -1, np.int32))
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(found)


def segment(buf: np.ndarray, off: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best paths of segments: (piece ids, offsets of each segment's ids, scores)."""
    n = len(off) - 1
    size = np.diff(off)
    start, length, piece = _matches(buf, np.repeat(off[1:], size).astype(np.int32), p)
    # best[i]: score of the best path to byte boundary i of its segment (one more cell each)
    seg_of = np.repeat(np.arange(n, dtype=np.int32), size)
    cell = off[:-1] + np.arange(n)
    best = np.full(len(buf) + n, -np.inf)
    best[cell] = 0.0
    back = np.zeros(len(best), np.int32)
    step = np.zeros(len(best), np.int32)
    seg = seg_of[start]
    source = start + seg
    offset = start - off[:-1].astype(np.int32)[seg]
    gain = np.append(p.score, p.unknown)       # piece -1 reads the last one
    if size.max(initial=0) > LONG:
        long = np.flatnonzero(size[seg] > LONG)
        long = long[np.lexsort((length[long], start[long]))]
        value: dict[int, tuple[float, int, int]] = {}
        for s, k, w in zip(source[long].tolist(), length[long].tolist(), piece[long].tolist()):
            total = (value[s][0] if s in value else 0.0) + gain[w]
            if s + k not in value or total > value[s + k][0]:
                value[s + k] = (total, w, k)
        where = np.array(list(value), np.int64)
        best[where] = [v[0] for v in value.values()]
        back[where] = [v[1] for v in value.values()]
        step[where] = [v[2] for v in value.values()]
        short = size[seg] <= LONG
        source, offset, length, piece = source[short], offset[short], length[short], piece[short]
    # like offset and length: at most one match for each segment, so plain assignment is safe
    key = (offset * 64 + length).astype(np.uint16)
    order = np.argsort(key, kind="stable")
    source, length, piece, key = source[order], length[order], piece[order], key[order]
    cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)])) \
        if len(key) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        s = source[a:b]
        t = s + length[a]
        total = best[s] + gain[piece[a:b]]
        # later pieces that end here start later and are shorter: a tie keeps the longer
        win = np.flatnonzero(total > best[t])
        t = t[win]
        best[t], back[t], step[t] = total[win], piece[a:b][win], length[a]
    # walk back from the end of every segment at once
    at = cell + size
    score = best[at]
    live = np.flatnonzero(size > 0)
    at = at[live]
    segs, pieces, ends, lens = [], [], [], []
    while len(live):
        segs.append(live)
        pieces.append(back[at])
        lens.append(step[at])
        ends.append(at)
        at = at - step[at]
        more = at > cell[live]
        live, at = live[more], at[more]
    if not segs:
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64), score
    segs, pieces, ends, lens = (np.concatenate(a) for a in (segs, pieces, ends, lens))
    order = np.argsort(ends, kind="stable")        # cells ascend through the segments
    segs, pieces, ends, lens = segs[order], pieces[order], ends[order], lens[order]
    count = np.where(pieces >= 0, 1, lens)
    first = np.concatenate(([0], np.cumsum(count)))
    ids = np.repeat(pieces, count).astype(np.int32)
    for k in np.flatnonzero(pieces < 0).tolist():
        b = ends[k] - segs[k]
        ids[first[k]:first[k + 1]] = p.byte_id[buf[b - lens[k]:b]]
    per = np.bincount(segs, weights=count, minlength=n).astype(np.int64)
    return ids, np.concatenate(([0], np.cumsum(per))), score


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... of each range, one after the other."""
    total = np.concatenate(([0], np.cumsum(count)))
    return np.arange(total[-1]) + np.repeat(begin - total[:-1], count)


def _kept_apart(buf, start, end, marks, one, which):
    """Distinct segments and their numbers, those apart whose bytes differ under one hash."""
    size = end - start
    like = one[which]
    same = (size == size[like]) & (marks == marks[like])
    again = np.flatnonzero(same & (like != np.arange(len(like))))
    unlike = buf[_ranges(start[again], size[again])] != buf[_ranges(start[like[again]], size[again])]
    if unlike.any():
        same[np.repeat(again, size[again])[unlike]] = False
    apart = np.flatnonzero(~same)
    if len(apart):
        which = which.copy()
        which[apart] = len(one) + np.arange(len(apart))
        one = np.concatenate((one, apart))
    return one, which


def encode_rows(buf: np.ndarray, off: np.ndarray, p: Pieces):
    """(ids, offsets of each row's ids, log score of each row) of a slice."""
    rows = len(off) - 1
    w = words_of(buf, off, _ONLY_SPACE)
    row = w.row_of()
    head = np.zeros(len(w.start), bool)
    head[w.first[:-1][w.counts > 0]] = True
    before = np.concatenate(([0], w.end[:-1])) if len(w.end) else w.end
    marks = np.where(head, w.start - off[row] + 1, w.start - before)
    # what is left behind the last word of a row, or of a row of spaces, is a segment of markers
    tail = off[1:] - np.where(w.counts > 0, w.end[np.maximum(w.first[1:] - 1, 0)] if len(w.end)
                              else 0, off[:-1] - 1)
    tail = np.where(np.diff(off) > 0, tail, 0)
    extra = np.flatnonzero(tail > 0)
    start, end = np.concatenate((w.start, off[extra + 1])), np.concatenate((w.end, off[extra + 1]))
    marks, row = np.concatenate((marks, tail[extra])), np.concatenate((row, extra))
    order = np.lexsort((start, row))
    start, end, marks, row = start[order], end[order], marks[order], row[order]
    key = span_hash(buf, start, end) ^ mix(marks.astype(U64))
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    one, which = _kept_apart(buf, start, end, marks, one, which)
    # the distinct segments as bytes: markers, then the word
    lead, body = 3 * marks[one], (end - start)[one]
    seg_off = np.concatenate(([0], np.cumsum(lead + body)))
    text = np.empty(seg_off[-1], np.uint8)
    lead_at = _ranges(seg_off[:-1], lead)
    text[lead_at] = _MARK_BYTES[(lead_at - np.repeat(seg_off[:-1], lead)) % 3]
    text[_ranges(seg_off[:-1] + lead, body)] = buf[_ranges(start[one], body)]
    solved = [segment(text[seg_off[a]:seg_off[b]], seg_off[a:b + 1] - seg_off[a], p)
              for a, b in row_slices(seg_off, SOLVE_BYTES)]
    ids = np.concatenate([s[0] for s in solved] or [np.zeros(0, np.int32)])
    id_off = np.concatenate(([0], np.cumsum(np.concatenate(
        [np.diff(s[1]) for s in solved] or [np.zeros(0, np.int64)]))))
    score = np.concatenate([s[2] for s in solved] or [np.zeros(0)])
    count = np.diff(id_off)[which]
    out = ids[_ranges(id_off[:-1][which], count)]
    per = np.bincount(row, weights=count, minlength=rows).astype(np.int64)
    return (out, np.concatenate(([0], np.cumsum(per))),
            np.bincount(row, weights=score[which], minlength=rows))


def decode_rows(ids: np.ndarray, off: np.ndarray, p: Pieces) -> list[str]:
    """The texts of rows of ids; ids outside the vocabulary are skipped."""
    known = (ids >= 0) & (ids < len(p.surface_off) - 1)
    safe = np.where(known, ids, 0)
    size = np.where(known, np.diff(p.surface_off)[safe], 0)
    raw = p.surface[_ranges(p.surface_off[safe], size)].tobytes()
    end = np.concatenate(([0], np.cumsum(size)))[off]
    out = []
    for a, b in zip(end[:-1].tolist(), end[1:].tolist()):
        text = raw[a:b]
        out.append((text[1:] if text[:1] == b" " else text).decode("utf-8", "replace"))
    return out


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, log_score and ids of every row of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    p = load_pieces(path)      # a few megabytes, the size of the vocabulary

    def run(batches):
        byte = np.zeros(len(p.score), bool)
        byte[p.byte_id] = True
        for batch in batches:
            for lo, hi, buf, off in slices_of(batch.column(1), SLICE_BYTES):
                ids, first, score = encode_rows(buf, off, p)
                bytes_ = np.concatenate(([0], np.cumsum(byte[ids])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)),
                     pa.array((bytes_[first[1:]] - bytes_[first[:-1]]).astype(np.int64)),
                     pa.array(score, pa.float64()),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))],
                    names=["doc_id", "n_pieces", "n_byte_pieces", "log_score", "ids"])

    return bound_tables(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_pieces bigint, n_byte_pieces bigint, log_score double, ids array<int>")


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with column ``text``: the decoded ``ids`` (null ids: empty; null elements skipped)."""
    bounded_batches(rows.sparkSession)
    p = load_pieces(path)
    source = rows.drop("text")
    at = source.columns.index(ids)
    names = [*source.columns, "text"]

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            parts, sizes = [], []
            for row in range(len(column)):
                v = column[row].values
                v = np.zeros(0, np.int32) if v is None else v.drop_null().to_numpy(zero_copy_only=False)
                parts.append(v)
                sizes.append(len(v))
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            texts = decode_rows(flat, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), p)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    schema = source.withColumn("text", F.lit("")).schema
    return source.mapInArrow(run, schema)


def encode_and_check(docs: DataFrame, path: str) -> DataFrame:
    """``encode`` with ``round_trip``: whether the ids decode to the text again
    (markers in the text read as spaces)."""
    bounded_batches(docs.sparkSession)
    p = load_pieces(path)

    def run(batches):
        byte = np.zeros(len(p.score), bool)
        byte[p.byte_id] = True
        for batch in batches:
            column = as_strings(batch.column(1))
            data, all_off = buffer_of(column)
            for lo, hi in row_slices(all_off, SLICE_BYTES):
                buf, off = data[all_off[lo]:all_off[hi]], all_off[lo:hi + 1] - all_off[lo]
                ids, first, score = encode_rows(buf, off, p)
                back = decode_rows(ids, first, p)
                same = [t.replace(MARK, " ") == b for t, b in
                        zip(column.slice(lo, hi - lo).to_pylist(), back)]
                bytes_ = np.concatenate(([0], np.cumsum(byte[ids])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)),
                     pa.array((bytes_[first[1:]] - bytes_[first[:-1]]).astype(np.int64)),
                     pa.array(score, pa.float64()), pa.array(same),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))],
                    names=["doc_id", "n_pieces", "n_byte_pieces", "log_score", "round_trip", "ids"])

    return bound_tables(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_pieces bigint, n_byte_pieces bigint, log_score double, "
             "round_trip boolean, ids array<int>")
