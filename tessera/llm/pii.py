"""Personal data, also where it is disguised, with spans in the source text.

Base spans are the leftmost non-overlapping matches of four patterns (email,
IPv4 address, payment card, phone number) on the text as it is.  A text with
signs of disguise is then run through three transducers, each of which carries
along the source span of every character it writes: look-alike characters
become plain ones (invisible ones vanish; O, l, I in numbers are digits), digits
spelled out, all or some, become digits, and ``(at)``/``dot`` forms and a bare
``at`` before a domain become ``@`` and ``.``.  The same patterns run on the
normalised text; matches that needed a rewritten character are added, mapped
back to source characters, unless a base span of their kind says as much.

Spans are code points, end exclusive.  Null and empty texts have none; rows
of equal doc_id are searched one by one.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import bound_tables, bounded_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive runs and the look-behind only avoid retries inside one run of digits
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    # a domain pattern after each @, and before it the run of local characters
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        if m:
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
        if m and start < at:
            out.append(("email", start, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return out


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind as listed and then by start."""
    out = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", *m.span()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


# Letters of other scripts that look like Latin ones, and their like
LOOK_ALIKE = dict(zip("АВЕКМНОРСТХаеорсухіјѕԁһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορνικ",
                      "ABEKMHOPCTXaeopcyxijsdhlABEZHIKMNOPTYXaopvik"))
LOOK_ALIKE.update({"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".",
                   "·": ".", " ": " ", " ": " ", " ": " ", " ": " "})
INVISIBLE = set("​‌‍⁠﻿­᠎")
# Digits 0 to 9 spelled in the languages of the texts
SPELLED = {w: str(i) for words in (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve") for i, w in enumerate(words.split())}
SPELLED["oh"] = "0"
_SPOKEN = {"plus": "+", "dash": "-", "hyphen": "-", "minus": "-", "dot": ".", "point": ".",
           "punkt": ".", "punto": "."}
_NUMERAL = "|".join(sorted(SPELLED, key=len, reverse=True))

_ODD = re.compile("[^\x00-ɏ]|[ ­·]")
_WORD = re.compile(r"[^\W\d_]+")
_RARE = frozenset(SPELLED) - {"un"}
_BRACKETED = re.compile(r"[(\[{<]\s*(?:at|@|arroba|dot|\.|punkt|punto|point)\s*[)\]}>]", re.I)
_BARE_DOT = re.compile(r"\s(?:dot|punkt|punto|point)\s", re.I)
# letters for 0 and 1: any run between digits, and those of a number of parts that - or . join
_NEAR_DIGIT = re.compile(r"[0-9][-.]?[OolI|]|[OolI][-.]?[0-9]")
_BETWEEN = re.compile(r"(?<=[0-9])[OolI|]+(?=[0-9])")
_LOOSE = re.compile(r"(?<![^\W_])[0-9OolI]++(?:[-.][0-9OolI]+)*(?![^\W_])")

_ITEM = rf"(?:(?:{_NUMERAL})(?![^\W\d])|[0-9]+)"
_RUN = re.compile(rf"\b(?:plus\b[\s,]+)?{_ITEM}(?:(?:[\s,;/-]+(?:dash|hyphen|minus|dot|point|punkt|punto)\b)?"
                  rf"[\s,;/().-]*{_ITEM})*", re.I)
_RUN_ITEM = re.compile(rf"(?:{_NUMERAL}|{'|'.join(_SPOKEN)})(?![^\W\d])|[0-9]+|[().+-]", re.I)
# white space counts from where it begins, so that a long run is tried once
_AT = re.compile(r"(?<!\s)\s*[(\[{<]\s*(?:at|@|arroba)\s*[)\]}>]\s*", re.I)
_DOT = re.compile(r"(?<!\s)\s*[(\[{<]\s*(?:dot|\.|punkt|punto|point)\s*[)\]}>]\s*", re.I)


def _worded(at: str, dot: str) -> re.Pattern:
    """An address with spelled or real dots in its domain."""
    point = rf"(?:\s+{dot}\s+|\.)"
    return re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\s+{dot}\s+[A-Za-z0-9_%+-]+)*(?P<at>{at})"
                      rf"[A-Za-z0-9-]+(?:{point}[A-Za-z0-9-]+)*{point}[A-Za-z]{{2,}}"
                      rf"(?:{point}[A-Za-z]{{2,}})*", re.I)


# beside a spelled "at" only "dot" counts; beside a sign the other languages' words too
_WORDED = (_worded(r"\s+at\s+", "dot"), _worded(r"\s*@\s*", "(?:dot|punkt|punto|point)"))
_APART = re.compile(r"\sat\s|\s@|@\s", re.I)
_BARE_AT = re.compile(r"\s(?:at|@)\s+(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2}", re.I)
_DOT_WORD = re.compile(r"(?<!\s)\s+(?:dot|punkt|punto|point)\s+", re.I)

# "at" before plain domains is an address only after such a word in the sentence, or a name no word has
_CONTACT = re.compile(r"\b(?:e-?mails?|mail(?:to)?|contact\w*|write|reach|address|adresse|kontakt\w*|schreib\w*"
                      r"|courriel|correo|escrib\w*|[ée]cri\w*)\b[^.!?\n]*\Z", re.I)
_ACCOUNT = re.compile(r"(?=.*[A-Za-z])[A-Za-z0-9%+-]*[._0-9+][A-Za-z0-9._%+-]*\Z")


class Traced:
    """A text with the source span of each character and whether it was rewritten."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.span = [(i, i + 1) for i in range(len(text))]
        self.new = [False] * len(text)

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Replace ascending, non-overlapping ranges; what replaces a range has its whole span."""
        text, span, new, done = [], [], [], 0
        for a, b, put in changes:
            if a < done or a == b:
                continue
            text.append(self.text[done:a])
            span += self.span[done:a]
            new += self.new[done:a]
            text.append(put)
            span += [(self.span[a][0], self.span[b - 1][1])] * len(put)
            new += [True] * len(put)
            done = b
        text.append(self.text[done:])
        self.text = "".join(text)
        self.span = span + self.span[done:]
        self.new = new + self.new[done:]


def _plain(c: str) -> str | None:
    """What a character of another alphabet or form stands for; None if for itself."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKE:
        return LOOK_ALIKE[c]
    digit = unicodedata.digit(c, None)
    if digit is not None and c > "ɏ":
        return str(digit)
    form = unicodedata.normalize("NFKC", c)
    return form if form != c and form.isascii() and form.strip() else None


def _loose(text: str) -> list[tuple[int, int, str]]:
    at = {i for m in _BETWEEN.finditer(text) for i in range(*m.span())}
    for m in _LOOSE.finditer(text):
        if _DIGIT.search(m.group()):
            at.update(i for i in range(*m.span()) if text[i] in "OolI")
    return [(i, i + 1, "0" if text[i] in "Oo" else "1") for i in sorted(at)]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Runs of three spelled digits, or of fewer and at least the four digits of an IP address."""
    out = []
    for m in _RUN.finditer(text):
        items = [i.group().lower() for i in _RUN_ITEM.finditer(m.group())]
        n = sum(i in SPELLED for i in items)
        if n == 1 and "un" in (items[0], items[-1]):
            continue        # the article before or after a number
        if n >= 3 or n and n + sum(len(i) for i in items if i.isdecimal()) >= 4:
            out.append((*m.span(), "".join(SPELLED.get(i) or _SPOKEN.get(i) or i for i in items)))
    return out


def _maybe_spelled(text: str) -> bool:
    """A cheap necessary sign of a run with spelled digits: such a word, or the article "un"
    three times or beside digits."""
    words = _WORD.findall(text.lower())
    return not _RARE.isdisjoint(words) or "un" in words and (
        words.count("un") >= 3 or bool(_DIGIT.search(text)))


def _numbers(text: str) -> list[tuple[int, int, str]]:
    return _spelled(text) if _maybe_spelled(text) else []


def normalise(text: str) -> Traced:
    """The three transducers, one after the other."""
    t = Traced(text)
    if _ODD.search(text):
        t.rewrite([(m.start(), m.end(), p) for m in _ODD.finditer(text)
                   if (p := _plain(m.group())) is not None])
    if _NEAR_DIGIT.search(t.text):
        t.rewrite(_loose(t.text))
    t.rewrite(_numbers(t.text))
    t.rewrite([(*m.span(), "@") for m in _AT.finditer(t.text)])
    t.rewrite([(*m.span(), ".") for m in _DOT.finditer(t.text)])
    for form in _WORDED if _BARE_DOT.search(t.text) or _APART.search(t.text) else ():
        changes = []
        for m in form.finditer(t.text):
            dots = [(d.start() + m.start(), d.end() + m.start(), ".") for d in _DOT_WORD.finditer(m.group())]
            at = m.group("at")
            # a sign with a space before or after it only, as of a name that is called, needs a rewritten dot
            if "@" in at and not dots and not (at[0] != "@" != at[-1]) and not any(t.new[m.end("at"):m.end()]):
                continue
            domain = m.end("at")
            if "@" not in at and not any(c[0] >= domain for c in dots) and not any(t.new[domain:m.end()]) \
                    and not _ACCOUNT.match(t.text[m.start():m.start("at")]) \
                    and not _CONTACT.search(t.text, max(0, m.start() - 60), m.start()):
                continue
            changes += [c for c in dots if c[1] <= m.start("at")] + [(*m.span("at"), "@")] \
                + [c for c in dots if c[0] >= m.end("at")]
        t.rewrite(changes)
    return t


def disguised(text: str) -> bool:
    """Signs of a disguise; without one the transducers would change nothing that matters."""
    if not text.isascii() and any(_plain(c) is not None for c in set(_ODD.findall(text))):
        return True
    if any(b in text for b in "([{<") and _BRACKETED.search(text):
        return True
    low = text.lower()
    if any(w in low for w in ("dot", "punkt", "punto", "point")) and _BARE_DOT.search(text):
        return True
    if "." in text and _BARE_AT.search(text):
        return True
    return bool(_NEAR_DIGIT.search(text) and _loose(text) or _numbers(text))


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans seen only in the normalised text.  One that meets base spans of its
    kind is added only if it covers them and more (the base found a part)."""
    if not disguised(text):
        return []
    t = normalise(text)
    held = {k: sorted((a, b) for kind, a, b in base if kind == k) for k in KINDS}
    out = []
    for kind, a, b in base_spans(t.text):
        start, end = t.span[a][0], t.span[b - 1][1]
        if any(t.new[a:b]) or end - start != b - a:
            if all(end <= x or start >= y or (start <= x and y <= end and (x, y) != (start, end))
                   for x, y in held[kind]):
                out.append((kind, start, end))
    return out


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind as listed and then by start."""
    if not text:
        return [], []
    base = base_spans(text)
    extra = added_spans(text, base)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + extra, key=lambda s: (order[s[0]], s[1])) if extra else base


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones merged, replaced by its kind in brackets."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their digest and all spans of every row of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [find(t) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
                      for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts,
                 pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found],
                          pa.string()),
                 pa.array([written(spans) for _, spans in found], pa.string()),
                 pa.array([len(spans) - len(base) for base, spans in found], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return bound_tables(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
             "base_sha256 string, spans string, n_added bigint")


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind, and ``n_chars`` of the new text."""
    bounded_batches(docs.sparkSession)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            texts = [None if t is None else redact(t, find(t)[1]) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if i == at else batch.column(i)
                 for i in range(len(names))], names=names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
