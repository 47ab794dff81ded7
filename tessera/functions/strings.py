"""String helpers (STR-1..10): all are compositions of built-in Spark functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the review cleaner turns into spaces, and the
# pair of doubled quotes that is collapsed to a single space first.
DOUBLED_QUOTE = '""'
PUNCTUATION_CLASS = r'["\n\r,.!?:;()\[\]+\-*/]'

# Java String.trim() strips every char <= U+0020 at both ends; Spark's trim
# strips spaces only, so the set of characters is given to btrim explicitly.
_JAVA_WHITESPACE = "".join(chr(i) for i in range(0x21))


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: str | Column) -> Column:
    """Trim like ``java.lang.String.trim`` (all control chars and space)."""
    return F.btrim(col_of(c), F.lit(_JAVA_WHITESPACE))


def drop_trailing_empty(arr: Column) -> Column:
    """Java ``String.split`` drops trailing empty strings; Spark keeps them.

    The array is cut after its last non-empty element (for an array that is
    already built; :func:`split_java` avoids building the empties at all).
    """
    keep = F.coalesce(
        F.array_max(F.transform(arr, lambda x, i: F.when(x != "", i + 1).otherwise(F.lit(0)))),
        F.lit(0),
    )
    return F.when(keep == 0, F.array().cast("array<string>")).otherwise(
        F.slice(arr, F.lit(1), keep))


def split_java(c: str | Column, sep: str, limit: int = -1) -> Column:
    """Split on a literal separator like Java ``String.split(sep[, limit])``.

    ``limit <= 0`` drops trailing empty fields (Java semantics for 0): the
    trailing separators are stripped before splitting, which keeps the whole
    expression code-generated.  A positive limit keeps the remainder in the
    last field, exactly like Spark.
    """
    lit = regex_literal(sep)
    if limit > 0:
        return F.split(col_of(c), lit, limit)
    stripped = F.regexp_replace(col_of(c), f"(?:{lit})+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, lit, -1))


def split_title_fields(c: str | Column) -> tuple[Column, Column, Column]:
    """``id,title,tags`` where the title may hold commas.

    id = before the first comma, tags = after the last one, title = between.
    """
    pattern = r"^([^,]*),(.*),([^,]*)$"
    col = col_of(c)
    return (F.regexp_extract(col, pattern, 1), F.regexp_extract(col, pattern, 2),
            F.regexp_extract(col, pattern, 3))


def last_field(c: str | Column, sep: str = ",") -> Column:
    """Everything after the last separator (Python ``rsplit(sep, 1)[-1]``)."""
    return F.substring_index(col_of(c), sep, -1)


def split_tags(c: str | Column, sep: str = "|") -> Column:
    """Multi-valued field -> array of non-empty tags (duplicates kept)."""
    return F.array_remove(F.split(col_of(c), regex_literal(sep)), "")


def clean_review(c: str | Column) -> Column:
    """Doubled quotes -> one space; quotes, punctuation, CR/LF -> space;
    Java trim; lower-case (Unicode aware).

    One regex pass: the alternation tries the doubled quote first, so ``""``
    becomes one space and every other listed character one space each -
    the same text as replacing the pair first and the class second."""
    spaced = F.regexp_replace(col_of(c), f"{DOUBLED_QUOTE}|{PUNCTUATION_CLASS}", " ")
    return F.lower(java_trim(spaced))


def tokens(c: str | Column, sep: str = " ") -> Column:
    """Tokenise on a single literal delimiter; empty and blank (" ") tokens are
    dropped.  ``array_remove`` keeps this inside whole-stage codegen."""
    parts = F.array_remove(F.split(col_of(c), regex_literal(sep)), "")
    return parts if sep == " " else F.array_remove(parts, " ")


def sql_list(words: Sequence[str]) -> str:
    """Words as a SQL list of string literals (``'a', 'b'``), sorted, unique."""
    def lit(w: str) -> str:
        return "'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(lit(w) for w in sorted(set(words)))


def not_in(col_name: str, words: Sequence[str]) -> Column:
    """``col NOT IN (words)`` as one SQL expression (Catalyst makes it a hash
    ``InSet``); a NULL value is not kept, like ``~isin``."""
    return F.expr(f"NOT (`{col_name}` IN ({sql_list(words)}))")


def without_words(arr: str | Column, words: Sequence[str]) -> Column:
    """Array minus the given words, order and duplicates kept, evaluated inside
    the row (no shuffle); the word list becomes a hash set (``InSet``).
    Given a column name, the filter is built as one SQL expression."""
    if not words:
        return col_of(arr)
    if isinstance(arr, str):
        return F.expr(f"filter(`{arr}`, x -> NOT (x IN ({sql_list(words)})))")
    listed = sorted(set(words))
    return F.filter(arr, lambda x: ~x.isin(listed))


def regex_literal(sep: str) -> str:
    """A literal string as a Java regex (special characters escaped)."""
    special = set(r"\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in sep)
