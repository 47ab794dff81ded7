"""Text-report formatting (STR-11..14) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.strings import col_of


def fixed2(c: str | Column) -> Column:
    """Two decimals the way Java's ``%.2f`` prints them (half-up on the
    decimal representation: 4.125 -> "4.13"); NULL stays NULL (Java would
    print ``"nu"``, i.e. "null" cut to the precision)."""
    v = col_of(c)
    return F.when(v.isNotNull(), F.format_string("%.2f", v))


def python_fixed(c: str | Column, digits: int = 2) -> Column:
    """Decimals the way Python's ``f"{x:.2f}"`` prints them: correctly rounded
    from the exact binary value, ties to even (4.125 -> "4.12").
    ``format_number`` rounds the same way; its grouping commas are removed."""
    return F.regexp_replace(F.format_number(col_of(c), digits), ",", "")


def left_justify(c: str | Column, width: int) -> Column:
    """``f"{x:<width}"``: pad on the right, never truncate (``rpad`` truncates)."""
    return F.format_string(f"%-{width}s", col_of(c))


def thousands(c: str | Column) -> Column:
    """Whole number with thousands separators (``f"{n:,}"``)."""
    return F.format_number(col_of(c), 0)


def or_label(c: str | Column, label: str = "NA") -> Column:
    """Missing value shown as a label in text reports, else two decimals."""
    return F.coalesce(fixed2(c), F.lit(label))
