"""Banding of a numeric attribute (CND-1, CND-2) as one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.strings import col_of

# The two age-band conventions of the ratings jobs.
# Right-closed (age <= 18, <= 35, <= 50, else) with labels:
RIGHT_CLOSED_AGE_EDGES = (18, 35, 50)
RIGHT_CLOSED_AGE_LABELS = ("0-18", "18-35", "35-50", "50+")
# Left-closed (age < 18, 18-34, 35-49, >= 50) with labels and the default for
# a value that does not parse:
LEFT_CLOSED_AGE_EDGES = (18, 35, 50)
LEFT_CLOSED_AGE_LABELS = ("Dưới 18", "18-34", "35-49", "50+")
UNKNOWN_LABEL = "Unknown"


def band(value: str | Column, edges: Sequence[float], labels: Sequence[str],
         closed: str = "right", default: str | None = None) -> Column:
    """Map a number to one of ``len(edges) + 1`` labels.

    ``closed="right"``: label i covers ``(edges[i-1], edges[i]]``;
    ``closed="left"``:  label i covers ``[edges[i-1], edges[i])``.
    A NULL value (e.g. a failed ``try_cast``) gets ``default``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    v = col_of(value)
    expr = None
    for edge, label in zip(edges, labels):
        cond = (v <= F.lit(edge)) if closed == "right" else (v < F.lit(edge))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.when(v.isNotNull(), F.lit(labels[-1]))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def band_sql(value_sql: str, edges: Sequence[float], labels: Sequence[str],
             closed: str = "right", default: str | None = None) -> str:
    """The same banding as an ANSI ``CASE`` (used by oracle SQL and docs)."""
    op = "<=" if closed == "right" else "<"
    parts = [f"WHEN {value_sql} {op} {e} THEN '{lab}'" for e, lab in zip(edges, labels)]
    parts.append(f"WHEN {value_sql} IS NOT NULL THEN '{labels[-1]}'")
    tail = f" ELSE '{default}'" if default is not None else ""
    return "CASE " + " ".join(parts) + tail + " END"
