"""Calendar helpers (DAT-1..3). All are time-zone independent (UTC arithmetic)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.strings import col_of

SECONDS_PER_DAY = 86400


def epoch_seconds(ts_ntz: str | Column) -> Column:
    """A ``timestamp_ntz`` as seconds since 1970-01-01 00:00 (UTC wall clock)."""
    c = col_of(ts_ntz)
    return (F.unix_date(F.to_date(c)).cast("bigint") * SECONDS_PER_DAY
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("bigint"))


def epoch_year(epoch_text: str | Column, default: str = "Unknown") -> Column:
    """Epoch-seconds text -> calendar year (UTC) as a string; bad input -> default.

    Uses integer day arithmetic, so the session time zone never matters.
    """
    secs = col_of(epoch_text).try_cast("bigint")
    days = F.floor(secs / F.lit(SECONDS_PER_DAY)).cast("int")
    year = F.year(F.date_from_unix_date(days))
    return F.coalesce(year.cast("string"), F.lit(default))


def year_of(ts: str | Column) -> Column:
    return F.year(col_of(ts)).cast("int")


def month_of(ts: str | Column) -> Column:
    return F.month(col_of(ts)).cast("int")
