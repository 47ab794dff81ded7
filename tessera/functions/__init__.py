"""Column -> Column helpers, built from ``pyspark.sql.functions`` only."""

from tessera.functions.bands import band, band_sql
from tessera.functions.report import fixed2, left_justify, or_label, thousands
from tessera.functions.strings import (clean_review, drop_trailing_empty, java_trim,
                                       last_field, split_java, split_tags,
                                       split_title_fields, tokens, without_words)
from tessera.functions.timeparts import epoch_seconds, epoch_year, month_of, year_of

__all__ = [
    "band", "band_sql", "fixed2", "left_justify", "or_label", "thousands",
    "clean_review", "drop_trailing_empty", "java_trim", "last_field", "split_java",
    "split_tags", "split_title_fields", "tokens", "without_words",
    "epoch_seconds", "epoch_year", "month_of", "year_of",
]
