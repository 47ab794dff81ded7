"""Readers and writers; every job itself takes and returns DataFrames."""

from tessera.sources.csv import (bad_records, read_delimited, read_glob, read_header_inferred,
                                 read_quoted_multiline)
from tessera.sources.tables import TABLES, load
from tessera.sources.text import (malformed_count, parse_positional,
                                  read_delimited_tolerant, read_wordlist)
from tessera.sources.writers import (materialize, write_delimited, write_key_value_text,
                                     write_report)

__all__ = [
    "bad_records", "read_delimited", "read_glob", "read_header_inferred", "read_quoted_multiline",
    "TABLES", "load", "malformed_count", "parse_positional", "read_delimited_tolerant",
    "read_wordlist", "materialize", "write_delimited", "write_key_value_text", "write_report",
]
