"""Delimited readers (SRC-6, SRC-7, SRC-8, SRC-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Keep text exactly as written: no whitespace trimming on either side.
_VERBATIM = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

_BAD = frozenset(("null", "fail", "skip"))
_RECORD, _FILE, _GOOD = "__bad_record", "__file", "__good"


def quoted_options(sep: str) -> dict[str, str]:
    """Options of quoted multi-line CSV; ``escape='"'`` is needed for doubled quotes."""
    return {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\u0000",
            "mode": "PERMISSIVE", **_VERBATIM}


def read_quoted_multiline(spark: SparkSession, path: str | Sequence[str],
                          schema: StructType | str,
                          sep: str = ";", header: bool = True) -> DataFrame:
    """Quoted CSV whose fields may hold the separator, doubled quotes and line
    breaks (SRC-7).

    ``escape='"'`` is required: with Spark's default escape a field holding
    ``""`` followed by the separator is torn apart.  A quoted empty field is
    an empty string, an unquoted empty field is NULL.  A multi-line file is
    read by one task per file; for few large files use
    :func:`~tessera.sources.csv_split.read_quoted_split`.
    """
    return (spark.read.schema(schema)
            .options(header=str(header).lower(), **quoted_options(sep))
            .csv(path))


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
                   sep: str = ";", header: bool = False) -> DataFrame:
    """Unquoted delimited text with a declared schema (SRC-8): empty -> NULL."""
    return (spark.read.schema(schema)
            .options(sep=sep, header=str(header).lower(), quote="\u0000",
                     mode="PERMISSIVE", **_VERBATIM)
            .csv(path))


def read_header_inferred(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
                         schema: StructType | str | None = None, sampling_ratio: float = 1.0,
                         multi_line: bool = False) -> DataFrame:
    """Header row + inferred types (SRC-10).

    Inference costs an extra pass over the input; pass ``schema`` to skip it
    (the header is then checked against the schema's column names).
    ``multi_line`` keeps quoted free text with line breaks in one row (the
    file is then read by one task).
    """
    reader = spark.read.options(sep=sep, header="true", multiLine=str(multi_line).lower(),
                                quote='"', escape='"')
    if schema is not None:
        return reader.schema(schema).option("enforceSchema", "false").csv(path)
    return reader.options(inferSchema="true", samplingRatio=str(sampling_ratio)).csv(path)


def read_glob(spark: SparkSession, pattern: str, schema: StructType | str, sep: str = ",",
              header: bool = False, source_col: str | None = "source_file",
              bad: str = "null") -> DataFrame:
    """Several files matched by a glob read as one table (SRC-6).

    ``source_col`` keeps the file each row came from (``_metadata``).  ``bad``
    says what becomes of a record of which a field does not parse, or that has
    too few or too many fields: ``null`` leaves the fields in question null,
    ``fail`` ends the job, naming the record, ``skip`` leaves the record out.
    :func:`bad_records` counts them.
    """
    if bad not in _BAD:
        raise ValueError(f"bad = {bad!r}, not one of {sorted(_BAD)}")
    if bad == "null":
        df = (spark.read.schema(schema)
              .options(sep=sep, header=str(header).lower(), **_VERBATIM)
              .csv(pattern))
        return df.withColumn(source_col, F.col("_metadata.file_path")) if source_col else df
    held = _checked_records(spark, pattern, schema, sep, header)
    good = F.col(_GOOD)
    if bad == "fail":
        said = F.concat(F.lit("bad record in "), F.col(_FILE), F.lit(": "), F.col(_RECORD))
        good = F.when(good, True).otherwise(F.raise_error(said).cast("boolean"))
    held = held.where(good).drop(_GOOD, _RECORD)
    return held.withColumnRenamed(_FILE, source_col) if source_col else held.drop(_FILE)


def _checked_records(spark: SparkSession, pattern: str | Sequence[str], schema: StructType | str,
                     sep: str, header: bool) -> DataFrame:
    """The columns of ``schema``, the text of a bad record (else null), its file, whether it is good."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    taken = sorted({_RECORD, _FILE, _GOOD} & set(declared.names))
    if taken:
        raise ValueError(f"reserved column names: {taken}")
    options = {"sep": sep, "header": str(header).lower(), "columnNameOfCorruptRecord": _RECORD,
               "mode": "PERMISSIVE", **_VERBATIM}
    whole = StructType([*declared.fields, StructField(_RECORD, StringType())])
    lines = spark.read.schema(whole).options(**options).csv(pattern)
    # the parser looks only at the columns in use, so the test uses them all (the rest is 0 or 1)
    used = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in declared.names]), F.lit(2)) < 2
    return lines.select("*", F.col("_metadata.file_path").alias(_FILE),
                        (F.col(_RECORD).isNull() & used).alias(_GOOD))


def bad_records(spark: SparkSession, pattern: str | Sequence[str], schema: StructType | str,
                sep: str = ",", header: bool = False) -> DataFrame:
    """Per file that has records: ``source_file``, ``n_good`` and ``n_bad`` (see :func:`read_glob`).
    Empty lines are no records."""
    held = _checked_records(spark, pattern, schema, sep, header)
    return (held.groupBy(F.col(_FILE).alias("source_file"))
            .agg(F.count_if(_GOOD).alias("n_good"), F.count_if(~F.col(_GOOD)).alias("n_bad")))
