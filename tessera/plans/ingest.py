"""Ingest and report jobs (#34-#38).

The readers are exercised on whole test tables that are first written, by
Spark, to a fresh folder under the shared ``spark.checkpoint.dir`` in the
file layout each reader is for, and then read back.  The write is part of the
query: it scales with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.timeparts import epoch_seconds
from tessera.operators import text as T
from tessera.plans import bindings as B
from tessera.plans import ratings as R
from tessera.plans.reports import age_lines
from tessera.session import scratch_path
from tessera.sources.csv import (bad_records, read_glob, read_header_inferred,
                                 read_quoted_multiline)
from tessera.sources.csv_split import read_quoted_split
from tessera.sources.infer import read_header_one_pass
from tessera.sources.datasets import REVIEW_SCHEMA, read_cleaned_reviews
from tessera.streaming import start_word_count
from tessera.sources.tables import load
from tessera.sources.text import malformed_count, read_delimited_tolerant
from tessera.sources.writers import write_delimited, write_key_value_text

# Malformed lines mixed into the tolerant reader's input
# (blank, whitespace only, too short, trailing empty field, non-numeric
# number fields, a comma inside the second field).
MALFORMED_LINES = (
    "",
    "   ",
    "1,2",
    "1,2,",
    "x,widget,3",
    "5,gadget,abc",
    "7,A, B (1990),X|Y",
)

ITEM_FIELDS = (("item_id", "bigint"), ("title", "string"), ("size", "int"))
RATING_FIELDS = (("user_id", "bigint"), ("item_id", "bigint"), ("line", "int"),
                 ("score", "double"), ("epoch", "bigint"))


def _part_lines(spark: SparkSession, d: str) -> str:
    """``part`` written as headerless ``id,name,size`` lines plus the
    malformed lines; returns the folder."""
    part = load(spark, d, "part")
    lines = part.select(F.concat(*[
        x for c in ("p_partkey", "p_name", "p_size")
        for x in (F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(","))][:-1]).alias("value"))
    bad = spark.createDataFrame([(s,) for s in MALFORMED_LINES], "value string")
    path = scratch_path(spark, "tolerant")
    lines.unionByName(bad).write.text(path)
    return path


def q_read_delimited_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """#34 ``part`` as headerless ``id,name,size`` lines plus malformed lines."""
    return read_delimited_tolerant(spark, _part_lines(spark, d), ITEM_FIELDS, min_fields=3)


def q_bad_record_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records of the #34 input that the typed glob reader finds good and bad."""
    schema = ", ".join(f"{n} {t}" for n, t in ITEM_FIELDS)
    return bad_records(spark, _part_lines(spark, d), schema).agg(
        F.sum("n_good").alias("n_good"), F.sum("n_bad").alias("n_bad"))


def q_malformed_count(spark: SparkSession, d: str) -> DataFrame:
    """How many lines of the #34 input the tolerant reader keeps and skips
    (FLT-1..3; bad ratings are skipped with a count available)."""
    return malformed_count(spark, _part_lines(spark, d), ITEM_FIELDS, min_fields=3)


def q_cleaned_table_hand_over(spark: SparkSession, d: str) -> DataFrame:
    """SNK-3 -> SRC-8: the cleaned review table of #16 stored as ``;`` text
    (no header, no quoting) and read back, then counted per word the way the
    downstream text jobs read it - the same answer as #17."""
    table = B.q_rebuild_clean_text(spark, d)
    path = scratch_path(spark, "cleaned")
    write_delimited(table, path, sep=";")
    stored = T.tokens_of_cleaned_table(read_cleaned_reviews(spark, path))
    return T.word_count(stored, [])


def q_streaming_word_count(spark: SparkSession, d: str) -> DataFrame:
    """The documents written as review CSV files (several part files) and
    counted per word by the incremental Structured Streaming job, run until
    all files are processed; the published table equals #17."""
    base = B.review_base(spark, d).withColumn("sentiment", F.lit(None).cast("string"))
    src = scratch_path(spark, "stream-src")
    write_delimited(base, src, sep=";", header=True, quoted=True)
    table = scratch_path(spark, "stream-table")
    query = start_word_count(spark, src, REVIEW_SCHEMA, B.STOPWORDS, table,
                             checkpoint=scratch_path(spark, "stream-ckpt"))
    query.awaitTermination()
    return spark.read.parquet(table)


def q_key_value_hand_over(spark: SparkSession, d: str) -> DataFrame:
    """SNK-1 -> SRC-4: the per-item rating counts of #1 written as
    ``item<TAB>count`` part files and read back by the tab-separated reader,
    like one chained job handing its output to the next."""
    counts = R.item_avg_score(B.ratings(spark, d), B.items(spark, d))
    path = scratch_path(spark, "keyvalue")
    write_key_value_text(counts, "item_id", "n_scores", path)
    return read_delimited_tolerant(spark, path, [("item_id", "bigint"), ("n_scores", "bigint")],
                                   min_fields=2, sep="\t")


DOC_SCHEMA = "doc_id bigint, text string, lang string, source string"


def _quoted_documents(spark: SparkSession, d: str) -> str:
    docs = load(spark, d, "documents").select("doc_id", "text", "lang", "source")
    path = scratch_path(spark, "quoted")
    write_delimited(docs, path, sep=";", header=True, quoted=True)
    return path


def q_read_quoted_multiline(spark: SparkSession, d: str) -> DataFrame:
    """#35 ``documents`` as a ``;`` quoted CSV with a header; the text holds
    line breaks, quotes and ``;``."""
    return read_quoted_multiline(spark, _quoted_documents(spark, d), DOC_SCHEMA, sep=";", header=True)


def q_read_quoted_split(spark: SparkSession, d: str) -> DataFrame:
    """The files of #35 read in parallel within each file."""
    return read_quoted_split(spark, _quoted_documents(spark, d), DOC_SCHEMA, sep=";", header=True)


def q_read_glob(spark: SparkSession, d: str) -> DataFrame:
    """#36 ``lineitem`` ratings written, in one pass, as two folders of
    ``ratings_1`` (shipped up to 1998) and ``ratings_2`` (later) files, then
    read back by one glob over both."""
    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        epoch_seconds("l_shipdate").alias("epoch"),
        F.when(F.year("l_shipdate") <= 1998, "ratings_1").otherwise("ratings_2").alias("src"))
    root = scratch_path(spark, "glob")
    write_delimited(li, root, sep=",", partition_by=["src"])
    schema = ", ".join(f"{n} {t}" for n, t in RATING_FIELDS)
    df = read_glob(spark, f"{root}/src=ratings_*", schema, sep=",", source_col="source_file")
    return df.withColumn("source", F.regexp_extract("source_file", r"/src=(ratings_[^/]+)/", 1)) \
        .drop("source_file")


def _with_header(spark: SparkSession, d: str, table: str) -> str:
    path = scratch_path(spark, "header")
    write_delimited(load(spark, d, table), path, sep=";", header=True)
    return path


def q_read_header_inferred(spark: SparkSession, d: str) -> DataFrame:
    """#37 ``customer`` as a ``;`` CSV with a header, types inferred."""
    return read_header_inferred(spark, _with_header(spark, d, "customer"), sep=";")


def q_read_header_one_pass(spark: SparkSession, d: str) -> DataFrame:
    """The file of #37 under types inferred in one aggregate."""
    return read_header_one_pass(spark, _with_header(spark, d, "customer"), sep=";")[0]


def q_inferred_types(spark: SparkSession, d: str) -> DataFrame:
    """Column, type and rows of ``orders`` and ``customer`` as CSV, inferred in one pass each."""
    found = []
    for table in ("orders", "customer"):
        df, rows = read_header_one_pass(spark, _with_header(spark, d, table), sep=";")
        found += [(table, f.name, f.dataType.simpleString(), rows) for f in df.schema]
    return spark.createDataFrame(found, "table_name string, column_name string, data_type string, n_rows long")


def q_format_report(spark: SparkSession, d: str) -> DataFrame:
    """#38 The per-(item, band) means of #10 as the reference's fixed-width
    text lines; the mean is formatted from its exact value."""
    rows = R.item_avg_by_band_long(B.ratings(spark, d), B.users(spark, d),
                                   B.items(spark, d),
                                   B.PRICE_EDGES, B.PRICE_BANDS_LEFT, digits=None)
    return age_lines(rows)

