"""Incremental word count equals the batch word count over all files so far."""

import os
import tempfile

from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators import text as T
from tessera.sources import read_quoted_multiline, write_delimited
from tessera.streaming import start_word_count

from conftest import rows

SCHEMA = StructType([StructField(n, StringType())
                     for n in ("id", "review", "aspect", "category", "sentiment")])
STOP = ["the", "và"]


def _batch_counts(spark, src):
    df = read_quoted_multiline(spark, os.path.join(src, "b*"), SCHEMA, header=True)
    return rows(T.word_count(T.review_tokens(T.clean_reviews(df)), STOP))


def test_streaming_word_count_is_incremental(spark):
    base = tempfile.mkdtemp(prefix="tessera-stream-")
    src, table, ckpt = (os.path.join(base, p) for p in ("src", "table", "ckpt"))
    first = spark.createDataFrame(
        [("1", "The room; the VIEW!\nclean", "ROOMS", "HOTEL", "positive"),
         ("2", "giá rẻ và sạch", "PRICES", "HOTEL", None)], SCHEMA)
    write_delimited(first, os.path.join(src, "b1"), sep=";", header=True, quoted=True)
    # each arriving batch is a folder of part files; the stream reads a glob
    q = start_word_count(spark, os.path.join(src, "b*"), SCHEMA, STOP, table, ckpt)
    q.awaitTermination(120)
    assert rows(spark.read.parquet(table)) == _batch_counts(spark, src)

    second = spark.createDataFrame(
        [("3", "clean room, giá tốt", "ROOMS", "SERVICE", "positive")], SCHEMA)
    write_delimited(second, os.path.join(src, "b2"), sep=";", header=True, quoted=True)
    q = start_word_count(spark, os.path.join(src, "b*"), SCHEMA, STOP, table, ckpt)
    q.awaitTermination(120)
    got = dict(rows(spark.read.parquet(table)))
    assert got == dict(_batch_counts(spark, src))
    assert got["clean"] == 2 and got["room"] == 2 and "the" not in got

