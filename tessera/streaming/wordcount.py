"""Word counts over a growing folder of review files (Structured Streaming)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.operators import text as T
from tessera.session import scratch_path


def review_stream(spark: SparkSession, source_dir: str, schema: StructType, sep: str = ";",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of quoted, multi-line review CSV files with a header."""
    reader = (spark.readStream.schema(schema)
              .options(sep=sep, quote='"', escape='"', multiLine="true", header="true",
                       nullValue="\u0000", ignoreLeadingWhiteSpace="false",
                       ignoreTrailingWhiteSpace="false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(source_dir)


def word_count_stream(reviews: DataFrame, stopwords: Sequence[str]) -> DataFrame:
    """Running frequency per word of a review stream.

    Same rules as :func:`tessera.operators.text.word_count`; stopwords are
    dropped before the stateful aggregation so they never enter the state.
    """
    rows = T.review_tokens(T.clean_reviews(reviews)).filter(
        F.col("category").isNotNull() & F.col("aspect").isNotNull())
    toks = rows.select(F.explode(T.WORDS).alias("word"))
    return T.remove_stopwords(toks, stopwords).groupBy("word").agg(
        F.count(F.lit(1)).alias("freq"))


def start_word_count(spark: SparkSession, source_dir: str, schema: StructType,
                     stopwords: Sequence[str], table_path: str,
                     checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Keep ``table_path`` (parquet) equal to the word counts of every file
    seen so far.  Progress and state live in ``checkpoint`` (default: a folder
    under the shared ``spark.checkpoint.dir``), so a restarted query resumes
    exactly once; each micro-batch overwrites the table with the complete
    counts, so a retried batch is idempotent.  ``available_now`` processes
    what is there and stops.

    The state holds one row per distinct word; for a large vocabulary run it
    on the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    counts = word_count_stream(review_stream(spark, source_dir, schema), stopwords)

    def publish(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(table_path)

    writer = (counts.writeStream.outputMode("complete").foreachBatch(publish)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "wordcount-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
