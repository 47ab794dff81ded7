"""The training-corpus pipeline: documents through five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
it kept and returns a DataFrame; ``run`` writes each result as Parquet to the
shared folder (``spark.checkpoint.dir``) and reads it again for the next.  All
stages but the last return the columns of documents.

1. toxicity: documents that the classifier rejects go;
2. near-duplicates by SimHash: of each group the document of the smallest id stays
   (3-word shingles, 2 bits; null ids come last, of rows of equal id and text one stays);
3. decontamination: documents that hold leaked benchmark items go;
4. personal data: every span is replaced by its kind;
5. SentencePiece encoding, with the decoded text compared to its source.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.decontam import without_leaks
from tessera.llm.pieces import encode_and_check
from tessera.llm.pii import without_personal_data
from tessera.llm.simhash import one_of_each_group
from tessera.llm.toxicity import without_toxic
from tessera.sources.tables import load
from tessera.sources.writers import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_personal_data(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_and_check(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data),
          ("encoding", encoding)]

# a trained classifier, XXH64 and greedy tiling are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), spark, f"pipeline-{name}")
    return docs
