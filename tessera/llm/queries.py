"""The operators bound to the test tables, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.alignment import alignment
from tessera.llm.decontam import leaks
from tessera.llm.html_text import main_texts
from tessera.llm.language import language
from tessera.llm.lexical import search
from tessera.llm.line_quality import line_quality
from tessera.llm.oracle import SQL
from tessera.llm.pieces import encode_and_check
from tessera.llm.pii import personal_data
from tessera.llm.ppm import scores
from tessera.llm.repeats import repeat_spans
from tessera.llm.simhash import near_duplicates
from tessera.llm.token_count import token_counts
from tessera.llm.toxicity import toxicity
from tessera.sources.tables import load


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(load(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(load(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(load(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_check(load(spark, sf_dir, "documents"),
                            public_tokenizers.path("piece_bpe_32k.model"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(load(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(load(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_spans(load(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(load(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                     public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_decontamination, op3_token_counts, op4_ppm_scores, op5_pieces, op6_simhash,
    op7_line_quality, op8_personal_data, op9_repeats, op10_toxicity, op11_lexical_search,
    op12_language, op13_alignment)}
ORACLE_SQL = dict(SQL)
