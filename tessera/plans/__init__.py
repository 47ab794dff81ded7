"""Composed jobs and their bindings to the test tables.

``QUERIES`` maps each job name to a ``(spark, sf_dir) -> DataFrame`` callable,
in the order of the blueprint; ``ORACLE_SQL`` holds the independent SQL for
each of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import bindings as B
from tessera.plans import events as EV
from tessera.plans import ingest as I
from tessera.plans.oracle import SQL as _SQL
from tessera.plans.report_jobs import REPORT_QUERIES

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {
    # ratings (families A, C)
    "item_avg_score": B.q_item_avg_score,
    "best_item_min_support": B.q_best_item_min_support,
    "item_ranking_min_support": B.q_item_ranking_min_support,
    "ranking_with_summary": B.q_ranking_with_summary,
    "tag_avg_score": B.q_tag_avg_score,
    "tag_avg_score_default": B.q_tag_avg_score_default,
    "item_avg_by_segment_wide": B.q_item_avg_by_segment_wide,
    "item_avg_by_segment_once": B.q_item_avg_by_segment_once,
    "item_avg_by_segment_long": B.q_item_avg_by_segment_long,
    "item_avg_by_band_wide": B.q_item_avg_by_band_wide,
    "item_avg_by_band_long": B.q_item_avg_by_band_long,
    "avg_score_by_two_hop_label": B.q_avg_score_by_two_hop_label,
    "avg_score_by_epoch_year": B.q_avg_score_by_epoch_year,
    # review text (family B)
    "clean_text": B.q_clean_text,
    "tokenize_reviews": B.q_tokenize_reviews,
    "remove_stopwords": B.q_remove_stopwords,
    "rebuild_clean_text": B.q_rebuild_clean_text,
    "word_count": B.q_word_count,
    "top_words": B.q_top_words,
    "count_by_category": B.q_count_by_category,
    "count_by_aspect": B.q_count_by_aspect,
    "count_by_aspect_sentiment": B.q_count_by_aspect_sentiment,
    "top_aspect_negative": B.q_top_aspect_negative,
    "top_aspect_positive": B.q_top_aspect_positive,
    "top_words_by_category_positive": B.q_top_words_by_category_positive,
    "top_words_by_category_negative": B.q_top_words_by_category_negative,
    "top_words_by_category": B.q_top_words_by_category,
    # commerce (family D)
    "schema_profile": B.q_schema_profile,
    "entity_counts": B.q_entity_counts,
    "orders_by_country": B.q_orders_by_country,
    "orders_by_year_month": B.q_orders_by_year_month,
    "average_valid_score": B.q_average_valid_score,
    "score_distribution": B.q_score_distribution,
    "seller_ranking": B.q_seller_ranking,
    # ingest and report
    "read_delimited_tolerant": I.q_read_delimited_tolerant,
    "read_quoted_multiline": I.q_read_quoted_multiline,
    "read_quoted_split": I.q_read_quoted_split,
    "read_glob": I.q_read_glob,
    "read_header_inferred": I.q_read_header_inferred,
    "read_header_one_pass": I.q_read_header_one_pass,
    "inferred_types": I.q_inferred_types,
    "format_report": I.q_format_report,
    # further reader/sink operators of the inventory
    "malformed_count": I.q_malformed_count,
    "bad_record_counts": I.q_bad_record_counts,
    "key_value_hand_over": I.q_key_value_hand_over,
    "cleaned_table_hand_over": I.q_cleaned_table_hand_over,
    "streaming_word_count": I.q_streaming_word_count,
    # report lines, stored stages and text layouts
    **REPORT_QUERIES,
    # events: ordered work over hot keys, interval joins, cubes
    **EV.QUERIES,
}

ORACLE_SQL: dict[str, str] = {**_SQL, **EV.SQL}

__all__ = ["QUERIES", "ORACLE_SQL", "QueryFn"]
