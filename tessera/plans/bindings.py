"""Bindings of the composed jobs to the test tables, one callable per query.

Every binding reads whole tables of ``sf_dir`` and renames columns to the
canonical names of the jobs with a projection (pruned by Catalyst down to the
parquet ``ReadSchema``).  A few documented rows are added so that the jobs'
defaults fire (``EXTRA_*``): scores of an item and of users that no dimension
has, a user of unknown code and of no numeric age, an item without scores,
epoch texts and score texts that are no numbers.

Ratings jobs read:
  ratings = lineitem (user = l_orderkey, item = l_partkey, score = l_quantity,
            epoch text from l_shipdate)
  items   = part     (item = p_partkey, title = p_name, tags = words of p_name)
  users   = orders   (user = o_orderkey, segment = o_orderstatus,
            numeric attribute = o_totalprice, code = o_custkey)
  codes   = customer (code = c_custkey, name = c_mktsegment)
Review jobs read documents (id, text, source as aspect, lang as category) and
labels (quality 1/0 -> positive/negative sentiment; unlabelled -> NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.strings import split_tags
from tessera.functions.timeparts import epoch_seconds
from tessera.operators import text as T
from tessera.operators.dims import lookup
from tessera.operators.profile import entity_counts, schema_profile
from tessera.plans import commerce as C
from tessera.plans import ratings as R
from tessera.sources.tables import load, spread

# ---------------------------------------------------------------- parameters
#: session setting by which a caller asks for the documents in that many tasks (off if unset)
SPREAD_TASKS = "spark.tessera.spreadTasks"
MIN_SUPPORT = 25                       # per-item score counts run 14-49 at sf0.01
# Added scores: 30 of item -1 (in no part), by user -1 (in no order) and -2 in turn
EXTRA_SCORES, EXTRA_ITEM, EXTRA_USER, KNOWN_EXTRA_USER = 30, -1, -1, -2
EXTRA_EPOCH = "n/a"
EXTRA_USER_ROW = (KNOWN_EXTRA_USER, "F", "n/a", -7)      # -7 is no customer
# One added rating without a score: the only one of its item, tags, user, code and year
UNSCORED_USER_ROW, UNSCORED_EPOCH = (-4, "F", "n/a", -8), "0"
EXTRA_ITEM_ROW = (-9, "part without scores")
EXTRA_SCORE_TEXTS = ("bad", "", None, "0", "five")
# Added reviews (id, review, aspect, category): a repeated header, one without id, one without text
EXTRA_REVIEWS = (("id", "review", "aspect", "category"),
                 (None, "a review without id", "web", "en"), ("-1", None, "web", "en"))
STATUS_SEGMENTS = ("F", "O")
STATUS_COLUMNS = ("avg_status_f", "avg_status_o")
PRICE_EDGES = (100000, 200000, 300000)
PRICE_BANDS_RIGHT = ("0-100k", "100k-200k", "200k-300k", "300k+")
PRICE_BAND_COLUMNS = ("avg_0_100k", "avg_100k_200k", "avg_200k_300k", "avg_300k_plus")
PRICE_BANDS_LEFT = ("under 100k", "100k-199k", "200k-299k", "300k+")
TOP_WORDS_K = 5
TOP_SELLERS_K = 20

# This library's own stopword list for the review jobs: frequent function
# words of the four languages of the documents table.
STOPWORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on",
    "with", "be", "this", "by", "as", "are", "from",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "des",
    "ist", "nicht", "dem", "im", "ein",
    "de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "por", "un",
    "no", "con", "su", "una", "para", "es", "al",
    "le", "et", "les", "du", "une", "pour", "est", "qui", "dans", "par", "sur",
    "au", "pas",
)


# ------------------------------------------------------------ ratings inputs
def ratings(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem")
    i = F.col("id")
    extra = spark.range(EXTRA_SCORES).select(
        (F.lit(EXTRA_USER) - i % 2).alias("user_id"), F.lit(EXTRA_ITEM).cast("long").alias("item_id"),
        (i % 5 + 1).cast("double").alias("score"), F.lit(EXTRA_EPOCH).alias("ts_text"))
    return li.select(F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                     F.col("l_quantity").alias("score"),
                     epoch_seconds("l_shipdate").cast("string").alias("ts_text")).unionByName(extra) \
        .unionByName(spark.createDataFrame(
            [(UNSCORED_USER_ROW[0], EXTRA_ITEM_ROW[0], None, UNSCORED_EPOCH)],
            "user_id long, item_id long, score double, ts_text string"))


def items(spark: SparkSession, d: str) -> DataFrame:
    part = load(spark, d, "part").select("p_partkey", "p_name").unionByName(
        spark.createDataFrame([EXTRA_ITEM_ROW], "p_partkey long, p_name string"))
    return part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                       split_tags("p_name", " ").alias("tags"))


def users(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("user_id"), F.col("o_orderstatus").alias("segment"),
                    F.col("o_totalprice").cast("string").alias("age"),
                    F.col("o_custkey").alias("code")).unionByName(
        spark.createDataFrame([EXTRA_USER_ROW, UNSCORED_USER_ROW],
                              "user_id long, segment string, age string, code long"))


def codes(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("code"), F.col("c_mktsegment").alias("name"))


# ------------------------------------------------------------- ratings jobs
def q_item_avg_score(spark, d):
    return R.item_avg_score(ratings(spark, d), items(spark, d))


def q_best_item_min_support(spark, d):
    return R.best_item_min_support(ratings(spark, d), items(spark, d), MIN_SUPPORT)


def q_item_ranking_min_support(spark, d):
    return R.item_ranking_min_support(ratings(spark, d), items(spark, d),
                                      MIN_SUPPORT)


def q_ranking_with_summary(spark, d):
    return R.ranking_with_summary(ratings(spark, d), items(spark, d),
                                  MIN_SUPPORT)


def q_tag_avg_score(spark, d):
    return R.tag_avg_score(ratings(spark, d), items(spark, d))


def q_tag_avg_score_default(spark, d):
    return R.tag_avg_score(ratings(spark, d), items(spark, d),
                           default_tag="Unknown")


def q_item_avg_by_segment_wide(spark, d):
    return R.item_avg_by_segment_wide(ratings(spark, d), users(spark, d), items(spark, d),
                                      STATUS_SEGMENTS, STATUS_COLUMNS)


def repeated_users(spark: SparkSession, d: str) -> DataFrame:
    """Every order under its customer: a user has as many rows as orders."""
    return load(spark, d, "orders").select(F.col("o_custkey").alias("user_id"),
                                           F.col("o_orderstatus").alias("segment"))


def q_item_avg_by_segment_once(spark, d):
    """#7 by customer, where users repeat: one segment is kept of each (JN-2)."""
    buyers = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    rated = ratings(spark, d).join(buyers, F.col("user_id") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), "item_id", "score")
    return R.item_avg_by_segment_wide(rated, repeated_users(spark, d), items(spark, d),
                                      STATUS_SEGMENTS, STATUS_COLUMNS, dedupe_users=True)


def q_item_avg_by_segment_long(spark, d):
    return R.item_avg_by_segment_long(ratings(spark, d), users(spark, d),
                                      items(spark, d))


def q_item_avg_by_band_wide(spark, d):
    return R.item_avg_by_band_wide(ratings(spark, d), users(spark, d), items(spark, d),
                                   PRICE_EDGES, PRICE_BANDS_RIGHT, PRICE_BAND_COLUMNS)


def q_item_avg_by_band_long(spark, d):
    return R.item_avg_by_band_long(ratings(spark, d), users(spark, d),
                                   items(spark, d),
                                   PRICE_EDGES, PRICE_BANDS_LEFT)


def q_avg_score_by_two_hop_label(spark, d):
    return R.avg_score_by_two_hop_label(ratings(spark, d), users(spark, d), codes(spark, d))


def q_avg_score_by_epoch_year(spark, d):
    return R.avg_score_by_epoch_year(ratings(spark, d))


# ------------------------------------------------------------- review inputs
def review_base(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("review"),
        F.col("source").alias("aspect"), F.col("lang").alias("category"))
    docs = docs.unionByName(spark.createDataFrame(
        list(EXTRA_REVIEWS), "id string, review string, aspect string, category string"))
    tasks = spark.conf.get(SPREAD_TASKS, None)
    return spread(docs, "id", int(tasks)) if tasks else docs


def sentiments(spark: SparkSession, d: str) -> DataFrame:
    lab = load(spark, d, "labels")
    s = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
    return lab.select(F.col("doc_id").cast("string").alias("id"), s.alias("sentiment"))


def with_sentiment(df: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Sentiment by id lookup (one label per document, never multiplies)."""
    return lookup(df, sentiments(spark, d), "id", "id", "sentiment")


def word_rows(spark: SparkSession, d: str) -> DataFrame:
    """Per review: its tokens in text order (row-local)."""
    return T.review_tokens(T.clean_reviews(review_base(spark, d)))


def stopword_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOPWORDS], "stopword string")


# -------------------------------------------------------------- review jobs
def q_clean_text(spark, d):
    return with_sentiment(T.clean_reviews(review_base(spark, d)), spark, d)


def q_tokenize_reviews(spark, d):
    return T.tokenize_reviews(q_clean_text(spark, d))


def q_remove_stopwords(spark, d):
    # the word table is built from the literal list, so it may be broadcast
    return T.remove_stopwords(q_tokenize_reviews(spark, d), stopword_table(spark), broadcast=True)


def q_rebuild_clean_text(spark, d):
    return T.rebuild_clean_text(with_sentiment(word_rows(spark, d), spark, d), STOPWORDS)


def q_word_count(spark, d):
    return T.word_count(word_rows(spark, d), STOPWORDS)


def q_top_words(spark, d):
    return T.top_words(word_rows(spark, d), STOPWORDS, TOP_WORDS_K)


def q_count_by_category(spark, d):
    return T.count_rows_by(T.cleaned_keys(word_rows(spark, d), STOPWORDS), "category")


def q_count_by_aspect(spark, d):
    return T.count_rows_by(T.cleaned_keys(word_rows(spark, d), STOPWORDS), "aspect")


def labelled_words(spark: SparkSession, d: str, sentiment: str) -> DataFrame:
    """Tokens of the reviews of one sentiment: joined to the raw documents, so
    that the others are neither cleaned nor tokenised."""
    lab = sentiments(spark, d).groupBy("id").agg(F.min("sentiment").alias("sentiment")) \
        .filter(F.col("sentiment") == sentiment)
    return T.review_tokens(T.clean_reviews(review_base(spark, d).join(lab, "id")))


def _keys_with_sentiment(spark, d, sentiment=None):
    """Keys of the labelled reviews: the labels meet the keys, never the texts."""
    lab = sentiments(spark, d).groupBy("id").agg(F.min("sentiment").alias("sentiment"))
    lab = lab.filter(F.col("sentiment").isNotNull() if sentiment is None
                     else F.col("sentiment") == sentiment)
    return T.cleaned_keys(word_rows(spark, d), STOPWORDS).join(lab, "id")


def q_count_by_aspect_sentiment(spark, d):
    return T.count_by_aspect_sentiment(_keys_with_sentiment(spark, d))


def q_top_aspect_negative(spark, d):
    return T.top_aspect(_keys_with_sentiment(spark, d, "negative"), "negative")


def q_top_aspect_positive(spark, d):
    return T.top_aspect(_keys_with_sentiment(spark, d, "positive"), "positive")


def q_top_words_by_category_positive(spark, d):
    return T.top_words_by_category(labelled_words(spark, d, "positive"), STOPWORDS,
                                   TOP_WORDS_K, "positive")


def q_top_words_by_category_negative(spark, d):
    return T.top_words_by_category(labelled_words(spark, d, "negative"), STOPWORDS,
                                   TOP_WORDS_K, "negative")


def q_top_words_by_category(spark, d):
    return T.top_words_by_category(word_rows(spark, d), STOPWORDS, TOP_WORDS_K)


# ------------------------------------------------------------ commerce jobs
def q_schema_profile(spark, d):
    return schema_profile(load(spark, d, "orders"))


def q_entity_counts(spark, d):
    return entity_counts([
        ("orders", load(spark, d, "orders"), "o_orderkey"),
        ("customers", load(spark, d, "customer"), "c_custkey"),
        ("sellers", load(spark, d, "lineitem"), "l_suppkey"),
    ])


def q_orders_by_country(spark, d):
    orders = load(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                             F.col("o_custkey").alias("customer_id"))
    cust = load(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"),
                                             F.col("c_nationkey"))
    customers = lookup(cust, load(spark, d, "nation"), "c_nationkey", "n_nationkey", "n_name",
                       out="country")
    return C.orders_by_country(orders, customers)


def q_orders_by_year_month(spark, d):
    orders = load(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                             F.col("o_orderdate").alias("purchase_ts"))
    return C.orders_by_year_month(orders)


def _score_texts(spark, d):
    texts = load(spark, d, "lineitem").select(F.col("l_quantity").cast("string").alias("score"))
    return texts.unionByName(spark.createDataFrame([(s,) for s in EXTRA_SCORE_TEXTS],
                                                   "score string"))


def q_average_valid_score(spark, d):
    return C.average_valid_score(_score_texts(spark, d))


def q_score_distribution(spark, d):
    return C.score_distribution(_score_texts(spark, d))


def q_seller_ranking(spark, d):
    li = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("seller_id"),
                                           F.col("l_orderkey").alias("order_id"),
                                           F.col("l_extendedprice").alias("price"))
    return C.seller_ranking(li, TOP_SELLERS_K)
