"""Readers for the input files of the reference's jobs, giving the canonical
columns the jobs in :mod:`tessera.plans` expect.

* ratings family: ``movies.txt`` (id, title with commas, ``|`` genres),
  ``ratings_*.txt`` (user, movie, rating, epoch), ``users.txt`` (user, gender,
  age, occupation, zip), ``occupation.txt`` (id, name) - headerless, ``,``;
* review family: ``hotel-review.csv`` (``;``, quoted, multi-line, header),
  ``stopwords.txt`` (one per line), the derived cleaned table (``;``);
* commerce family: ``;`` CSVs with a header (types inferred unless given).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.strings import java_trim, split_tags, split_title_fields
from tessera.sources.csv import read_delimited, read_header_inferred
from tessera.sources.csv_split import read_quoted_split
from tessera.sources.text import read_delimited_tolerant, read_wordlist

# The commerce tables' columns and types as the reference
# recorded them (Review_Score and Review_Creation_Date are text there).
COMMERCE_SCHEMAS = {
    "Customer_List": "Customer_Trx_ID string, Subscriber_ID string, Subscribe_Date date, "
                     "First_Order_Date date, Customer_Postal_Code string, Customer_City string, "
                     "Customer_Country string, Customer_Country_Code string, Age int, "
                     "Gender string",
    "Order_Items": "Order_ID string, Order_Item_ID int, Product_ID string, Seller_ID string, "
                   "Shipping_Limit_Date timestamp, Price double, Freight_Value double",
    "Order_Reviews": "Review_ID string, Order_ID string, Review_Score string, "
                     "Review_Comment_Title_En string, Review_Comment_Message_En string, "
                     "Review_Creation_Date string, Review_Answer_Timestamp timestamp",
    "Orders": "Order_ID string, Customer_Trx_ID string, Order_Status string, "
              "Order_Purchase_Timestamp timestamp, Order_Approved_At timestamp, "
              "Order_Delivered_Carrier_Date timestamp, Order_Delivered_Customer_Date timestamp, "
              "Order_Estimated_Delivery_Date timestamp",
    "Products": "Product_ID string, Product_Category_Name string, Product_Weight_Gr int, "
                "Product_Length_Cm int, Product_Height_Cm int, Product_Width_Cm int",
}

REVIEW_COLUMNS = ("id", "review", "aspect", "category", "sentiment")
REVIEW_SCHEMA = StructType([StructField(c, StringType()) for c in REVIEW_COLUMNS])


def read_movies(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``item_id, title, tags``: id before the first comma, genres after the
    last one, the title in between (it may hold commas).  A two-field line
    has a title and no genres; blank and one-field lines are dropped."""
    line = java_trim("value")
    lines = spark.read.text(path).select(line.alias("line")).filter(F.length("line") > 0)
    i, t, g = split_title_fields("line")
    two = F.split("line", ",", 2)
    three_plus = F.col("line").rlike("^[^,]*,.*,")
    return lines.filter(F.col("line").contains(",")).select(
        F.when(three_plus, i).otherwise(F.try_element_at(two, F.lit(1))).alias("item_id"),
        F.when(three_plus, t).otherwise(F.try_element_at(two, F.lit(2))).alias("title"),
        F.when(three_plus, split_tags(g)).otherwise(F.array().cast("array<string>")).alias("tags"))


def read_ratings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``user_id, item_id, score, ts_text`` from one or more (globbed) files;
    a line without three fields or with a rating that is not a number is
    skipped (count them with :func:`tessera.sources.text.malformed_count`)."""
    fields = [("user_id", "string"), ("item_id", "string"), ("score", "double"),
              ("ts_text", "string")]
    return read_delimited_tolerant(spark, path, fields, min_fields=3)


def read_users(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``user_id, segment (gender), age (text), code (occupation), zip``."""
    fields = [("user_id", "string"), ("segment", "string"), ("age", "string"),
              ("code", "string"), ("zip", "string")]
    return read_delimited_tolerant(spark, path, fields, min_fields=2)


def read_occupations(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``code, name``."""
    return read_delimited_tolerant(spark, path, [("code", "string"), ("name", "string")],
                                   min_fields=2, limit=2)


def read_hotel_reviews(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``id, review, aspect, category, sentiment`` from the quoted ``;`` CSV,
    each file read by many tasks.  The header row is removed by the cleaning
    step (``id != 'id'``) as well."""
    return read_quoted_split(spark, path, REVIEW_SCHEMA, sep=";", header=True)


def read_stopwords(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_wordlist(spark, path, "stopword")


def read_cleaned_reviews(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The stored cleaned table (``;``, unquoted, no header)."""
    return read_delimited(spark, path, REVIEW_SCHEMA, sep=";", header=False)


def read_commerce_table(spark: SparkSession, path: str | Sequence[str], name: str | None = None,
                        schema: StructType | str | None = None, infer: bool = False,
                        free_text: bool = False) -> DataFrame:
    """A ``;`` CSV with a header.

    The declared schema of table ``name`` (:data:`COMMERCE_SCHEMAS`) is the
    default - one pass over the file, and the header is checked against it;
    ``infer=True`` (or an unknown name) infers types instead, which costs an
    extra pass.  ``free_text`` (e.g. review comments) reads quoted line breaks
    as part of the field instead of starting broken rows."""
    if schema is None and not infer and name in COMMERCE_SCHEMAS:
        schema = COMMERCE_SCHEMAS[name]
    return read_header_inferred(spark, path, sep=";", schema=schema, multi_line=free_text)
