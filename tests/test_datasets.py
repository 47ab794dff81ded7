"""The jobs end to end on files in the reference's input formats, with the
edge rows of FIXTURES.md, checked against brute force."""

from decimal import Decimal
import os
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import text as T
from tessera.plans import ratings as R
from tessera.sources import write_delimited
from tessera.sources.datasets import (read_cleaned_reviews, read_hotel_reviews, read_movies,
                                      read_occupations, read_ratings, read_stopwords,
                                      read_users)

from conftest import rows

MOVIES = "\n".join([
    "1,Toy Story (1995),Animation|Comedy",
    "",
    "2,Heat (1995),Action|Crime||",
    "7,A, B (1990),X|Y",              # title with a comma
    "3,Drama Only,Drama||War|",       # empty genres dropped, duplicates kept
    "3,Duplicate id,Comedy",          # duplicated dimension id
    "4,No Ratings,Drama",             # movie without ratings
    "9",                              # one field: dropped
]) + "\n"
RATINGS_1 = "\n".join([
    "10,1,4.0,978307200", "11,1,5.0,978307200", "12,2,3.0,x", "13,7,2.0,946684800",
    "", "1,2", "1,2,", "1,2,abc",      # blank, short, trailing empty, bad rating
]) + "\n"
RATINGS_2 = "\n".join([
    "10,3,5.0,946684800", "11,3,3.0,946684800", "99,3,1.0,946684800",   # unknown user 99
    "12,8,4.0,946684800",                                               # unknown movie 8
]) + "\n"
USERS = "\n".join([
    "10,M,18,1,11111", "11,F,35,2,22222", "12,M,50,7,33333", "13,F,x,1,44444",
]) + "\n"
OCCUPATIONS = "1,writer\n2,artist\n"  # occupation 7 is missing


@pytest.fixture(scope="module")
def files():
    d = tempfile.mkdtemp(prefix="tessera-data-")
    for name, text in [("movies.txt", MOVIES), ("ratings_1.txt", RATINGS_1),
                       ("ratings_2.txt", RATINGS_2), ("users.txt", USERS),
                       ("occupation.txt", OCCUPATIONS)]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    return d


@pytest.fixture(scope="module")
def data(spark, files):
    p = lambda n: os.path.join(files, n)
    return (read_ratings(spark, p("ratings_*.txt")), read_movies(spark, p("movies.txt")),
            read_users(spark, p("users.txt")), read_occupations(spark, p("occupation.txt")))


def test_readers(data):
    r, m, u, o = data
    assert r.count() == 8                                   # 4 malformed lines skipped
    got = {i: (t, tags) for i, t, tags in rows(m)}
    assert got["7"] == ("A, B (1990)", ["X", "Y"])
    assert got["3"][1] in (["Drama", "War"], ["Comedy"])
    assert got["2"] == ("Heat (1995)", ["Action", "Crime"])
    assert "9" not in got
    assert rows(o) == [("1", "writer"), ("2", "artist")]


def test_item_and_tag_jobs(data):
    r, m, u, o = data
    # duplicate id 3 resolves to the smallest title: "Drama Only"
    assert rows(R.item_avg_score(r, m)) == [("1", "Toy Story (1995)", 4.5, 2),
                                            ("2", "Heat (1995)", 3.0, 1),
                                            ("3", "Drama Only", 3.0, 3),
                                            ("7", "A, B (1990)", 2.0, 1)]
    tags = dict((t, (a, n)) for t, a, n in rows(R.tag_avg_score(r, m, default_tag="Unknown")))
    assert tags["Drama"] == (3.0, 3) and tags["War"] == (3.0, 3)
    assert tags["Unknown"] == (4.0, 1)                      # movie 8 is not in movies.txt
    assert tags["Animation"] == (4.5, 2)


def test_segment_band_label_year_jobs(data):
    r, m, u, o = data
    wide = {row[0]: row[2:] for row in rows(
        R.item_avg_by_segment_wide(r, u, m, ["M", "F"], ["male", "female"]))}
    assert wide["3"] == (5.0, 3.0)        # user 99 unknown: not counted
    assert wide["4"] == (None, None)      # kept although it has no ratings
    assert "8" not in wide                # not in the dimension
    bands = {(i, b): a for i, b, a, t in rows(R.item_avg_by_band_long(
        r, u, m, [18, 35, 50], ["Dưới 18", "18-34", "35-49", "50+"]))}
    assert bands[("1", "18-34")] == 4.0 and bands[("1", "35-49")] == 5.0
    assert bands[("7", "Unknown")] == 2.0  # age "x"
    assert bands[("2", "50+")] == 3.0
    labels = {lab: (a, n) for lab, a, n in rows(R.avg_score_by_two_hop_label(r, u, o))}
    assert labels == {"writer": (round(11 / 3, 4), 3), "artist": (4.0, 2),
                      "7": (3.5, 2), "Unknown": (1.0, 1)}
    years = dict((y, (a, n)) for y, a, n in rows(R.avg_score_by_epoch_year(r)))
    assert years == {"2001": (4.5, 2), "2000": (3.0, 5), "Unknown": (3.0, 1)}


REVIEWS_CSV = (
    'id;review;aspect;category;sentiment\n'
    '1;"Phòng ""đẹp""; sạch\nrất tốt";ROOMS;HOTEL;positive\n'
    '2;"và là";SERVICE;HOTEL;negative\n'
    '3;"Giá RẺ, phục vụ tốt";PRICES;HOTEL;positive\n'
    '4;;PRICES;HOTEL;negative\n'
)


def test_review_files_and_cleaned_table_hand_over(spark):
    d = tempfile.mkdtemp(prefix="tessera-data-")
    with open(os.path.join(d, "hotel-review.csv"), "w", encoding="utf-8") as f:
        f.write(REVIEWS_CSV)
    with open(os.path.join(d, "stopwords.txt"), "w", encoding="utf-8") as f:
        f.write("và\nlà\n")
    reviews = read_hotel_reviews(spark, os.path.join(d, "hotel-review.csv"))
    stop = read_stopwords(spark, os.path.join(d, "stopwords.txt"))
    assert reviews.count() == 4
    toks = T.review_tokens(T.clean_reviews(reviews))
    table = T.rebuild_clean_text(toks, stop, broadcast=True)
    got = {r["id"]: r["review"] for r in table.collect()}
    assert got == {"1": "phòng,đẹp,sạch,rất,tốt", "3": "giá,rẻ,phục,vụ,tốt"}
    # store the cleaned table like the reference (";", no header) and re-read it
    out = os.path.join(d, "cleaned")
    write_delimited(table, out, sep=";")
    stored = T.tokens_of_cleaned_table(read_cleaned_reviews(spark, out))
    words = defaultdict(int)
    for text in got.values():
        for w in text.split(","):
            words[w] += 1
    assert dict(rows(T.word_count(stored, stop))) == dict(words)
    assert dict(rows(T.word_count(toks, stop))) == dict(words)


COMMERCE = {
    "Customer_List.csv": "Customer_Trx_ID;Customer_Country\nc1;Germany\nc2;France\nc3;Germany\n",
    "Orders.csv": ("Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp\n"
                   "o1;c1;2023-12-01 10:00:00\no2;c1;2023-11-05 09:00:00\n"
                   "o3;c2;2022-10-01 08:00:00\no4;c9;2023-12-24 12:00:00\no5;c3;\n"),
    "Order_Items.csv": ("Order_ID;Order_Item_ID;Seller_ID;Price\n"
                        "o1;1;s1;10.10\no2;1;s1;5.00\no3;1;s2;15.10\no3;2;s2;0.00\n"
                        "o4;1;s3;1.00\n"),
    "Order_Reviews.csv": ('Review_ID;Order_ID;Review_Score;Review_Comment_Message_En\n'
                          'r1;o1;5;"great"\nr2;o2;abc;"x"\nr3;o3;;"none"\n'
                          'r4;o4;4.0;"multi\nline; comment"\nr5;o5;0;"zero"\nr6;o1;6;"six"\n'
                          'r7;o2;1;"one"\n'),
}


def test_commerce_files(spark):
    from tessera.plans import commerce as C
    from tessera.sources.datasets import read_commerce_table

    d = tempfile.mkdtemp(prefix="tessera-data-")
    for name, text in COMMERCE.items():
        os.makedirs(os.path.join(d, name[:-4]))
        with open(os.path.join(d, name[:-4], name), "w", encoding="utf-8") as f:
            f.write(text)
    t = lambda n, **kw: read_commerce_table(spark, os.path.join(d, n), **kw)
    orders = t("Orders").select(F.col("Order_ID").alias("order_id"),
                                F.col("Customer_Trx_ID").alias("customer_id"),
                                F.col("Order_Purchase_Timestamp").alias("purchase_ts"))
    cust = t("Customer_List").select(F.col("Customer_Trx_ID").alias("customer_id"),
                                     F.col("Customer_Country").alias("country"))
    # o4's customer is unknown: dropped by the inner join
    assert [tuple(r) for r in C.orders_by_country(orders, cust).collect()] == [
        ("Germany", 3), ("France", 1)]
    # NULL timestamp (o5) is not counted; year ascending, month descending
    assert [tuple(r) for r in C.orders_by_year_month(orders).collect()] == [
        (2022, 10, 1), (2023, 12, 2), (2023, 11, 1)]
    reviews = t("Order_Reviews", free_text=True)
    assert reviews.count() == 7                               # multi-line comment kept whole
    scores = reviews.select(F.col("Review_Score").cast("string").alias("score"))
    assert [tuple(r) for r in C.score_distribution(scores).collect()] == [(1.0, 1), (4.0, 1),
                                                                         (5.0, 1)]
    assert tuple(C.average_valid_score(scores).first()) == (round(10 / 3, 4), 3)
    items = t("Order_Items").select(F.col("Seller_ID").alias("seller_id"),
                                    F.col("Order_ID").alias("order_id"),
                                    F.col("Price").alias("price"))
    # s1 and s2 both earn 15.10; s1 has two orders, so it ranks first
    assert [tuple(r) for r in C.seller_ranking(items, 2).collect()] == [
        ("s1", Decimal("15.10"), 2), ("s2", Decimal("15.10"), 1)]


def test_declared_commerce_schema_checks_the_header(spark):
    from tessera.sources.datasets import read_commerce_table

    d = tempfile.mkdtemp(prefix="tessera-data-")
    path = os.path.join(d, "Products.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Product_ID;Product_Category_Name;Product_Weight_Gr;Product_Length_Cm;"
                "Product_Height_Cm;Product_Width_Cm\np1;toys;100;10;5;3\n")
    df = read_commerce_table(spark, path, "Products")
    assert df.schema.simpleString().startswith("struct<Product_ID:string,")
    assert tuple(df.first()) == ("p1", "toys", 100, 10, 5, 3)
    bad = os.path.join(d, "bad.csv")
    with open(bad, "w", encoding="utf-8") as f:
        f.write("Wrong;Header\na;b\n")
    with pytest.raises(Exception):
        read_commerce_table(spark, bad, "Products").collect()
