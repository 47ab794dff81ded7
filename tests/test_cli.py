"""The command line runs each family on files in the reference's formats."""

import glob
import os
import tempfile

from tessera import cli

from test_datasets import MOVIES, OCCUPATIONS, RATINGS_1, RATINGS_2, REVIEWS_CSV, USERS


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _read(folder):
    out = []
    for p in sorted(glob.glob(os.path.join(folder, "part-*"))):
        with open(p, encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


def test_ratings_family(spark):
    src, out = tempfile.mkdtemp(prefix="tessera-cli-"), tempfile.mkdtemp(prefix="tessera-out-")
    for name, text in [("movies.txt", MOVIES), ("ratings_1.txt", RATINGS_1),
                       ("ratings_2.txt", RATINGS_2), ("users.txt", USERS),
                       ("occupation.txt", OCCUPATIONS)]:
        _write(os.path.join(src, name), text)
    assert cli.main(["ratings", "--input", src, "--output", out, "--min-support", "2"], spark) == 0
    assert _read(os.path.join(out, "item_means")) == [
        "Toy Story (1995)\tAverage Rating: 4.50 (Total Ratings: 2)",
        "Heat (1995)\tAverage Rating: 3.00 (Total Ratings: 1)",
        "Drama Only\tAverage Rating: 3.00 (Total Ratings: 3)",
        "A, B (1990)\tAverage Rating: 2.00 (Total Ratings: 1)"]
    assert _read(os.path.join(out, "best_item")) == [
        "Toy Story (1995)\tis the highest rated movie with an average rating of 4.50 "
        "among movies with at least 2 ratings"]
    ranking = _read(os.path.join(out, "ranking"))
    assert ranking[:2] == ["1, Toy Story (1995), 4.50, 2", "3, Drama Only, 3.00, 3"]
    assert ranking[-6:-3] == ["KET QUA: PHIM CO DIEM TRUNG BINH CAO NHAT", "ID phim: 1",
                              "Ten phim: Toy Story (1995)"]
    assert "Năm: 2000 | Điểm TB: 3.00 | Tổng số lượt đánh giá: 5" in _read(os.path.join(out, "year"))
    assert _read(os.path.join(out, "band_means"))[0] == (
        "Toy Story (1995):\t[0-18: 4.00, 18-35: 5.00, 35-50: NA, 50+: NA]")


def test_reviews_family(spark):
    d, out = tempfile.mkdtemp(prefix="tessera-cli-"), tempfile.mkdtemp(prefix="tessera-out-")
    _write(os.path.join(d, "hotel-review.csv"), REVIEWS_CSV)
    _write(os.path.join(d, "stopwords.txt"), "và\nlà\n")
    assert cli.main(["reviews", "--input", os.path.join(d, "hotel-review.csv"),
                     "--stopwords", os.path.join(d, "stopwords.txt"), "--output", out], spark) == 0
    assert sorted(_read(os.path.join(out, "cleaned_data"))) == [
        "1;phòng,đẹp,sạch,rất,tốt;ROOMS;HOTEL;positive",
        "3;giá,rẻ,phục,vụ,tốt;PRICES;HOTEL;positive"]
    assert _read(os.path.join(out, "top_words"))[0] == "tốt,2"
    assert _read(os.path.join(out, "category")) == ["HOTEL,2"]
    assert _read(os.path.join(out, "most_positive_aspect")) == ["PRICES,positive,1"]
    assert _read(os.path.join(out, "most_negative_aspect")) == []


def test_commerce_family(spark):
    src, out = tempfile.mkdtemp(prefix="tessera-cli-"), tempfile.mkdtemp(prefix="tessera-out-")
    tables = {
        "Customer_List": (
            "Customer_Trx_ID;Subscriber_ID;Subscribe_Date;First_Order_Date;Customer_Postal_Code;"
            "Customer_City;Customer_Country;Customer_Country_Code;Age;Gender\n"
            "c1;s1;2023-01-01;2023-02-01;10115;Berlin;DE;DE;30;F\n"
            "c2;s2;2023-01-05;2023-03-01;75001;Paris;FR;FR;41;M\n"),
        "Orders": (
            "Order_ID;Customer_Trx_ID;Order_Status;Order_Purchase_Timestamp;Order_Approved_At;"
            "Order_Delivered_Carrier_Date;Order_Delivered_Customer_Date;"
            "Order_Estimated_Delivery_Date\n"
            "o1;c1;delivered;2023-12-01 10:00:00;;;;\n"
            "o2;c2;delivered;2023-11-01 10:00:00;;;;\n"),
        "Order_Items": (
            "Order_ID;Order_Item_ID;Product_ID;Seller_ID;Shipping_Limit_Date;Price;Freight_Value\n"
            "o1;1;p1;x;2023-12-02 10:00:00;2.50;1.0\no2;1;p2;x;2023-11-02 10:00:00;1.25;1.0\n"),
        "Order_Reviews": (
            "Review_ID;Order_ID;Review_Score;Review_Comment_Title_En;Review_Comment_Message_En;"
            "Review_Creation_Date;Review_Answer_Timestamp\n"
            'r1;o1;5;t;"a\nb";2023-12-05;2023-12-06 10:00:00\n'
            'r2;o2;abc;t;"c";2023-11-05;2023-11-06 10:00:00\n'),
    }
    for name, text in tables.items():
        _write(os.path.join(src, f"{name}.csv"), text)
    assert cli.main(["commerce", "--input", src, "--output", out], spark) == 0
    assert _read(os.path.join(out, "entity_counts")) == [
        "entity,n", "orders,2", "customers,2", "sellers,1"]
    assert _read(os.path.join(out, "seller_ranking")) == [
        "seller_id,total_revenue,order_count", "x,3.75,2"]
    assert _read(os.path.join(out, "score_distribution")) == ["score,total_reviews", "5.0,1"]
    assert os.path.isdir(os.path.join(out, "schema_Orders"))
    # declared schema: the timestamp column is typed without an inference pass
    assert any(ln.startswith("Order_Purchase_Timestamp,4,timestamp,")
               for ln in _read(os.path.join(out, "schema_Orders")))
