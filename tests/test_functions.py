"""Column helpers: one test per semantic trap of the blueprint (§2.12)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import (band, clean_review, epoch_year, java_trim, last_field,
                               left_justify, split_java, split_tags, split_title_fields,
                               thousands, tokens, without_words)
from tessera.functions.bands import (LEFT_CLOSED_AGE_EDGES, LEFT_CLOSED_AGE_LABELS,
                                     RIGHT_CLOSED_AGE_EDGES, RIGHT_CLOSED_AGE_LABELS)
from tessera.functions.report import fixed2, python_fixed
from tessera.functions.timeparts import epoch_seconds


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_java_trim_strips_control_chars(spark):
    assert one(spark, java_trim("v"), "\t\x01 ab c \r\n") == "ab c"
    # Spark's own trim keeps tabs; the helper must not
    assert one(spark, F.trim("v"), "\tx") == "\tx"


def test_split_java_drops_trailing_empty_fields(spark):
    assert one(spark, split_java("v", ","), "1,2,") == ["1", "2"]
    assert one(spark, split_java("v", ","), "1,,3") == ["1", "", "3"]
    assert one(spark, split_java("v", ","), ",,") == []
    # a positive limit keeps the remainder (embedded commas) in the last field
    assert one(spark, split_java("v", ",", 3), "a,b,c,d") == ["a", "b", "c,d"]


def test_title_with_commas(spark):
    i, t, g = split_title_fields("v")
    df = spark.createDataFrame([("7,A, B (1990),X|Y",)], "v string")
    assert df.select(i, t, g).first()[:] == ("7", "A, B (1990)", "X|Y")
    assert one(spark, last_field("v"), "7,A, B (1990),X|Y") == "X|Y"


def test_split_tags_drops_empty_keeps_duplicates(spark):
    assert one(spark, split_tags("v"), "Drama||War|War|") == ["Drama", "War", "War"]


def test_clean_review_and_tokens(spark):
    raw = 'Phòng ""Đẹp""; SẠCH!\r\nGiá (rẻ)\t+ tốt '
    cleaned = one(spark, clean_review("v"), raw)
    assert cleaned == "phòng  đẹp   sạch   giá  rẻ \t  tốt"
    assert one(spark, tokens(clean_review("v")), raw) == ["phòng", "đẹp", "sạch", "giá", "rẻ",
                                                            "\t", "tốt"]
    assert one(spark, tokens("v", ","), "a,, ,b") == ["a", "b"]


def test_without_words_keeps_order_and_duplicates(spark):
    df = spark.createDataFrame([(["a", "the", "b", "a", "of"],)], "v array<string>")
    assert df.select(without_words(F.col("v"), ["the", "of"])).first()[0] == ["a", "b", "a"]


def test_band_edges_right_and_left_closed(spark):
    df = spark.createDataFrame([(a,) for a in ["17", "18", "19", "35", "36", "50", "51", "x", None]],
                               "age string")
    v = F.col("age").try_cast("double")
    right = band(v, RIGHT_CLOSED_AGE_EDGES, RIGHT_CLOSED_AGE_LABELS, "right")
    left = band(v, LEFT_CLOSED_AGE_EDGES, LEFT_CLOSED_AGE_LABELS, "left", default="Unknown")
    got = [(r[0], r[1], r[2]) for r in df.select("age", right, left).collect()]
    assert got == [
        ("17", "0-18", "Dưới 18"), ("18", "0-18", "18-34"), ("19", "18-35", "18-34"),
        ("35", "18-35", "35-49"), ("36", "35-50", "35-49"), ("50", "35-50", "50+"),
        ("51", "50+", "50+"), ("x", None, "Unknown"), (None, None, "Unknown"),
    ]


def test_epoch_year_is_utc_and_tolerant(spark):
    df = spark.createDataFrame([("978307199",), ("978307200",), ("x",), (None,), ("-1",)],
                               "v string")
    # 2000-12-31T23:59:59Z, 2001-01-01T00:00:00Z, garbage, NULL, 1969-12-31T23:59:59Z
    assert [r[0] for r in df.select(epoch_year("v")).collect()] == [
        "2000", "2001", "Unknown", "Unknown", "1969"]


def test_epoch_seconds_of_timestamp_ntz(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2001-01-01 00:00:01' AS t")
    assert df.select(epoch_seconds("t")).first()[0] == 978307201


def test_report_formatting(spark):
    # half-up two decimals (Java %.2f), padding never truncates, thousands
    assert one(spark, fixed2("v"), 4.125, "v double") == "4.13"
    assert one(spark, fixed2("v"), None, "v double") is None
    assert one(spark, left_justify("v", 5), "1234567") == "1234567"
    assert one(spark, left_justify("v", 5), "12") == "12   "
    assert one(spark, thousands("v"), 1234567, "v bigint") == "1,234,567"
    # Python rounding: ties on the exact binary value go to even
    assert one(spark, python_fixed("v"), 4.125, "v double") == "4.12"
    assert one(spark, python_fixed("v"), 1234.5, "v double") == "1234.50"


@settings(max_examples=40, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6, allow_nan=False),
                          st.integers(-4000, 4000).map(lambda k: k / 8)), min_size=1, max_size=50))
def test_python_fixed_matches_python(spark, values):
    # (values that round to minus zero are left out: Python prints "-0.00")
    values = [v for v in values if f"{v:.2f}" != "-0.00"]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(python_fixed("v")).collect()] == [f"{v:.2f}" for v in values]


def test_report_lines(spark):
    from tessera.plans import reports as RP
    long = spark.createDataFrame([(1010, "18-34", 3.6, "Lawrence of Arabia (1962)")],
                                 "item_id bigint, band string, avg_score double, title string")
    assert RP.age_lines(long).first()["line"] == (
        "ID: 1010  | Nhóm tuổi: 18-34    | Điểm TB: 3.60 | Phim: Lawrence of Arabia (1962)")
    labels = spark.createDataFrame([("Programmer", 4.25, 12345)],
                                   "label string, avg_score double, n_scores bigint")
    assert RP.occupation_lines(labels).first()["line"] == (
        "Nghề nghiệp: Programmer      | Điểm TB: 4.25 | Tổng số lượt đánh giá: 12,345")
    best = spark.createDataFrame([("1015", "Sunset Boulevard (1950)", 4.357, 7)],
                                 "item_id string, title string, avg_score double, n_scores bigint")
    block = [r["line"] for r in RP.summary_lines(best).orderBy("line_no").collect()]
    assert block[3:7] == ["ID phim: 1015", "Ten phim: Sunset Boulevard (1950)",
                          "Diem trung binh: 4.36 / 5.0", "So luot danh gia: 7 luot"]
