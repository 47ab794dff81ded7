"""One-pass type inference against Spark's own."""

import random

from pyspark.sql import functions as F

from tessera.sources import infer
from tessera.sources.infer import infer_types, read_header_one_pass

KINDS = {
    "int": ["1", "-5", "+7", "007", "2147483647", "-2147483648"],
    "long": ["2147483648", "-9223372036854775808"],
    "big": ["99999999999999999999", "1.", "-123456789012345678901.", "000099999999999999999999"],
    "huge": ["12345678901234567890123456789012345678901"],
    "double": ["1.5", ".5", "-.5e-3", "1e5", "NaN", "Inf", "-Inf", "Infinity", " 1", "1 ", "1.5d", "1f", "1e400"],
    "date": ["2020-01-01", "1999-12-31"],
    "time": ["2020-01-01 10:00:00", "2020-1-1", "2020-01", "2020-01-01T10:00:00Z", "2020-01-01 10:00:00.123",
             "2020-01-01 10:00:00+02:00", "2020-01-01 10"],
    "bool": ["true", "FALSE", "True"],
    "text": ["abc", "nan", "INF", "1_000", "2020-13-01", "2020/01/01", "1L", "t", "0x", "- 1", "1,5"],
    "none": [""]}


def spark_types(spark, path):
    df = spark.read.options(sep=";", header="true", inferSchema="true", quote='"', escape='"').csv(path)
    return [f.dataType.simpleString() for f in df.schema]


def write(path, columns):
    rows = zip(*columns)
    path.write_text("\n".join([";".join(f"c{k}" for k in range(len(columns))), *map(";".join, rows)]) + "\n")
    return str(path)


def test_single_cells_and_random_columns(spark, tmp_path):
    singles = [[v] for vs in KINDS.values() for v in vs]
    rnd = random.Random(1)
    groups = [["int", "none"], ["int", "long"], ["int", "long", "big"], ["int", "big", "none"], ["long", "big"],
              ["int", "double"], ["big", "double"], ["int", "huge"], ["big", "huge"], ["date", "none"],
              ["date", "time"], ["time"], ["bool", "none"], ["bool", "text"], ["date", "bool"], ["time", "double"],
              ["int", "text"], ["none"], ["date", "text"], ["big"], ["long"], ["double", "none"]]
    mixed = [[rnd.choice(KINDS[rnd.choice(g)]) for _ in range(12)] for g in groups for _ in range(6)]
    for name, columns in (("a", singles), ("b", mixed)):
        path = write(tmp_path / f"{name}.csv", columns)
        df, rows = read_header_one_pass(spark, path)
        want = spark_types(spark, path)
        got = [f.dataType.simpleString() for f in df.schema]
        assert [(c, g, w) for c, g, w in zip(columns, got, want) if g != w] == []
        assert rows == len([r for r in zip(*columns) if any(r)])


def test_a_number_among_dates_is_text_in_any_order(spark):
    for values in (["2020-01-01", "2020"], ["2020", "2020-01-01"]):
        schema, _ = infer_types(spark.createDataFrame([(v,) for v in values], "a string"))
        assert schema[0].dataType.simpleString() == "string"


def test_tables_of_no_rows_nulls_and_odd_names(spark, tmp_path):
    t = spark.createDataFrame([(None, "1", None), (None, "2.5", "x")], "`a.b` string, c0 string, `t0;` string")
    schema, rows = infer_types(t)
    assert [f.dataType.simpleString() for f in schema] == ["string", "double", "string"] and rows == 2
    assert schema.names == ["a.b", "c0", "t0;"]
    schema, rows = infer_types(t.where("false"))
    assert {f.dataType.simpleString() for f in schema} == {"string"} and rows == 0


def test_values_are_read_under_the_types(spark, tmp_path):
    path = write(tmp_path / "v.csv", [["1", "2"], ["x", ""], ["2020-01-01", "2020-01-02"]])
    df, rows = read_header_one_pass(spark, path)
    assert rows == 2 and [tuple(map(str, r)) for r in df.orderBy("c0").collect()] == [
        ("1", "x", "2020-01-01"), ("2", "None", "2020-01-02")]


def test_one_aggregate_merges_partitions(spark):
    t = spark.range(0, 100, 1, 8).select(F.when(F.col("id") == 99, "2.5").otherwise(F.col("id").cast("string"))
                                         .alias("a"))
    schema, rows = infer_types(t)
    assert schema[0].dataType.simpleString() == "double" and rows == 100
    assert infer.merged_type(0, None, None).simpleString() == "string"
