"""Readers and writers: tolerant text, quoted multi-line CSV, glob, header."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.session import checkpoint_root
from tessera.sources import (bad_records, malformed_count, materialize, read_delimited,
                             read_delimited_tolerant, read_glob, read_header_inferred,
                             read_quoted_multiline, read_wordlist, write_delimited,
                             write_key_value_text, write_report)

from conftest import rows


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_tolerant_reader_drops_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    _write(os.path.join(d, "movies.txt"),
           "1,Toy Story,3\n\n   \n2,Short\n3,Trailing,\n4,Bad number,abc\n"
           " 5 , Spaces , 7 \n\t6,Tab,8\r\n7,A, B (1990),9\n")
    fields = [("id", "bigint"), ("title", "string"), ("n", "int")]
    got = rows(read_delimited_tolerant(spark, d, fields, min_fields=3))
    assert got == [(1, "Toy Story", 3), (5, "Spaces", 7), (6, "Tab", 8)]
    counts = malformed_count(spark, d, fields, min_fields=3).first()
    assert (counts["kept"], counts["malformed"]) == (3, 6)
    # split limit 3: the third field keeps its commas
    three = [("id", "bigint"), ("title", "string"), ("rest", "string")]
    got = dict((r[0], r[2]) for r in rows(read_delimited_tolerant(spark, d, three, 3, limit=3)))
    assert got[7] == "B (1990),9"


def test_quoted_multiline_round_trip(spark):
    text = ['plain', 'has ; separator', 'has ""doubled"" quotes', 'line\nbreak\r\nand CR',
            '  leading and trailing  ', '', None, '"quoted";"fields"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "id bigint, text string")
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-test-"), "csv")
    write_delimited(df, path, sep=";", header=True, quoted=True)
    schema = StructType([StructField("id", LongType()), StructField("text", StringType())])
    back = read_quoted_multiline(spark, path, schema, sep=";", header=True)
    assert back.count() == len(text)
    got = dict(rows(back))
    for i, t in enumerate(text):
        assert got[i] == t, (i, got[i], t)


def test_unquoted_semicolon_reader_empty_is_null(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    _write(os.path.join(d, "part-0"), "1;a,b;X\n2;;Y\n")
    schema = StructType([StructField(n, StringType()) for n in ("id", "review", "aspect")])
    assert rows(read_delimited(spark, d, schema)) == [("1", "a,b", "X"), ("2", None, "Y")]


def test_glob_reads_several_files_with_provenance(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    _write(os.path.join(d, "ratings_1.txt"), "1,10,4.0\n2,10,3.0\n")
    _write(os.path.join(d, "ratings_2.txt"), "3,11,5.0\n")
    _write(os.path.join(d, "other.txt"), "9,99,1.0\n")
    schema = StructType([StructField("user", StringType()), StructField("item", StringType()),
                         StructField("score", StringType())])
    df = read_glob(spark, os.path.join(d, "ratings_*.txt"), schema)
    got = sorted((r["user"], os.path.basename(r["source_file"])) for r in df.collect())
    assert got == [("1", "ratings_1.txt"), ("2", "ratings_1.txt"), ("3", "ratings_2.txt")]


def test_glob_fails_on_skips_and_counts_bad_records(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    _write(os.path.join(d, "ratings_1.txt"), "1,10,4.0\n2,10,x\n\n   \n3,10\n4,10,1.0,9\n5,11,\n")
    _write(os.path.join(d, "ratings_2.txt"), "6,11,5.0\n")
    _write(os.path.join(d, "ratings_3.txt"), "y,11,5.0\n")
    path, schema = os.path.join(d, "ratings_*.txt"), "user int, item int, score double"
    assert read_glob(spark, path, schema).count() == 7
    kept = read_glob(spark, path, schema, bad="skip")
    assert rows(kept.select("user", F.coalesce("score", F.lit(-1.0)).alias("score"))) == [
        (1, 4.0), (5, -1.0), (6, 5.0)]
    assert kept.count() == 3 and kept.columns == ["user", "item", "score", "source_file"]
    assert kept.select("item").count() == 3        # however few columns are in use
    counts = {os.path.basename(r["source_file"]): (r["n_good"], r["n_bad"])
              for r in bad_records(spark, path, schema).collect()}
    assert counts == {"ratings_1.txt": (2, 3), "ratings_2.txt": (1, 0), "ratings_3.txt": (0, 1)}
    good = os.path.join(d, "ratings_2.txt")
    assert read_glob(spark, good, schema, bad="fail", source_col=None).collect() == [(6, 11, 5.0)]
    for use in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("item").collect()):
        with pytest.raises(Exception, match="bad record in .*ratings_3.txt: y,11,5.0"):
            use(read_glob(spark, os.path.join(d, "ratings_3.txt"), schema, bad="fail"))
    with pytest.raises(ValueError, match="bad = "):
        read_glob(spark, path, schema, bad="drop")
    with pytest.raises(ValueError, match="reserved"):
        bad_records(spark, path, "__file string")


def test_header_inferred_types(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    _write(os.path.join(d, "c.csv"), "Order_ID;Price;Review_Score\na1;1.5;4\na2;2;abc\n")
    df = read_header_inferred(spark, d, sep=";")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types == {"Order_ID": "string", "Price": "double", "Review_Score": "string"}


def test_wordlist_and_writers(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    _write(os.path.join(d, "stop.txt"), "và\n là \n\nvà\nthe\n")
    assert rows(read_wordlist(spark, d)) == [("là",), ("the",), ("và",)]
    df = spark.createDataFrame([("k", 1.5)], "k string, v double")
    kv = os.path.join(d, "kv")
    write_key_value_text(df, "k", "v", kv)
    assert [r[0] for r in spark.read.text(kv).collect()] == ["k\t1.5"]
    rep = os.path.join(d, "rep")
    write_report(spark.createDataFrame([("line 1",), ("line 2",)], "value string"), rep,
                 single_file=True)
    assert len([f for f in os.listdir(rep) if f.startswith("part-")]) == 1


def test_materialize_uses_shared_checkpoint_folder(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    back = materialize(df, spark, "stage")
    assert sorted(r[0] for r in back.collect()) == list(range(10))
    root = checkpoint_root(spark).replace("file:", "").lstrip("/")
    files = back.inputFiles()
    assert files and all("/tessera/stage-" in f for f in files)
    assert all(root in f for f in files)


def test_tab_separated_hand_over_between_jobs(spark):
    """A job's key<TAB>value output re-read by the next job (SRC-4, SNK-1):
    trimmed like one chained job, kept verbatim like the other."""
    d = tempfile.mkdtemp(prefix="tessera-test-")
    df = spark.createDataFrame([("m1 ", "GR:M:4.0"), ("m2", " GR:F:3.5")], "k string, v string")
    out = os.path.join(d, "stage1")
    write_key_value_text(df, "k", "v", out)
    fields = [("movie", "string"), ("value", "string")]
    trimmed = rows(read_delimited_tolerant(spark, out, fields, 2, sep="\t"))
    assert trimmed == [("m1", "GR:M:4.0"), ("m2", "GR:F:3.5")]
    verbatim = rows(read_delimited_tolerant(spark, out, fields, 2, sep="\t", trim_fields=False))
    assert verbatim == [("m1 ", "GR:M:4.0"), ("m2", " GR:F:3.5")]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_table_schemas_match_the_files(spark, sf):
    from tessera.sources.tables import TABLES, load
    d = f"/root/testdata/{sf}"
    if not os.path.isdir(d):
        pytest.skip("test tables not available")
    for t in TABLES:
        declared = load(spark, d, t).schema.simpleString()
        assert declared == load(spark, d, t, declared=False).schema.simpleString(), t
