"""The splittable reader of quoted multi-line CSV gives the rows of Spark's own,
wherever the file is cut into ranges."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from tessera.sources import csv_split
from tessera.sources.csv import read_quoted_multiline
from tessera.sources.csv_split import LineStates, read_quoted_split

SCHEMA = "a string, b string, c string"


class Ranges:
    """A session whose files are cut into ranges of ``size`` bytes."""

    def __init__(self, spark, size):
        self.spark, self.conf = spark, {"spark.sql.files.maxPartitionBytes": str(size),
                                        "spark.sql.files.openCostInBytes": "0",
                                        "spark.sql.files.minPartitionNum": "1"}

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.old.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def both(spark, path, size, header=True, sep=";"):
    want = Counter(tuple(r) for r in read_quoted_multiline(spark, path, SCHEMA, sep, header).collect())
    with Ranges(spark, size):
        got = Counter(tuple(r) for r in read_quoted_split(spark, path, SCHEMA, sep, header).collect())
    return got, want


TRICKY = (b'a;b;c\n1;"x;y";z\n2;"line\nbreak ""quoted"" ;\n\n tail";""\n3;;\n'
          b'4;"""";"a""b"\n5;un"quoted;"end"\n6;"\n";"\n\n"\n\n7;"caf\xc3\xa9\n";last')


def test_every_cut_position(spark, tmp_path):
    # a longer header in each file moves all that follows past the cuts, every 20 bytes
    for k in range(20):
        (tmp_path / f"{k}.csv").write_bytes(b"a" * k + TRICKY)
    got, want = both(spark, str(tmp_path), 20)
    assert got == want and sum(want.values()) == 140
    for size in (1, 2):
        got, want = both(spark, str(tmp_path / "0.csv"), size)
        assert got == want


@pytest.mark.parametrize("text", [
    TRICKY.replace(b"\n", b"\r\n"), b"a;b;c\n", b"", b"a;b;c", b'a;"b\nb";c\n1;2;3\n', b"\n\na;b;c\n1;2;3\n\n",
    b'a;b;c\n"x"y;"p"q"r;s";t\n"u" ;v;w\n', b'a;b;c\n1;2\n1;2;3;4\n', b'"a\n;b;c\n1;2;3\nnever closed',
    b'\xef\xbb\xbfa;b;c\n1;2;3\n'])
@pytest.mark.parametrize("header", [True, False])
def test_odd_files(spark, tmp_path, text, header):
    path = str(tmp_path / "t.csv")
    with open(path, "wb") as f:
        f.write(text)
    got, want = both(spark, path, 11, header)
    assert got == want


def test_random_files_and_folders(spark, tmp_path):
    rnd = random.Random(7)
    for n in range(2):
        folder = tmp_path / f"f{n}"
        folder.mkdir()
        for k in range(12):
            rows = []
            for _ in range(rnd.randrange(1, 25)):
                fields = []
                for _ in range(3):
                    raw = "".join(rnd.choice(['a', ' ', ';', '"', '\n', 'é', '\\', ',', "'"])
                                  for _ in range(rnd.randrange(6)))
                    if any(c in raw for c in ';"\n') or rnd.random() < 0.3:
                        raw = '"' + raw.replace('"', '""') + '"'
                    fields.append(raw)
                rows.append(";".join(fields))
            (folder / f"p{k}.csv").write_text("a;b;c\n" + "\n".join(rows) + rnd.choice(["", "\n"]))
        got, want = both(spark, str(folder), 7)
        assert got == want, n


def test_a_record_over_many_ranges_and_a_long_one(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write('a;b;c\n1;"' + "many\nlines " * 5000 + '";x\n2;y;z\n')
    got, want = both(spark, path, 1000)
    assert got == want and sum(want.values()) == 2
    with Ranges(spark, 1000):
        df = read_quoted_split(spark, path, SCHEMA)
        assert csv_split._lines(spark, path).rdd.getNumPartitions() > 50
        assert df.count() == 2


def test_lines_dealt_by_range_beyond_the_broadcast(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.csv")
    with open(path, "wb") as f:
        f.write(TRICKY * 3)
    monkeypatch.setattr(csv_split, "BROADCAST_RANGES", 0)
    got, want = both(spark, path, 30)
    assert got == want


def test_other_splits_than_planned_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "wb") as f:
        f.write(TRICKY)
    df = read_quoted_split(spark, path, SCHEMA)
    with Ranges(spark, 10), pytest.raises(Exception, match="split otherwise"):
        df.select("a").distinct().collect()


def test_states_against_a_walk_over_the_characters():
    rnd = random.Random(3)
    states = LineStates(";")
    for _ in range(3000):
        line = "".join(rnd.choice('a";"') for _ in range(rnd.randrange(9)))
        for begun_inside in (False, True):
            mode = "Q" if begun_inside else "S"
            for c in line:
                if mode == "S":
                    mode = "Q" if c == '"' else "S" if c == ";" else "U"
                elif mode == "U":
                    mode = "S" if c == ";" else "U"
                elif mode == "Q":
                    mode = "E" if c == '"' else "Q"
                else:
                    mode = "Q" if c == '"' else "S" if c == ";" else "U"
            out = states.after(pa.array([line.encode()], pa.binary()))
            assert out[begun_inside][0] == (mode == "Q"), line
