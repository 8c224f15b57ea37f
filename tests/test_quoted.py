"""Quoted line breaks over many splits against Spark's own reader."""

import csv
import io
import random

import pytest

from civicloom.sources import files, quoted

HEADER = ["Percent\nLevel 3", "a,b", 'say "hi"', "plain"]


def body(rows, end="\n", header=HEADER):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def cell(r):
    kind = r.random()
    if kind < 0.1:
        return "\n".join(["x" * r.randrange(30)] * r.randrange(1, 60))
    if kind < 0.2:
        return 'quote " and "" more, ' * r.randrange(3)
    if kind < 0.25:
        return '",\n"'
    return "".join(r.choice("abc dé,") for _ in range(r.randrange(12)))


@pytest.fixture
def split_small(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def both(spark, path):
    own = quoted.read_quoted_csv(spark, path)
    theirs = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    return own, sorted(map(tuple, own.collect()), key=repr), sorted(map(tuple, theirs.collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_the_whole_file_reader(spark, tmp_path, split_small, end):
    r = random.Random(len(end))
    rows = [[cell(r) for _ in range(4)] for _ in range(3000)]
    rows[700][1] = "long\n" * 9000  # over many splits
    (tmp_path / "a.csv").write_text(body(rows, end), newline="")
    own, got, want = both(spark, str(tmp_path / "a.csv"))
    assert own.columns == ["percent_level_3", "ab", "say_hi", "plain"] and len(got) == 3000
    if end == "\n":
        assert got == want
    assert got == sorted((tuple(c if c else None for c in row) for row in rows), key=repr)
    assert quoted._lines(spark, str(tmp_path / "a.csv")).rdd.getNumPartitions() > 20


def test_stray_quotes_blank_lines_and_no_last_line_end(spark, tmp_path, split_small):
    text = 'a,b,c\n1,5" pipe,x\n\n2,"y\n\nz",6"\n"a,b,c",,\na,b,c\n' + 'p,q"r"s,t\n' * 2000 + '3,"end\nof file",last'
    (tmp_path / "a.csv").write_text(text)
    _, got, want = both(spark, str(tmp_path / "a.csv"))
    assert got == want and len(got) == 2005


def test_many_files(spark, tmp_path, split_small):
    r = random.Random(9)
    rows = [[[cell(r) for _ in range(4)] for _ in range(n)] for n in (0, 1, 400, 900)]
    for k, own in enumerate(rows):
        (tmp_path / f"{k}.csv").write_text(body(own))
    _, got, want = both(spark, str(tmp_path))
    assert got == want and len(got) == 1301
    (tmp_path / "z.csv").write_text(body([["1"] * 4], header=HEADER[::-1]))
    with pytest.raises(ValueError, match="one header"):
        quoted.read_quoted_csv(spark, str(tmp_path))


def test_line_states():
    assert [quoted.ends_inside(line, False) for line in ("a,b", '"a', 'a,"b', 'a"b', '"a""', '"a"",b"', '"a",b"', '"a"b,"c', "", '""', '"""')] == [False, True, True, False, True, False, False, True, False, False, True]
    assert [quoted.ends_inside(line, True) for line in ("a", 'a"', 'a""', 'a"",', 'a",b', 'a","b', '"', '""', "")] == [True, False, True, True, False, True, False, True, True]


def test_read_csv_text_uses_it(spark, tmp_path):
    (tmp_path / "a.csv").write_text(body([["1\n2", "b", "c", ""]]))
    assert [tuple(r) for r in files.read_csv_text(spark, str(tmp_path), line_breaks=True).collect()] == [("1\n2", "b", "c", None)]
