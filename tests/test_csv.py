"""CSV files read in byte ranges against a whole-file parser."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from quillmill.sources import files, records
from quillmill.sources.records import ends_inside, read_csv

RANGE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of a few records."""
    spark.conf.set(RANGE, "2k")
    yield
    spark.conf.unset(RANGE)


def plain(text, width):
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), quoting=csv.QUOTE_NOTNULL) if r][1:]
    return [tuple((r + [None] * width)[:width]) for r in rows]


def value(rng):
    kind = rng.random()
    text = "".join(rng.choice(["a", "b,", '"', "\n", "\r\n", "\r", "é", " ", "xyz"]) for _ in range(rng.randint(0, 25 if kind < 0.95 else 400)))
    if kind < 0.3:
        return "".join(c for c in text if c not in '",\r\n')
    return '"' + text.replace('"', '""') + '"'


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n"), (3, "\n"), (4, "\n"), (5, "\r\n")])
def test_any_edge(spark, tmp_path, small_ranges, seed, end):
    """Quotes, commas and breaks within values over every range edge; odd quotes in bare values too."""
    rng = random.Random(seed)
    odd = ['ab"c', 'a""b', "x y", '"open" then bare', '""']
    lines = [",".join(rng.choice(odd) if rng.random() < 0.1 else value(rng) for _ in range(rng.randint(1, 5))) for _ in range(900)]
    text = "k,text,n,m" + end + end.join(lines) + (end if seed % 2 else "")
    (tmp_path / "c.csv").write_bytes(text.encode())
    spark.conf.set(RANGE, str(1500 + 97 * seed))
    in_order = read_csv(spark, str(tmp_path / "c.csv"), order=True).orderBy(*records.FILE_ORDER).collect()
    assert len({r["__start"] for r in in_order}) > 15
    assert [tuple(r)[:4] for r in in_order] == plain(text, 4)


def test_a_value_over_many_ranges(spark, tmp_path, small_ranges):
    long = "line without a quote\n" * 700
    text = f'k,text\n1,"{long}"\n2,"{long}""{long}"\n3,bare\n'
    (tmp_path / "c.csv").write_text(text)
    got = read_csv(spark, str(tmp_path / "c.csv")).collect()
    assert sorted(tuple(r) for r in got) == plain(text, 2)


def test_several_files(spark, tmp_path, small_ranges):
    """Ranges of several files in one task, a quote that is never closed, empty and header-only files."""
    bodies = {"a.csv": 'k,text\n1,"x\ny"\n', "b.csv": "k,text\n", "c.csv": "", "d.csv": 'k,text\n2,"' + "never closed\n" * 400, "e.csv": "k,text\n3,z\n\n\n,\n"}
    for name, body in bodies.items():
        (tmp_path / name).write_text(body)
    got = {tuple(r) for r in read_csv(spark, str(tmp_path)).collect()}
    assert got == {("1", "x\ny"), ("2", "never closed\n" * 400), ("3", "z"), (None, None)}


def test_types_and_clashing_names(spark, tmp_path):
    (tmp_path / "c.csv").write_text('text,inside,value,c0\n1,2,3,4\n"",x\n')
    rows = read_csv(spark, str(tmp_path / "c.csv")).collect()
    assert [r.asDict() for r in rows] == [
        {"text": "1", "inside": "2", "value": "3", "c0": "4"},
        {"text": "", "inside": "x", "value": None, "c0": None},
    ]
    typed = read_csv(spark, str(tmp_path / "c.csv"), "text string, inside long, value double, c0 int, extra string").collect()
    assert [tuple(r) for r in typed] == [("1", 2, 3.0, 4, None), ("", None, None, None, None)]


def test_state_of_a_line():
    cases = {b"a,b": (False, True), b'a,"b': (True, False), b'"a""': (True, False), b'a"b': (False, False), b'"': (True, False), b'""': (False, True), b'x",y"': (False, False), b'x","y': (True, True)}
    for line, (outside, inside) in cases.items():
        assert (ends_inside(line, False), ends_inside(line, True)) == (outside, inside), line


def test_one_file_uses_all_cores(spark, tmp_path):
    """Ranges are dealt to many tasks, and only ranges' summaries and loose edges are exchanged."""
    body = "k,text\n" + "".join(f'{i},"a\nb ""{i}"""\n' for i in range(20_000))
    (tmp_path / "c.csv").write_text(body)
    spark.conf.set(RANGE, "32k")
    try:
        got = read_csv(spark, str(tmp_path / "c.csv"), order=True)
        assert got.select("__start").distinct().count() >= 8
        assert got.count() == 20_000 and got.where(F.col("text") != F.concat(F.lit('a\nb "'), "k", F.lit('"'))).count() == 0
        lines = records._lines(spark, str(tmp_path / "c.csv")).withColumn("inside", F.lit(False))
        assert "Exchange" not in records._cut(lines, 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(RANGE)


def test_percent_of_records_over_ranges(spark, tmp_path, small_ranges):
    body = "a,text\n" + "".join(f'{i},"line\n{i}"\n' for i in range(1000))
    (tmp_path / "c.csv").write_text(body)
    got = files.read_corpus_csv(spark, str(tmp_path / "c.csv"), 50).collect()
    assert sorted(int(r.a) for r in got) == list(range(500))
