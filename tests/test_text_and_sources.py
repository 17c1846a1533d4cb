import io
import re
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from logsense.functions import text
from logsense.functions.regex import to_java
from logsense.sources.text_logs import is_excluded, lines_of_texts, read_log_lines, read_raw_lines

#: (line, clean line)
LINES = [
    ('', ''),
    (' ', ''),
    ('  a b  ', 'a b'),
    ('\ufeffx', 'x'),
    ('\ufeff\ufffd\xef\xbb\xbfx\ufeffy', 'xy'),
    ('\xa0x\xa0y\xa0', 'x y'),
    ('\x1c\x1da\x85', 'a'),
    ('a\u200bb\u200e', 'ab'),
    ('\u200b a', ' a'),
    ('\u3000wide\u2003', 'wide'),
    ('caf\xe9\xa0au', 'caf\xe9 au'),
    ('\xef\xbf\xbdz', 'z'),
    ('tab\tin', 'tab\tin'),
]


def test_clean_line(spark):
    df = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(LINES)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", text.clean_line(F.col("s")).alias("c")).collect()}
    assert got == {i: clean for i, (_, clean) in enumerate(LINES)}


@pytest.mark.parametrize("body", ["", "a", "a\n", "a\n\n", "a\r\nb\rc\nd", "\n", "\r", "\r\n\r\n", "a\n\r", "x\r\r\ny"])
def test_split_lines(spark, body):
    df = spark.createDataFrame([("f", body)], "f string, t string")
    got = [r.line for r in lines_of_texts(df, F.col("f"), F.col("t")).orderBy("line_no").collect()]
    assert got == [x.strip() for x in io.StringIO(body, newline=None)]


PATTERNS = [
    r"^(?P<a_b>\w+)\s+(?P<c>\d+)$", r"^(?P<x>[-[:.\w&&]+)=(?P<y>[^]\s]*)", r"^(?P<q>['\"]).*?(?P=q)", r"^\((?P<in_>[^)]*)\)\Z",
    r"^(?:a|b)(?P<rest>.*)$", r"^(?P<s>\S+)\s(?P<t>[\s\d]*)",
]
SUBJECTS = ["word 12", "w\u00f6rd\x1c\u0663", "a[b&=c]d", "'quo' te", "(in)", "(in)\n", "bcd\nef", "x \t 1", "word 1\n", "-:.=", ""]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_patterns_mean_the_same_in_java(spark, pattern):
    java, python = to_java(pattern), re.compile(pattern, re.DOTALL)
    df = spark.createDataFrame(list(enumerate(SUBJECTS)), "i int, s string")
    rx = java.anchored()
    groups = [F.regexp_extract("s", rx, g).alias(f"g{g}") for g in range(1, java.n_groups + 1)]
    for row in df.select("i", F.col("s").rlike(rx).alias("hit"), *groups).collect():
        m = python.match(SUBJECTS[row.i])
        assert row.hit == bool(m), SUBJECTS[row.i]
        if m:
            assert [row[f"g{g}"] for g in range(1, java.n_groups + 1)] == [g or "" for g in m.groups()]


def test_excludes_agree_with_pathlib(spark):
    paths = ["/a/b/js.log", "/a/js.log", "/a/b/c.bxlog", "/a/x/b.log", "/a/b.log/c", "/logs/[1].log", "/a/b1.log"]
    globs = ["**/js.log", "**/*.bxlog", "x/b.log", "/a/b.log", "b?.log", "b[0-4].log", "b[!0-4].log", "", "*.log", "[[]1].log"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for glob in globs:
        got = {r.p: r.x for r in df.select("p", is_excluded(F.col("p"), [glob]).alias("x")).collect()}
        assert got == {p: bool(glob) and PurePosixPath(p).match(glob) for p in paths}, glob


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def test_files_are_found_numbered_and_cleaned(spark, tmp_path):
    write(tmp_path / "a.log", b"\xef\xbb\xbfone\r\ntwo \xff\rthree\n\nfive")
    write(tmp_path / "s p+q%" / "b.log", b"x\ny\n")
    write(tmp_path / "s p+q%" / "skip.log", b"no\n")
    write(tmp_path / "c.txt", b"no\n")
    got = {(r.log_file, r.line_no): r.line for r in read_log_lines(spark, str(tmp_path), exclude_globs=["skip.*"]).collect()}
    a, b = str(tmp_path / "a.log"), str(tmp_path / "s p+q%" / "b.log")
    assert got == {(a, 1): "one", (a, 2): "two \ufffd", (a, 3): "three", (a, 4): "", (a, 5): "five", (b, 1): "x", (b, 2): "y"}
    flat = read_log_lines(spark, str(tmp_path), pattern="*.log")
    assert {r.log_file for r in flat.collect()} == {a}
    nested = read_log_lines(spark, str(tmp_path), pattern="**/s*/b.*")
    assert {r.log_file for r in nested.collect()} == {b}
    assert read_log_lines(spark, b).count() == 2
    write(tmp_path / "r" / "q" / "r" / "d.log", b"z\n")
    assert read_log_lines(spark, str(tmp_path / "r"), pattern="**/q/**/d.log").count() == 1
    assert read_log_lines(spark, str(tmp_path / "r"), pattern="**/none/d.log").count() == 0


def test_numbers_run_on_across_splits(spark, tmp_path):
    lines = [f"{i} " + "x" * (i % 37) for i in range(3000)]
    write(tmp_path / "big.log", "\n".join(lines).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read_raw_lines(spark, str(tmp_path)).select("block").distinct().count() > 5
        got = {r.line_no: r.line for r in read_log_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i + 1: s.strip() for i, s in enumerate(lines)}


def test_a_glob_without_a_hit_gives_no_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\n")
    assert read_log_lines(spark, str(tmp_path), pattern="*.txt").count() == 0
    assert read_log_lines(spark, str(tmp_path), pattern="*.log").count() == 1
