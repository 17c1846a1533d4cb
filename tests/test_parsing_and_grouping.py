import random

import pytest
from pyspark.sql import functions as F

from logsense.config import ParserConfig
from logsense.functions.parsing import effective_message, event_time, parse_entries
from logsense.operators import grouping
from logsense.plans.parse import parse_lines

FULL = "[2024-02-03 04:05:06.789] [debug  ] [disk] [ 1234: 77] [C0FFEE: 42] volume has not changed, check skipped"
SHORT = "[2024-02-03 04:05:07.001] 4321 CloseHandle_9 DONE code=0"


def parse(spark, raws, config=ParserConfig()):
    df = spark.createDataFrame([("f.log", i, r) for i, r in enumerate(raws, 1)], "log_file string, start_line_no bigint, raw string")
    return parse_entries(df, config).orderBy("start_line_no").collect()


def test_layouts(spark):
    full, short, free = parse(spark, [FULL, SHORT, "free text"])
    assert (full.parsing_status, full.level, full.component, full.pid, full.tid, full.file_guid_prefix, full.line_no) == (
        "parsed", "DEBUG", "disk", 1234, 77, "C0FFEE", 42)
    assert full.timestamp == "2024-02-03 04:05:06.789" and full.message.endswith("skipped")
    assert (short.level, short.component, short.pid, short.tid, short.line_no) == (None, None, 4321, -1, -1)
    assert short.message == "CloseHandle_9 DONE code=0"
    assert (free.parsing_status, free.message, free.pid, free.line_no, free.timestamp) == ("raw", "free text", -1, 3, None)


def test_level_map_multiline_message_and_mark_character(spark):
    head = "[t] [fnction] [c] [1: 2] [A1: 3] "
    mapped, marked, huge = parse(spark, [head + "a\nb ", head + "x\x01y", head.replace("1: 2", "99999999999999999999: 2")])
    assert (mapped.level, mapped.message) == ("FUNCTION", "a\nb")
    assert (marked.message, marked.level, marked.line_no) == ("x\x01y", "FUNCTION", 3)
    assert huge.pid == -1 and huge.message == ""


def test_missing_groups_and_no_patterns(spark):
    config = ParserConfig(patterns=(r"^(?P<level>\[?\w+\]?)?:(?P<pid>\d+)?",))
    some, none = parse(spark, ["[warn]:7 rest ", ":"], config)
    assert (some.level, some.pid, some.message, some.tid) == ("WARN", 7, "[warn]:7 rest", -1)
    assert (none.level, none.pid, none.parsing_status) == (None, -1, "parsed")
    assert parse(spark, [FULL], ParserConfig(patterns=()))[0].parsing_status == "raw"


def test_effective_message_and_event_time(spark):
    df = spark.createDataFrame([("m", "r"), ("", "r"), (None, "r"), ("", "")], "message string, raw string")
    assert [r[0] for r in df.select(effective_message()).collect()] == ["m", "r", "r", None]
    times = spark.createDataFrame([("2025-08-27 11:07:22.966",), ("2025-08-27T11:07:22,966",), ("x",)], "timestamp string")
    a, b, c = (r[0] for r in times.select(event_time()).collect())
    assert a == b and a.microsecond == 966000 and c is None


def fold(lines, cap, sep):
    """Entries of one file, line by line."""
    out, buf, first = [], [], None
    for no, line in lines:
        if buf and line.startswith("#"):
            out.append((first, sep.join(buf), len(buf)))
            buf = []
        if not buf:
            first = no
        buf.append(line)
        if cap and len(buf) >= cap:
            out.append((first, sep.join(buf), len(buf)))
            buf = []
    return out + ([(first, sep.join(buf), len(buf))] if buf else [])


@pytest.mark.parametrize("cap", [0, 1, 2, 3, 7])
def test_grouping_equals_a_sequential_fold(spark, monkeypatch, cap):
    monkeypatch.setattr(grouping, "LINES_PER_BLOCK", 11)
    rng = random.Random(cap)
    files = {
        f"f{i}": [(n, rng.choice(["# start", "more", "", "x # no"])) for n in range(1, rng.choice([2, 30, 200]))]
        for i in range(4)
    }
    files["none"] = [(n, "cont") for n in range(1, 40)]
    rows = [(f, n, s) for f, lines in files.items() for n, s in lines]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "log_file string, line_no bigint, line string").repartition(5)
    config = ParserConfig(start_regexes=("^#",), max_lines=cap, join_with="|")
    got = {(r.log_file, r.start_line_no, r.raw, r.n_lines) for r in grouping.group_entries(df, config).collect()}
    assert got == {(f, *e) for f, lines in files.items() for e in fold(lines, cap, "|")}


def test_grouping_off_and_without_start_patterns(spark):
    df = spark.createDataFrame([("f", 1, "a"), ("f", 2, "# b")], "log_file string, line_no bigint, line string")
    assert grouping.group_entries(df, ParserConfig(multiline=False)).count() == 2
    assert [r.raw for r in grouping.group_entries(df, ParserConfig(start_regexes=())).collect()] == ["a # b"]


def test_parsed_filters_do_not_repeat_the_regexes(spark):
    df = spark.createDataFrame([("f", 1, FULL), ("f", 2, "more"), ("f", 3, SHORT)], "log_file string, line_no bigint, line string")
    parsed = parse_lines(df)
    assert [r.message.split()[-1] for r in parsed.orderBy("start_line_no").collect()] == ["more", "code=0"]
    plan = parsed.filter("message <> ''").filter(F.col("level") == "DEBUG")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 2
