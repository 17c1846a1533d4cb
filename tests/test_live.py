import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from logsense.config import ParserConfig
from logsense.operators.grouping import group_entries
from logsense.sources.live_lines import LineReader, live_log_lines, line_ends
from logsense.sources.text_logs import read_log_lines
from logsense.streaming.live_grouping import group_stream, open_entries, settle
from logsense.streaming.state import disk_state


def append(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "ab") as f:
        f.write(data)


def follow(spark, tmp_path, **options):
    """One run over what has come since the last, and all lines so far."""
    options.setdefault("split_bytes", 16)
    lines = live_log_lines(spark, str(tmp_path / "logs"), str(tmp_path / "index"), **options)
    writer = lines.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).option("path", str(tmp_path / "lines"))
    writer.format("parquet").trigger(availableNow=True).start().awaitTermination()
    return sorted(map(tuple, spark.read.parquet(str(tmp_path / "lines")).collect()))


def batch(spark, tmp_path, **options):
    rows = read_log_lines(spark, str(tmp_path / "logs"), **options).select("log_file", "line_no", "line")
    return sorted(map(tuple, rows.collect()))


def test_growing_files_give_the_lines_of_the_batch_source(spark, tmp_path):
    a, b = tmp_path / "logs" / "a.log", tmp_path / "logs" / "x" / "y" / "b.log"
    append(a, b"one\ntwo\r\nthr")
    append(b, b"\xef\xbb\xbf\xff bad\rlone\r")
    append(tmp_path / "logs" / "_hidden.log", b"never\n")
    append(tmp_path / "logs" / "other.txt", b"no log\n")
    first = follow(spark, tmp_path)
    assert [(n, line) for f, n, line in first if f.endswith("a.log")] == [(1, "one"), (2, "two")]
    # between two runs the second byte of a line end comes, a line goes on, and a file is new
    append(a, b"ee\r")
    append(b, b"\nmore\n\n\n\r\r\nlast")
    append(tmp_path / "logs" / "c.log", b"\n")
    follow(spark, tmp_path)
    append(a, b"four\n" + b"a line that is much longer than a split of this test\n" * 9)
    append(b, b" without an end")
    follow(spark, tmp_path)
    assert follow(spark, tmp_path, closed_after=0) == batch(spark, tmp_path)
    assert follow(spark, tmp_path, closed_after=0) == batch(spark, tmp_path)  # nothing comes twice
    append(b, b"\nnext")
    with_next = follow(spark, tmp_path, closed_after=0)
    assert [(n, line) for f, n, line in with_next if f.endswith("b.log")][-2:] == [(9, ""), (10, "next")]


def test_excluded_files_and_lost_counts(spark, tmp_path):
    append(tmp_path / "logs" / "keep" / "a.log", b"1\n2\n3\n")
    append(tmp_path / "logs" / "drop" / "a.log", b"1\n")
    follow(spark, tmp_path, exclude_globs=("drop/*",))
    for path in glob.glob(str(tmp_path / "index" / "*" / "*")):
        os.remove(path)  # counts that got lost are made again
    append(tmp_path / "logs" / "keep" / "a.log", b"4\n" * 40)
    found = follow(spark, tmp_path, exclude_globs=("drop/*",))
    assert found == batch(spark, tmp_path, exclude_globs=("drop/*",)) and found[-1][1] == 43


def test_random_bytes_in_random_steps(tmp_path):
    """The reader alone, split by split, against a plain loop over the whole file."""
    rng = random.Random(2)
    path = tmp_path / "logs" / "r.log"
    whole = bytes(rng.choice(b"ab\n\r") for _ in range(600))
    reader = LineReader({"path": str(tmp_path / "logs"), "index": str(tmp_path / "index"), "split_bytes": "7"})
    offset, found, at = {}, [], 0
    while at < len(whole):
        step = rng.randint(1, 60)
        append(path, whole[at : at + step])
        at += step
        now = reader.latestOffset()
        splits = reader.partitions(offset, now)
        rng.shuffle(splits)
        found += [(n, v) for s in splits for b in reader.read(s) for n, v in zip(b["line_no"].to_pylist(), b["value"].to_pylist())]
        reader.commit(now)
        offset = now
    want = whole.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
    # a carriage return at the very end may still become one half of a pair
    done = want[:-2] if whole.endswith(b"\r") else want[:-1]
    assert sorted(found) == list(enumerate(done, 1))
    with pytest.raises(ValueError, match="shrunk"):
        reader.partitions(offset, {k: {"bytes": 1, "closed": False} for k in offset})
    assert line_ends(b"", 13).tolist() == []


CONFIG = ParserConfig(start_regexes=("^[A-Z]",), max_lines=4)


def entries(spark, tmp_path, config=CONFIG, idle_seconds=3600.0, **trigger):
    lines = live_log_lines(spark, str(tmp_path / "logs"), str(tmp_path / "index"), split_bytes=32)
    with disk_state(spark):
        found = group_stream(lines, config, idle_seconds)
        writer = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        return writer.option("path", str(tmp_path / "entries")).trigger(**(trigger or {"availableNow": True})).start()


def random_log(rng, n):
    return "".join(rng.choice(["Start", "more", "and more", ""]) + rng.choice([" x", ""]) + "\n" for _ in range(n)).encode()


@pytest.mark.parametrize("config", [CONFIG, ParserConfig(start_regexes=("^[A-Z]",), max_lines=0, join_with="\n"), ParserConfig(multiline=False)])
def test_entries_of_growing_files_are_those_of_the_batch(spark, tmp_path, config):
    rng = random.Random(7)
    for _ in range(3):
        for k, name in enumerate(("hot.log", "b/b.log", "c.log")):
            data = random_log(rng, [90, 7, 3][k])
            append(tmp_path / "logs" / name, data)
        entries(spark, tmp_path, config).awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "entries"))
    with disk_state(spark):
        still = open_entries(spark, str(tmp_path / "state"), config)
        assert still.count() <= 3
        got = sorted(map(tuple, closed.unionByName(still).collect()))
    whole = group_entries(read_log_lines(spark, str(tmp_path / "logs")), config)
    assert got == sorted(map(tuple, whole.select("log_file", "start_line_no", "raw", "n_lines").collect()))


def test_silence_closes_an_entry_without_new_lines(spark, tmp_path):
    append(tmp_path / "logs" / "a.log", b"First\nmore\n")
    query = entries(spark, tmp_path, idle_seconds=1.0, processingTime="500 milliseconds")
    try:
        end, found = time.time() + 60, []
        while time.time() < end and not found:
            time.sleep(0.5)
            if glob.glob(str(tmp_path / "entries" / "*.parquet")):
                found = spark.read.parquet(str(tmp_path / "entries")).collect()
    finally:
        query.stop()
    assert [(r.start_line_no, r.raw, r.n_lines) for r in found] == [(1, "First more", 2)]


def test_the_state_of_a_file():
    held, closed = settle(None, [(1, False, ["a"]), (2, True, ["B", "b"])], 0)
    assert (held, closed) == ((2, ["B", "b"], 4), [(1, ["a"])])
    assert settle(held, [(4, False, ["c"])], 3) == ((5, [], 5), [(2, ["B", "b", "c"])])
    assert settle(held, [(2, True, ["B", "b", "c"])], 0) == ((2, ["B", "b", "c"], 5), [])  # what came before is late
    assert settle(held, [(9, False, ["x"])], 0) == ((9, ["x"], 10), [(2, ["B", "b"])])  # a gap
    assert settle(held, [(3, False, ["b"])], 0) == (held, [])


def test_lines_in_any_order_within_a_batch(spark, tmp_path):
    rng = random.Random(1)
    rows = [("f", k + 1, rng.choice(["Start", "more"])) for k in range(50)] + [(None, 1, "Start")]
    frame = spark.createDataFrame(rows, "log_file string, line_no bigint, line string")
    frame.orderBy(F.rand(3)).repartition(4).write.parquet(str(tmp_path / "lines"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "lines"))
    with disk_state(spark):
        query = group_stream(stream, CONFIG).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        query.option("path", str(tmp_path / "entries")).trigger(availableNow=True).start().awaitTermination()
        both = spark.read.parquet(str(tmp_path / "entries")).unionByName(open_entries(spark, str(tmp_path / "state"), CONFIG))
        got = sorted(map(tuple, both.collect()))
    want = group_entries(frame.where("log_file = 'f'"), CONFIG).select("log_file", "start_line_no", "raw", "n_lines")
    assert got == sorted(map(tuple, want.collect()))
