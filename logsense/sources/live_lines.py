"""Growing log files as a stream of numbered lines.

A micro-batch takes the bytes that each file has gained since the one before. The range is read in splits, so that a file
with a large backlog is read by several tasks. A line belongs to the split that holds its terminator, wherever it began; so
no line is read before it is whole. The number of lines before a split is a small file in the ``index`` folder, which the
task that read up to there has written; where one is not there (yet), the bytes between are counted again. So a repeated,
speculative or lost task gives the same numbers, and nothing but file names and sizes passes through the driver.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from logsense.functions.regex import glob_to_regex, right_anchored_glob
from logsense.functions.text import clean_line
from logsense.sources.paths import open_path

#: Least bytes of a split, and the most splits of one file in a micro-batch.
SPLIT_BYTES, FILE_SPLITS = 64 << 20, 16
#: Bytes that a task holds at a time, and lines of one Arrow batch.
CHUNK_BYTES, BATCH_LINES = 8 << 20, 1 << 16
SCHEMA = "log_file string, line_no bigint, value binary"
_NEWLINE, _RETURN = 10, 13


def line_ends(data: bytes, before: int) -> np.ndarray:
    """Places in ``data`` that end a line: a line feed, or the byte after a lone carriage return.

    ``before`` is the byte ahead of ``data`` (0 at the start of a file). A carriage return ends its line only when the next byte
    is there and no line feed, so the two of a pair are one end, also when a range ends between them.
    """
    values = np.frombuffer(data, np.uint8)
    after_return = np.empty(len(values), bool)
    after_return[:1] = before == _RETURN
    after_return[1:] = values[:-1] == _RETURN
    return np.flatnonzero((values == _NEWLINE) | after_return)


@dataclass
class LineSplit(InputPartition):
    """The ``bounds`` of a file's splits in this micro-batch, and which of them this is.

    ``last``: the file ends with it, and what follows the last terminator is a line of its own. ``fresh``: that was so
    at the first of the bounds, so no line goes on there.
    """

    path: str
    bounds: tuple[int, ...]
    number: int
    last: bool
    fresh: bool


class LineReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root, self.index = options["path"].rstrip("/") or "/", options["index"].rstrip("/")
        self.pattern = re.compile(_python(glob_to_regex(options.get("pattern", "**/*.log"))))
        excludes = [right_anchored_glob(g) for g in options.get("excludes", "").split("\n") if g]
        self.excludes = [re.compile(_python(g)) for g in excludes if g]
        self.closed_after = float(options.get("closed_after", "inf"))
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))

    # -- on the driver: names and sizes only --------------------------------------------------

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Per file its bytes, and whether it was silent for ``closed_after`` seconds, so that an unended line counts."""
        system, root = open_path(self.root)
        selector = fs.FileSelector(root, recursive=True, allow_not_found=True)
        found, now = {}, time.time()
        for info in system.get_file_info(selector):
            inside = info.path.removeprefix(root).lstrip("/")
            hidden = any(part.startswith(("_", ".")) for part in inside.split("/"))
            if info.type != fs.FileType.File or hidden or not self.pattern.fullmatch(inside):
                continue
            if any(e.search("/" + info.path.lstrip("/")) for e in self.excludes):
                continue
            silent = info.mtime_ns is not None and now - info.mtime_ns / 1e9 >= self.closed_after
            found[info.path] = {"bytes": info.size, "closed": bool(silent)}
        return found

    def partitions(self, start: dict, end: dict) -> list[LineSplit]:
        out = []
        for path, now in sorted(end.items()):
            then = start.get(path, {"bytes": 0, "closed": False})
            a, b = then["bytes"], now["bytes"]
            ends = now["closed"] and not (then["closed"] and a == b)
            if b < a:
                raise ValueError(f"{path} has shrunk from {a} to {b} bytes: a file may only grow")
            if a == b and not ends:
                continue
            size = max(self.split_bytes, -(-(b - a) // FILE_SPLITS))
            bounds = tuple(range(a, b, size)) + (b,) if b > a else (a, a)
            out += [LineSplit(path, bounds, k, ends and k == len(bounds) - 2, then["closed"]) for k in range(len(bounds) - 1)]
        return out

    def commit(self, end: dict) -> None:
        """Counts below the offset that Spark goes on from are not needed any more."""
        store, index = open_path(self.index)
        for path, now in end.items():
            folder = f"{index}/{_name(path)}"
            for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if info.base_name.isdigit() and int(info.base_name) < now["bytes"]:
                    store.delete_file(info.path)

    # -- in the tasks ----------------------------------------------------------------------------

    def read(self, split: LineSplit) -> Iterator[pa.RecordBatch]:
        system, _ = open_path(self.root)
        store, index = open_path(self.index)
        counts = _Counts(store, f"{index}/{_name(split.path)}")
        a, b = split.bounds[split.number], split.bounds[split.number + 1]
        with system.open_input_file(split.path) as file:
            number = counts.before(file, split.bounds[: split.number + 1])
            open_line = _line_so_far(file, a, split.bounds[0] if split.fresh else 0)
            for data, before in _chunks(file, a, b):
                ends = line_ends(data, before)
                lines = _cut(open_line, data, ends)
                open_line = lines.pop()
                for k in range(0, len(lines), BATCH_LINES):
                    yield _batch(split.path, number + k, lines[k : k + BATCH_LINES])
                number += len(lines)
            if split.last and open_line:
                yield _batch(split.path, number, [open_line.removesuffix(b"\r")])
                number += 1
            counts.write(b, number)


def _name(path: str) -> str:
    return hashlib.sha256(path.encode()).hexdigest()[:32]


def _python(java: str) -> str:
    """The globs' patterns use what both languages share."""
    return java.replace("(?s)", "")


def _chunks(file, a: int, b: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, byte ahead of them) of the range from ``a`` to ``b``."""
    before = file.read_at(1, a - 1)[0] if a else 0
    for at in range(a, b, CHUNK_BYTES):
        data = file.read_at(min(CHUNK_BYTES, b - at), at)
        yield data, before
        before = data[-1] if data else before


def _line_so_far(file, a: int, begin: int) -> bytes:
    """What of the line that is open at ``a`` comes before it: back to the last end of a line, or to ``begin``."""
    parts: list[bytes] = []
    at, step = a, 1 << 12
    while at > begin:
        start = max(begin, at - step)
        data = file.read_at(at - start, start)
        ends = line_ends(data, file.read_at(1, start - 1)[0] if start else 0)
        if len(ends):
            end = int(ends[-1])
            # the byte after a lone carriage return is the first of its line
            parts.append(data[end + 1 :] if data[end] == _NEWLINE else data[end:])
            break
        parts.append(data)
        at, step = start, step * 4
    return b"".join(reversed(parts))


def _cut(open_line: bytes, data: bytes, ends: np.ndarray) -> list[bytes]:
    """The lines that end in ``data`` without their terminators, and last what is left open."""
    lines, at = [], 0
    for end in ends.tolist():
        feed = data[end] == _NEWLINE
        line = data[at:end]
        if open_line:
            line, open_line = open_line + line, b""
        lines.append(line.removesuffix(b"\r"))
        at = end + 1 if feed else end
    lines.append(open_line + data[at:])
    return lines


def _batch(path: str, number: int, lines: list[bytes]) -> pa.RecordBatch:
    numbers = pa.array(np.arange(number + 1, number + 1 + len(lines)))
    return pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), numbers, pa.array(lines, pa.binary())], names=["log_file", "line_no", "value"])


class _Counts:
    """Numbers of lines before places of one file, in a folder that all tasks reach."""

    def __init__(self, store: fs.FileSystem, folder: str):
        self.store, self.folder = store, folder

    def read(self, at: int) -> int | None:
        if at == 0:
            return 0
        try:
            with self.store.open_input_stream(f"{self.folder}/{at}") as f:
                return int(f.read())
        except FileNotFoundError:
            return None

    def write(self, at: int, number: int) -> None:
        self.store.create_dir(self.folder, recursive=True)
        draft = f"{self.folder}/.{at}-{time.time_ns()}"
        with self.store.open_output_stream(draft) as f:
            f.write(str(number).encode())
        self.store.move(draft, f"{self.folder}/{at}")

    def before(self, file, bounds: tuple[int, ...]) -> int:
        """Lines that end before the last of ``bounds``: from the nearest place that is known, else from the start."""
        known, at = None, 0
        for place in reversed(bounds):
            known, at = self.read(place), place
            if known is not None:
                break
        if known is None:
            known, at = 0, 0
        for data, before in _chunks(file, at, bounds[-1]):
            known += len(line_ends(data, before))
        return known


class LogLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineReader:
        return LineReader(self.options)


def live_log_lines(
    spark: SparkSession, path: str, index: str, pattern: str = "**/*.log", exclude_globs: tuple[str, ...] = (),
    closed_after: float | None = None, split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """``log_file, line_no, line`` of the files under ``path`` that match, as a stream that follows them as they grow.

    The lines and numbers are those of ``read_log_lines``. ``index`` is a folder for line counts that all executors
    reach; it belongs to one query and its checkpoint. A line without a terminator is held back until one comes; with ``closed_after``
    it is given once its file was silent for so many seconds, and what comes later starts another line. A file that
    shrinks fails the query. Names starting with ``_`` or ``.`` are never read.
    """
    spark.dataSource.register(LogLines)
    reader = spark.readStream.format("log_lines").option("path", path).option("index", index).option("pattern", pattern)
    reader = reader.option("excludes", "\n".join(exclude_globs)).option("split_bytes", str(split_bytes))
    if closed_after is not None:
        reader = reader.option("closed_after", str(closed_after))
    return reader.load().select("log_file", "line_no", clean_line(F.make_valid_utf8(F.col("value").cast("string"))).alias("line"))
