"""Multi-line entries from a stream of numbered lines, with one open entry per file in keyed state and a timer for silence.

Within a task the lines of a file that follow on each other form a run. All of a run's entries but the first and the last
are whole and pass by; only the fragments at its edges go to the state of their file. So a file that sends a third of all lines puts
no more than its edges into one task, and a batch touches the state of its own files alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logsense.config import ParserConfig
from logsense.functions.parsing import is_entry_start

ENTRIES = "log_file string, start_line_no bigint, raw string, n_lines int"
_FRAGMENTS = "log_file string, way int, first_line bigint, starts boolean, lines array<string>"
_STATE = "start_line_no bigint, lines array<string>, next_line_no bigint"
#: Tasks over which the whole entries of a file are dealt.
WAYS = 64


def cut_run(first_line: int, lines: list[str], starts: np.ndarray) -> Iterator[tuple[bool, int, bool, list[str]]]:
    """(at an edge, first line, begins with a start line, lines) of the pieces between a run's start lines."""
    marks = [0, *(m for m in np.flatnonzero(starts).tolist() if m), len(lines)]
    for k, (a, b) in enumerate(zip(marks[:-1], marks[1:])):
        begins = bool(starts[a])
        yield (k == 0 and not begins) or b == len(lines), first_line + a, begins, lines[a:b]


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files = batch.column("log_file").to_pandas().to_numpy()
        codes, names = pd.factorize(files)
        numbers = batch.column("line_no").to_numpy()
        order = np.lexsort((numbers, codes))
        codes, numbers = codes[order], numbers[order]
        lines = batch.column("line").take(pa.array(order)).to_pylist()
        starts = batch.column("starts").take(pa.array(order)).to_numpy(zero_copy_only=False).astype(bool)
        breaks = np.flatnonzero((np.diff(codes) != 0) | (np.diff(numbers) != 1)) + 1
        bounds = [0, *breaks.tolist(), len(lines)]
        rows = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a < b:
                for edge, first, begins, part in cut_run(int(numbers[a]), lines[a:b], starts[a:b]):
                    rows.append((names[codes[a]], -1 if edge else first % WAYS, first, begins, part))
        columns = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["log_file", "way", "first_line", "starts", "lines"]
        )


def chunks(start: int, lines: list[str], most: int) -> list[tuple[int, list[str]]]:
    """An entry cut every ``most`` lines (0: never)."""
    step = most or max(len(lines), 1)
    return [(start + k, lines[k : k + step]) for k in range(0, len(lines), step)]


def settle(held: tuple | None, fragments: list[tuple[int, bool, list[str]]], most: int) -> tuple[tuple, list[tuple[int, list[str]]]]:
    """The state (start, lines, next line) of a file after ``fragments`` (first line, begins with a start, lines), and what was closed.

    Lines behind the next line to come are late and left out. A gap closes what is open: what follows is an entry of its own.
    """
    start, lines, frontier = held or (0, [], None)
    closed: list[tuple[int, list[str]]] = []
    for first, begins, part in sorted(fragments, key=lambda f: f[0]):
        if frontier is not None and first < frontier:
            part, first, begins = part[frontier - first :], frontier, begins and first == frontier
        if not part:
            continue
        follows = bool(lines) and not begins and start + len(lines) == first
        if not follows:
            if lines:
                closed.append((start, lines))
            start, lines = first, []
        whole = chunks(start, lines + part, most)
        # a full entry is closed at once; the next chunk begins with the line that comes
        if most and len(whole[-1][1]) == most:
            closed += whole
            start, lines = start + len(lines) + len(part), []
        else:
            closed += whole[:-1]
            start, lines = whole[-1]
        frontier = first + len(part)
    return (start, lines, frontier), closed


class OpenEntries(StatefulProcessor):
    """Keeps the open entry of a file; emits it when it is full, when another begins, or when the file was silent."""

    def __init__(self, most: int, join_with: str, idle_seconds: float):
        self.most, self.join_with, self.idle = most, join_with, idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _STATE)

    def _rows(self, file: str, entries: list[tuple[int, list[str]]]) -> pd.DataFrame:
        rows = [(file, start, self.join_with.join(lines), len(lines)) for start, lines in entries]
        return pd.DataFrame(rows, columns=["log_file", "start_line_no", "raw", "n_lines"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        file, way = key
        if way >= 0:
            for frame in rows:
                whole = zip(frame["first_line"], frame["lines"])
                yield self._rows(file, [c for first, lines in whole for c in chunks(int(first), list(lines), self.most)])
            return
        parts = [
            (int(first), bool(begins), list(lines))
            for frame in rows for first, begins, lines in zip(frame["first_line"], frame["starts"], frame["lines"])
        ]
        held = None
        if self.open.exists():
            start, lines, frontier = self.open.get()
            held = (start, list(lines), frontier)
        state, closed = settle(held, parts, self.most)
        self.open.update(state)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if state[1]:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.idle * 1000))
        yield self._rows(file, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, lines, frontier = self.open.get()
        self.open.update((start + len(lines), [], frontier))
        yield self._rows(key[0], [(start, list(lines))] if len(lines) else [])

    def close(self) -> None:
        pass


def group_stream(lines: DataFrame, config: ParserConfig = ParserConfig(), idle_seconds: float = 300.0) -> DataFrame:
    """Stream of ``log_file, line_no, line`` -> stream of ``log_file, start_line_no, raw, n_lines``, as ``group_entries`` does it.

    Start the query inside ``disk_state``. Lines of a file come in order, batch by batch, as ``live_log_lines`` gives
    them; in a batch they may come in any order and in any number of tasks. An entry is given out when the next one begins, when it
    has ``max_lines`` lines, or when its file was silent for ``idle_seconds``, also if no other file sends anything.
    Lines of one micro-batch between two start lines meet in one task, as they are one entry. Lines without a file are left out.
    """
    starts = F.coalesce(is_entry_start(F.col("line"), config), F.lit(False)) if config.multiline else F.lit(True)
    marked = lines.where("log_file is not null").select("log_file", "line_no", "line", starts.alias("starts"))
    cut = marked.mapInArrow(_fragments, _FRAGMENTS).groupBy("log_file", "way")
    processor = OpenEntries(config.max_lines, config.join_with, idle_seconds)
    return cut.transformWithStateInPandas(processor, ENTRIES, "Append", "ProcessingTime")


def open_entries(spark: SparkSession, checkpoint: str, config: ParserConfig = ParserConfig()) -> DataFrame:
    """What was still open after the last batch of a query, in the form of its output; the state is only read."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "open").load()
    held = state.select("key.log_file", "value.*").where("size(lines) > 0")
    return held.select(
        "log_file", "start_line_no", F.array_join("lines", config.join_with).alias("raw"), F.size("lines").alias("n_lines")
    )
