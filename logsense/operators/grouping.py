"""Lines -> multi-line entries, without one task per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsense.config import ParserConfig
from logsense.functions.parsing import is_entry_start

LINES_PER_BLOCK = 65536


def group_entries(
    lines: DataFrame, config: ParserConfig = ParserConfig(), is_start: Column | None = None
) -> DataFrame:
    """``log_file, line_no, line`` -> ``log_file, start_line_no, raw, n_lines``.

    With grouping off every line is an entry.
    """
    if not config.multiline:
        return lines.select(
            "log_file", F.col("line_no").alias("start_line_no"), F.col("line").alias("raw"), F.lit(1).alias("n_lines")
        )
    return entry_members(lines, config, is_start).select(
        "log_file",
        "start_line_no",
        join_members(F.col("members"), config).alias("raw"),
        F.size("members").alias("n_lines"),
    )


def entry_members(
    lines: DataFrame, config: ParserConfig = ParserConfig(), is_start: Column | None = None
) -> DataFrame:
    """``log_file, line_no, line`` -> ``log_file, start_line_no, members``, members in line order.

    A line that starts an entry opens it and the others join it; lines before the first start are
    an entry of their own; an entry is cut every ``max_lines`` lines. Line numbers of a file must
    be gap-free. A file is worked on in blocks: only the last start line of each block crosses
    to the blocks behind it, so one huge file spreads over the whole cluster.
    """
    return collect_members(entry_lines(lines, config, is_start))


def entry_lines(
    lines: DataFrame, config: ParserConfig = ParserConfig(), is_start: Column | None = None
) -> DataFrame:
    """The lines with ``_entry`` and ``_chunk``, which tell the entry that holds them."""
    start = is_entry_start(F.col("line"), config) if is_start is None else is_start
    if "block" not in lines.columns:
        lines = lines.withColumn("block", F.floor(F.col("line_no") / LINES_PER_BLOCK))
    marked = lines.withColumn("_start", F.when(start, F.col("line_no")))

    blocks = marked.groupBy("log_file", "block").agg(
        F.max("_start").alias("_last"), F.min("line_no").alias("_first")
    )
    in_file = Window.partitionBy("log_file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "log_file",
        "block",
        F.coalesce(F.max("_last").over(earlier), F.min("_first").over(in_file)).alias("_carry"),
    )
    so_far = Window.partitionBy("log_file", "block").orderBy("line_no")
    opened = (
        marked.withColumn("_open", F.max("_start").over(so_far))
        .join(carried, ["log_file", "block"])
        .withColumn("_entry", F.coalesce("_open", "_carry"))
    )
    chunk = F.lit(0).cast("bigint")
    if config.max_lines:
        chunk = F.floor((F.col("line_no") - F.col("_entry")) / config.max_lines)
    return opened.select("log_file", "line_no", "line", "_entry", chunk.alias("_chunk"))


def collect_members(placed: DataFrame) -> DataFrame:
    """``log_file, start_line_no, members`` of the lines of ``entry_lines``."""
    members = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return (
        placed.groupBy("log_file", "_entry", "_chunk")
        .agg(F.min("line_no").alias("start_line_no"), members.alias("members"))
        .select("log_file", "start_line_no", "members")
    )


def join_members(members: Column, config: ParserConfig) -> Column:
    """The entry text of its sorted lines."""
    return F.array_join(F.transform(members, lambda m: m["line"]), config.join_with)
