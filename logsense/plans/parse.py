"""Log files or lines -> parsed logs, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsense.config import ParserConfig
from logsense.functions.parsing import parse_entries
from logsense.operators.grouping import group_entries
from logsense.sources.text_logs import read_log_lines


def parse_lines(lines: DataFrame, config: ParserConfig = ParserConfig()) -> DataFrame:
    return parse_entries(group_entries(lines, config).drop("n_lines"), config)


def parse_log_files(spark: SparkSession, path: str, config: ParserConfig = ParserConfig(), **options) -> DataFrame:
    """Parse a training folder; ``options`` are those of ``read_raw_lines`` (glob, excludes)."""
    return parse_lines(read_log_lines(spark, path, **options), config)


def parse_new_file(spark: SparkSession, path: str, config: ParserConfig = ParserConfig()) -> DataFrame:
    """Parse the one file to be checked; the folder's glob and excludes do not apply to it."""
    return parse_lines(read_log_lines(spark, path), config)
