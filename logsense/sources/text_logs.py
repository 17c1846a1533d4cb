"""Raw log files -> numbered, cleaned lines."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsense.functions.regex import glob_to_regex, right_anchored_glob
from logsense.functions.text import clean_line, split_lines
from logsense.sources.paths import open_path


def is_excluded(path: Column, exclude_globs: Sequence[str]) -> Column:
    """True where a glob matches the last segments of the path."""
    slashed = F.regexp_replace(F.translate(path, "\\", "/"), "/(?:\\./)+|/{2,}", "/")
    slashed = F.regexp_replace(slashed, "(?<=.)/$", "")
    patterns = [right_anchored_glob(g.replace("\\", "/")) for g in exclude_globs]
    tests = [slashed.rlike("(?s)" + p) for p in patterns if p]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _file_path() -> Column:
    """The plain path of the file a row came from (the metadata column is URL-encoded)."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(encoded), "^file:/+", "/")


def read_raw_lines(
    spark: SparkSession,
    path: str,
    pattern: str = "**/*.log",
    exclude_globs: Sequence[str] = (),
    skip_unreadable: bool = True,
) -> DataFrame:
    """Lines of one file, or of the files under a folder that match a glob.

    ``log_file, block, pos, line``: ``block`` is the split's offset in its file and ``pos`` grows
    along a split, so (block, pos) is the file's own order and stays so when a task is run again.
    A glob without a hit gives no lines. Names starting with ``_`` or ``.`` are never read; Spark's file listing
    leaves them out. ``skip_unreadable=False`` fails on a bad file instead of skipping what is left of it.
    """
    root = path.rstrip("/") or "/"
    reader = spark.read.option("ignoreMissingFiles", skip_unreadable).option("ignoreCorruptFiles", skip_unreadable)
    if is_file(spark, root):
        files = reader.text(root)
    elif "**" in pattern:
        tail = pattern.rsplit("/", 1)[-1]
        narrow = "*" if tail == "**" else tail
        files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", narrow).text(root)
        top = f"{_plain(root)}/"
        inside = F.substr(_file_path(), F.instr(_file_path(), top) + len(top))
        if pattern.replace("**/", "", 1) != tail or not pattern.startswith("**/"):
            files = files.filter(inside.rlike(f"^{glob_to_regex(pattern)}$"))
    else:
        try:
            files = reader.text(f"{root}/{pattern}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], "log_file string, block bigint, pos bigint, line string")
    if exclude_globs:
        files = files.filter(~is_excluded(_file_path(), exclude_globs))
    return files.select(
        _file_path().alias("log_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        clean_line(F.make_valid_utf8("value")).alias("line"),
    )


def _plain(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def is_file(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop) and fs.getFileStatus(hadoop).isFile()


#: Bytes that a task holds of a file that it tries to read.
_TRY_BYTES = 8 << 20


def list_files(spark: SparkSession, path: str, pattern: str = "**/*.log", exclude_globs: Sequence[str] = ()) -> DataFrame:
    """``log_file`` of the files with content that ``read_raw_lines`` takes; none is read. Store it before a run that may lose files."""
    root = path.rstrip("/") or "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    plain = F.regexp_replace(F.col("path"), "^file:/+", "/")
    inside = F.substr(plain, F.instr(plain, f"{_plain(root)}/") + len(_plain(root)) + 1)
    files = files.filter(inside.rlike(f"^{glob_to_regex(pattern)}$"))
    if exclude_globs:
        files = files.filter(~is_excluded(plain, exclude_globs))
    return files.select(plain.alias("log_file"))


def skipped_files(listed: DataFrame) -> DataFrame:
    """``log_file, reason`` of the files of ``list_files`` that cannot be read to their end.

    ``reason`` is ``missing``, ``denied`` or ``corrupt`` with what the file system said. Each task reads whole files piece by
    piece and keeps none; gzip and other compressed files are unpacked on the way.
    """

    def attempt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("log_file").to_pylist():
                try:
                    system, plain = open_path(path)
                    with system.open_input_stream(plain, compression="detect") as stream:
                        while stream.read(_TRY_BYTES):
                            pass
                except FileNotFoundError:
                    found.append((path, "missing"))
                except PermissionError as error:
                    found.append((path, f"denied: {error}"))
                except (OSError, pa.ArrowInvalid) as error:
                    found.append((path, f"corrupt: {error}"))
            paths, reasons = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(reasons, pa.string())], names=["log_file", "reason"])

    tasks = listed.sparkSession.sparkContext.defaultParallelism
    return listed.repartition(tasks, "log_file").mapInArrow(attempt, "log_file string, reason string")


def number_lines(raw_lines: DataFrame) -> DataFrame:
    """1-based line numbers per file; the work is split by file block, never by whole file.

    Each block is numbered on its own and then moved by the number of lines in the blocks before
    it. That table of blocks holds one row per input split.
    """
    within = Window.partitionBy("log_file", "block").orderBy("pos")
    sizes = raw_lines.groupBy("log_file", "block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("log_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("log_file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        raw_lines.withColumn("_rn", F.row_number().over(within))
        .join(offsets, ["log_file", "block"])
        .select("log_file", "block", (F.col("_before") + F.col("_rn")).alias("line_no"), "line")
    )


def read_log_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """``log_file, block, line_no, line`` of the log files under ``path``."""
    return number_lines(read_raw_lines(spark, path, **options))


def lines_of_texts(texts: DataFrame, file_col: Column, text_col: Column) -> DataFrame:
    """Cleaned, numbered lines of a table that holds one whole file per row."""
    return texts.select(file_col.alias("log_file"), F.posexplode(split_lines(text_col)).alias("_pos", "_line")).select(
        "log_file",
        (F.col("_pos") + 1).cast("bigint").alias("line_no"),
        clean_line(F.col("_line")).alias("line"),
    )
