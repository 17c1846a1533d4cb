"""Session settings and the one way this package cuts lineage: a table in the shared folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Spark removes the shuffle files of a finished query; those of a stored table serve nothing any more.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_LOCAL_DIRS: dict[str, str] = {}


def local_session(cpus: int | str = "*", app: str = "logsense") -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster brings its own session."""
    partitions = "8" if cpus == "*" else str(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder, one per application; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    # the setting cannot be changed in a running session
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="logsense-")
    return _LOCAL_DIRS[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_stored_by = threading.local()


@contextmanager
def passing_tables() -> Iterator[list[DataFrame]]:
    """Tables stored within go at the end, apart from those that are taken out of the list."""
    outer, tables = getattr(_stored_by, "tables", None), []
    _stored_by.tables = tables
    try:
        yield tables
    finally:
        _stored_by.tables = outer
        release(*tables)


def keep(table: DataFrame) -> DataFrame:
    """``table``, which the innermost ``passing_tables`` leaves to the one around it."""
    _stored_by.tables[:] = [t for t in _stored_by.tables if t is not table]
    return table


def materialize(
    df: DataFrame, label: str = "table", partition_by: tuple[str, ...] = (), codec: str | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; a table already stored here is returned.

    Survives the loss of any executor, cuts the lineage, and gives later joins the real size. The shuffle files
    of the query that made it go at once, not when the driver happens to collect its garbage.
    """
    if getattr(df, "_logsense_stored", False) and not partition_by:
        return df
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec)
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._logsense_stored = True
    stored._logsense_path = path
    tables = getattr(_stored_by, "tables", None)
    if tables is not None:
        tables.append(stored)
    return stored


def release(*tables: DataFrame, below: str = "") -> None:
    """Delete stored tables that nothing will read again, or their folder ``below``; others are left alone."""
    for table in tables:
        path = getattr(table, "_logsense_path", None)
        if path:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{below}" if below else path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
