"""Exact duplicates by a stream over files: keyed state on disk remembers each digest, hits are checked byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsense.llm.streams import stream_table
from logsense.operators.joins import lookup_join
from logsense.session import materialize, scratch_path
from logsense.streaming.state import disk_state

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Micro-batches in which a table is taken.
BATCHES = 4
#: Bits of the filter of repeated digests per such digest, and the least and most bits (32 MB) it may have.
FILTER_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28
#: Bits of one value of ``bitmap_construct_agg`` (fixed by Spark).
_BITMAP = 32768


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "utf-8"), 256))


def _keyed(table: DataFrame, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """(digest, text, doc_id, file, row): ``file`` and ``row`` locate the content of a row."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    slim = table.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("text"), *place)
    return slim.select(digest(F.col("text")).alias("digest"), "text", "doc_id", "file", "row")


def absorb(
    spark: SparkSession, path: str, checkpoint: str, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id",
    text_col: str = "text", batches: int = BATCHES,
) -> None:
    """Take the files at ``path`` that ``checkpoint`` has not seen into its state; files taken before are not read again.

    Per digest the state keeps, without expiry, the largest id, where that row's content lies (file and row) and the
    number of rows. A lost executor's state is rebuilt from the checkpoint, a broken batch is run again.
    """
    with disk_state(spark):
        keyed = _keyed(stream_table(spark, path, batches), digest, id_col, text_col)
        seen = keyed.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("stays"), F.count("*").alias("n"))
        query = seen.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()


def remembered(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, doc_id, file, row, n) as the state holds it after its last batch."""
    with disk_state(spark):
        state = spark.read.format("statestore").option("path", checkpoint).load()
    return state.select("key.digest", "value.max.*", F.col("value.count").alias("n"))


def _may_repeat(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Every row whose digest is in ``hits`` and few others, by a bitmap of bounded size; no row is shuffled."""
    n_bits = LEAST_BITS
    while n_bits < MOST_BITS and n_bits < FILTER_BITS * hits.count():
        n_bits *= 2
    bit = F.pmod(F.xxhash64("digest"), F.lit(n_bits))
    slots = hits.select((bit / _BITMAP).cast("int").alias("_bucket"), (bit % _BITMAP).alias("_bit"))
    bitmap = slots.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    marked = rows.withColumns({"_bucket": (bit / _BITMAP).cast("int"), "_bit": bit % _BITMAP})
    byte = "cast(conv(hex(substring(_bitmap, cast(_bit div 8 + 1 as int), 1)), 16, 10) as int)"
    found = marked.join(F.broadcast(bitmap), "_bucket").where(F.expr(f"(shiftright({byte}, cast(_bit % 8 as int)) & 1) = 1"))
    return found.drop("_bucket", "_bit", "_bitmap")


def exact_duplicates(
    spark: SparkSession, path: str, checkpoint: str | None = None, digest: Callable[[Column], Column] = sha256,
    id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, file, row for each row of the Parquet table at ``path``.

    The files run through ``absorb``; pass the ``checkpoint`` of an earlier call to go on where it stopped when files
    were added. Rows whose digest came more than once are hits: their whole texts are grouped, so that texts are equal
    by their bytes and not by a digest; copies collapse before they are shuffled. Two texts of one digest are settled
    by joins on the text.

    Of equal texts the row with the largest id stays, of equal ids (or without ids, which come last) the one with the
    largest file and row: one row of each group. A null text is empty. ``keep_id`` is null where only rows without an id
    hold the text. An empty table gives an empty result; other columns are not read. Groups of any size are joined by
    a lookup that deals hot digests over all tasks.
    """
    checkpoint = checkpoint or scratch_path(spark, "digests")
    absorb(spark, path, checkpoint, digest, id_col, text_col, batches)
    repeated = materialize(remembered(spark, checkpoint).where("n > 1").select("digest"), "repeated")
    rows = _keyed(spark.read.parquet(path), digest, id_col, text_col)
    texts = _may_repeat(rows, repeated).groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("stays"), F.count("*").alias("group_size")
    )
    groups = texts.groupBy("digest").agg(
        F.count("*").alias("n_texts"), F.max("stays").alias("stays"), F.sum("group_size").alias("group_size")
    )
    groups = materialize(groups.where("group_size > 1"), "groups")
    narrow = rows.select("doc_id", "digest", "file", "row", F.sha2(F.encode("text", "utf-8"), 256).alias("text_sha256"))
    lookup = groups.select("digest", F.col("stays").alias("_stays"), "group_size", F.col("group_size").alias("_rows"))
    clashing = groups.where("n_texts > 1").select("digest")
    if clashing.isEmpty():
        return _verdicts(lookup_join(narrow, lookup, "digest", "group_size"))
    # texts that share a digest: the lookup is by the whole text
    same = rows.join(clashing, "digest", "left_semi")
    by_text = same.groupBy("text").agg(F.max(F.struct("doc_id", "file", "row")).alias("_stays"), F.count("*").alias("group_size"))
    by_text = materialize(by_text.withColumn("_rows", F.col("group_size")), "texts-of-a-digest")
    apart = lookup_join(same, by_text, "text", "group_size")
    apart = apart.withColumn("text_sha256", F.sha2(F.encode("text", "utf-8"), 256)).drop("text")
    alone = lookup_join(narrow.join(clashing, "digest", "left_anti"), lookup, "digest", "group_size")
    return _verdicts(alone.unionByName(apart))


def _verdicts(rows: DataFrame) -> DataFrame:
    unique = F.col("_stays").isNull()
    here = (F.col("_stays.file") == F.col("file")) & (F.col("_stays.row") == F.col("row"))
    return rows.select(
        "doc_id", F.when(unique, F.col("doc_id")).otherwise(F.col("_stays.doc_id")).alias("keep_id"),
        F.coalesce(F.col("_rows"), F.lit(1)).cast("long").alias("group_size"), (unique | here).alias("kept"), "text_sha256", "file", "row",
    )
