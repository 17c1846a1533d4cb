"""Contiguous shards of nearly equal bytes, from prefix sums over ranges of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsense.session import materialize

#: Bytes that each document costs beside its text.
OVERHEAD = 16
#: Rows per range of ids, for choosing the number of ranges.
RANGE_ROWS = 1 << 18


def byte_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    In ascending order of id (rows without one first; rows of one id by size and checksum) the sizes are
    summed up, and a document goes to the shard in whose share of all bytes its middle lies. So shards are
    ranges of ids whose bytes differ by at most one document; a document larger than a share leaves
    shards empty. ``slot`` counts from 0 in each shard. A null text has size 16 and the checksum of the
    empty text. Sizes under this law depend on all documents, so there is no ``grown_shard``. An empty
    table gives an empty result; other columns of ``docs`` are not read.

    The rows are dealt to ranges of ids once and stored, so that a lost executor cannot change the
    ranges. Totals of ranges are summed over one row per range; within a range a window adds the rest.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    )
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.count() // RANGE_ROWS))
    dealt = materialize(
        slim.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "size", "text_crc32").withColumn("part", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_base"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_base"), F.sum("bytes").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    summed = dealt.select(
        "*", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("byte_end"),
        F.row_number().over(inside).alias("row_end"),
    )
    # twice the middle of a document, so that all stays in whole numbers
    middle = 2 * (F.col("byte_base") + F.col("byte_end")) - F.col("size")
    placed = summed.join(offsets, "part").withColumn("middle", middle).select(
        "doc_id", "size", "text_crc32",
        F.expr(f"cast(middle as decimal(38,0)) * {int(shards)} div (2 * cast(all_bytes as decimal(38,0)))").cast("int").alias("shard"),
        (F.col("row_base") + F.col("row_end") - 1).alias("row"),
    )
    placed = materialize(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first_row")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` in a folder per shard, in order of slot; ``placed`` comes from ``byte_shards``.

    Ids must be unique here. The shard column replaces one of that name in ``docs``.
    """
    where = placed.select(F.col("doc_id").alias(id_col), "shard", "slot")
    both = docs.drop("shard", "slot").join(where, id_col)
    both.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
