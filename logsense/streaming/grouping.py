"""Multi-line grouping of a line stream.

A micro-batch is grouped with the split-parallel batch operator, so a file that sends a third of
all lines is not bound to one task. Between batches only the last, still open entry of each file
is kept, as a table in the state folder; writing it under the batch id makes a repeat harmless.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsense.config import ParserConfig
from logsense.operators.grouping import collect_members, entry_lines, join_members
from logsense.session import materialize, release
from logsense.streaming.jobs import start

STATE_SCHEMA = (
    "log_file string, start_line_no bigint, members array<struct<line_no: bigint, line: string>>, "
    "next_line_no bigint, seen double"
)


@dataclass(frozen=True)
class StreamGrouping:
    """``entries`` are written to ``out_path``, lines behind the frontier of their file to ``late_path``.

    An entry stays open until its file sends a new start line, it is full, or its file was silent
    for ``idle_seconds``.
    """

    out_path: str
    state_path: str
    late_path: str
    config: ParserConfig = ParserConfig()
    idle_seconds: float = 300.0

    def state_before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id == 0:
            # known to be empty when planned, so that the first batch, often the largest, is joined to nothing
            return spark.createDataFrame([], STATE_SCHEMA).filter(F.lit(False))
        return spark.read.schema(STATE_SCHEMA).parquet(f"{self.state_path}/batch={batch_id - 1}")

    def run_batch(self, batch: DataFrame, batch_id: int, now: float | None = None) -> None:
        spark = batch.sparkSession
        now = time.time() if now is None else now
        state = self.state_before(spark, batch_id)
        frontier = state.select("log_file", "next_line_no", "seen")
        incoming = materialize(
            batch.select("log_file", "line_no", "line")
            .join(frontier.drop("seen"), "log_file", "left")
            .withColumn("late", F.coalesce(F.col("line_no") < F.col("next_line_no"), F.lit(False))),
            "incoming",
        )
        incoming.filter("late").select("log_file", "line_no", "line").write.mode("overwrite").parquet(
            f"{self.late_path}/batch={batch_id}"
        )
        held = state.select("log_file", F.explode("members").alias("m")).select("log_file", "m.line_no", "m.line")
        fresh = incoming.filter(~F.col("late")).select("log_file", "line_no", "line")
        active = materialize(fresh.select("log_file").distinct(), "active").withColumn("active", F.lit(True))
        # each step's table goes when the next one is stored, so the disk holds the texts of a batch three times at most
        placed = materialize(entry_lines(held.unionByName(fresh), self.config), "lines")
        release(incoming)
        entries = materialize(collect_members(placed), "entries")
        release(placed)

        last = entries.groupBy("log_file").agg(
            F.max("start_line_no").alias("last_start"),
            F.max(F.element_at("members", -1)["line_no"]).alias("last_line"),
        )
        files = (
            last.join(frontier, "log_file", "full")
            .join(active, "log_file", "left")
            .withColumn("seen", F.when(F.col("active"), F.lit(now)).otherwise(F.col("seen")))
            .withColumn("idle", F.lit(now) - F.col("seen") >= self.idle_seconds)
            .withColumn("next_line_no", F.greatest(F.col("next_line_no"), F.col("last_line") + 1))
            .select("log_file", "last_start", "next_line_no", "seen", "idle")
        )
        files = materialize(files, "files")
        full = F.lit(False)
        if self.config.max_lines:
            full = F.size("members") >= self.config.max_lines
        keep = (F.col("start_line_no") == F.col("last_start")) & ~F.col("idle") & ~full
        judged = materialize(entries.join(files, "log_file").select(*entries.columns, keep.alias("_open")), "judged", ("_open",))
        release(entries)

        opened = judged.filter("_open").select("log_file", "start_line_no", "members")
        files.select("log_file", "next_line_no", "seen").join(opened, "log_file", "left").select(
            "log_file", "start_line_no", "members", "next_line_no", "seen"
        ).write.mode("overwrite").parquet(f"{self.state_path}/batch={batch_id}")
        self._emit(judged.filter(~F.col("_open"))).write.mode("overwrite").parquet(f"{self.out_path}/batch={batch_id}")
        release(judged, files)

    def _emit(self, entries: DataFrame) -> DataFrame:
        return entries.select(
            "log_file",
            "start_line_no",
            join_members(F.col("members"), self.config).alias("raw"),
            F.size("members").alias("n_lines"),
        )

    def open_entries(self, spark: SparkSession, last_batch: int) -> DataFrame:
        """What is still open after a batch, in the form of the output; for the end of a stream."""
        return self._emit(self.state_before(spark, last_batch + 1).filter("members IS NOT NULL"))

    def start(self, lines: DataFrame, checkpoint: str | None = None, **trigger) -> StreamingQuery:
        return start(lines.writeStream.foreachBatch(self.run_batch), lines, checkpoint, **trigger)
