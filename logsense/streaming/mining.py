"""Template mining that follows a stream: a store of template tables, one version per micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsense.config import MinerConfig
from logsense.operators.frequency import distinct_messages
from logsense.operators.mining import mine_templates
from logsense.operators.templates import match_messages
from logsense.session import materialize
from logsense.sources import artifacts
from logsense.streaming.jobs import start


@dataclass(frozen=True)
class StreamMiner:
    """Each micro-batch reads version ``batch - 1`` below ``store_path`` and writes version ``batch``.

    A version depends only on the one before and on the batch, so a batch that is run again writes the same again. The
    store belongs to one query and its checkpoint.
    """

    store_path: str
    config: MinerConfig = MinerConfig()
    message_col: str = "message"

    def templates(self, spark: SparkSession, version: int) -> DataFrame:
        return artifacts.read_templates(spark, f"{self.store_path}/version={version}")

    def latest(self, spark: SparkSession) -> int | None:
        """The last version that was written whole."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.store_path)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return None
        done = [
            int(status.getPath().getName().split("=")[1]) for status in fs.listStatus(folder)
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
        ]
        return max(done, default=None)

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        messages = materialize(distinct_messages(batch, self.message_col), "messages")
        if batch_id:
            found = self.updated(messages, self.templates(batch.sparkSession, batch_id - 1))
        else:
            found = mine_templates(messages, self.config)
        artifacts.write_table(found, f"{self.store_path}/version={batch_id}", mode="overwrite")

    def updated(self, messages: DataFrame, templates: DataFrame) -> DataFrame:
        """The templates after ``message, n``: what they match adds to their sizes, only the rest is mined on top of them."""
        matched = materialize(match_messages(messages, templates), "matched")
        grown = matched.where("template is not null").groupBy("template").agg(F.sum("n").alias("_more"))
        size = (F.col("size") + F.coalesce("_more", F.lit(0))).cast("long").alias("size")
        sized = templates.join(grown, "template", "left").select(*[size if c == "size" else F.col(c) for c in templates.columns])
        new = matched.where("template is null").select("message", "n")
        if new.isEmpty():
            return sized
        return mine_templates(new, self.config, previous=materialize(sized, "sized"))

    def start(self, messages: DataFrame, checkpoint: str | None = None, **trigger) -> StreamingQuery:
        return start(messages.writeStream.foreachBatch(self.run_batch), messages, checkpoint, **trigger)
