"""The batch functions on streams: micro-batches run the same plans, with frozen models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsense.config import MinerConfig
from logsense.functions.parsing import event_time
from logsense.operators.clustering import ClusterModel
from logsense.operators.embedding import Embedder
from logsense.operators.scoring import find_anomalies
from logsense.plans.detect import detect
from logsense.session import materialize, scratch_path


def each_batch(
    stream: DataFrame, run: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str | None = None, **trigger
) -> StreamingQuery:
    """Run a batch plan on every micro-batch; each writes its own folder, so a repeat replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        run(batch).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return start(stream.writeStream.foreachBatch(write), stream, checkpoint, **trigger)


def append_to(stream: DataFrame, out_path: str, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    return start(stream.writeStream.format("parquet").option("path", out_path), stream, checkpoint, **trigger)


def start(writer, stream: DataFrame, checkpoint: str | None, **trigger) -> StreamingQuery:
    location = checkpoint or scratch_path(stream.sparkSession, "stream")
    return writer.option("checkpointLocation", location).trigger(**(trigger or {"availableNow": True})).start()


def detect_stream(
    parsed: DataFrame,
    templates: DataFrame,
    model: ClusterModel,
    out_path: str,
    embedder: Embedder | None = None,
    miner: MinerConfig = MinerConfig(),
    checkpoint: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Parsed log stream -> anomalies, by the batch detection of each micro-batch; templates are stored once."""
    templates = materialize(templates, "templates")

    def run(batch: DataFrame) -> DataFrame:
        return detect(batch, templates, model, embedder, miner)

    return each_batch(parsed, run, out_path, checkpoint, **trigger)


def anomaly_vectors(vectors: DataFrame, model: ClusterModel, vector_col: str = "embedding") -> DataFrame:
    """Anomalies of a vector stream; a stateless projection and filter."""
    return find_anomalies(vectors, model, vector_col)


def upsert_to(counts: DataFrame, out_path: str, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Every change of a windowed count, open windows too; read them with ``latest_counts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return start(counts.writeStream.outputMode("update").foreachBatch(write), counts, checkpoint, **trigger)


def latest_counts(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """The last count of each window and ``keys`` that ``upsert_to`` has written."""
    changes = spark.read.parquet(out_path)
    return changes.groupBy("window_start", "window_end", *keys).agg(F.max_by("n", "batch").alias("n"))


def window_counts(
    logs: DataFrame, keys: list[str], width: str = "1 hour", delay: str = "1 hour", time_col: str | None = None
) -> DataFrame:
    """Counts per tumbling event-time window and ``keys``; state is dropped behind the watermark."""
    timed = logs.withColumn("event_time", F.col(time_col).cast("timestamp") if time_col else event_time())
    return (
        timed.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", width).alias("w"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )
