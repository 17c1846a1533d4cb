"""Stage results on storage: parquet by default, CSV and JSON lines where people read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsense.operators.clustering import ClusterModel, center_model, centers_frame
from logsense.operators.scoring import thresholds_frame

PARSED_SCHEMA = (
    "log_file string, raw string, parsing_status string, timestamp string, level string, component string, "
    "pid bigint, tid bigint, file_guid_prefix string, line_no bigint, message string, start_line_no bigint"
)
TEMPLATE_SCHEMA = (
    "cluster_id bigint, template string, corrected_template string, was_corrected boolean, size bigint, "
    "n_tokens int, route_key string, tokens array<string>"
)
EMBEDDING_SCHEMA = "cluster_id bigint, template string, embedding array<double>"
_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "emptyValue": "", "nullValue": "\\N",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: Most rows of a CSV file. Quoted texts hold line feeds, so a file cannot be split: one task reads it whole.
CSV_ROWS = 20_000


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write any stage's table. CSV has no arrays, so there they are JSON text, and its files have CSV_ROWS rows at most."""
    writer_options = {}
    if fmt == "csv":
        nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")}
        df = df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns])
        writer_options = {k: v for k, v in _CSV.items() if k not in ("multiLine", "emptyValue")} | {"maxRecordsPerFile": CSV_ROWS}
    df.write.options(**writer_options).mode(mode).format(fmt).save(path)


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Read with a fixed schema; types are never inferred, and a missing path is an error."""
    options = _CSV if fmt == "csv" else {}
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_parsed_logs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, PARSED_SCHEMA, fmt)


def read_templates(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, TEMPLATE_SCHEMA, fmt)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, EMBEDDING_SCHEMA)


def write_evaluations(evaluations: DataFrame, suggestion: DataFrame, path: str, fmt: str = "json") -> None:
    write_table(evaluations, f"{path}/evaluations", fmt)
    write_table(suggestion, f"{path}/suggestion", fmt)


def write_model(spark: SparkSession, model: ClusterModel, path: str, labels: DataFrame | None = None) -> None:
    """Tables ``model``, ``centers``, ``thresholds`` and, when given, ``labels``."""
    summary = spark.createDataFrame(
        [(model.method, model.k, model.inertia, model.common_threshold)],
        "method string, k int, inertia double, common_threshold double",
    )
    write_table(summary, f"{path}/model")
    write_table(centers_frame(spark, model), f"{path}/centers")
    write_table(thresholds_frame(spark, model), f"{path}/thresholds")
    if labels is not None:
        write_table(labels, f"{path}/labels")


def read_model(spark: SparkSession, path: str) -> ClusterModel:
    """Load the model; a missing part is an error."""
    summary = spark.read.parquet(f"{path}/model").first()
    centers = spark.read.parquet(f"{path}/centers").collect()
    limits = spark.read.parquet(f"{path}/thresholds").collect()
    return center_model(
        [r["cluster"] for r in centers],
        [r["center"] for r in centers],
        method=summary["method"],
        inertia=summary["inertia"],
        thresholds={r["cluster"]: r["threshold"] for r in limits},
        common_threshold=summary["common_threshold"],
        sizes={r["cluster"]: r["n"] for r in limits},
    )
