"""Parsed logs -> templates, vectors, clusters and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.config import ClusterConfig, MinerConfig
from logsense.functions.parsing import effective_message
from logsense.operators.clustering import ClusterModel, assign, train_clusters
from logsense.operators.embedding import Embedder, hashed_embedder
from logsense.operators.frequency import assign_frequency_templates, distinct_messages
from logsense.operators.joins import lookup_join
from logsense.operators.mining import mine_templates
from logsense.operators.templates import match_messages, template_table
from logsense.operators.thresholds import learn_thresholds
from logsense.session import materialize


@dataclass(frozen=True)
class Training:
    templates: DataFrame
    vectors: DataFrame
    model: ClusterModel
    labels: DataFrame
    evaluations: DataFrame | None
    suggestion: DataFrame | None


def messages_of(parsed: DataFrame, message_col: str = "message") -> DataFrame:
    """Parsed logs with ``message`` filled from the raw text where empty; textless rows dropped."""
    return parsed.withColumn("message", effective_message(message_col)).filter("message IS NOT NULL")


def mine(
    parsed: DataFrame, config: MinerConfig = MinerConfig(), support: int | None = None, previous: DataFrame | None = None
) -> DataFrame:
    """The template table: by token frequency if a support is given, else by similarity."""
    messages = distinct_messages(messages_of(parsed))
    if support is not None:
        return template_table(assign_frequency_templates(messages, support, config), config)
    return mine_templates(messages, config, previous)


def training_rows(parsed: DataFrame, templates: DataFrame) -> DataFrame:
    """Each training row with the template that holds it; rows without text or template are left out.

    ``log_file, start_line_no, component, log_level, cluster_id, template, corrected_template, was_corrected``.
    """
    rows = messages_of(parsed)
    known = materialize(templates, "templates")
    matched = match_messages(materialize(distinct_messages(rows), "messages"), known).filter("template IS NOT NULL")
    corrected = known.select("cluster_id", "corrected_template", "was_corrected")
    lookup = materialize(matched.join(corrected, "cluster_id"), "lookup")
    return lookup_join(rows, lookup, "message", "n", how="inner").select(
        "log_file", "start_line_no", "component", F.col("level").alias("log_level"), "cluster_id", "template",
        "corrected_template", "was_corrected",
    )


def embed_templates(templates: DataFrame, embedder: Embedder) -> DataFrame:
    """``cluster_id, template, embedding``, keyed rather than aligned by position."""
    return embedder(templates.select("cluster_id", "template", "corrected_template"), "corrected_template").select(
        "cluster_id", "template", "embedding"
    )


def train(
    parsed: DataFrame,
    miner: MinerConfig = MinerConfig(),
    clusters: ClusterConfig = ClusterConfig(),
    embedder: Embedder | None = None,
    support: int | None = None,
    previous: DataFrame | None = None,
) -> Training:
    """All training stages. Thresholds are learned on the distinct templates."""
    templates = materialize(mine(parsed, miner, support, previous), "templates")
    vectors = materialize(embed_templates(templates, embedder or hashed_embedder()), "vectors")
    vectors.persist()
    try:
        model, evaluations, suggestion = train_clusters(vectors, "cluster_id", clusters)
        model = learn_thresholds(vectors, model, clusters.percentile)
    finally:
        vectors.unpersist()
    labels = assign(vectors, model).select("cluster_id", "cluster", F.col("distance"))
    return Training(templates, vectors, model, labels, evaluations, suggestion)
