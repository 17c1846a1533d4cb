"""Parsed new logs -> anomalous rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.config import MinerConfig
from logsense.functions.correction import with_correction
from logsense.operators.clustering import ClusterModel
from logsense.operators.embedding import Embedder, hashed_embedder
from logsense.operators.joins import lookup_join
from logsense.operators.scoring import find_anomalies
from logsense.operators.templates import message_templates, with_templates
from logsense.session import materialize, release


def template_rows(
    parsed: DataFrame, templates: DataFrame, embedder: Embedder | None = None, miner: MinerConfig = MinerConfig()
) -> DataFrame:
    """All rows with ``template, is_new, embedding``: the full record of a detection run.

    It carries a vector per row; ``detect`` does not need it.
    """
    lookup = corrected_lookup(parsed, templates, miner)
    vectors = (embedder or hashed_embedder())(
        lookup.groupBy("corrected_template").agg(F.sum("n").alias("_rows")), "corrected_template"
    )
    known = lookup.join(vectors.drop("_rows"), "corrected_template").drop("corrected_template")
    rows = with_templates(parsed, materialize(known, "vectors"))
    return rows.filter(F.col("embedding").isNotNull())


def corrected_lookup(parsed: DataFrame, templates: DataFrame, miner: MinerConfig) -> DataFrame:
    """``message, n, template, is_new, corrected_template`` per distinct text, and for the empty text."""
    lookup = message_templates(parsed, templates)
    blank = parsed.sparkSession.range(1).select(
        F.lit("").alias("message"), F.lit(0).cast("bigint").alias("n"), F.lit("").alias("template"), F.lit(True).alias("is_new")
    )
    both = with_correction(lookup.unionByName(blank), miner.apply_correction, miner.user_strings)
    return both.drop("was_corrected")


def detect(
    parsed: DataFrame,
    templates: DataFrame,
    model: ClusterModel,
    embedder: Embedder | None = None,
    miner: MinerConfig = MinerConfig(),
    common: bool = False,
) -> DataFrame:
    """Parsed columns + ``template, is_new, embedding, cluster, distance, threshold`` of the anomalies.

    Rows are matched without learning. The logs are read twice: once for their distinct texts, once to pick the
    rows of anomalous texts. Each distinct template is embedded and scored once, from the lookup of
    texts, so vectors never ride along with normal rows. An input without anomalies gives an empty
    table of the same schema.
    """
    lookup = corrected_lookup(parsed, templates, miner)
    # Both tables are stored, as the filter on the distance would else be run on all texts too, with the embedder: below the
    # grouping and on the other side of the join.
    partitions = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = lookup.select("corrected_template").distinct().repartition(partitions, F.xxhash64("corrected_template"))
    distinct = materialize(distinct, "distinct")
    odd = materialize(find_anomalies((embedder or hashed_embedder())(distinct, "corrected_template"), model, common=common), "odd")
    texts = materialize(lookup.join(odd, "corrected_template").drop("corrected_template"), "anomalies")
    release(distinct, odd)
    return lookup_join(parsed, texts, "message", "n", how="inner")
