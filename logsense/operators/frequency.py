"""Templates by token frequency: fully relational, so no group of messages meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.config import MinerConfig
from logsense.functions.correction import WILDCARD
from logsense.functions.tokens import route_key, tokens_of, wide_hash
from logsense.session import materialize


def distinct_messages(logs: DataFrame, message_col: str = "message") -> DataFrame:
    """``message, n``: copies are counted on the map side, so only distinct texts shuffle."""
    return (
        logs.select(F.col(message_col).alias("message"))
        .filter(F.col("message") != "")
        .groupBy("message")
        .agg(F.count("*").alias("n"))
    )


def assign_frequency_templates(
    messages: DataFrame, support: int, config: MinerConfig = MinerConfig()
) -> DataFrame:
    """``message, n`` -> ``message, n, template``.

    Per route and position a token stays if messages holding it there number at least
    ``support``; every other token becomes ``<*>``. The distinct messages are used three times,
    so they are written once instead of being counted again from the logs.
    """
    routed = materialize(messages, "messages").withColumn("_tokens", tokens_of(F.col("message"))).select(
        "message",
        "n",
        *wide_hash("id", F.col("message")),
        *wide_hash("route", F.size("_tokens"), route_key(F.col("_tokens"), config.routed_tokens)),
        "_tokens",
    )
    ids = ["id_a", "id_b"]
    slots = routed.select(*ids, "route_a", "route_b", "n", F.posexplode_outer("_tokens").alias("_pos", "_token"))
    slot = ["route_a", "route_b", "_pos", "_token"]
    kept = slots.groupBy(*slot).agg(F.sum("n").alias("_support")).filter(F.col("_support") >= support)
    word = F.when(F.col("_support").isNull(), WILDCARD).otherwise(F.col("_token"))
    rebuilt = (
        slots.drop("n")
        .join(kept, slot, "left")
        .groupBy(*ids)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", word.alias("w")))).alias("_words"))
        .select(*ids, F.array_join(F.transform("_words", lambda w: w["w"]), " ").alias("template"))
    )
    return routed.select(*ids, "message", "n").join(rebuilt, ids).drop(*ids)
