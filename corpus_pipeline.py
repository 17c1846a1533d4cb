"""A corpus pipeline: every stage reads what the one before kept, written as Parquet in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsense.llm.contamination import contaminated
from logsense.llm.minhash import near_duplicates
from logsense.llm.packing import pack
from logsense.llm.quality import keep_good
from logsense.llm.suffix import remove_repeats
from logsense.llm.texts import read_table
from logsense.session import materialize

_TEXT_KEY = "_decontamination_key"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids`` (distinct, not null), with their columns."""
    return docs.join(ids.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays, the one with the smallest id.

    Documents without an id and repeated rows of one id all stay.
    """
    marked = near_duplicates(docs).where("not kept and doc_id is not null")
    return _without(docs, marked.select("doc_id").distinct())


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier in the corpus are taken out of the texts; ``n_chars`` follows."""
    cleaned = remove_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, those without an id too; of rows that share an id each is judged by its own text."""
    keyed = docs.withColumn(_TEXT_KEY, F.xxhash64("text"))
    found = contaminated(keyed, read_table(spark, sf_dir, "benchmark"), id_col=_TEXT_KEY)
    ids = found.select(F.col("doc_id").alias(_TEXT_KEY)).distinct()
    return keyed.join(ids.hint("shuffle_hash"), _TEXT_KEY, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: the training sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_repeats", repeat_stage),
    ("decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: Near duplicates, repeated strings and best-fit packing have no SQL; tests hold ``run`` against plain loops.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
