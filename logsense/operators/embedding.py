"""Text -> vectors. Each embedder maps a DataFrame with a text column to one with ``embedding``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from logsense.functions.vectors import l2_normalize
from logsense.operators.joins import lookup_join
from logsense.session import materialize

Embedder = Callable[[DataFrame, str], DataFrame]


def token_bucket(token: Column, dims: int) -> Column:
    """A fixed bucket per token, the same in any engine: the first 32 bits of its MD5."""
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint"), F.lit(dims)).cast("int")


def words_of(text: Column) -> Column:
    """Lower-case words; white space and punctuation part them, wildcards drop out."""
    return F.filter(F.split(F.lower(text), r"(?U)[^\w]+"), lambda w: w != "")


def hashed_embedder(dims: int = 256, normalize: bool = True) -> Embedder:
    """Word counts in hashed buckets. Needs no fit and no files, so batch and stream agree."""

    @F.arrow_udf("array<double>")
    def densify(buckets: pa.Array) -> pa.Array:
        n = len(buckets)
        row = np.repeat(np.arange(n), np.asarray(buckets.value_lengths().fill_null(0)))
        cells = np.bincount(row * dims + np.asarray(buckets.flatten(), dtype=np.int64), minlength=n * dims)
        return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dims, cells.astype(np.float64))

    def embed(df: DataFrame, text_col: str) -> DataFrame:
        words = words_of(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        out = df.withColumn("_buckets", F.transform(words, lambda w: token_bucket(w, dims)))
        out = out.withColumn("embedding", densify("_buckets")).drop("_buckets")
        return l2_normalize(out) if normalize else out

    return embed


def fit_tfidf(df: DataFrame, text_col: str, dims: int = 1024) -> PipelineModel:
    """Word counts weighted by rarity; the fitted pipeline is saved with the model."""
    stages = [
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"(?U)[^\w]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dims),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(p=2.0, inputCol="_tfidf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(df.filter(F.col(text_col).isNotNull()))


def fitted_embedder(model: PipelineModel, normalize: bool = True) -> Embedder:
    def embed(df: DataFrame, text_col: str) -> DataFrame:
        fitted_col = model.stages[0].getInputCol()
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        out = model.transform(df.withColumn("_text", text).withColumn(fitted_col, text))
        out = out.withColumn("embedding", vector_to_array("_unit" if normalize else "_tfidf"))
        return out.select(*df.columns, "embedding")

    return embed


def model_embedder(
    make_predict_fn: Callable, batch_size: int = 256, normalize: bool = True
) -> Embedder:
    """Any user model: ``make_predict_fn()`` loads it once per task and returns texts -> matrix."""
    predict = predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()), batch_size=batch_size)

    def embed(df: DataFrame, text_col: str) -> DataFrame:
        out = df.withColumn("embedding", predict(F.col(text_col).cast("string")))
        return l2_normalize(out) if normalize else out

    return embed


def embed_distinct(rows: DataFrame, text_col: str, embedder: Embedder) -> DataFrame:
    """Each distinct text once: ``text_col, n, embedding``."""
    distinct = rows.filter(F.col(text_col).isNotNull()).groupBy(text_col).agg(F.count("*").alias("n"))
    return embedder(distinct, text_col)


def embed_rows(rows: DataFrame, text_col: str, embedder: Embedder) -> DataFrame:
    """Rows with the vector of their text; rows without a vector are dropped."""
    vectors = materialize(embed_distinct(rows, text_col, embedder), "vectors")
    return lookup_join(rows, vectors, text_col, "n").filter(F.col("embedding").isNotNull())
