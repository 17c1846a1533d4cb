"""Two-dimensional projection of clustered vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.functions.vectors import as_doubles, to_matrix
from logsense.operators.sampling import sample_rows


def project_2d(
    clustered: DataFrame, id_col: str, label_col: str = "cluster", vector_col: str = "embedding",
    sample_size: int = 0, seed: int = 0,
) -> DataFrame:
    """``id, pc1, pc2, cluster_id`` from the first two principal components.

    With a sample size only the sampled rows are fitted and projected. Each component points to
    the side of its largest loading, so signs do not vary from run to run.
    """
    rows = sample_rows(clustered, id_col, sample_size, seed) if sample_size > 0 else clustered
    if rows.filter(F.col(label_col).isNull()).limit(1).count():
        raise ValueError("some vectors have no cluster")
    data = rows.select(
        F.col(id_col), F.col(label_col).alias("cluster_id"), array_to_vector(as_doubles(F.col(vector_col))).alias("_v")
    )
    scaler = StandardScaler(inputCol="_v", outputCol="_x", withMean=True, withStd=False).fit(data)
    centered = scaler.transform(data)
    pca = PCA(k=2, inputCol="_x", outputCol="_pc").fit(centered)
    loadings = pca.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), [0, 1]])
    out = pca.transform(centered).withColumn("_y", vector_to_array("_pc"))
    return out.select(
        id_col,
        (F.col("_y")[0] * float(signs[0])).alias("pc1"),
        (F.col("_y")[1] * float(signs[1])).alias("pc2"),
        "cluster_id",
    )


def leading_direction(vectors: DataFrame, start: np.ndarray, rounds: int, vector_col: str = "embedding") -> np.ndarray:
    """The direction of most variance after ``rounds`` of power iteration from ``start``, as a unit vector.

    A round is one pass: each task adds up its centered vectors, weighted by their product with the direction, and hands
    on one vector. No matrix of the vectors' width squared is built, so it serves vectors too wide for ``project_2d``.
    """
    known = vectors.select(as_doubles(F.col(vector_col)).alias("v")).where("v is not null")
    middle = known.agg(Summarizer.mean(array_to_vector("v"))).first()[0].toArray()
    direction = np.asarray(start, np.float64)
    for _ in range(rounds):
        direction = direction / np.linalg.norm(direction)

        def product(batches: Iterator[pa.RecordBatch], now: np.ndarray = direction) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(now))
            for batch in batches:
                x = to_matrix(batch.column("v"), len(now)) - middle
                total += (x @ now) @ x
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

        direction = known.mapInArrow(product, "total array<double>").agg(Summarizer.sum(array_to_vector("total"))).first()[0].toArray()
    return direction / np.linalg.norm(direction)
