"""Distance scores and the anomaly filter."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsense.functions.vectors import as_doubles, nearest_center
from logsense.operators.clustering import ClusterModel


def thresholds_frame(spark: SparkSession, model: ClusterModel) -> DataFrame:
    sizes = model.sizes or {}
    rows = [(int(c), float(t), sizes.get(c)) for c, t in sorted((model.thresholds or {}).items())]
    return spark.createDataFrame(rows, "cluster int, threshold double, n bigint")


def score(vectors: DataFrame, model: ClusterModel, vector_col: str = "embedding", common: bool = False) -> DataFrame:
    """Add ``cluster, distance, threshold``.

    The threshold is that of the nearest cluster, or the common one; a cluster without one gets
    infinity. Centers and thresholds travel with the task, so no row is shuffled.
    """
    if common:
        if model.common_threshold is None:
            raise ValueError("the model has no common threshold")
        limits = np.full(model.k, model.common_threshold)
    else:
        limits = np.array([(model.thresholds or {}).get(int(i), np.inf) for i in model.ids])
    near = nearest_center(model.centers, model.ids, limits)(as_doubles(F.col(vector_col)))
    fields = [F.col("_near")[f].alias(f) for f in ("cluster", "distance", "threshold")]
    return vectors.withColumn("_near", near).select(*vectors.columns, *fields)


def find_anomalies(vectors: DataFrame, model: ClusterModel, vector_col: str = "embedding", common: bool = False) -> DataFrame:
    """The rows strictly farther from their nearest center than the threshold allows; a NaN distance is not."""
    scored = score(vectors, model, vector_col, common)
    return scored.filter((F.col("distance") > F.col("threshold")) & ~F.isnan("distance"))
