"""k-means on a vector column, the sweep over k, and the model that scoring uses."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import replace

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsense.config import ClusterConfig
from logsense.functions.vectors import as_doubles, nearest_center
from logsense.operators.metrics import suggest_k
from logsense.operators.models import MAX_CENTERS, ClusterModel, center_model
from logsense.operators.sweep import bounded_sample, evaluate_models, fit_many, running_means, seed_centers
from logsense.session import materialize

#: Times per epoch that mini-batch fits of all tasks are merged.
MERGES = 8
#: Vectors of a task of a mini-batch fit; so the result does not depend on the cluster.
TASK_ROWS = 1 << 17


def label_centers(vectors: DataFrame, label_col: str, vector_col: str = "embedding") -> ClusterModel:
    """The mean vector of each label as a model. Rows without a label or a vector do not count."""
    known = vectors.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull())
    rows = (
        known.groupBy(F.col(label_col).alias("label"))
        .agg(Summarizer.mean(array_to_vector(as_doubles(F.col(vector_col)))).alias("c"), F.count("*").alias("n"))
        .limit(MAX_CENTERS + 1)
        .collect()
    )
    sizes = {r["label"]: r["n"] for r in rows}
    return center_model([r["label"] for r in rows], [r["c"].toArray() for r in rows], method="labels", sizes=sizes)


def centers_frame(spark: SparkSession, model: ClusterModel) -> DataFrame:
    rows = [(int(i), [float(x) for x in c]) for i, c in zip(model.ids, model.centers)]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def assign(vectors: DataFrame, model: ClusterModel, vector_col: str = "embedding") -> DataFrame:
    """Add ``cluster`` and ``distance`` of the nearest center."""
    near = nearest_center(model.centers, model.ids)(as_doubles(F.col(vector_col)))
    return vectors.withColumn("_near", near).select(*vectors.columns, "_near.cluster", "_near.distance")


def inertia(vectors: DataFrame, model: ClusterModel, vector_col: str = "embedding") -> float:
    """Sum of squared distances to the final centers."""
    squared = F.sum(F.col("distance") * F.col("distance"))
    return float(assign(vectors.select(vector_col), model, vector_col).agg(squared).first()[0] or 0.0)


def fit(
    vectors: DataFrame,
    k: int,
    config: ClusterConfig = ClusterConfig(),
    vector_col: str = "embedding",
    id_col: str | None = None,
) -> ClusterModel:
    """k centers by Lloyd's method or by mini-batches; the best of ``n_init`` seeds is kept.

    ``vectors`` is read many times: pass a cached or materialized DataFrame. ``id_col`` spreads
    equal vectors over the mini-batches.
    """
    one = _fit_lloyd if config.method == "kmeans" else _fit_minibatch
    tries = []
    for i in range(max(config.n_init, 1)):
        model = one(vectors, k, replace(config, seed=config.seed + i), vector_col, id_col)
        tries.append(replace(model, inertia=inertia(vectors, model, vector_col)))
    return min(tries, key=lambda m: m.inertia)


def _features(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.select(array_to_vector(as_doubles(F.col(vector_col))).alias("features"))


def _fit_lloyd(
    vectors: DataFrame, k: int, config: ClusterConfig, vector_col: str, id_col: str | None
) -> ClusterModel:
    if k < 2:  # without a suggestion few vectors make one cluster, which Spark's KMeans refuses
        known = vectors.filter(F.col(vector_col).isNotNull())
        mean = known.agg(Summarizer.mean(array_to_vector(as_doubles(F.col(vector_col))))).first()[0]
        return center_model([0], [mean.toArray()], method="kmeans")
    fitted = KMeans(k=k, maxIter=config.max_iter, seed=config.seed, initMode="k-means||").fit(
        _features(vectors, vector_col)
    )
    centers = fitted.clusterCenters()
    return center_model(range(len(centers)), centers, method="kmeans")


def _fit_minibatch(
    vectors: DataFrame, k: int, config: ClusterConfig, vector_col: str, id_col: str | None
) -> ClusterModel:
    """Centers are the running means of the vectors they have won, batch by batch of ``batch_size``.

    An epoch is cut into MERGES rounds by a hash of the id (or of the vector). In a round every task takes its own rows in
    batches, from the centers that all began the round with; then the sums of what was won are added up over all
    tasks, which gives the running means over all of them. So an epoch is MERGES jobs, whatever the size of the table.
    """
    key = F.xxhash64(F.lit(config.seed), F.col(id_col) if id_col else F.col(vector_col))
    rows = vectors.where(F.col(vector_col).isNotNull()).select(F.col(vector_col).alias("v"), key.alias("key"))
    placed = rows.withColumn("round", F.pmod(F.xxhash64("key"), F.lit(MERGES)).cast("int"))
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    stored = materialize(placed.repartition(tasks, "key").sortWithinPartitions("round", "key"), "rounds", ("round",))
    centers = seed_centers(bounded_sample(stored, "key", config, "v"), k, config.seed)
    won = np.zeros(len(centers))
    for _ in range(max(config.epochs, 1)):
        for r in range(MERGES):
            found = running_means(stored.where(F.col("round") == r), centers, won, config.batch_size, "v")
            for j, (n, total) in found.items():
                centers[j] = (centers[j] * won[j] + total) / (won[j] + n)
                won[j] += n
    return center_model(range(len(centers)), centers, method="minibatch")


def evaluate_k_range(
    vectors: DataFrame, id_col: str, k_values: Sequence[int], config: ClusterConfig = ClusterConfig(), vector_col: str = "embedding"
) -> DataFrame:
    """One row per k: inertia and quality metrics of a fit, and its seconds.

    With Lloyd's method all k are fitted in the same passes and share their time equally; mini-batch fits are one after another.
    """
    begin = time.perf_counter()
    if config.method == "kmeans":
        models = fit_many(vectors, k_values, bounded_sample(vectors, id_col, config, vector_col), config, vector_col)
        seconds = [(time.perf_counter() - begin) / len(models)] * len(models)
    else:
        models, seconds = [], []
        for k in k_values:
            models.append(fit(vectors, k, config, vector_col, id_col))
            seconds.append(time.perf_counter() - begin)
            begin = time.perf_counter()
    return evaluate_models(vectors, id_col, models, config, vector_col, seconds, k_values)


def k_range(config: ClusterConfig, n: int) -> range:
    return range(config.k_start, min(config.k_stop, n) + 1, config.k_step)


def train_clusters(
    vectors: DataFrame, id_col: str, config: ClusterConfig = ClusterConfig(), vector_col: str = "embedding"
) -> tuple[ClusterModel, DataFrame | None, DataFrame | None]:
    """Choose k (fixed, or by the sweep), then fit: (model, evaluations, suggestion)."""
    if config.k is not None and config.k > 1:
        return fit(vectors, config.k, config, vector_col, id_col), None, None
    n = vectors.count()
    values = k_range(config, n)
    if not values:
        raise ValueError(f"no k to try for {n} vectors")
    evaluations = evaluate_k_range(vectors, id_col, values, config, vector_col)
    suggestion = materialize(suggest_k(evaluations), "suggestion")
    best = suggestion.select(
        F.coalesce("consensus_k", "silhouette_best", F.floor(F.sqrt(F.lit(n / 2))).cast("int"))
    ).first()[0]
    return fit(vectors, best, config, vector_col, id_col), evaluations, suggestion
