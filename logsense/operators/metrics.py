"""Cluster quality and the choice of k."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsense.functions.vectors import as_doubles, distance_to_own, to_matrix

MAX_SAMPLE_BYTES = 512 * 1024 * 1024
EVALUATION_SCHEMA = (
    "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double, "
    "train_seconds double, sample_size int"
)


def _finite(value: float | None) -> float | None:
    return value if value is not None and math.isfinite(value) else None


def _enough_labels(labels: int, n: int) -> bool:
    return 2 <= labels <= n - 1


def _labelled(df: DataFrame, label_col: str, vector_col: str) -> DataFrame:
    return df.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull())


def label_statistics(df: DataFrame, label_col: str, vector_col: str = "embedding") -> list[dict]:
    """Per label: rows, center, and the sums of distances and squared distances to the center.

    Rows without a label or a vector do not count.
    """
    df = _labelled(df, label_col, vector_col)
    v = as_doubles(F.col(vector_col))
    means = (
        df.groupBy(F.col(label_col).alias("label"))
        .agg(F.count("*").alias("n"), Summarizer.mean(array_to_vector(v)).alias("c"))
        .collect()
    )
    centers = {r["label"]: r["c"].toArray() for r in means}
    if not centers:
        return []
    own = distance_to_own(centers)(F.col(label_col), v)
    sums = {
        r["label"]: r
        for r in df.select(F.col(label_col).alias("label"), own.alias("d"))
        .groupBy("label")
        .agg(F.sum("d").alias("d"), F.sum(F.col("d") * F.col("d")).alias("dd"))
        .collect()
    }
    return [
        {"label": r["label"], "n": r["n"], "center": centers[r["label"]], "d": sums[r["label"]]["d"],
         "dd": sums[r["label"]]["dd"]}
        for r in means
    ]


def davies_bouldin_of(stats: list[dict]) -> float | None:
    """Mean over clusters of the worst (spread + spread) / center distance; null if undefined."""
    if not _enough_labels(len(stats), sum(s["n"] for s in stats)):
        return None
    spread = np.array([s["d"] / s["n"] for s in stats])
    centers = np.stack([s["center"] for s in stats])
    apart = np.stack([np.sqrt(((centers - c) ** 2).sum(axis=1)) for c in centers])  # k x k, never k x k x d
    if np.allclose(spread, 0) or np.allclose(apart, 0):
        return 0.0
    apart[apart == 0] = np.inf
    return _finite(float(((spread[:, None] + spread[None, :]) / apart).max(axis=1).mean()))


def calinski_harabasz_of(stats: list[dict]) -> float | None:
    """Between-cluster over within-cluster variance, scaled by the degrees of freedom."""
    n, k = sum(s["n"] for s in stats), len(stats)
    if not _enough_labels(k, n):
        return None
    counts = np.array([s["n"] for s in stats], dtype=float)
    centers = np.stack([s["center"] for s in stats])
    middle = counts @ centers / n
    between = float(counts @ ((centers - middle) ** 2).sum(axis=1))
    within = float(sum(s["dd"] for s in stats))
    return 1.0 if within == 0 else _finite(between * (n - k) / (within * (k - 1)))


def silhouette(
    df: DataFrame,
    label_col: str,
    vector_col: str = "embedding",
    mode: str = "exact",
    values: int | None = None,
) -> float | None:
    """Mean silhouette with Euclidean distances.

    Every point is compared with all others, so this is for a bounded sample: the sample travels
    to the tasks once, and each Arrow batch of points yields one number per point, never a pair.
    ``values`` is the number of vector entries, if the caller knows it; it is checked first.
    ``mode='fast'`` is Spark's evaluator on squared distances for data of any size.
    """
    df = _labelled(df, label_col, vector_col)
    v = as_doubles(F.col(vector_col))
    if mode == "fast":
        data = df.select(F.col(label_col).cast("double").alias("prediction"), array_to_vector(v).alias("features"))
        if not _enough_labels(data.select("prediction").distinct().count(), data.count()):
            return None
        return _finite(float(ClusteringEvaluator().evaluate(data)))
    if values is None:
        values = df.agg(F.sum(F.size(vector_col))).first()[0] or 0
    if values * 8 > MAX_SAMPLE_BYTES:
        raise ValueError("too many vectors for the exact silhouette; sample first or use mode='fast'")
    points = df.select(F.col(label_col).alias("label"), v.alias("v"))
    table = points.toArrow()
    labels, index = np.unique(np.asarray(table["label"]), return_inverse=True)
    n, k = len(index), len(labels)
    if not _enough_labels(k, n):
        return None
    x = to_matrix(table["v"].combine_chunks())
    squares = np.einsum("ij,ij->i", x, x)
    member = np.zeros((n, k))
    member[np.arange(n), index] = 1.0
    counts = member.sum(axis=0)

    @F.arrow_udf("double")
    def score(label: pa.Array, vectors: pa.Array) -> pa.Array:
        mine = np.searchsorted(labels, np.asarray(label))
        block = to_matrix(vectors)
        out = np.empty(len(block))
        for lo in range(0, len(block), 512):
            b, own = block[lo : lo + 512], mine[lo : lo + 512]
            d2 = np.einsum("ij,ij->i", b, b)[:, None] + squares[None, :] - 2.0 * (b @ x.T)
            sums = np.sqrt(np.maximum(d2, 0.0)) @ member
            out[lo : lo + 512] = _silhouettes_of(sums, own, counts)
        return pa.array(out)

    return _finite(float(points.select(score("label", "v").alias("s")).agg(F.avg("s")).first()[0]))


def mean_silhouettes(spark: SparkSession, x: np.ndarray, labelings: list[np.ndarray]) -> list[float | None]:
    """The exact mean silhouette of each labeling of a bounded sample ``x``, all in one pass.

    The sample travels to the tasks once; each distance is computed once and serves all labelings.
    """
    members, counts, owns = [], [], []
    for labels in labelings:
        _, own = np.unique(labels, return_inverse=True)
        member = np.zeros((len(x), own.max(initial=0) + 1))
        member[np.arange(len(x)), own] = 1.0
        members.append(member)
        counts.append(member.sum(axis=0))
        owns.append(own)
    shared = spark.sparkContext.broadcast((x, np.concatenate(members, axis=1), counts, owns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, member, counts, owns = shared.value
        squares = np.einsum("ij,ij->i", x, x)
        edges = np.concatenate([[0], np.cumsum([len(c) for c in counts])])
        for batch in batches:
            ids = np.asarray(batch.column(0))
            totals = np.zeros(len(counts))
            for lo in range(0, len(ids), 512):
                rows = ids[lo : lo + 512]
                d2 = squares[rows, None] + squares[None, :] - 2.0 * (x[rows] @ x.T)
                sums = np.sqrt(np.maximum(d2, 0.0)) @ member
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    totals[k] += _silhouettes_of(sums[:, a:b], owns[k][rows], counts[k]).sum()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(counts)), pa.int32()), pa.array(totals)], names=["labeling", "s"])

    found = spark.range(len(x)).mapInArrow(run, "labeling int, s double").groupBy("labeling").agg(F.sum("s").alias("s")).collect()
    sums = {r["labeling"]: r["s"] for r in found}
    return [_finite(sums[k] / len(x)) if _enough_labels(len(c), len(x)) else None for k, c in enumerate(counts)]


def _silhouettes_of(sums: np.ndarray, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per row the silhouette from its sums of distances to the members of each cluster; 0 for a cluster of one."""
    rows = np.arange(len(own))
    inner = sums[rows, own] / np.maximum(counts[own] - 1, 1)
    mean = sums / counts
    mean[rows, own] = np.inf
    outer = mean.min(axis=1)
    top = np.maximum(inner, outer)
    with np.errstate(invalid="ignore"):
        s = np.divide(outer - inner, top, out=np.zeros(len(own)), where=(top > 0) & np.isfinite(top))
    return np.where(counts[own] == 1, 0.0, s)


def label_metrics(
    df: DataFrame, label_col: str, vector_col: str = "embedding", sample: DataFrame | None = None
) -> tuple:
    """(silhouette, Davies-Bouldin, Calinski-Harabasz); null where a metric is not defined.

    The last two are sums over all rows of ``df``. The silhouette compares points with each other; it runs on
    ``sample`` if one is given, rows of the same columns.
    """
    stats = label_statistics(df, label_col, vector_col)
    if sample is None:
        values = sum(s["n"] * len(s["center"]) for s in stats)
        middle = silhouette(df, label_col, vector_col, values=values)
    else:
        middle = silhouette(sample, label_col, vector_col)
    return middle, davies_bouldin_of(stats), calinski_harabasz_of(stats)


def elbow(evaluations: DataFrame) -> DataFrame:
    """The k farthest from the straight line between the first and last point, if there are three."""
    points = evaluations.filter("inertia IS NOT NULL").select("k", "inertia")
    ends = points.agg(
        F.struct(
            F.count("*").alias("m"),
            F.min("k").alias("k0"),
            F.max("k").alias("k1"),
            F.min_by("inertia", "k").alias("y0"),
            F.max_by("inertia", "k").alias("y1"),
        )
    ).scalar()
    line = points.withColumn("_e", ends).select("k", "inertia", "_e.*").filter("m >= 3")
    run, rise = F.col("k1") - F.col("k0"), F.col("y1") - F.col("y0")
    area = F.abs(run * (F.col("y0") - F.col("inertia")) - (F.col("k0") - F.col("k")) * rise)
    off = area / F.sqrt(run * run + rise * rise)
    return line.agg(F.min(F.struct(-off, F.col("k")))["k"].alias("elbow_best"))


def suggest_k(evaluations: DataFrame) -> DataFrame:
    """One row: the best k by each metric and the k with most votes (ties: the smallest k)."""
    scores = {"silhouette": -1, "davies_bouldin": 1, "calinski_harabasz": -1}
    best = evaluations.agg(
        *[
            F.min(F.when(F.col(m).isNotNull(), F.struct(F.col(m) * sign, F.col("k"))))["k"].alias(f"{m}_best")
            for m, sign in scores.items()
        ]
    ).withColumn("elbow_best", elbow(evaluations).scalar())
    votes = F.filter(F.array(*best.columns), lambda k: k.isNotNull())
    ballots = F.transform(
        "_votes", lambda k: F.struct((-F.size(F.filter("_votes", lambda v: v == k))).alias("n"), k.alias("k"))
    )
    return (
        best.withColumn("_votes", votes).withColumn("consensus_k", F.array_min(ballots)["k"]).drop("_votes")
    )


def metric_series(evaluations: DataFrame, suggestion: DataFrame) -> DataFrame:
    """The table behind the k charts: all metrics by k, with the chosen k marked."""
    chosen = suggestion.select(F.coalesce("consensus_k", "silhouette_best", "elbow_best")).scalar()
    return evaluations.withColumn("is_chosen", F.coalesce(F.col("k") == chosen, F.lit(False)))
