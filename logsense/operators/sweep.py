"""Many k-means models at once: each pass over the vectors serves all values of k.

What a pass sends on is one row per task, model and cluster, so its size does not grow with the vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.config import ClusterConfig
from logsense.functions.vectors import as_doubles, nearest_rows, to_matrix
from logsense.operators.metrics import (
    EVALUATION_SCHEMA, MAX_SAMPLE_BYTES, calinski_harabasz_of, davies_bouldin_of, mean_silhouettes,
)
from logsense.operators.models import MAX_CENTERS, ClusterModel, center_model
from logsense.operators.sampling import sample_rows
from logsense.session import materialize

#: Centers that move no further than this have converged.
TOLERANCE = 1e-4
#: Products of vectors and centers that are held at once.
_CELLS = 1 << 22
_PARTIAL = "model int, cluster int, n bigint, total array<double>, d double, dd double"

#: Block of rows -> (model, cluster of each row, distance of each row), for every model.
Look = Callable[[np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def _pass(vectors: DataFrame, width: int, sizes: Sequence[int], begin: Callable[[], Look]) -> dict[tuple[int, int], tuple]:
    """(model, cluster) -> (n, sum of vectors, sum of d, sum of d * d) over all vectors.

    ``begin`` gives each task its own function of a block. Tasks add up before they hand on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((k, width)) for k in sizes]
        rest = [np.zeros((k, 3)) for k in sizes]
        look = begin()
        for batch in batches:
            x = to_matrix(batch.column("v"), width)
            for model, cluster, d in look(x):
                k = sizes[model]
                rest[model][:, 0] += np.bincount(cluster, minlength=k)
                rest[model][:, 1] += np.bincount(cluster, weights=d, minlength=k)
                rest[model][:, 2] += np.bincount(cluster, weights=d * d, minlength=k)
                order = np.argsort(cluster, kind="stable")
                used, starts = np.unique(cluster[order], return_index=True)
                if len(used):
                    sums[model][used] += np.add.reduceat(x[order], starts, axis=0)
        models = np.repeat(np.arange(len(sizes)), sizes)
        clusters = np.concatenate([np.arange(k) for k in sizes])
        flat, totals = np.concatenate(rest), np.concatenate(sums)
        seen = flat[:, 0] > 0
        totals = totals[seen]
        offsets = pa.array(np.arange(0, totals.size + 1, width), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(models[seen], pa.int32()), pa.array(clusters[seen], pa.int32()), pa.array(flat[seen, 0].astype(np.int64)),
                pa.ListArray.from_arrays(offsets, pa.array(totals.ravel())), pa.array(flat[seen, 1]), pa.array(flat[seen, 2]),
            ],
            names=["model", "cluster", "n", "total", "d", "dd"],
        )

    summed = vectors.mapInArrow(run, _PARTIAL).groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), Summarizer.sum(array_to_vector("total")).alias("total"), F.sum("d").alias("d"), F.sum("dd").alias("dd")
    )
    return {(r["model"], r["cluster"]): (r["n"], r["total"].toArray(), r["d"], r["dd"]) for r in summed.collect()}


def _known(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.select(as_doubles(F.col(vector_col)).alias("v")).where("v is not null")


def _checked(sizes: Sequence[int]) -> None:
    if sum(sizes) > MAX_CENTERS:
        raise ValueError(f"{sum(sizes)} centers in all; at most {MAX_CENTERS} can travel with each task")


def seed_centers(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k start centers among the rows of a sample, each far from those before it (k-means++); fewer if rows are equal.

    Of a few candidates drawn by their distance the one stays that leaves the least in all.
    """
    rng = np.random.default_rng(seed)
    squares = np.einsum("ij,ij->i", sample, sample)

    def distances(rows: np.ndarray) -> np.ndarray:
        return np.maximum(squares[:, None] + squares[rows] - 2.0 * (sample @ sample[rows].T), 0.0)

    chosen = [int(rng.integers(len(sample)))]
    least = distances(np.array(chosen))[:, 0]
    least[chosen] = 0
    while len(chosen) < k and least.sum() > 1e-12 * squares.sum():
        drawn = rng.choice(len(sample), size=2 + int(np.log(k)), p=least / least.sum())
        after = np.minimum(least[:, None], distances(drawn))
        best = int(after.sum(axis=0).argmin())
        chosen.append(int(drawn[best]))
        least = after[:, best]
        least[chosen] = 0
    return sample[chosen]


def bounded_sample(vectors: DataFrame, id_col: str, config: ClusterConfig, vector_col: str = "embedding") -> np.ndarray:
    """The ``sample_size`` vectors whose ids come first in the order of a hash, for seeding and the silhouette."""
    rows = sample_rows(vectors.select(id_col, vector_col).where(F.col(vector_col).isNotNull()), id_col, config.sample_size, config.seed)
    points = materialize(rows.select(F.col(id_col).alias("id"), as_doubles(F.col(vector_col)).alias("v")), "sample")
    values = points.agg(F.sum(F.size("v"))).first()[0] or 0
    if values * 8 > MAX_SAMPLE_BYTES:
        raise ValueError("too many vectors for the exact silhouette; take a smaller sample")
    return to_matrix(points.orderBy("id").toArrow()["v"].combine_chunks())


def lloyd_step(vectors: DataFrame, centers: Sequence[np.ndarray], vector_col: str = "embedding") -> list[np.ndarray]:
    """All models' centers after one step of Lloyd's method; one that wins no vector stays where it is."""
    _checked([len(c) for c in centers])
    shared = [np.asarray(c, np.float64) for c in centers]

    every = np.concatenate(shared)
    squares = np.einsum("ij,ij->i", every, every)
    edges = np.concatenate([[0], np.cumsum([len(c) for c in shared])])
    rows_at_once = max(1, _CELLS // len(every))

    def look(x: np.ndarray) -> Iterator[tuple]:
        # one product with the centers of all models; a row's own square does not change which is the nearest
        which = np.empty((len(shared), len(x)), np.int64)
        for lo in range(0, len(x), rows_at_once):
            block = slice(lo, lo + rows_at_once)
            far = np.round(squares - 2.0 * (x[block] @ every.T), 12)
            for model, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                which[model, block] = far[:, a:b].argmin(axis=1)
        for model in range(len(shared)):
            yield model, which[model], np.zeros(len(x))

    found = _pass(_known(vectors, vector_col), shared[0].shape[1], [len(c) for c in shared], lambda: look)
    moved = [c.copy() for c in shared]
    for (model, cluster), (n, total, _, _) in found.items():
        moved[model][cluster] = total / n
    return moved


def running_means(
    vectors: DataFrame, centers: np.ndarray, won: np.ndarray, batch_size: int, vector_col: str = "embedding"
) -> dict[int, tuple[int, np.ndarray]]:
    """center -> (number, sum) of the vectors it wins, where each task moves its centers to their running means batch by batch."""

    def begin() -> Look:
        own, weight = centers.copy(), won.copy()

        def look(x: np.ndarray) -> Iterator[tuple]:
            which, far = np.empty(len(x), np.int64), np.empty(len(x))
            for lo in range(0, len(x), batch_size):
                block = slice(lo, lo + batch_size)
                which[block], far[block] = nearest_rows(x[block], own)
                n = np.bincount(which[block], minlength=len(own))
                total = np.zeros_like(own)
                np.add.at(total, which[block], x[block])
                hit = n > 0
                own[hit] = (own[hit] * weight[hit, None] + total[hit]) / (weight + n)[hit, None]
                weight[hit] += n[hit]
            yield 0, which, far

        return look

    found = _pass(_known(vectors, vector_col), centers.shape[1], [len(centers)], begin)
    return {cluster: (n, total) for (_, cluster), (n, total, _, _) in found.items()}


def fit_many(
    vectors: DataFrame, k_values: Sequence[int], sample: np.ndarray, config: ClusterConfig = ClusterConfig(), vector_col: str = "embedding"
) -> list[ClusterModel]:
    """A model for each k by Lloyd's method, all in the same passes; of ``n_init`` starts the one with the least inertia.

    Start centers come from ``sample``, a bounded number of vectors. A model that has converged takes no part any more.
    """
    tries = [(k, config.seed + i) for k in k_values for i in range(max(config.n_init, 1))]
    centers = [seed_centers(sample, k, seed) for k, seed in tries]
    active = list(range(len(tries)))
    for _ in range(config.max_iter):
        moved = lloyd_step(vectors, [centers[m] for m in active], vector_col)
        still = []
        for m, now in zip(active, moved):
            if np.sqrt(((now - centers[m]) ** 2).sum(axis=1)).max() > TOLERANCE:
                still.append(m)
            centers[m] = now
        active = still
        if not active:
            break
    models = [center_model(range(len(c)), c) for c in centers]
    stats = model_statistics(vectors, models, vector_col)
    found = [replace(m, inertia=inertia) for m, (inertia, _) in zip(models, stats)]
    return [min((m for m, (k_, _) in zip(found, tries) if k_ == k), key=lambda m: m.inertia) for k in k_values]


def model_statistics(vectors: DataFrame, models: Sequence[ClusterModel], vector_col: str = "embedding") -> list[tuple[float, list[dict]]]:
    """Per model its inertia and, as ``label_statistics`` has them, the statistics of the clusters it assigns.

    Two passes for all models: the first gives the clusters' means, the second the distances to them.
    """
    sizes = [m.k for m in models]
    _checked(sizes)
    known = _known(vectors, vector_col)
    centers = [m.centers for m in models]

    def assigned(x: np.ndarray) -> Iterator[tuple]:
        for model, c in enumerate(centers):
            yield model, *nearest_rows(x, c)

    first = _pass(known, centers[0].shape[1], sizes, lambda: assigned)
    means = [c.copy() for c in centers]
    for (model, cluster), (n, total, _, _) in first.items():
        means[model][cluster] = total / n

    def spread(x: np.ndarray) -> Iterator[tuple]:
        for model, cluster, _ in assigned(x):
            diff = x - means[model][cluster]
            yield model, cluster, np.sqrt(np.einsum("ij,ij->i", diff, diff))

    second = _pass(known, centers[0].shape[1], sizes, lambda: spread)
    out = []
    for model, m in enumerate(models):
        mine = sorted(c for at, c in second if at == model)
        inertia = float(sum(first[model, c][3] for c in mine))
        stats = [
            {"label": int(m.ids[c]), "n": second[model, c][0], "center": means[model][c], "d": second[model, c][2], "dd": second[model, c][3]}
            for c in mine
        ]
        out.append((inertia, stats))
    return out


def evaluate_models(
    vectors: DataFrame, id_col: str, models: Sequence[ClusterModel], config: ClusterConfig = ClusterConfig(), vector_col: str = "embedding",
    seconds: Sequence[float] | None = None, k_values: Sequence[int] | None = None,
) -> DataFrame:
    """One row per model: inertia and quality metrics over all vectors, the silhouette on one bounded sample.

    ``k_values`` names the models where one has fewer centers than were asked for.

    The number of passes does not depend on the number of models: two for the sums, one for all silhouettes, in which
    each distance between two vectors of the sample is computed once.
    """
    spark = vectors.sparkSession
    x = bounded_sample(vectors, id_col, config, vector_col)
    labels = [nearest_rows(x, m.centers)[0] for m in models]
    silhouettes = mean_silhouettes(spark, x, labels)
    stats = model_statistics(vectors, models, vector_col)
    rows = [
        (k, inertia, s, davies_bouldin_of(st), calinski_harabasz_of(st), t, len(x))
        for k, (inertia, st), s, t in zip(k_values or [m.k for m in models], stats, silhouettes, seconds or [0.0] * len(models))
    ]
    return spark.createDataFrame(rows, EVALUATION_SCHEMA)
