"""Vector arithmetic. Arrow batches carry whole blocks of rows into NumPy; nothing runs per row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INF = float("inf")
#: Differences of vectors and centers that are held at once.
_BLOCK_CELLS = 1 << 22


def to_matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column without nulls as an (n, d) matrix; all its vectors must have one length.

    ``width`` is that length where it is known; without it an empty column has none.
    """
    lengths = np.asarray(vectors.value_lengths())
    if width is None:
        width = int(lengths[0]) if len(lengths) else 0
    if (lengths != width).any():
        raise ValueError(f"vectors of {width} values expected, got {sorted(set(lengths.tolist()))[:5]}")
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), width)


def as_doubles(col: Column) -> Column:
    return col.cast("array<double>")


def l2_normalize(df: DataFrame, col: str = "embedding", out: str | None = None) -> DataFrame:
    """Unit length vectors; a zero vector stays zero."""
    scaled = Normalizer(p=2.0, inputCol="_v", outputCol="_u").transform(
        df.withColumn("_v", array_to_vector(as_doubles(F.col(col))))
    )
    return scaled.withColumn(out or col, vector_to_array("_u")).drop("_v", "_u")


def nearest_rows(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the place of the nearest center and the distance to it; ties go to the first.

    Distances are rounded to 12 decimals, so that those equal but for the order of summation tie.
    """
    rows_at_once = max(1, _BLOCK_CELLS // max(1, centers.size))
    best = np.empty(len(x))
    which = np.empty(len(x), dtype=np.int64)
    for lo in range(0, len(x), rows_at_once):
        diff = x[lo : lo + rows_at_once, None, :] - centers[None, :, :]
        distance = np.round(np.sqrt(np.einsum("ijk,ijk->ij", diff, diff)), 12)
        least = distance.argmin(axis=1)
        which[lo : lo + rows_at_once] = least
        best[lo : lo + rows_at_once] = distance[np.arange(len(least)), least]
    return which, best


def nearest_center(centers: np.ndarray, ids: np.ndarray, thresholds: np.ndarray | None = None):
    """Column function: vector -> struct(cluster, distance, threshold), as ``nearest_rows`` finds them.

    A null vector gives nulls; one with a NaN has distance NaN.
    """
    limits = np.full(len(ids), _INF) if thresholds is None else thresholds
    width = centers.shape[1]

    @F.arrow_udf("cluster int, distance double, threshold double")
    def nearest(vectors: pa.Array) -> pa.Array:
        known = np.asarray(vectors.is_valid())
        which, best = nearest_rows(to_matrix(vectors.drop_null(), width), centers)
        place = np.cumsum(known) - 1  # row -> index among the non-null vectors
        take = pa.array(place, mask=~known)
        parts = [pa.array(ids[which], pa.int32()), pa.array(best), pa.array(limits[which])]
        return pa.StructArray.from_arrays([p.take(take) for p in parts], ["cluster", "distance", "threshold"])

    return nearest


def distance_to_own(centers: dict[int, np.ndarray]):
    """Column function: (label, vector) -> distance to the center of that label."""
    order = np.array(sorted(centers))
    table = np.stack([centers[i] for i in order])

    @F.arrow_udf("double")
    def own(labels: pa.Array, vectors: pa.Array) -> pa.Array:
        diff = to_matrix(vectors, table.shape[1]) - table[np.searchsorted(order, np.asarray(labels))]
        return pa.array(np.sqrt(np.einsum("ij,ij->i", diff, diff)))

    return own
