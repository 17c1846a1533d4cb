"""The model that clusters and scores vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

MAX_CENTERS = 10_000


@dataclass(frozen=True)
class ClusterModel:
    """At most MAX_CENTERS centers with their thresholds; small enough to travel with each task."""

    ids: np.ndarray
    centers: np.ndarray
    method: str = "kmeans"
    inertia: float | None = None
    thresholds: dict[int, float] | None = None
    common_threshold: float | None = None
    sizes: dict[int, int] | None = None

    @property
    def k(self) -> int:
        return len(self.ids)


def center_model(ids: Sequence[int], centers: Sequence[Sequence[float]], **more) -> ClusterModel:
    if len(ids) > MAX_CENTERS:
        raise ValueError(f"{len(ids)} centers; at most {MAX_CENTERS} can be broadcast")
    order = np.argsort(np.asarray(ids), kind="stable")
    return ClusterModel(np.asarray(ids)[order], np.asarray(centers, dtype=np.float64)[order], **more)
