import numpy as np
import pytest
from pyspark.sql import functions as F

from logsense.config import ClusterConfig
from logsense.operators.clustering import assign, evaluate_k_range, fit, inertia, label_centers
from logsense.operators.metrics import label_metrics
from logsense.operators.models import center_model
from logsense.operators.projection import leading_direction
from logsense.operators.sweep import bounded_sample, evaluate_models, fit_many, lloyd_step, seed_centers
from logsense.operators.thresholds import learn_thresholds
from logsense.session import materialize


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(8, 5)) * 12
    x = np.concatenate([m + rng.normal(size=(60 + 30 * k, 5)) for k, m in enumerate(middles)])
    return x[rng.permutation(len(x))]


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(k, [float(v) for v in p]) for k, p in enumerate(points)]
    frame = spark.createDataFrame([*rows, (-1, None)], "id bigint, embedding array<double>")
    return materialize(frame.repartition(5), "vectors")


def steps(x, centers, rounds):
    for _ in range(rounds):
        own = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[own == j].mean(axis=0) if (own == j).any() else c for j, c in enumerate(centers)])
    return centers


def test_steps_of_several_models_are_those_of_a_loop(vectors, points):
    starts = [points[:3], np.concatenate([points[10:14], [[1e6] * 5]])]  # one center wins nothing
    found = starts
    for _ in range(3):
        found = lloyd_step(vectors, found)
    for start, got in zip(starts, found):
        np.testing.assert_allclose(got, steps(points, start, 3))


def test_all_fits_share_their_passes(spark, vectors, points):
    config = ClusterConfig(sample_size=300, n_init=2)
    sample = bounded_sample(vectors, "id", config)
    tracker, before = spark.sparkContext.statusTracker(), set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    models = fit_many(vectors, [2, 5, 8], sample, config)
    jobs = len(set(tracker.getJobIdsForGroup(None)) - before)
    assert [m.k for m in models] == [2, 5, 8] and jobs <= 2 * (config.max_iter + 2)
    for m in models:
        np.testing.assert_allclose(steps(points, m.centers, 1), m.centers, atol=1e-3)  # converged
        assert m.inertia == pytest.approx(inertia(vectors.where("id >= 0"), m))
    best = fit(vectors.where("id >= 0"), 8, ClusterConfig(n_init=3)).inertia
    assert models[2].inertia <= 1.05 * best


def test_mini_batches_come_close_to_lloyd_in_a_fixed_number_of_jobs(spark, vectors):
    known = vectors.where("id >= 0")
    batch = ClusterConfig(method="minibatch", batch_size=64, epochs=3)
    full = min(fit(known, 8, ClusterConfig(n_init=3)).inertia, fit(known, 8, batch, id_col="id").inertia)
    tracker = spark.sparkContext.statusTracker()

    def jobs(frame):
        before = set(tracker.getJobIdsForGroup(None))
        found = fit(frame, 8, batch, id_col="id").inertia
        return found, len(set(tracker.getJobIdsForGroup(None)) - before)

    small, few = jobs(known)
    assert small <= 1.05 * full
    larger = materialize(known.withColumn("more", F.explode(F.sequence(F.lit(0), F.lit(9)))).selectExpr("id * 10 + more AS id", "embedding"), "larger")
    assert jobs(larger)[1] <= few + 2


def test_one_pass_metrics_are_those_of_each_model(spark, vectors):
    known = vectors.where("id >= 0")
    models = [label_centers(known.withColumn("l", F.col("id") % k), "l") for k in (2, 7)]
    models.append(center_model([0, 1, 2], [[0.0] * 5, [1.0] * 5, [1e6] * 5]))  # an empty cluster
    rows = evaluate_models(vectors, "id", models, ClusterConfig(sample_size=0)).collect()
    for m, row in zip(models, rows):
        near = materialize(assign(known, m), "near")
        s, db, ch = label_metrics(near, "cluster")
        assert (row.silhouette, row.davies_bouldin, row.calinski_harabasz) == pytest.approx((s, db, ch))
        assert row.inertia == pytest.approx(inertia(known, m)) and row.sample_size == known.count()


def test_equal_vectors_and_too_many_centers(spark):
    same = materialize(spark.createDataFrame([(k, [1.0, 2.0]) for k in range(6)], "id bigint, embedding array<double>"), "same")
    found = evaluate_k_range(same, "id", [2, 3]).collect()
    assert [(r.k, r.inertia, r.silhouette) for r in found] == [(2, 0.0, None), (3, 0.0, None)]
    assert len(seed_centers(np.ones((5, 2)), 3, 1)) == 1
    with pytest.raises(ValueError, match="at most"):
        lloyd_step(same, [np.zeros((6000, 2))] * 2)


def test_sketched_limits_keep_their_rank(vectors, points):
    known = vectors.where("id >= 0")
    model = center_model([0, 1], points[:2])
    exact, sketched = learn_thresholds(known, model, 90.0), learn_thresholds(vectors, model, 90.0, accuracy=50)
    assert sketched.sizes == exact.sizes
    d = {c: np.sort([r.distance for r in assign(known, model).where(F.col("cluster") == c).collect()]) for c in (0, 1)}
    for c, limit in sketched.thresholds.items():
        n = len(d[c])
        assert abs(np.searchsorted(d[c], limit, "right") - 0.9 * n) <= n / 50 + 1
    every = np.sort(np.concatenate(list(d.values())))
    assert abs(np.searchsorted(every, sketched.common_threshold, "right") - 0.9 * len(every)) <= len(every) / 50 + 1


def test_power_iteration_finds_the_first_component(vectors, points):
    x = points - points.mean(axis=0)
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    found = leading_direction(vectors, np.ones(5), 60)
    assert abs(found @ axes[0]) == pytest.approx(1, abs=1e-6)
