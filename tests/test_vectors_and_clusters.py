import numpy as np
import pytest
from pyspark.sql import functions as F

from logsense.config import ClusterConfig
from logsense.functions.vectors import l2_normalize
from logsense.operators.clustering import (
    assign, center_model, evaluate_k_range, fit, inertia, k_range, label_centers, train_clusters,
)
from logsense.operators.embedding import embed_rows, fit_tfidf, fitted_embedder, hashed_embedder
from logsense.operators.metrics import (
    EVALUATION_SCHEMA, label_metrics, metric_series, silhouette, suggest_k,
)
from logsense.operators.projection import project_2d
from logsense.operators.sampling import sample_rows
from logsense.operators.scoring import find_anomalies, score
from logsense.operators.thresholds import group_percentiles, learn_thresholds


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(4, 6)) * 4
    labels = rng.integers(0, 4, size=240)
    return centers[labels] + rng.normal(size=(240, 6)), labels


@pytest.fixture(scope="module")
def vectors(spark, points):
    x, labels = points
    rows = [(i, [float(v) for v in x[i]], int(labels[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "id bigint, embedding array<double>, label int").persist()


def test_l2_and_embedders(spark):
    df = spark.createDataFrame([("a b A 12",), ("",), (None,)], "t string")
    rows = [r.embedding for r in hashed_embedder(16)(df, "t").collect()]
    assert abs(np.linalg.norm(rows[0]) - 1) < 1e-12 and rows[1] == [0.0] * 16 == rows[2]
    assert sum(r.embedding[0] for r in hashed_embedder(1, normalize=False)(df, "t").collect()) == 4.0
    tfidf = fitted_embedder(fit_tfidf(df, "t", 32))
    assert len(tfidf(df, "t").first().embedding) == 32
    normal = l2_normalize(spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<float>"))
    assert [r.embedding for r in normal.collect()] == [[0.6, 0.8], [0.0, 0.0]]
    back = embed_rows(spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "i int, t string"), "t", hashed_embedder(4))
    assert sorted(r.i for r in back.collect()) == [1, 2]


def test_nearest_center_ties_nulls_and_thresholds(spark):
    model = center_model([5, 2], [[0.0, 0.0], [2.0, 0.0]], thresholds={2: 0.5}, common_threshold=0.5)
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.5]), (3, [2.0, 0.6]), (4, None), (5, [0.0, 9.0])], "i int, embedding array<double>")
    got = {r.i: (r.cluster, r.distance) for r in assign(df, model).collect()}
    assert got == {1: (2, 1.0), 2: (2, 0.5), 3: (2, 0.6), 4: (None, None), 5: (5, 9.0)}
    assert sorted(r.i for r in find_anomalies(df, model).collect()) == [1, 3]
    assert sorted(r.i for r in find_anomalies(df, model, common=True).collect()) == [1, 3, 5]
    assert {r.i: r.threshold for r in score(df, model).collect()}[5] == float("inf")


def brute(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    ks = np.unique(labels)
    s = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == k].mean() for k in ks if k != labels[i])
        s.append((b - a) / max(a, b))
    c = np.array([x[labels == k].mean(0) for k in ks])
    spread = np.array([np.linalg.norm(x[labels == k] - c[j], axis=1).mean() for j, k in enumerate(ks)])
    db = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(ks)) if j != i) for i in range(len(ks))])
    between = sum((labels == k).sum() * ((c[j] - x.mean(0)) ** 2).sum() for j, k in enumerate(ks))
    within = sum(((x[labels == k] - c[j]) ** 2).sum() for j, k in enumerate(ks))
    return np.mean(s), db, between * (len(x) - len(ks)) / (within * (len(ks) - 1))


def test_metrics_equal_brute_force(spark, points, vectors):
    x, labels = points
    assert np.allclose(label_metrics(vectors, "label"), brute(x, labels), atol=1e-9)
    lone = vectors.withColumn("label", F.when(F.col("id") == 0, 9).otherwise(F.col("label")))
    changed = labels.copy()
    changed[0] = 9
    assert np.allclose(label_metrics(lone, "label"), brute(x, changed), atol=1e-9)
    assert label_metrics(vectors.withColumn("label", F.lit(1)), "label") == (None, None, None)
    assert label_metrics(vectors.withColumn("label", F.col("id").cast("int")), "label") == (None, None, None)
    assert -1 < silhouette(vectors, "label", mode="fast") < 1


@pytest.mark.parametrize("percent", [0, 37.5, 50, 90, 99, 100])
@pytest.mark.parametrize("direct", [10**6, 3])
def test_percentiles_equal_numpy(spark, percent, direct):
    rng = np.random.default_rng(1)
    groups = {0: rng.exponential(size=500), 1: np.r_[np.full(300, 0.25), rng.random(50), 1e6], 2: np.array([7.0]), 3: np.zeros(40),
              4: np.array([1.0, 1e300, 2.0, 3.0, -5.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(0, None)]
    got = group_percentiles(spark.createDataFrame(rows, "g int, v double"), "g", "v", percent, direct)
    assert [(g, n) for g, _, n in got] == [(g, len(v)) for g, v in groups.items()]
    for (_, t, _), v in zip(got, groups.values()):
        assert np.isclose(t, np.percentile(v, percent), rtol=1e-12)


def test_thresholds_leave_few_outside_and_skip_empty_clusters(spark, points, vectors):
    model = label_centers(vectors, "label")
    extra = center_model([*model.ids, 99], [*model.centers, [1e6] * 6])
    learned = learn_thresholds(vectors, extra, 90)
    assert 99 not in learned.thresholds and sum(learned.sizes.values()) == 240
    for r in find_anomalies(vectors, learned).groupBy("cluster").count().collect():
        assert r["count"] <= np.ceil((learned.sizes[r.cluster] - 1) * 0.1)


def test_fits(spark, points, vectors):
    one = fit(vectors, 4, ClusterConfig(max_iter=1))
    full = fit(vectors, 4)
    best = fit(vectors, 4, ClusterConfig(n_init=3))
    assert best.inertia <= full.inertia <= one.inertia + 1e-9
    x, _ = points
    d = ((x[:, None] - full.centers[None]) ** 2).sum(2).min(1).sum()
    assert abs(inertia(vectors, full) - d) < 1e-6
    batch = fit(vectors, 4, ClusterConfig(method="minibatch", batch_size=50, epochs=2), id_col="id")
    again = fit(vectors.repartition(7), 4, ClusterConfig(method="minibatch", batch_size=50, epochs=2), id_col="id")
    assert batch.k == 4 and np.isclose(batch.inertia, again.inertia) and batch.inertia < 3 * full.inertia


def test_sweep_and_choice(spark, vectors):
    assert list(k_range(ClusterConfig(), 7)) == [2, 4, 6]
    evaluations = evaluate_k_range(vectors, "id", [2, 4, 6], ClusterConfig(sample_size=100))
    assert [r.sample_size for r in evaluations.collect()] == [100] * 3
    assert all(v is not None for r in evaluations.collect() for v in r)
    model, _, suggestion = train_clusters(vectors, "id", ClusterConfig(k_stop=6))
    assert model.k == suggestion.first().consensus_k
    assert train_clusters(vectors, "id", ClusterConfig(k=3))[0].k == 3


def test_two_vectors_make_one_cluster_without_a_suggestion(spark):
    pair = spark.createDataFrame([(1, [0.0, 2.0]), (2, [4.0, 0.0])], "id int, embedding array<double>")
    model, _, suggestion = train_clusters(pair, "id")
    assert suggestion.first().consensus_k is None and model.centers.tolist() == [[2.0, 1.0]]


def sweep_of(spark, rows):
    return spark.createDataFrame([(*r, 0.0, 0) for r in rows], EVALUATION_SCHEMA)


def test_suggestion_ties_nulls_and_votes(spark):
    rows = [(2, 100.0, 0.5, None, 3.0), (4, 40.0, 0.5, 0.9, None), (6, 35.0, None, 0.9, 9.0), (8, 30.0, 0.1, 1.0, 1.0)]
    got = suggest_k(sweep_of(spark, rows)).first()
    assert tuple(got) == (2, 4, 6, 4, 4)
    assert [r.k for r in metric_series(sweep_of(spark, rows), suggest_k(sweep_of(spark, rows))).filter("is_chosen").collect()] == [4]
    assert tuple(suggest_k(sweep_of(spark, rows[:2])).first()) == (2, 4, 2, None, 2)
    assert tuple(suggest_k(sweep_of(spark, [(2, None, None, None, None)])).first()) == (None,) * 5
    assert metric_series(sweep_of(spark, rows[:1]), suggest_k(sweep_of(spark, [(2, None, None, None, None)]))).first().is_chosen is False


def test_sample_is_exact_repeatable_and_layout_free(spark, vectors):
    one = {r.id for r in sample_rows(vectors, "id", 37).collect()}
    assert len(one) == 37 and one == {r.id for r in sample_rows(vectors.repartition(9), "id", 37).collect()}
    assert one != {r.id for r in sample_rows(vectors, "id", 37, seed=1).collect()}
    assert sample_rows(vectors, "id", 0).count() == sample_rows(vectors, "id", 999).count() == 240


def test_projection(spark, points, vectors):
    x, _ = points
    got = project_2d(vectors, "id", "label").orderBy("id").collect()
    y = np.array([[r.pc1, r.pc2] for r in got])
    spectrum = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(y.var(axis=0, ddof=1), spectrum[:2]) and np.allclose(y.mean(axis=0), 0)
    assert project_2d(vectors, "id", "label", sample_size=50).count() == 50
    with pytest.raises(ValueError):
        project_2d(vectors.withColumn("label", F.lit(None).cast("int")), "id", "label")


def test_null_ragged_and_nan_vectors(spark):
    model = center_model([0, 1], [[0.0, 0.0], [2.0, 0.0]], thresholds={0: 0.5, 1: 0.5})
    schema = "i int, embedding array<double>"
    nulls = spark.createDataFrame([(1, None), (2, None)], schema)
    assert [r.cluster for r in assign(nulls, model).collect()] == [None, None]
    with pytest.raises(Exception, match="vectors of 2 values"):
        assign(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0, 5.0, 6.0])], schema).coalesce(1), model).collect()
    odd = spark.createDataFrame([(1, [float("nan"), 0.0]), (2, [9.0, 0.0]), (3, None)], schema)
    assert [r.i for r in find_anomalies(odd, model).collect()] == [2]
    assert np.isnan({r.i: r.distance for r in assign(odd, model).collect()}[1])


def test_metrics_leave_out_rows_without_vector_or_label(spark, vectors):
    holes = vectors.select("embedding", "label").unionByName(
        spark.createDataFrame([(None, 1), ([0.0] * 6, None)], "embedding array<double>, label int")
    )
    assert label_metrics(holes, "label") == pytest.approx(label_metrics(vectors, "label"))


def test_infinite_distances_have_percentiles(spark):
    inf = float("inf")
    values = [("a", v) for v in (1.0, 2.0, 3.0, inf, inf, inf, 4.0)] + [("b", -inf), ("b", 0.0), ("b", 1.0), ("b", 5.0)]
    df = spark.createDataFrame(values, "g string, v double")
    for percent in (0, 25, 50):
        assert group_percentiles(df, "g", "v", percent, direct_rows=3) == group_percentiles(df, "g", "v", percent)


def test_minibatch_keeps_k_with_small_batches(spark, vectors):
    config = ClusterConfig(method="minibatch", batch_size=3, epochs=1, n_init=1)
    assert fit(vectors.limit(30), 6, config, id_col="id").k == 6
