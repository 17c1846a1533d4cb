import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from logsense.config import ClusterConfig, ParserConfig
from logsense.operators.clustering import assign, center_model
from logsense.operators.embedding import hashed_embedder
from logsense.operators.grouping import group_entries
from logsense.plans import catalog
from logsense.plans.detect import detect
from logsense.plans.parse import parse_log_files, parse_new_file
from logsense.plans.train import train
from logsense.sources import artifacts
from logsense.streaming.grouping import StreamGrouping
from logsense.streaming.jobs import append_to, latest_counts, upsert_to, window_counts


def test_train_then_detect(spark, tmp_path):
    rng = random.Random(1)
    line = "[2025-01-01 00:00:{:02d}.000] [info] [net] [1: 2] [A: 3] {}\n"
    kinds = ["connection {} opened to host {}", "connection {} closed after {} ms", "cache {} flushed", "heartbeat {} ok"]
    (tmp_path / "train").mkdir()
    with open(tmp_path / "train" / "a.log", "w") as f:
        for i in range(400):
            f.write(line.format(i % 60, rng.choice(kinds).format(rng.randrange(99), rng.randrange(99))))
    with open(tmp_path / "new.log", "w") as f:
        f.write(line.format(1, "heartbeat 5 ok") + line.format(2, "kernel panic in module zzz") + "trace below\n")
    parsed = parse_log_files(spark, str(tmp_path / "train"))
    result = train(parsed, clusters=ClusterConfig(k=2), embedder=hashed_embedder(64))
    assert result.labels.count() == result.templates.count()
    artifacts.write_model(spark, result.model, str(tmp_path / "model"), result.labels)
    model = artifacts.read_model(spark, str(tmp_path / "model"))
    found = detect(parse_new_file(spark, str(tmp_path / "new.log")), result.templates, model, hashed_embedder(64)).collect()
    assert [r.message for r in found] == ["kernel panic in module zzz trace below"]
    assert found[0].is_new and found[0].distance > found[0].threshold and len(found[0].embedding) == 64
    calm = detect(parsed.limit(0), result.templates, model, hashed_embedder(64))
    assert calm.count() == 0 and "threshold" in calm.columns


def test_train_and_detect_chooses_k(spark, tmp_path, monkeypatch):
    """The number of clusters comes from the sweep over all k, not from a fixed value."""
    words = ["red", "oak tree", "sun moon star", "salt sugar milk tea", "one two four six ten"]
    rows = []
    for i in range(60):
        kind = ["view", "click", "error"][i % 3]
        rows.append((i, i % 4, kind, f"{words[i % 5]} {kind} part{'abcdefgh'[i % 8]}"))
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, props string")
    events.withColumn("ts", F.timestamp_seconds("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    monkeypatch.setattr(catalog, "train", lambda *args, **more: seen.append(train(*args, **more)) or seen[0])
    found = catalog.train_and_detect(spark, str(tmp_path)).collect()
    result, n = seen[0], seen[0].templates.count()
    assert n > 4 and [r.k for r in result.evaluations.orderBy("k").collect()] == list(range(2, n + 1, 2))
    assert result.model.k == result.suggestion.first().consensus_k
    assert {r.cluster for r in found} <= set(result.model.ids.tolist()) and all(r.distance > r.threshold for r in found)


def test_tables_survive_every_format(spark, tmp_path):
    rows = [("f", 'say "hi", ok\nnext', "raw", None, "null", "NA", 1, -1, None, 2, " padded ", 1), ("f", "", "raw", "", None, None, 1, -1, None, 2, "", 2)]
    df = spark.createDataFrame(rows, artifacts.PARSED_SCHEMA)
    for fmt in ("parquet", "csv", "json"):
        artifacts.write_table(df, str(tmp_path / fmt), fmt)
        back = artifacts.read_parsed_logs(spark, str(tmp_path / fmt), fmt)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())), fmt
    with pytest.raises(Exception):
        artifacts.read_parsed_logs(spark, str(tmp_path / "nowhere"))
    with pytest.raises(Exception):
        artifacts.read_model(spark, str(tmp_path / "nowhere"))


def lines_frame(spark, rows):
    return spark.createDataFrame(rows, "log_file string, line_no bigint, line string")


def test_stream_grouping_equals_batch_over_many_batches(spark, tmp_path):
    rng = random.Random(2)
    config = ParserConfig(start_regexes=("^#",), max_lines=4)
    rows = [(f, n, rng.choice(["# s", "c", "d"])) for f in ("a", "b", "c") for n in range(1, 60)]
    grouping = StreamGrouping(str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "late"), config, idle_seconds=1000)
    cuts = [0, 7, 7, 20, 45, 60]
    for batch, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = [r for r in rows if lo < r[1] <= hi and not (r[0] == "c" and batch == 0)]
        part += [r for r in rows if batch == 2 and r[0] == "c" and r[1] <= 7]
        grouping.run_batch(lines_frame(spark, part), batch, now=float(batch))
    closed = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    got = closed.unionByName(grouping.open_entries(spark, 4)).collect()
    assert sorted(map(str, got)) == sorted(map(str, group_entries(lines_frame(spark, rows), config).collect()))
    grouping.run_batch(lines_frame(spark, [("a", 59, "late")]), 5, now=5.0)
    assert spark.read.parquet(str(tmp_path / "late")).filter("batch = 5").count() == 1
    before = grouping.open_entries(spark, 5).count()
    grouping.run_batch(lines_frame(spark, []), 6, now=9999.0)
    assert grouping.open_entries(spark, 6).count() == 0
    assert spark.read.parquet(str(tmp_path / "out")).filter("batch = 6").count() == before


def test_window_counts_drop_open_windows(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:20:00", "a"), ("2024-01-01 05:00:00", "b")]
    df = spark.createDataFrame(rows, "timestamp string, level string")
    df.coalesce(1).write.parquet(source)
    counts = window_counts(spark.readStream.schema(df.schema).parquet(source), ["level"])
    append_to(counts, str(tmp_path / "out")).awaitTermination()
    assert [(r.level, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", 2)]


def test_latest_counts_have_open_windows(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:20:00", "a"), ("2024-01-01 05:00:00", "b")]
    df = spark.createDataFrame(rows, "timestamp string, level string")
    for k, part in enumerate((df.limit(1), df.offset(1))):
        part.coalesce(1).write.parquet(f"{source}/{k}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(source)
    upsert_to(window_counts(stream, ["level"], delay="9 hours"), str(tmp_path / "out")).awaitTermination()
    assert sorted((r.level, r.n) for r in latest_counts(spark, str(tmp_path / "out"), ["level"]).collect()) == [("a", 2), ("b", 1)]


def test_scoring_needs_no_shuffle(spark):
    df = spark.createDataFrame([([1.0],)], "embedding array<double>")
    plan = assign(df, center_model([0], [[0.0]]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_registered_queries_have_names_and_sql(spark):
    queries, oracle = spark_entry.queries(), spark_entry.oracle_sql()
    assert set(oracle) <= set(queries)
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["doc_entries", "doc_correct", "template_match", "anomalies_per_cluster", "k_suggestion", "stream_detect"])
def test_queries_equal_sql(spark, name):
    from tools.check_oracle import compare, duck

    sf_dir = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf_dir), name, sf_dir).startswith("ok")


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_of_documents_in_part_files(spark, tmp_path, parts):
    rows = [(k, f"One {k}\ntwo\nThree {k}") for k in range(20)] + [(20, None), (21, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
    queries = spark_entry.queries()
    found, plain = (queries[q](spark, str(tmp_path)).collect() for q in ("stream_entries", "doc_entries"))
    assert sorted(map(str, found)) == sorted(map(str, plain)) and len(plain) >= 40


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_of_vectors_in_part_files(spark, tmp_path, parts):
    rows = [(k, [float(k % 2), float(k)], k % 2) for k in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    vectors.repartition(parts).write.parquet(str(tmp_path / "embeddings.parquet"))
    queries = spark_entry.queries()
    found, plain = (queries[q](spark, str(tmp_path)).collect() for q in ("stream_score", "anomalies_per_cluster"))
    assert sorted(map(str, found)) == sorted(map(str, plain)) and plain


def test_scores_of_a_table_with_missing_vectors_and_labels(spark, tmp_path):
    rows = [(k, [float(k % 2), float(k)], k % 2) for k in range(40)] + [(40, [0.5, 500.0], None), (41, [3.0, 19.0], None)]
    holes = [(42, None, 0), (43, None, 5), (44, None, None)]
    vectors = spark.createDataFrame(rows + holes, "vec_id bigint, embedding array<float>, label int")
    vectors.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    x, labels = np.array([v for _, v, _ in rows]), np.array([-1 if n is None else n for _, _, n in rows])
    distances = np.stack([np.linalg.norm(x - x[labels == n].mean(axis=0), axis=1) for n in (0, 1)], axis=1)
    near, least = distances.argmin(axis=1), distances.min(axis=1)
    limits = np.array([np.percentile(least[near == n], 90) for n in (0, 1)])[near]
    want = [(k, near[k], least[k], limits[k]) for k in range(len(rows)) if least[k] > limits[k]]
    for name in ("stream_score", "anomalies_per_cluster"):
        found = spark_entry.queries()[name](spark, str(tmp_path)).collect()
        assert np.allclose(sorted(map(tuple, found)), want, rtol=0, atol=1e-6) and 40 in [r.vec_id for r in found]


def test_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(artifacts, "CSV_ROWS", 10)
    rows = [("f", f"line {k}\nnext", "raw", None, None, None, 1, -1, None, 2, "", k) for k in range(95)]
    df = spark.createDataFrame(rows, artifacts.PARSED_SCHEMA).coalesce(1)
    artifacts.write_table(df, str(tmp_path / "csv"), "csv")
    back = artifacts.read_parsed_logs(spark, str(tmp_path / "csv"), "csv").withColumn("file", F.input_file_name())
    assert sorted(r["count"] for r in back.groupBy("file").count().collect()) == [5] + [10] * 9
    assert sorted(map(str, back.drop("file").collect())) == sorted(map(str, df.collect()))


def test_detection_embeds_each_template_once(spark, tmp_path):
    rows = [("f", f"known {k} fixed", "raw", None, None, None, 1, -1, None, 2, f"known {k} fixed", k) for k in range(60)]
    parsed = spark.createDataFrame(rows + [("f", "odd", "raw", None, None, None, 1, -1, None, 2, "odd", 60)], artifacts.PARSED_SCHEMA)
    templates = spark.createDataFrame([("known <*> fixed", 1)], "template string, cluster_id bigint")
    calls = spark.sparkContext.accumulator(0)

    def counted(df, text_col):
        @F.udf("array<double>")
        def one(text):
            calls.add(1)
            return [1.0 if text.startswith("known") else 0.0]

        return df.withColumn("embedding", one(text_col))

    model = center_model([0], [[1.0]], thresholds={0: 0.5})
    found = detect(parsed, templates, model, counted).collect()
    assert [r.message for r in found] == ["odd"]
    assert calls.value <= 5  # the template, the odd text and the empty one; of anomalies the vector is made once more
