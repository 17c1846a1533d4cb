import gzip

from logsense.operators.frequency import distinct_messages
from logsense.operators.templates import match_messages
from logsense.sources.text_logs import list_files, skipped_files
from logsense.streaming.mining import StreamMiner


def words(k):
    return f"user u{k} logged in from host h{k % 7}" if k % 3 else f"disk d{k} is {k % 100} percent full on node n{k % 5}"


def test_versions_cover_all_messages_and_a_repeat_is_harmless(spark, tmp_path):
    schema = "message string"
    batches = [spark.createDataFrame([(words(k),) for k in range(a, a + 60)], schema) for a in (0, 60, 60)]
    batches.append(spark.createDataFrame([("a new kind of line 17",), ("a new kind of line 18",), ("",), (None,)], schema))
    miner = StreamMiner(str(tmp_path / "store"))
    assert miner.latest(spark) is None
    seen, total = None, 0
    for number, batch in enumerate(batches):
        miner.run_batch(batch, number)
        before = sorted((r.template, r.size) for r in miner.templates(spark, number).collect())
        miner.run_batch(batch, number)
        assert sorted((r.template, r.size) for r in miner.templates(spark, number).collect()) == before
        total += batch.where("message <> ''").count()
        assert miner.latest(spark) == number and sum(n for _, n in before) == total
        seen = batch if seen is None else seen.union(batch)
        matched = match_messages(distinct_messages(seen).cache(), miner.templates(spark, number))
        assert matched.where("template is null").count() == 0
    assert len(before) < 20


def test_a_stream_of_files(spark, tmp_path):
    lines = spark.createDataFrame([(words(k),) for k in range(90)], "message string")
    lines.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    miner = StreamMiner(str(tmp_path / "store"))
    miner.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
    assert miner.latest(spark) == 2
    lines.limit(5).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    miner.start(stream, str(tmp_path / "checkpoint")).awaitTermination()  # goes on after a restart
    assert miner.latest(spark) == 3
    assert sum(r.size for r in miner.templates(spark, 3).collect()) == 95


def test_missing_and_corrupt_files_are_named(spark, tmp_path):
    folder = tmp_path / "logs" / "x"
    folder.mkdir(parents=True)
    (folder / "good.log").write_bytes(b"one\n" * 10)
    (folder / "empty.log").write_bytes(b"")
    (folder / "good.log.gz").write_bytes(gzip.compress(b"two\n" * 1000))
    (folder / "cut.log.gz").write_bytes(gzip.compress(bytes(range(256)) * 500)[:-20])
    (folder / "gone.log").write_bytes(b"three\n")
    (folder / "other.txt").write_bytes(b"no")
    listed = list_files(spark, str(tmp_path / "logs"), "**/*.log*").cache()
    assert listed.count() == 4  # an empty file has nothing to be skipped
    assert list_files(spark, str(tmp_path / "logs"), "**/*.log", ("x/g*",)).count() == 1
    (folder / "gone.log").unlink()
    found = {r.log_file.rsplit("/", 1)[1]: r.reason for r in skipped_files(listed).collect()}
    assert sorted(found) == ["cut.log.gz", "gone.log"]
    assert found["gone.log"] == "missing" and found["cut.log.gz"].startswith("corrupt")
