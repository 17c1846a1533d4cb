import random
import zlib

from logsense.llm.shards import byte_shards, write_shards
from logsense.session import scratch_path

from .conftest import HARD, prose


def plain(rows, shards):
    sized = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=lambda r: (r[0] is not None, r))
    total, at, slots, out = sum(s for _, s, _ in sized), 0, {}, []
    for i, size, crc in sized:
        shard = (2 * at + size) * shards // (2 * total)
        at += size
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i, size, crc, "bytes", shard, slots[shard], None))
    return out


def test_shards_match_plain_sums(make_docs):
    rng = random.Random(2)
    rows = [(k, " ".join(prose(k, rng.choice([1, 5, 200])))) for k in range(300)]
    rows += [(1000 + k, t) for k, t in enumerate(HARD)] + [(5, "copy"), (5, "copy"), (-3, "é" * 40000)]
    rng.shuffle(rows)
    for shards in (1, 7, 40, 1000):
        got = sorted(tuple(r) for r in byte_shards(make_docs(rows).repartition(5), shards).collect())
        assert got == sorted(plain(rows, shards))


def test_shards_are_balanced(make_docs):
    rows = [(k, "w" * (k * 37 % 900)) for k in range(2000)]
    totals = {}
    for r in byte_shards(make_docs(rows), 40).collect():
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
    assert len(totals) == 40 and max(totals.values()) - min(totals.values()) <= 2 * 916


def test_rows_without_an_id_and_empty_tables(make_docs):
    got = byte_shards(make_docs([(1, "a"), (None, "b" * 100)]), 2).collect()
    assert [(r["doc_id"], r["shard"]) for r in sorted(got, key=lambda r: r["shard"])] == [(None, 0), (1, 1)]
    assert byte_shards(make_docs([]), 40).count() == 0


def test_written_shards(spark, make_docs):
    docs = make_docs([(k, "t" * k) for k in range(50)])
    path = scratch_path(spark, "shards")
    write_shards(docs, byte_shards(docs, 4), path)
    back = spark.read.parquet(path)
    assert back.count() == 50 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
