import random

import pytest

from logsense.llm.packing import pack, pack_group

from .conftest import HARD, prose


def plain_best_fit(pieces, capacity):
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [
            (capacity - used, k) for k, (used, held) in enumerate(bins)
            if capacity - used >= max(size, 1) and not {(0, source), (1, cluster)} & held
        ]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([0, set()])
        out.append((k, bins[k][0]))
        bins[k][0] += size
        bins[k][1] |= {x for x in ((0, source), (1, cluster)) if x[1] is not None}
    return out


@pytest.mark.parametrize("capacity", [5, 16, 50])
def test_group_equals_the_plain_search(capacity):
    rng = random.Random(capacity)
    for _ in range(150):
        pieces = [
            (rng.randint(1, capacity - 1), rng.choice([None, "a", "a", "b", "c"]), rng.choice([None, 1, 2, 3, 4]))
            for _ in range(rng.randint(0, 60))
        ]
        pieces.sort(key=lambda x: -x[0])
        assert pack_group(pieces, capacity) == plain_best_fit(pieces, capacity)


def test_hot_source_stays_fast():
    rng = random.Random(3)
    pieces = sorted(((rng.randint(1, 900), rng.choice(["hot", "hot", k]), k) for k in range(20000)), key=lambda x: -x[0])
    placed = pack_group(pieces, 1000)
    assert len({b for (b, _), p in zip(placed, pieces) if p[1] == "hot"}) == sum(p[1] == "hot" for p in pieces)


def test_every_word_is_packed_once_and_no_bin_breaks_a_rule(make_docs):
    rng = random.Random(1)
    rows = [(k, " ".join(prose(k, rng.choice([3, 20, 130, 64])))) for k in range(200)]
    rows += [(200 + k, t) for k, t in enumerate(HARD)] + [(3, rows[3][1]), (None, "no id at all"), (400, rows[3][1])]
    docs = make_docs(rows)
    got = pack(docs, capacity=64).collect()
    sizes = [len((t or "").split()) for _, t in rows]
    assert sum(r["n_words"] for r in got) == sum(sizes)
    spans = {}
    for r in got:
        spans.setdefault(r["doc_id"], []).append((r["word_start"], r["n_words"]))
    for (i, text) in rows:
        if i not in (3, None):
            parts = sorted(spans[i])
            assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
            assert sum(n for _, n in parts) == len((text or "").split())
    bins = {}
    source = {i: f"src{k % 3}" for k, (i, _) in enumerate(rows)}
    for r in got:
        if r["bin"] is not None:
            bins.setdefault(r["bin"], []).append((r["bin_offset"], r["n_words"], r["doc_id"]))
        else:
            assert r["n_words"] == 0
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(parts, parts[1:]))
        assert sum(n for _, n, _ in parts) <= 64
        ids = [i for *_, i in parts]
        if 3 not in ids:
            assert len({source[i] for i in ids}) == len(ids)
        assert not {3, 400} <= set(ids)


def test_null_sources_and_empty_tables(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(k, f"w{k} x") for k in range(10)]).withColumn("source", F.lit(None).cast("string"))
    assert pack(docs, capacity=20).select("bin").distinct().count() == 1
    assert pack(make_docs([])).count() == 0
