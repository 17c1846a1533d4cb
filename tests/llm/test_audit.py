import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from logsense.llm.audit import COUNTERS, filter_audit, settle

from .conftest import HARD, prose

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(rows):
    """Per row the set of letters that fail, by the contract."""
    smallest = {}
    for i, _, t in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, _, t in rows:
        t = t or ""
        words = t.encode().split()
        found = set()
        if len(words) < 200:
            found.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            found.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t):
            found.add("C")
        if set(t) & set("#$%&*|"):
            found.add("D")
        if i is not None and i > smallest[t]:
            found.add("E")
        out.append(found)
    return out


def plain(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    failed, out = fails(rows), {}
    for part in {s or "" for _, s, _ in rows}:
        own = [(i, f) for (i, s, _), f in zip(rows, failed) if (s or "") == part]
        removals = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                left = [(i, f) for i, f in own if not f & set(order[:step])]
                gone = [i for i, f in left if letter in f]
                removals[letter] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(left) - len(gone), len(gone), sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                    sum(i in good for i in gone), sum(i in toxic for i in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(removals[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def corpus():
    rng = random.Random(3)
    texts = [" ".join(prose(k, 230, 400 if k % 3 else 80)) + ("" if k % 4 else " #") for k in range(6)]
    texts += [t.title() for t in texts[:3]] + [*HARD, "short one", "SHORT ONE"]
    rows = [(k, rng.choice(["a", "b", None, ""]), rng.choice(texts)) for k in range(90)]
    rows += [(200 - k, "hot", texts[0]) for k in range(60)]  # ids of one text descend, so that counters are taken back
    rows += [(None, "a", texts[0]), (None, "hot", "short one"), (None, None, None), (3, "b", rows[3][2]), (-5, "c", texts[0]), (-5, "d", texts[0])]
    labels = [(k, k % 2, (k + 1) % 3 // 2) for k in range(0, 200, 3)] + [(0, 0, 1), (None, 1, 1), (-5, 1, None), (5, None, 1)]
    return rows, labels


@pytest.fixture
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, s, t, "clash", 1, "clash") for i, s, t in rows], "doc_id long, source string, text string, part string, mask int, key string")
    return docs, spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, part string"), rows, labels


def results(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in df.collect()}


@pytest.mark.parametrize("batches", [1, 6])
def test_against_a_loop(spark, tables, tmp_path, batches):
    docs, labels, rows, marked = tables
    docs.orderBy(F.desc("doc_id")).repartition(6).write.parquet(str(tmp_path / "docs.parquet"))
    found = filter_audit(spark, str(tmp_path / "docs.parquet"), labels, batches=batches)
    assert found.count() == len({s or "" for _, s, _ in rows}) * 600
    assert results(found) == plain(rows, marked)


def test_a_smaller_id_in_a_later_file_takes_counters_back(spark, tables, tmp_path):
    docs, labels, rows, marked = tables
    path, folder = str(tmp_path / "docs.parquet"), str(tmp_path / "audit")
    docs.where("doc_id >= 50 or doc_id is null").coalesce(1).write.parquet(path)
    filter_audit(spark, path, labels, folder=folder)
    docs.where("doc_id < 50").coalesce(1).write.mode("append").parquet(path)
    assert results(filter_audit(spark, path, labels, folder=folder)) == plain(rows, marked)
    assert spark.read.schema(COUNTERS).parquet(f"{folder}/counters/*").where("n < 0").count() > 0


def test_no_rows(spark, tables, tmp_path):
    docs, labels, _, _ = tables
    docs.where("false").coalesce(1).write.parquet(str(tmp_path / "docs.parquet"))
    assert filter_audit(spark, str(tmp_path / "docs.parquet"), labels.where("false")).count() == 0


def test_the_state_of_a_text_does_not_depend_on_the_order_of_its_rows():
    rng = random.Random(5)
    rows = [(rng.randrange(6), rng.choice("xy"), 2, True, False, rng.randrange(1, 4)) for _ in range(14)]
    totals = set()
    for _ in range(50):
        rng.shuffle(rows)
        held, counted = None, {}
        step = rng.choice([1, 3, 14])
        for at in range(0, 14, step):
            held, changes = settle(held, rows[at : at + step], 16)
            for *place, n in changes:
                counted[tuple(place)] = counted.get(tuple(place), 0) + n
        totals.add((held[0], tuple(sorted((k, v) for k, v in counted.items() if v))))
    assert len(totals) == 1
