import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsense.llm.brown import BrownConfig, exchange_sweep, head_words, score_texts
from logsense.llm.texts import id_crc32

from .conftest import HARD, prose

SMALL = BrownConfig(classes=4, exchange=20, head=60, sweeps=2)


def corpus():
    """Sentences of four kinds of words in a fixed order, so that classes help."""
    rng = np.random.default_rng(1)
    kinds = [[f"{name}{k}" for k in range(8)] for name in ("art", "noun", "verb", "adv")]
    texts = [" ".join(str(rng.choice(kinds[k % 4])) for k in range(rng.integers(1, 60))) for _ in range(120)]
    return texts + [" ".join(prose(5, 40)), "Y" * 100 + " y"]


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


def counted(rows):
    counts = Counter()
    for i, t in rows:
        if not held_out(i):
            counts.update((t or "").encode().lower().split())
            counts[None] += 1
    return counts


@pytest.mark.parametrize("config", [SMALL, BrownConfig(classes=3, exchange=5, head=0), BrownConfig()])
def test_base_counts_and_scores(make_docs, config):
    rows = list(enumerate([*corpus(), *HARD]))
    counts = counted(rows)
    total, norm = sum(counts.values()), 0.5 * (len(counts) + 1)
    got = {r["doc_id"]: r for r in score_texts(make_docs(rows).repartition(4), id_crc32("doc_id") % 5 == 1, config=config).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held_out(i), len(tokens), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (total + norm)) for w in tokens))
        assert r["score"] < 0 and r["perplexity"] == pytest.approx(10 ** (-r["score"] / len(tokens)))


def test_classes_beat_the_base_on_held_out_texts(make_docs):
    rows = list(enumerate(corpus()))
    config = BrownConfig(classes=4, exchange=32, head=64, sweeps=4, backoff=1.0)
    got = score_texts(make_docs(rows), id_crc32("doc_id") % 5 == 1, config=config).where("held_out and n_tokens > 5")
    base, score = got.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base * 0.75


def test_words_have_probabilities_that_sum_to_one(make_docs):
    """One-word texts for every word, and one unseen word for all others, after the same start."""
    rows = list(enumerate(corpus()))
    counts = counted(rows)
    words = [w.decode() for w in counts if w is not None] + ["unseenword"]
    train = [r for r in rows if not held_out(r[0])]
    probe_ids = iter(i for i in range(10**6, 10**7) if held_out(i))
    probes = [(next(probe_ids), w) for w in words] + [(next(probe_ids), "")]
    got = {r["doc_id"]: r for r in score_texts(make_docs(train + probes), id_crc32("doc_id") % 5 == 1, config=SMALL).collect()}
    # P(word, end) = P(word) P(end | class): summed over words and the empty text it stays below one
    total = sum(10 ** got[i]["score"] for i, _ in probes)
    assert 0 < total < 1


def test_sweep_raises_the_likelihood():
    rng = np.random.default_rng(2)
    words, config = 12, BrownConfig(classes=3, exchange=12)
    true = np.arange(words) % 3
    step = np.array([[0.05, 0.9, 0.05], [0.05, 0.05, 0.9], [0.9, 0.05, 0.05]])
    sequence, k = [], 0
    for _ in range(4000):
        k = rng.choice(3, p=step[k])
        sequence.append(int(rng.choice(np.flatnonzero(true == k))))

    def counts(classes):
        chain = classes[sequence]
        before, after = np.zeros((2, words, 5), np.int64)
        np.add.at(before, (sequence[1:], chain[:-1]), 1)
        np.add.at(after, (sequence[:-1], chain[1:]), 1)
        bigrams = np.zeros((5, 5), np.int64)
        np.add.at(bigrams, (chain[:-1], chain[1:]), 1)
        return before, after, bigrams

    def value(classes):
        n = counts(classes)[2]
        f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
        return f(n) - f(n.sum(0)) - f(n.sum(1))

    classes = rng.integers(0, 3, words)
    for _ in range(6):
        classes = exchange_sweep(classes, *counts(classes), config)
    assert value(classes) >= value(true) - 1e-6


def test_head_is_bounded_and_keeps_ties_together(spark):
    rows = [(b"a", 5000), (b"b", 5000), (b"c", 70), (b"d", 3), (b"e", 3), (b"f", 3), (b"x" * 65, 9000)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    assert [w for w, _ in head_words(counts, 5)] == [b"a", b"b", b"c"]
    assert [w for w, _ in head_words(counts, 6)] == [b"a", b"b", b"c", b"d", b"e", b"f"]
    assert head_words(counts, 1) == [] and head_words(counts.limit(0), 5) == []


def test_no_training_rows_and_empty_tables(make_docs):
    docs = make_docs([(1, "a b"), (None, None)])
    got = score_texts(docs, F.lit(True), config=SMALL).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in got] == [(0, 0)] * 2
    assert score_texts(make_docs([]), F.lit(False), config=SMALL).count() == 0
    nulls = make_docs([(None, "a b"), (None, "a b"), (4, "a")])
    assert score_texts(nulls, F.col("doc_id") == 4, config=SMALL).where("held_out").count() == 3
