"""The whole Brown model against plain loops: counts, exchange, smoothing and the score of each text."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logsense.llm.brown import BrownConfig, score_texts

from .conftest import HARD, prose


def f(x):
    return x * math.log(x) if x > 1 else 0.0


def plain_scores(rows, held, config):
    """doc_id -> score, by dictionaries of counts."""
    split = {i: (t or "").encode().lower().split() for i, t in rows}
    training = [w for i, w in split.items() if i not in held]
    counts = Counter(w for words in training for w in words)
    order = sorted((w for w in counts if len(w) <= 64), key=lambda w: (-counts[w], w))[: config.exchange]
    k, other, edge = config.classes, config.classes, config.classes + 1
    of = {w: j % k for j, w in enumerate(order)}

    def chain(words):
        return [edge, *(of.get(w, other) for w in words), edge]

    def count():
        before, after, pairs = {w: Counter() for w in order}, {w: Counter() for w in order}, Counter()
        for words in training:
            classes = chain(words)
            for j, w in enumerate(words):
                if w in of:
                    before[w][classes[j]] += 1
                    after[w][classes[j + 2]] += 1
            pairs.update(zip(classes[:-1], classes[1:]))
        # texts stand in one row: an edge follows an edge nowhere but at an empty text
        return before, after, pairs

    def likelihood(pairs):
        value = sum(map(f, pairs.values()))
        for side in (0, 1):
            sums = Counter()
            for key, x in pairs.items():
                sums[key[side]] += x
            value -= sum(map(f, sums.values()))
        return value

    highest, kept = -math.inf, dict(of)
    for sweep in range(config.sweeps + 1):
        before, after, pairs = count()
        if likelihood(pairs) <= highest:
            break
        highest, kept = likelihood(pairs), dict(of)
        if sweep == config.sweeps:
            break
        n = {(a, b): float(pairs[a, b]) for a in range(k + 2) for b in range(k + 2)}
        for w in order:
            left, right, own, tokens = before[w], after[w], of[w], sum(before[w].values())
            for c in range(k + 2):
                n[c, own] = n[c, own] - left[c]
            for c in range(k + 2):
                n[own, c] = n[own, c] - right[c]
            n = {key: max(v, 0.0) for key, v in n.items()}
            gains = []
            for c in range(k):
                gain = sum(f(n[a, c] + left[a]) - f(n[a, c]) for a in range(k + 2))
                gain += sum(f(n[c, b] + right[b]) - f(n[c, b]) for b in range(k + 2))
                into, out = sum(n[a, c] for a in range(k + 2)), sum(n[c, b] for b in range(k + 2))
                gains.append(gain - (f(into + tokens) - f(into)) - (f(out + tokens) - f(out)))
            best = max(range(k), key=lambda c: (round(gains[c], 9), -c))
            of[w] = best
            for c in range(k + 2):
                n[c, best] += left[c]
            for c in range(k + 2):
                n[best, c] += right[c]
    of = kept
    _, _, pairs = count()
    total = sum(pairs.values())
    into = [sum(pairs[a, b] for a in range(k + 2)) for b in range(k + 2)]
    out = [sum(pairs[a, b] for b in range(k + 2)) for a in range(k + 2)]
    share = [(x + 1) / (total + k + 2) for x in into]
    step = lambda a, b: (pairs[a, b] + config.backoff * share[b]) / (out[a] + config.backoff)
    members = Counter()
    for w in order:
        members[of[w]] += counts[w]
    rest = sum(counts.values()) - sum(counts[w] for w in order) + 0.5 * (len(counts) - len(order) + 1)
    scores = {}
    for i, words in split.items():
        classes = chain(words)
        s = sum(math.log10(step(a, b)) for a, b in zip(classes[:-1], classes[1:]))
        s += sum(math.log10(counts[w] / members[of[w]] if w in of else (counts[w] + 0.5) / rest) for w in words)
        scores[i] = s
    return scores


@pytest.mark.parametrize("config", [BrownConfig(classes=3, exchange=12, head=40, sweeps=2), BrownConfig(classes=4, exchange=64, head=1000, sweeps=12)])
def test_scores_are_those_of_plain_loops(spark, make_docs, config):
    rows = [(k, " ".join(prose(k, 60, 45))) for k in range(40)] + [(100 + k, t) for k, t in enumerate(HARD)]
    held = {k for k in range(0, 40, 4)} | {100, 103}
    found = score_texts(make_docs(rows), F.col("doc_id").isin(list(held)), config=config).collect()
    want = plain_scores(rows, held, config)
    assert len(found) == len(want)
    for r in found:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6), r.doc_id
        assert r.perplexity == pytest.approx(10 ** (-want[r.doc_id] / r.n_tokens), rel=1e-6)
