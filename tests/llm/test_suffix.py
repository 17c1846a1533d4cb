import hashlib
import random

import numpy as np
import pytest
from pyarrow import fs

import logsense.llm.induced as induced
from logsense.llm.anchors import pieces
from logsense.llm.suffix import remove_repeats, removal_digests

from .conftest import HARD, prose


def brute(rows, length=100):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shared_texts(seed):
    rng = random.Random(seed)
    passages = [" ".join(prose(seed + k, rng.randint(12, 60))) for k in range(5)] + ["la " * 120, "é" * 300]
    texts = []
    for k in range(40):
        parts = [" ".join(prose(1000 + 7 * k, rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 3)
            parts += [p[cut : len(p) - rng.randint(0, len(p) // 3)], " ".join(prose(rng.randint(0, 10**6), rng.randint(0, 20)))]
        texts.append(" ".join(parts))
    zeros = "a\0b" * 60
    return texts + [texts[3], texts[3], texts[5] + "tail", "x" + texts[7], zeros, "c" + zeros, "\0" * 250]


@pytest.mark.parametrize("batch, depth, limit", [(1, 0, 0), (3, 1, 64), (1000, 12, 10**9)])
def test_induced_order_is_the_suffix_order(tmp_path, monkeypatch, batch, depth, limit):
    monkeypatch.setattr(induced, "BATCH", batch)
    monkeypatch.setattr(induced, "DEPTH", depth)
    rng = random.Random(batch)
    for k in range(150):
        text = [rng.randint(1, rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 50))]
        text = (text[: len(text) // 4] * 4 if k % 3 == 0 else text) + [0]
        spill = induced.Spill(fs.LocalFileSystem(), str(tmp_path), limit)
        got = np.concatenate(list(induced.sorted_suffixes(np.array(text, np.int32), spill)))[::-1]
        spill.close()
        assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    assert list(tmp_path.iterdir()) == []


@pytest.mark.parametrize("batch, depth", [(1, 0), (3, 1), (1000, 12)])
def test_induced_prefixes(monkeypatch, batch, depth):
    monkeypatch.setattr(induced, "BATCH", batch)
    monkeypatch.setattr(induced, "DEPTH", depth)
    rng = random.Random(batch + 7)
    for k in range(200):
        text = [rng.randint(1, rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(1, 50))]
        text = (text[: len(text) // 4 + 1] * 5 if k % 3 == 0 else text) + [0]
        batches = list(induced.sorted_suffixes(np.array(text, np.int32), induced.Spill(), with_prefixes=True))
        order = [int(x) & induced.LOW for b in batches for x in b]
        shared = [int(x) >> induced.SHIFT for b in batches for x in b]
        assert order == sorted(range(len(text)), key=lambda i: text[i:])[::-1]
        for i in range(1, len(order)):
            a, b = text[order[i - 1] :], text[order[i] :]
            assert shared[i] == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_equal_windows_have_equal_anchors():
    shared = " ".join(prose(3, 60)).encode()
    anchors = []
    for around in (b"", b"some other beginning of a text ", b"z" * 5000):
        text = around + shared + around
        found = pieces(text, 100)
        by_window = {}
        for anchor, _, start, n in found.tolist():
            for s in range(start, start + n):
                by_window[text[s : s + 100]] = anchor
        assert sum(n for *_, n in found.tolist()) == len(text) - 99
        anchors.append([by_window[shared[s : s + 100]] for s in range(len(shared) - 99)])
    assert anchors[0] == anchors[1] == anchors[2]
    assert len(pieces(b"x" * 99, 100)) == 0 and len(pieces(b"", 100)) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_matches_brute_force(make_docs, seed):
    rows = list(enumerate(shared_texts(seed), 50))
    random.Random(seed).shuffle(rows)
    got = sorted(tuple(r) for r in removal_digests(make_docs(rows).repartition(3)).collect())
    assert got == brute(rows)


def test_shards_in_blocks_and_spilled(make_docs, monkeypatch):
    import logsense.llm.anchors as anchors

    rows = list(enumerate(shared_texts(9)))
    long = " ".join(prose(77, 3000))
    rows += [(100, long), (101, "front " + long[5000:] + " back")]
    monkeypatch.setattr(anchors, "BLOCK", 4096)
    monkeypatch.setattr(induced, "BATCH", 64)
    assert sum(n for *_, n in pieces(long.encode(), 100).tolist()) == len(long) - 99
    assert sorted(tuple(r) for r in removal_digests(make_docs(rows)).collect()) == brute(rows)


def test_hard_rows(make_docs):
    rows = list(enumerate(HARD))
    got = sorted(tuple(r) for r in removal_digests(make_docs(rows)).collect())
    assert got == brute(rows)
    text = " ".join(prose(5, 80))
    extra = [(None, text), (7, text), (7, text), (8, "ab " + text)]
    got = sorted((tuple(r)[:4] for r in removal_digests(make_docs(extra)).collect()), key=str)
    n = len(text)
    # the row without an id is first; repeated rows of one id are equal places
    assert got == sorted([(7, n, n, 1), (7, n, n, 1), (8, n + 3, n, 1), (None, n, 0, 0)], key=str)
    twice = [(7, text), (7, text)]
    assert {tuple(r)[2] for r in removal_digests(make_docs(twice)).collect()} == {0}


def test_empty_table(make_docs):
    assert removal_digests(make_docs([])).count() == 0
    assert remove_repeats(make_docs([])).count() == 0


def test_texts_keep_whole_characters(make_docs):
    shared = "é" * 80
    docs = make_docs([(1, "a" + shared + "b"), (2, "x" + shared + "y"), (3, None)])
    out = remove_repeats(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[1].startswith("aé") and texts[3] is None
    assert texts[2] == "xy" and {r["shard"] for r in out.collect()} == {"clash"}
