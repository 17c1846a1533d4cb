import math
import re

import pytest

from logsense.llm.licenses import CONTAINMENT, NOTICES, SHINGLE, STEP, scan

from .conftest import HARD, prose


def shingles(text):
    words = [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]
    return [tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def plain(rows):
    found = {}
    for i, text in rows:
        mine = shingles(text)
        for name, notice in NOTICES.items():
            want = set(shingles(notice))
            reach = math.ceil(len(want) / STEP) * STEP
            for at in range(0, len(mine), STEP):
                share = len(want & set(mine[max(0, at - reach) : at + STEP + reach])) / len(want)
                if share >= CONTAINMENT:
                    found[i, name] = max(share, found.get((i, name), 0))
    return found


def test_scan_matches_plain_windows(make_docs):
    fill = lambda k: " ".join(prose(k, 37))
    rows = [(100 + k, f"{fill(k)}\n{t}\n{fill(k + 1)}") for k, t in enumerate(NOTICES.values())]
    rows += [(200 + k, f"{'pad ' * k}{t.upper()}") for k, t in enumerate(NOTICES.values())]
    for k, t in enumerate(NOTICES.values()):
        words = t.split()
        words[-2] = "edited"
        rows.append((300 + k, fill(k) + " " + " ".join(words)))
        rows.append((400 + k, fill(k) + " " + " ".join(t.split()[: len(t.split()) // 2])))
    rows += list(enumerate(HARD)) + [(500, " ".join(NOTICES.values())), (501, "License Apache Licensed MIT the under")]
    got = {(r["doc_id"], r["license"]): r["containment"] for r in scan(make_docs(rows).repartition(3)).collect()}
    assert got == pytest.approx(plain(rows)) and len(got) > 25


def test_hard_rows(make_docs):
    text = "Released under the MIT License."
    got = scan(make_docs([(None, text), (1, text), (1, text), (2, None), (3, "")])).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "None"]
    assert scan(make_docs([])).count() == 0
    assert scan(make_docs([(1, text)]), {"short": "two words"}).count() == 0


def test_the_plan_runs_no_python(make_docs, capsys):
    scan(make_docs([(1, "a")])).explain()
    assert "Python" not in capsys.readouterr().out.replace("PythonRDD", "")
