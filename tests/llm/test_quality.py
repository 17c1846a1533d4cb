import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logsense.llm.quality import Rule, default_rules, judge, keep_good, rules_by_gain

from .conftest import CLASHES, HARD, prose

JUNK = {
    "symbols": " ".join(f"{w}###" for w in prose(1, 80)),
    "shouting": " ".join(prose(2, 80)).upper(),
    "digits": " ".join(str(10**7 + 7919 * k) for k in range(80)),
    "word_length": " ".join(w * 9 for w in prose(3, 80)),
    "base": "again and again " * 60,
    "dup_lines": "\n".join([" ".join(prose(50 + k, 20)) for k in range(3)] + ["x y"] * 20),
}
GOOD = [" ".join(prose(k, 120)).capitalize() + "." for k in range(20)]


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_and_base_match_plain_loops(make_docs):
    texts = [*HARD, *JUNK.values(), *GOOD, "a b c a b c", "a a a a", "  is a word here", "1 < 2 & 3 > 2 | % $ * #"]
    rows = list(enumerate(texts)) + [(None, GOOD[0]), (0, GOOD[1]), (0, GOOD[1])]
    got = judge(make_docs(rows)).collect()
    assert len(got) == len(rows)
    expected = Counter((i, *plain(t)) for i, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == expected
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_junk_goes_and_good_texts_stay(make_docs):
    rows = list(enumerate([*JUNK.values(), *GOOD]))
    got = {r["doc_id"]: r for r in judge(make_docs(rows)).collect()}
    for k, name in enumerate(JUNK):
        assert not got[k]["kept"], name
        assert got[k]["failed_rule"] in (name, "base")
    assert all(got[k]["kept"] for k in range(len(JUNK), len(rows)))


def test_verdict_does_not_depend_on_order_or_sample(make_docs):
    docs = make_docs(list(enumerate([*HARD, *JUNK.values(), *GOOD])))
    slim = docs.select("doc_id", "text")
    order = rules_by_gain(slim, default_rules(), sample_rows=5)
    assert sorted(r.name for r, _, _ in order) == sorted(r.name for r in default_rules())
    gains = [share / seconds for _, share, seconds in order]
    assert gains == sorted(gains, reverse=True)
    kept = [
        {r["doc_id"] for r in judge(docs, rules).where("kept").select("doc_id").collect()}
        for rules in (default_rules(), default_rules()[::-1])
    ]
    assert kept[0] == kept[1]


def test_kept_rows_keep_their_columns(make_docs):
    rows = list(enumerate([*HARD, *JUNK.values(), *GOOD])) + [(None, GOOD[0]), (900, GOOD[1]), (900, GOOD[1])]
    docs = make_docs(rows)
    out = keep_good(docs)
    assert out.columns == docs.columns and set(CLASHES) <= set(out.columns)
    kept = judge(docs).where("kept")
    key = ["doc_id"]
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in kept.select(*key).collect())


def test_own_rules_and_null_verdicts(make_docs):
    docs = make_docs(list(enumerate(GOOD)))
    rules = [Rule("null", F.lit(None).cast("boolean")), Rule("third", F.col("n_words") < 0)]
    assert judge(docs, rules).where("kept").count() == len(GOOD)
    assert judge(docs, []).where("kept").count() == len(GOOD)


@pytest.mark.parametrize("function", [judge, keep_good])
def test_empty_table(make_docs, function):
    assert function(make_docs([])).count() == 0
