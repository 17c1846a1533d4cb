import hashlib
import random

import pytest

import __spark_entry__
import corpus_pipeline
from logsense.llm.contamination import contaminated
from logsense.llm.oracle import ORACLE
from logsense.llm.packing import pack_group
from logsense.llm.queries import QUERIES

from .conftest import HARD, prose
from .test_minhash import brute as brute_near
from .test_packing import plain_best_fit
from .test_quality import JUNK

ITEM = " ".join(prose(900, 30))


def table(spark, folder):
    rng = random.Random(6)
    passage = " ".join(prose(901, 40))
    texts = []
    for k in range(40):
        words = prose(1000 + k, rng.randint(60, 160))
        texts.append(" ".join(words))
        if k % 4 == 0:
            texts.append(" ".join(words + ["more"]))
        if k % 5 == 0:
            texts.append(" ".join(words))
        if k % 7 == 0:
            texts.append(passage + " " + " ".join(prose(2000 + k, 90)))
        if k % 9 == 0:
            texts.append(" ".join(prose(3000 + k, 80)) + " " + ITEM)
    texts += [*JUNK.values(), *HARD]
    rng.shuffle(texts)
    rows = [(k, t, "en", f"src{k % 4}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def plain_repeats(rows, length=100):
    seen, out = set(), []
    for i, text in sorted(rows):
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        out.append((i, bytes(b for b, g in zip(data, gone) if not g).decode()))
    return out


def windows(words, n=5):
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def test_run_matches_plain_loops(spark, tmp_path, monkeypatch):
    from logsense.llm.quality import judge

    rows = table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"] for r in judge(docs).where("kept").collect()}  # its counts are tested on their own
    texts = [(i, t) for i, t, *_ in rows if i in kept]
    assert not any(t in JUNK.values() or t in HARD for _, t in texts)
    first = {i for i, _, root, is_root in brute_near(texts, 5, 80) if is_root}
    texts = plain_repeats([(i, t) for i, t in texts if i in first])
    item = ITEM.lower().split()
    texts = [(i, t) for i, t in texts if 2 * len(windows(item) & windows(t.lower().split())) < len(windows(item))]
    sources = {i: s for i, _, _, s, _ in rows}
    pieces = sorted(((len(t.split()), sources[i], hashlib.sha256(t.encode()).hexdigest(), i) for i, t in texts), key=lambda p: (-p[0], p[3]))
    placed = plain_best_fit([p[:3] for p in pieces], 4096)
    assert placed == pack_group([p[:3] for p in pieces], 4096)
    expected = sorted((p[3], p[0], f"0:{b}", o) for p, (b, o) in zip(pieces, placed) if p[0])
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["n_words"], r["bin"], r["bin_offset"]) for r in got.collect() if r["n_words"]) == expected
    assert len(expected) < len(first) < len(kept) < len(rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_takes_hard_and_no_rows(spark, make_docs, tmp_path, name, stage):
    spark.createDataFrame([(1, ITEM), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = " ".join(prose(4, 100))
    rows = [*enumerate(HARD), (50, long), (50, long), (None, " ".join(prose(5, 100))), (None, None)]
    for given in ([], rows):
        docs = make_docs(given)
        out = stage(spark, docs, str(tmp_path))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            assert out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        out = out.collect()
        assert len(out) <= len(given) + 3 and (not given or sum(r["doc_id"] == 50 for r in out) == 2)


def test_clean_documents_stay_in_filters(spark, make_docs, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs([(k, " ".join(prose(5000 + k, 150))) for k in range(30)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).count() == 30, name


def test_registration():
    names = set(__spark_entry__.queries())
    assert {*QUERIES, "pipeline"} <= names and set(ORACLE) <= set(QUERIES)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_contaminated_stage_equals_operator(spark, make_docs):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert contaminated(make_docs([(1, "x " + ITEM)]), bench).count() == 1


def test_documents_without_an_own_id_are_decontaminated(spark, make_docs, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = " ".join(prose(77, 60))
    docs = make_docs([(None, "x " + ITEM), (None, clean), (None, None), (3, clean), (3, ITEM), (4, ITEM)])
    out = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect()) == sorted([("None", clean), ("None", "None"), ("3", clean)])
