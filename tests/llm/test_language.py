import numpy as np
import pytest
from pyspark.sql import functions as F

from logsense.llm.language import KernelConfig, fit, predict, presence
from logsense.llm.texts import id_crc32

from .conftest import HARD

SYLLABLES = {"aa": "ba da ga la ma na ra ta".split(), "ee": "bel del gel mel nel rel tel vel".split(), "oo": "bosk dosk gosk losk".split()}


def texts(n):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(n):
        lang = list(SYLLABLES)[k % 3]
        words = ["".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(rng.integers(5, 60))]
        rows.append((k, " ".join(words), lang))
    return rows


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))


def test_held_out_accuracy_and_ranges(spark):
    docs = labelled(spark, texts(300))
    held_out = id_crc32("doc_id") % 4 == 2
    model = fit(docs.where(~held_out))
    got = predict(docs, model, extra={"held_out": held_out}).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == 300
    assert (got.lang == got.lang_pred)[got.held_out].mean() >= 0.98
    assert got.score.between(0, 1).all()


def test_model_matches_the_dense_kernel(spark):
    """Predictions equal those of kernel matrices written out with sets."""
    rows = texts(60)
    config = KernelConfig(sample_rows=60, landmarks=9, bits=14)
    docs = labelled(spark, rows)
    model = fit(docs, config=config)
    sets = [set(presence(t, config).tolist()) for _, t, _ in rows]
    dense = np.array([[float(g in s) for s in sets] for g in range(1 << config.bits)])
    assert np.allclose(
        predict(docs, model).orderBy("doc_id").toPandas().score,
        np.clip(((dense.T @ model.weights) / np.sqrt([[len(s)] for s in sets]) + model.bias).max(axis=1), 0, 1), atol=1e-4,
    )


def test_presence_counts_whole_texts_once():
    config = KernelConfig(bits=22)
    assert len(presence("abab", config)) == len({"a", "b", "ab", "ba", "aba", "bab"})
    assert presence("ABAB", config).tolist() == presence("abab", config).tolist()
    assert len(presence("", config)) == 0
    long = "x" * 50000 + "q"
    assert set(presence("q", config)) <= set(presence(long, config))


def test_hard_rows(spark, make_docs):
    model = fit(labelled(spark, [*texts(60), (900, None, "aa"), (901, "", "aa"), (902, "zzz", None)]))
    assert model.languages == ("aa", "ee", "oo")
    rows = list(enumerate([*HARD, "123 456 !!!", None])) + [(None, "bada gala"), (3, "bada"), (3, "bada")]
    got = predict(make_docs(rows), model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] in (0, 1, 2, len(HARD), len(HARD) + 1):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.languages
    assert predict(make_docs([]), model).count() == 0


def test_nothing_to_learn_from(spark, make_docs):
    model = fit(labelled(spark, []))
    assert [r["lang_pred"] for r in predict(make_docs([(1, "some text")]), model).collect()] == ["und"]
    with pytest.raises(ValueError):
        fit(labelled(spark, texts(9)), config=KernelConfig(languages=2))


def test_fit_does_not_depend_on_order(spark):
    docs = labelled(spark, texts(90))
    a, b = fit(docs.repartition(1)), fit(docs.orderBy(F.desc("doc_id")).repartition(5))
    assert np.array_equal(a.weights, b.weights)


def test_copies_count_once_in_the_sample(spark, monkeypatch):
    import logsense.llm.language as module

    taken, solve = [], module._solve
    monkeypatch.setattr(module, "_solve", lambda sample, *rest: taken.extend(sample) or solve(sample, *rest))
    rows = [("de", "immer wieder derselbe satz")] * 200 + [(lang, f"{lang} satz nummer {k}") for lang in ("de", "en") for k in range(8)]
    module.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(x[0] for x in taken) == ["de"] * 9 + ["en"] * 8
