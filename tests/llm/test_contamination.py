from logsense.llm.contamination import contaminated

from .conftest import HARD, prose

SUM = (
    "A farmer named Alice sold 12 apples to her neighbour Bob for 3 dollars each. How many dollars did Alice get for the "
    "12 apples when Bob paid 3 dollars each?"
)
PROSE = " ".join(prose(11, 40)) + "."
FILL = " ".join(prose(12, 60))


def items(spark):
    rows = [(1, SUM), (2, PROSE), (3, "too short"), (4, None), (None, PROSE + " more"), (5, "1 2 3 4 5 6 7 8 9"), (6, "")]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


def found(spark, make_docs, texts):
    rows = contaminated(make_docs(list(enumerate(texts))), items(spark)).collect()
    return {(r["doc_id"], r["item_id"], r["slots_changed"]) for r in rows}


def test_exact_and_re_parameterised_copies(spark, make_docs):
    changed = SUM.replace("12", "250").replace("Alice", "Zoe").replace("Bob", "Max").replace(" 3 ", " 7 ")
    mixed = SUM.replace("12 apples to", "99 apples to").replace("Alice sold", "Zoe sold").replace("3 dollars each.", "4 dollars each.")
    texts = [
        f"{FILL}. {SUM} {FILL}", f"{FILL}. {changed} {FILL}", f"{FILL}\n{PROSE}", PROSE.upper(), PROSE.replace(" ", "\n"),
        FILL, mixed, SUM.replace("12", "1,250").replace(" 3 ", " 7.5 "),
    ]
    assert found(spark, make_docs, texts) == {
        (0, 1, False), (1, 1, True), (2, 2, False), (3, 2, False), (4, 2, False), (7, 1, True),
    }


def test_parts_of_an_item(spark, make_docs):
    words = PROSE.split()
    half = " ".join(words[: len(words) // 2 + 4])
    run = " ".join(words[10:23])
    short = " ".join(words[5:13])
    edited = " ".join("changed" if k == 20 else w for k, w in enumerate(words))
    assert found(spark, make_docs, [half, f"{FILL} {run} {FILL}", f"{FILL} {short} {FILL}", edited]) == {
        (0, 2, False), (1, 2, False), (3, 2, False),
    }


def test_units_are_placeholders_only_after_numbers(spark, make_docs):
    bench = spark.createDataFrame([(1, "the long road to town is 40 km and the ride back takes 2 hours at best")], "item_id long, text string")
    docs = make_docs([
        (1, "the long road to town is 55 mi and the ride back takes 90 minutes at best"),
        (2, "the long road to town is fast and the ride back takes ages minutes at best"),
    ])
    # minutes is no listed unit, so the second slot is a plain word there
    assert [(r["doc_id"], r["slots_changed"]) for r in contaminated(docs, bench).collect()] == [(1, True)]


def test_hard_rows_and_empty_tables(spark, make_docs):
    rows = list(enumerate(HARD)) + [(None, PROSE), (50, PROSE), (50, PROSE), (51, "\u0001\u0002 " + PROSE)]
    got = sorted((str(r["doc_id"]), r["item_id"], r["n_matched"] == r["n_windows"]) for r in contaminated(make_docs(rows), items(spark)).collect())
    assert got == [("50", 2, True), ("51", 2, True), ("None", 2, True)]
    assert contaminated(make_docs([]), items(spark)).count() == 0
    assert contaminated(make_docs(rows), items(spark).limit(0)).count() == 0


def test_large_benchmarks_are_shuffled(spark, make_docs, monkeypatch):
    import logsense.llm.contamination as module

    docs = make_docs([(1, PROSE), (2, FILL), (3, SUM)])
    small = sorted(map(tuple, contaminated(docs, items(spark)).collect()))
    monkeypatch.setattr(module, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, contaminated(docs, items(spark)).collect())) == small and len(small) == 2


def test_verbatim_copies_of_any_tokens_are_found(spark, make_docs):
    texts = {
        1: "What is 12 + 34 * 5 - 6?",
        2: "The Quick Brown Fox Jumps Over The Lazy Dog Every Day",
        3: "Red green",
        4: "then the old man told Alice and Bob that the ferry would leave at dawn",
        5: "1 2 3 4 5 6 7 8 9",
    }
    bench = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    docs = make_docs([
        (1, f"{FILL}. {texts[1]} {FILL}"), (2, f"{FILL}. {texts[2]} {FILL}"), (3, "so " + texts[2].lower()), (4, "x red GREEN y"),
        (5, texts[4].replace("Alice", "\nAlice")), (6, texts[4].replace(" Alice and", "\nZoe and")), (7, f"{FILL}, {texts[5]}"),
        (8, "What is 13 + 35 * 7 - 8?"), (9, "green red"), (10, ""), (11, "red"),
        (12, f"{FILL} {texts[2]}".replace("Every", "Some")),
    ])
    got = {(r["doc_id"], r["item_id"], r["slots_changed"]) for r in contaminated(docs, bench).collect()}
    assert got == {
        (1, 1, False), (2, 2, False), (3, 2, False), (4, 3, False), (5, 4, False), (6, 4, True), (7, 5, False), (12, 2, False),
    }


def test_one_changed_value_does_not_hide_the_rest(spark, make_docs):
    """The last 12 differs from the first: windows over it do not count, all others do."""
    bench = spark.createDataFrame([(1, f"we saw 12 birds {PROSE} then 12 more")], "item_id long, text string")
    docs = make_docs([(1, f"we saw 12 birds {PROSE} then 13 more")])
    (row,) = contaminated(docs, bench).collect()
    assert 2 * row["n_matched"] > row["n_windows"] > row["n_matched"] and not row["slots_changed"]


def test_rows_of_one_id_do_not_spoil_each_other(spark, make_docs):
    docs = make_docs([(None, SUM), (None, SUM.replace("Alice", "Zoe")), (7, SUM.replace("Bob", "Max")), (7, SUM)])
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items(spark)).collect()} == {(None, 1), (7, 1)}
