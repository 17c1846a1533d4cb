import os
import random

import pytest
from pyspark.sql import functions as F

from logsense.config import MinerConfig
from logsense.operators import joins, mining, templates
from logsense.operators.frequency import assign_frequency_templates, distinct_messages
from logsense.operators.joins import lookup_join
from logsense.operators.mining import merge_similar, mine_assignments, mine_templates, routed_messages
from logsense.operators.templates import describe_templates, match_logs, match_messages, new_messages, template_table
from logsense.session import shared_dir


def logs_of(n=600, seed=1):
    rng = random.Random(seed)
    kinds = ["user {} logged in from {}", "disk {} is full at {} percent", "retry {} of job {} failed badly", "ping {}"]
    rows = []
    for _ in range(n):
        kind = rng.choices(kinds, [6, 2, 1, 1])[0]
        rows.append(kind.format(*[rng.randrange(40) for _ in range(kind.count("{}"))]))
    return rows


def frame(spark, messages):
    return spark.createDataFrame([(m,) for m in messages], "message string")


def fits(template, message):
    a, b = template.split(" "), message.split()
    return len(a) == len(b) and all(x in ("<*>", y) for x, y in zip(a, b))


def test_merge_similar_is_the_one_by_one_greedy_pass():
    def slow(texts, weights, similarity):
        found = []
        for text, n in sorted(zip(texts, weights), key=lambda x: (-x[1], x[0])):
            row = text.split(" ")
            best = None
            for group in found:
                same = sum(a == b != "<*>" for a, b in zip(group[0], row))
                fixed = sum(a != "<*>" for a in group[0])
                own = sum(b != "<*>" for b in row)
                if same >= similarity * len(row) - 1e-9 or same == fixed or same == own:
                    rank = (same, -fixed)
                    if best is None or rank > best[0]:
                        best = (rank, group)
            if best is None:
                found.append([row, n])
            else:
                best[1][0] = [a if a == b else "<*>" for a, b in zip(best[1][0], row)]
                best[1][1] += n
        return [(" ".join(t), n) for t, n in found]

    rng = random.Random(7)
    for width in (1, 3, 6):
        for _ in range(20):
            texts = list({" ".join(rng.choice("abc<") .replace("<", "<*>") for _ in range(width)) for _ in range(60)})
            weights = [rng.randrange(1, 4) for _ in texts]
            for similarity in (0.4, 0.65, 1.0):
                assert merge_similar(texts, weights, similarity) == slow(texts, weights, similarity)


@pytest.mark.parametrize("room", [16, 4096])
def test_mining_covers_every_message_however_small_the_buckets(spark, monkeypatch, room):
    monkeypatch.setattr(mining, "BUCKET_ROWS", room)
    messages = distinct_messages(frame(spark, logs_of()))
    assigned = mine_assignments(messages).collect()
    assert sum(r.n for r in assigned) == 600
    assert all(fits(r.template, r.message) for r in assigned)
    templates = {r.template for r in assigned}
    assert "user <*> logged in from <*>" in templates and "disk <*> is full at <*> percent" in templates
    table = template_table(mine_assignments(messages))
    assert table.agg(F.sum("size")).first()[0] == 600


def test_mining_ignores_order_and_partitions(spark):
    rows = logs_of()
    one = mine_templates(distinct_messages(frame(spark, rows)))
    other = mine_templates(distinct_messages(frame(spark, sorted(rows, reverse=True)).repartition(7)))
    assert sorted(one.drop("tokens").collect()) == sorted(other.drop("tokens").collect())


def test_unlike_messages_of_one_route_all_stay(spark, monkeypatch):
    monkeypatch.setattr(mining, "BUCKET_ROWS", 16)
    rows = [f"start 1 {'abcdefghij'[i % 10]}{i} b{i}x c{i}y" for i in range(200)]
    table = mine_templates(distinct_messages(frame(spark, rows)))
    assert table.agg(F.sum("size")).first()[0] == 200


def test_incremental_mining_keeps_what_was_known(spark):
    first = mine_templates(distinct_messages(frame(spark, logs_of(300, 1))))
    more = logs_of(300, 2) + ["brand new thing"]
    both = mine_templates(distinct_messages(frame(spark, more)), previous=first)
    assert both.agg(F.sum("size")).first()[0] == 601
    matched = match_messages(distinct_messages(frame(spark, logs_of(300, 1) + more)), both)
    assert matched.filter("template IS NULL").count() == 0


def test_crowded_places_route_by_wildcard(spark):
    rows = [f"{chr(97 + i // 26)}{chr(97 + i % 26)} same tail" for i in range(60)] + ["aa same tail"] * 5 + ["x9 same tail"]
    routed = routed_messages(distinct_messages(frame(spark, rows)), MinerConfig(depth=4, max_children=10))
    keys = {r.template: r.route_key.strip() for r in routed.collect()}
    assert keys["aa same tail"] == "aa" and keys["x9 same tail"] == "<*>"
    assert sum(k == "<*>" for k in keys.values()) == 52  # the wildcard is one of the ten children


def test_frequency_templates(spark):
    rows = ["a b 1", "a b 2", "a c 1", "d e f g"]
    messages = distinct_messages(frame(spark, rows * 2))
    got = {r.message: r.template for r in assign_frequency_templates(messages, 4, MinerConfig(depth=3)).collect()}
    assert got == {"a b 1": "a b 1", "a b 2": "a b <*>", "a c 1": "a <*> 1", "d e f g": "<*> <*> <*> <*>"}


def test_match_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "c", "<*>"])
    templates = sorted({" ".join(word() for _ in range(rng.randrange(1, 5))) for _ in range(60)})
    texts = sorted({" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6))) for _ in range(200)})
    table = describe_templates(spark.createDataFrame([(t, 1) for t in templates], "template string, size bigint"))
    ids = {r.template: r.cluster_id for r in table.collect()}
    got = {r.message: r.template for r in match_messages(distinct_messages(frame(spark, texts)), table).collect()}
    for text in texts:
        fit = [t for t in templates if fits(t, text)]
        best = min(fit, key=lambda t: (t.split().count("<*>"), ids[t])) if fit else None
        assert got[text] == best, text


@pytest.mark.parametrize("bound", [1 << 25, 300_000])
def test_many_layouts_of_one_length(spark, monkeypatch, bound):
    """10 000 layouts of wildcards; with a small bound the templates come in many parts."""
    monkeypatch.setattr(templates, "TRIE_BYTES", bound)
    rng = random.Random(4)
    words = [f"w{k}" for k in range(3)]
    layouts = rng.sample(range(1 << 14), 10_000)
    known = {" ".join("<*>" if layout >> k & 1 else rng.choice(words) for k in range(14)) for layout in layouts}
    assert len(known) == 10_000
    texts = sorted({" ".join(rng.choice([*words, "<*>"]) for _ in range(14)) for _ in range(150)} | {"w0", ""})
    table = describe_templates(spark.createDataFrame([(t, 1) for t in known], "template string, size bigint"))
    ids = {r.template: r.cluster_id for r in table.select("template", "cluster_id").collect()}
    messages = spark.createDataFrame([(t, 1) for t in texts], "message string, n bigint")
    got = {r.message: r.template for r in match_messages(messages, table).collect()}
    assert len(got) == len(texts)
    split = [(t, t.split(" ")) for t in known]
    for text in texts:
        tokens = text.split(" ")
        fit = [t for t, own in split if len(own) == len(tokens) and all(x in ("<*>", y) for x, y in zip(own, tokens))]
        best = min(fit, key=lambda t: (t.split(" ").count("<*>"), ids[t])) if fit else None
        assert got[text] == best, text


def test_rows_keep_their_number_and_new_messages_show(spark):
    table = describe_templates(spark.createDataFrame([("a <*>", 1)], "template string, size bigint"))
    logs = spark.createDataFrame(
        [("f", "a 1"), ("f", "a 1"), ("g", "b 1"), ("g", ""), ("h", "a  2")], "log_file string, message string")
    matched = match_logs(logs, table)
    assert sorted((r.message, r.template, r.is_new) for r in matched.collect()) == [
        ("", "", True), ("a  2", "a <*>", False), ("a 1", "a <*>", False), ("a 1", "a <*>", False), ("b 1", "b 1", True)]
    assert ("g", "b 1") in {tuple(r) for r in new_messages(matched).collect()}


@pytest.mark.parametrize("hot", [1, 3, 1000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_is_a_plain_join(spark, monkeypatch, hot, how):
    monkeypatch.setattr(joins, "HOT_KEYS", hot)
    rows = [(i, "hot") for i in range(300)] + [(i, f"k{i % 9}") for i in range(300, 400)] + [(400, None), (401, "absent")]
    left = spark.createDataFrame(rows, "id int, k string")
    lookup = spark.createDataFrame([("hot", 300, None)] + [(f"k{i}", 11, i) for i in range(9)], "k string, n int, v int")
    got = lookup_join(left, lookup, "k", "n", how).select("id", "k", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, left.join(lookup, "k", how).select("id", "k", "v").collect()))


def test_mining_is_the_same_with_small_buckets(spark, monkeypatch):
    """Pairs of similar messages in one route: each pair is one template, whatever the buckets."""
    letters = lambda k: "".join(chr(97 + int(d)) for d in str(k))
    rows = []
    for k in range(300):
        words = [f"w{letters(k * 10 + p)}" for p in range(8)]
        rows += [(" ".join(["go", *words, end]), 2) for end in ("left", "right")]
    df = spark.createDataFrame(rows, "message string, n bigint")
    found = []
    for room in (4096, 16):
        monkeypatch.setattr(mining, "BUCKET_ROWS", room)
        found.append(sorted((r.template, r.n) for r in mining.mine_groups(df, MinerConfig(depth=4)).collect()))
    assert len(found[0]) == 300 and found[0] == found[1]


def test_no_two_templates_are_similar_after_the_bands(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "abcd" for b in "xyz"]
    for width, similarity in ((1, 0.65), (4, 0.5), (9, 0.65), (6, 1.0), (5, 0.2)):
        texts = {" ".join(rng.choice(words[:6]) for _ in range(width)) for _ in range(60)}
        rows = [(width, "r", t, rng.randint(1, 9)) for t in texts]
        df = spark.createDataFrame(rows, "n_tokens int, route_key string, template string, n bigint")
        out = mining.merge_by_bands(df, similarity).collect()
        assert sum(r.n for r in out) == sum(r[3] for r in rows)
        left = [r.template.split(" ") for r in out]
        need = similarity * width - 1e-9
        same = lambda a, b: sum(x == y != mining.WILDCARD for x, y in zip(a, b))
        assert not any(same(a, b) >= need for i, a in enumerate(left) for b in left[:i])
        for text in texts:
            assert any(all(x in (mining.WILDCARD, y) for x, y in zip(t, text.split(" "))) for t in left)


def test_a_miner_that_merges_nothing_is_caught(spark):
    from logsense.plans.catalog import _fit_of

    texts = [f"job started by {name} today" for name in ("ann", "bob", "cy")]
    same = spark.createDataFrame([(t, 1, t) for t in texts], "message string, n bigint, template string")
    assert {(r.fits, r.apart) for r in _fit_of(same).collect()} == {(True, True), (True, False)}
    blank = spark.createDataFrame([(t, 1, "<*> <*> <*> <*> <*>") for t in texts], "message string, n bigint, template string")
    assert {(r.fits, r.firm) for r in _fit_of(blank).collect()} == {(True, False)}


def test_unlike_messages_of_one_route_meet_in_small_groups(spark, monkeypatch):
    """2000 templates share their routed tokens, and all a common tail; similar pairs still meet."""
    monkeypatch.setattr(mining, "BUCKET_ROWS", 64)
    letters = lambda k: "".join(chr(97 + int(d)) for d in str(k))
    rows = []
    for k in range(1000):
        words = [f"w{letters(k * 10 + p)}" for p in range(5)]
        rows += [(9, " go on", " ".join(["go", "on", *words, end, "done"]), 2) for end in ("left", "right")]
    df = spark.createDataFrame(rows, "n_tokens int, route_key string, template string, n bigint")
    named = mining.materialize(df.select("*", *mining.wide_hash("id", mining.F.col("template"))), "named")
    groups = mining._meetings(named, 0.65, True).groupBy("key").count()
    assert groups.agg({"count": "max"}).first()[0] <= 2 * 64
    assert mining.similar_pairs(named, 0.65).count() == 1000


def test_blocks_of_a_large_group_lose_no_pair(spark, monkeypatch):
    """Few distinct words: every key is shared by many, so groups are split in stretches and blocks."""
    monkeypatch.setattr(mining, "BUCKET_ROWS", 16)
    rng = random.Random(9)
    texts = sorted({" ".join(rng.choice(["a", "b", "c", "<*>"]) for _ in range(7)) for _ in range(300)})
    weights = [rng.randint(1, 9) for _ in texts]
    df = spark.createDataFrame([(7, "r", t, n) for t, n in zip(texts, weights)], "n_tokens int, route_key string, template string, n bigint")
    named = mining.materialize(df.select("*", *mining.wide_hash("id", mining.F.col("template"))), "named")
    got = {(r.template, r.leader) for r in mining.similar_pairs(named, 0.65).join(named, ["id_a", "id_b"]).collect()}
    assert got == {(texts[i], texts[j]) for i, j in mining.nearest_leaders(texts, weights, 0.65)}


def test_mining_leaves_no_table_but_its_result(spark):
    folder = shared_dir(spark).removeprefix("file://")
    messages = mining.materialize(distinct_messages(frame(spark, logs_of())), "given")
    before = set(os.listdir(folder))
    assigned = mine_assignments(messages)
    assert [name.split("-")[0] for name in set(os.listdir(folder)) - before] == ["assigned"]
    assert sum(r.n for r in assigned.collect()) == 600 and messages.count() > 0


@pytest.mark.parametrize("similarity", [0.3, 0.65, 1.0])
def test_pairs_are_the_same_in_any_number_of_passes(spark, monkeypatch, similarity):
    rng = random.Random(10)
    texts = sorted({" ".join(rng.choice(["a", "b", "c", "d", "<*>"]) for _ in range(8)) for _ in range(120)})
    weights = [rng.randint(1, 9) for _ in texts]
    df = spark.createDataFrame([(8, "r", t, n) for t, n in zip(texts, weights)], "n_tokens int, route_key string, template string, n bigint")
    named = mining.materialize(df.select("*", *mining.wide_hash("id", mining.F.col("template"))), "named")
    want = {(texts[i], texts[j]) for i, j in mining.nearest_leaders(texts, weights, similarity)}
    for keys in (1, 100):
        monkeypatch.setattr(mining, "PASS_KEYS", keys)
        got = {(r.template, r.leader) for r in mining.similar_pairs(named, similarity).join(named, ["id_a", "id_b"]).collect()}
        assert got == want


def test_a_template_that_is_the_message_wins_and_needs_no_trie(spark, monkeypatch):
    rows = [("a b", 7), ("a b", 5), ("a <*>", 1), ("<*> c", 2), ("x<*>y", 4), ("d e f", 6)]
    known = spark.createDataFrame(rows, "template string, cluster_id bigint")
    texts = ["a b", " a  b ", "a c", "q c", "x<*>y", "x1y", "d e f", "d e g"]
    seen = []
    match = templates._match_wild
    monkeypatch.setattr(templates, "_match_wild", lambda m, t, parts: seen.append((m, t)) or match(m, t, parts))
    messages = spark.createDataFrame([(t, 1) for t in texts], "message string, n bigint")
    got = {r.message: (r.template, r.cluster_id) for r in match_messages(messages, known).collect()}
    assert got == {
        "a b": ("a b", 5), " a  b ": ("a b", 5), "a c": ("a <*>", 1), "q c": ("<*> c", 2), "x<*>y": ("x<*>y", 4),
        "x1y": (None, None), "d e f": ("d e f", 6), "d e g": (None, None)}
    assert sorted(r.message for r in seen[0][0].collect()) == ["a c", "d e g", "q c", "x1y"]
    assert sorted(r.template for r in seen[0][1].collect()) == ["<*> c", "a <*>"]
