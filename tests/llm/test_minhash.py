import random

from pyspark.sql import functions as F

from logsense.llm.components import connected_components
from logsense.llm.minhash import MinHash, near_duplicates

from .conftest import HARD, prose


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, width):
    w = words_of(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def roots(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = roots(sets, links)
    return {(i, len(sets[i]), root[i], root[i] == i) for i in sets}


def family(seed):
    """Texts around a few bases, with a common passage, edits of all degrees, and copies."""
    rng = random.Random(seed)
    passage = prose(1, 10)
    texts = []
    for base in range(6):
        words = prose(seed * 10 + base, rng.choice([4, 20, 60, 150]))
        for _ in range(12):
            edited = [w if rng.random() > 0.04 * rng.randint(0, 4) else f"e{rng.randint(0, 10**6)}" for w in words]
            if rng.random() < 0.3:
                edited = passage + edited
            if rng.random() < 0.2:
                edited = edited[: int(len(edited) * rng.uniform(0.7, 1))]
            texts.append(" ".join(edited))
    texts += rng.choices(texts, k=10) + [" ".join(passage + prose(200 + k, 2)) for k in range(20)]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def test_components_match_union_find(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (40, 30), (60, 45), (50, 200)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(0, k) for k in range(0, n, 7)]
        links += [(k, k + 1) for k in range(n // 2, n - 1)]  # a path
        edges = spark.createDataFrame([*links, (None, 3), (3, None)], "u long, v long")
        got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
        expected = roots(range(n), links)
        inside = {x for a, b in links for x in (a, b) if a != b}
        assert got == {x: expected[x] for x in inside}


def test_empty_links(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_families_match_brute_force(make_docs):
    for seed, (width, percent) in enumerate([(3, 85), (5, 80), (2, 60)]):
        rows = family(seed)
        config = MinHash(width, percent)
        got = {tuple(r) for r in near_duplicates(make_docs(rows), config=config).collect()}
        assert got == brute(rows, width, percent)


def test_hard_rows(make_docs):
    rows = list(enumerate(HARD)) + [(20, "A B"), (21, "a  b\n"), (21, "a  b\n"), (None, "only here"), (None, None)]
    got = sorted((tuple(r) for r in near_duplicates(make_docs(rows)).collect()), key=str)
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[0] == (0, 0, 0, True) and by_id[1] == (1, 0, 1, True) and by_id[2] == (2, 0, 2, True)
    assert by_id[20] == (20, 1, 4, False) and by_id[21] == (21, 1, 4, False)
    assert [r for r in got if r[0] is None] == [(None, 0, None, True), (None, 1, None, True)]


def test_rows_that_share_an_id_link_their_copies(make_docs):
    rows = [(5, "one two three four"), (5, "uno dos tres cuatro"), (3, "one two three four"), (9, "uno dos tres cuatro")]
    got = {tuple(r) for r in near_duplicates(make_docs(rows)).select("doc_id", "component_id").collect()}
    assert got == {(5, 3), (3, 3), (9, 3)}


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0


def test_result_does_not_depend_on_partitions(make_docs):
    docs = make_docs(family(8))
    results = [
        sorted(map(tuple, near_duplicates(docs.repartition(n, F.rand(n))).collect())) for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_band_settings():
    for config in (MinHash(), MinHash(3, 85)):
        p = config.percent / 100
        assert (1 - p**config.rows) ** config.bands <= config.miss
        assert 0 < config.least_agreement < p * config.bands * config.rows
