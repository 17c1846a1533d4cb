import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from logsense.llm.merkle import FIELDS, merkle_proofs

from .conftest import HARD, prose

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long, n long, part string, up string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def plain(rows):
    """The contract, row by row, over trees as lists."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))

    def levels(leaves):
        out = [leaves]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
        return out

    trees = {}
    for s in order:
        members = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = members, levels([leaf_of(r) for r in members])
    top = levels([trees[s][1][-1][0] for s in order])

    def steps(tree, at):
        for level in tree[:-1]:
            start = at - at % 3
            yield "".join(level[start:at]), "".join(level[at + 1 : start + 3])
            at //= 3

    out = []
    for k, s in enumerate(order):
        members, tree = trees[s]
        for at, row in enumerate(members):
            path = list(steps(tree, at)) + list(steps(top, k))
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].replace("\n", ""))
            h = leaf_of(changed)
            for left, right in path:
                h = sha(left, h, right)
            root = top[-1][0]
            out.append((row[0], leaf_of(row), tree[-1][0], root, sha(*[x for step in path for x in step]), h, h == root))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 7, "clash", "clash") for r in rows], SCHEMA)


def results(df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_against_a_loop(spark):
    rows = []
    for k in range(130):  # most rows are in one source, heights and paths differ
        source = ["hot", "hot", "hot", "b", None, "é", "", "B"][k % 8] if k < 120 else f"alone{k}"
        rows.append((k * 3 % 131, source, None if k % 9 == 0 else "en", None if k % 7 == 0 else k, " ".join(prose(k, 12)) + "\n" * (k % 3)))
    rows += [(1000 + k, "hard", "fr", k, t) for k, t in enumerate(HARD)]
    rows += [(None, "hot", None, None, None), (None, "hot", None, None, "x\ny"), (5, "hot", "en", 1, "a\nb"), (5, "hot", "en", 1, "a\nb"), (5, "hot", "en", 1, "c")]
    found = results(merkle_proofs(table(spark, rows)))
    assert found == plain(rows)
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


@pytest.mark.parametrize("sources", [["a"], ["a", "a"], ["a", "b"], ["a"] * 28, [f"s{k:02}" for k in range(10)]])
def test_small_trees(spark, sources):
    rows = [(k, s, "en", k, f"line\n{k}") for k, s in enumerate(sources)]
    assert results(merkle_proofs(table(spark, rows))) == plain(rows)


def test_no_rows(spark):
    empty = table(spark, [(1, "a", "en", 1, "x")]).where("false")
    assert merkle_proofs(empty).count() == 0


def test_any_change_of_a_field_changes_the_root(spark):
    rows = [(k, f"s{k % 2}", "en", k, f"text {k}") for k in range(9)]
    before = merkle_proofs(table(spark, rows)).first()["root"]
    for field in FIELDS[1:]:
        changed = table(spark, rows).withColumn(field, F.when(F.col("doc_id") == 4, F.lit(None)).otherwise(F.col(field)))
        assert merkle_proofs(changed).first()["root"] != before
