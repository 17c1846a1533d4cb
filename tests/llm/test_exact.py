import hashlib

import pytest
from pyspark.sql import functions as F

from logsense.llm.exact import exact_duplicates, remembered

from .conftest import HARD, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    texts = [" ".join(prose(k, 30)) for k in range(12)]
    found = [(k, t) for k, t in enumerate(texts)] + [(40 + k, t.upper() if k % 2 else t) for k, t in enumerate(texts[:7])]
    found += [(100 + k, texts[3]) for k in range(60)]  # a hot group
    found += [(300 + k, t) for k, t in enumerate(HARD)] + [(400 + k, t) for k, t in enumerate(HARD)]
    found += [(None, texts[5]), (None, "only without an id"), (None, "ONLY without an id"), (7, texts[7]), (7, texts[7]), (8, "another text of eight")]
    return found + [(500, "É is not é"), (501, "é is not É"), (502, "é is not é")]


def plain(found):
    """(doc_id, keep_id, group_size, sha256) by a loop over all rows."""
    groups = {}
    for i, t in found:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, max(known) if known else None, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def results(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def check(df, found):
    assert results(df) == plain(found)
    kept = [r for r in df.collect() if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({t for _, t in {(0, (t or "").translate(LOWER)) for _, t in found}})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_against_a_loop(spark, make_docs, tmp_path):
    make_docs(rows()).repartition(5).write.parquet(str(tmp_path / "docs.parquet"))
    check(exact_duplicates(spark, str(tmp_path / "docs.parquet"), batches=3).cache(), rows())


@pytest.mark.parametrize("modulus", [1, 7])
def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark, make_docs, tmp_path, modulus):
    path = str(tmp_path / "docs.parquet")
    make_docs(rows()).repartition(3).write.parquet(path)
    weak = lambda text: F.encode(F.pmod(F.xxhash64(text), F.lit(modulus)).cast("string"), "utf-8")
    check(exact_duplicates(spark, path, digest=weak).cache(), rows())


def test_later_files_meet_the_state_of_earlier_ones(spark, make_docs, tmp_path):
    path, checkpoint = str(tmp_path / "docs.parquet"), str(tmp_path / "state")
    first, second = rows()[:40], rows()[40:]
    make_docs(first).coalesce(1).write.parquet(path)
    check(exact_duplicates(spark, path, checkpoint).cache(), first)
    make_docs(second).coalesce(1).write.mode("append").parquet(path)
    check(exact_duplicates(spark, path, checkpoint).cache(), rows())
    state = {bytes(r.digest): r.n for r in remembered(spark, checkpoint).collect()}
    assert sum(state.values()) == len(rows())  # no file was read twice


def test_a_single_file_and_an_empty_table(spark, make_docs, tmp_path):
    folder = tmp_path / "written"
    make_docs(rows()).coalesce(1).write.parquet(str(folder))
    single = tmp_path / "docs.parquet"
    single.write_bytes(next(folder.glob("part-*.parquet")).read_bytes())
    check(exact_duplicates(spark, str(single)).cache(), rows())
    make_docs(rows()).where("false").coalesce(1).write.parquet(str(tmp_path / "none.parquet"))
    assert exact_duplicates(spark, str(tmp_path / "none.parquet")).count() == 0
