import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logsense.llm.tokens import Encoder, FrameFile, read_documents, read_token_files, write_frames, write_token_files
from logsense.session import scratch_path

from .conftest import HARD, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "don't IT'LL x'ré a1b22c3é!!...,;é ñÑ Åå ſ ßẞ ŉ ǆ ª º µ ² ½ é² ÷ × ¡é¿ \x7f a\x00b İi ĸ ɏ ɐa ǅ ﬁ",
    "a b\x1cc\x85d <|endoftext|>x <|ENDOFTEXT|> İΣΑΣ Σ 12's é Éx  K  ́x \ta's<|startoftext|>B",
    "日本語 текст 🙂🙂 été  nbsp",
]


def plain_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer():
    encoder = Encoder(PATH)
    assert encoder.wordwise
    for text in [*HARD, *ODD, " ".join(prose(2, 300)) + "!!"]:
        for _ in range(2):  # the second time from the cache
            assert np.frombuffer(encoder.encode((text or "").encode()), "<u4").tolist() == plain_ids(text)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = Encoder(path)
    assert not encoder.wordwise
    for text in ODD:
        expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == expected


def opened(data):
    class Source:
        def size(self):
            return len(data)

        def read_at(self, n, at):
            self.read = getattr(self, "read", []) + [(at, n)]
            return data[at : at + n]

    return Source()


def test_frames_are_read_alone_and_checked():
    ids = [np.arange(k * 100, dtype="<u4") for k in range(5)]
    out = io.BytesIO()
    assert write_frames(out, [(k if k != 3 else None, x.tobytes()) for k, x in enumerate(ids)]) == (5, 1000)
    source = opened(out.getvalue())
    file = FrameFile(source)
    assert file.names == [0, 1, 2, None, 4]
    source.read = []
    assert file.read(2).tolist() == ids[2].tolist()
    assert source.read == [(int(file.starts[2]), int(file.frames[2, 0]))]
    assert file.read(0).tolist() == []
    damaged = bytearray(out.getvalue())
    damaged[int(file.starts[4]) - 3] ^= 255
    with pytest.raises(Exception):
        FrameFile(opened(bytes(damaged))).read(3)
    # the whole file is one valid zstandard stream
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert whole == b"".join(x.tobytes() for x in ids)


def test_files_hold_all_documents_in_order(spark, make_docs):
    texts = [*HARD, *ODD, *(" ".join(prose(k, 50)) for k in range(30))]
    rows = [((k * 7) % 101, t) for k, t in enumerate(texts)]
    folder = scratch_path(spark, "ids")
    manifest = write_token_files(make_docs(rows), folder, PATH, end_id=2, files=4)
    got = [tuple(r) for r in read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    expected, start = [], 0
    for i, text in sorted(rows):
        ids = np.array([*plain_ids(text), 2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got) == expected
    wanted = spark.createDataFrame([(7,), (14,), (5000,)], "doc_id long")
    read = {r["doc_id"]: r["ids"] for r in read_documents(spark, folder, manifest, wanted).collect()}
    assert read == {i: [*plain_ids(t), 2] for i, t in rows if i in (7, 14)}


def test_rows_without_or_with_shared_ids_and_empty_tables(spark, make_docs):
    folder = scratch_path(spark, "ids")
    manifest = write_token_files(make_docs([(None, "b"), (1, "a a"), (1, "c"), (None, None)]), folder, PATH)
    got = sorted((tuple(r) for r in read_token_files(manifest, folder).select("doc_id", "start", "n_tokens").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 1] and sum(r[2] for r in got) == 8
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(4)]
    folder = scratch_path(spark, "ids")
    assert read_token_files(write_token_files(make_docs([]), folder, PATH), folder).count() == 0


def test_frames_of_other_documents_are_not_decompressed(spark, make_docs):
    folder = scratch_path(spark, "ids")
    manifest = write_token_files(make_docs([(k, f"word {k}") for k in range(6)]), folder, PATH, end_id=2, files=1)
    (name,) = (r["file"] for r in manifest.collect())
    path = f"{folder}/{name}"
    with open(path, "rb") as source:
        data = bytearray(source.read())
    frames = FrameFile(opened(bytes(data)))
    data[int(frames.starts[3]) : int(frames.starts[4])] = bytes(int(frames.frames[3, 0]))
    with open(path, "wb") as out:
        out.write(data)
    wanted = spark.createDataFrame([(2,), (5,)], "doc_id long")
    read = {r["doc_id"]: r["ids"] for r in read_documents(spark, folder, manifest, wanted).collect()}
    assert read == {k: [*plain_ids(f"word {k}"), 2] for k in (2, 5)}
    with pytest.raises(Exception):
        read_documents(spark, folder, manifest, spark.createDataFrame([(3,)], "doc_id long")).collect()
