"""Token ids in seekable zstandard files: one frame per document, a seek table with checksums at the end.

File format (a valid zstandard stream, in the public seekable layout):

* per document one frame: its ids as little-endian unsigned 32-bit integers;
* a skippable frame (magic 0x184D2A5D) with the document index: count as uint32, then per document its
  id as int64, then per document one byte, 1 where the id is null;
* a skippable frame (magic 0x184D2A5E) with the seek table: per frame three uint32 (compressed size, size,
  lowest 32 bits of the XXH64 of the ids); then the number of frames as uint32, one byte 0x80 (checksums
  present) and the magic 0x8F92EAB1.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsense.llm.storage import open_store
from logsense.llm.texts import batches_of, id_and_bytes
from logsense.session import materialize

INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
#: Encoded words that a worker keeps between documents, and the longest word kept.
CACHE_WORDS, CACHE_BYTES = 600_000, 64
#: Bytes of text per file, for choosing the number of files.
FILE_BYTES = 64 << 20
MANIFEST = "file string, n_docs long, n_ids long, first_id long, part int"


# The parts of a word-end BPE tokenizer whose tokens never span white space.
_WORDWISE_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_WORDWISE_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Letters, single digits and runs of marks: pieces of which the tokenizer's pattern makes one token each.
_PARTS = re.compile(rb"[a-z\x80-\xff]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte that is not printable in Latin-1."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder(dict):
    """Ids of whole texts as uint32 bytes, remembered by word where that is the same.

    Tokens of ``word_bpe_49k`` never span white space: its pattern matches none and its normaliser works on single
    characters. So words are encoded once each, their runs of plain letters, digits and marks by the bare
    merge model. A-Z are folded first, as the normaliser does too, except where a special token could be
    written in capitals. With any other tokenizer every text is encoded as it stands.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        steps = ((parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}])[:2]
        self.wordwise = (
            [x.get("type") for x in (parts.get("normalizer") or {}).get("normalizers", [])] == _WORDWISE_NORMALIZERS
            and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"].get("Regex") == _WORDWISE_SPLIT
            and not steps[1]["add_prefix_space"]
        )
        self.letters = _byte_letters()

    def _full(self, text: bytes) -> bytes:
        found = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return array("I", found).tobytes()

    def _part(self, part: bytes) -> bytes | None:
        """A run of letters, a digit or a run of marks; None if it needs the normaliser."""
        if part.isascii():
            text = part.decode()
        else:
            text = part.decode("utf-8", "replace").lower()
            if not text.isalpha() or max(text) >= "\u0250" or not unicodedata.is_normalized("NFC", text):
                return None
            text = text.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.tokenizer.model.tokenize(text)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        parts = _PARTS.findall(word)
        if b"<|" not in word and sum(map(len, parts)) == len(word):
            found = [self.get(part) or self._part(part) for part in parts]
            if None not in found:
                return b"".join(found)
        return self._full(word)

    def __missing__(self, word: bytes) -> bytes:
        ids = self._word(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= CACHE_BYTES:
            self[word] = ids
        return ids

    def encode(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        if not self.wordwise:
            return self._full(text)
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))


def write_frames(out, documents: Iterable[tuple[int | None, bytes]], level: int = 3) -> tuple[int, int]:
    """Write (id, ids as bytes) in order as one file; number of documents and of token ids."""
    packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
    names, table, total = [], [], 0
    for name, ids in documents:
        frame = packer.compress(ids)
        out.write(frame)
        names.append(name)
        table.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        total += len(ids) // 4
    index = struct.pack("<I", len(names)) + np.array([x or 0 for x in names], "<i8").tobytes()
    index += bytes(x is None for x in names)
    out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
    body = b"".join(table) + struct.pack("<IBI", len(table), 0x80, FOOTER_MAGIC)
    out.write(struct.pack("<II", TABLE_MAGIC, len(body)) + body)
    return len(names), total


class FrameFile:
    """Random access to one file: reads the two tables at the end, then only the frames asked for."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != FOOTER_MAGIC or flags != 0x80:
            raise ValueError("not a seekable token file")
        at = size - 9 - 12 * n
        self.frames = np.frombuffer(source.read_at(12 * n, at), "<u4").reshape(n, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        index = source.read_at(at - 8 - int(self.starts[-1]), int(self.starts[-1]))
        if struct.unpack_from("<I", index)[0] != INDEX_MAGIC or struct.unpack_from("<I", index, 8)[0] != n:
            raise ValueError("the document index does not fit the seek table")
        null = np.frombuffer(index, np.uint8, n, 12 + 8 * n)
        self.names = [None if x else int(i) for i, x in zip(np.frombuffer(index, "<i8", n, 12), null)]
        self._unpacker = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.names)

    def read(self, k: int) -> np.ndarray:
        """The ids of the k-th document, checked against its size and checksum."""
        packed, size, checksum = (int(x) for x in self.frames[k])
        ids = self._unpacker.decompress(self.source.read_at(packed, int(self.starts[k])), max_output_size=max(size, 1))
        if len(ids) != size or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(ids, "<u4")


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Encode whole texts and write them in ascending order of id; the stored manifest of the files.

    Each range of ids is one task and one file. A file's name is unique to the attempt that wrote it and
    only files in the manifest count, so a lost or repeated task leaves at most a file nobody reads.
    Null texts are empty and hold the end id alone. Rows without an id come first; rows of one id keep
    all their rows. An empty table gives no file.
    """
    slim = id_and_bytes(docs, id_col, text_col)
    if files is None:
        size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(1, -(-size // FILE_BYTES), docs.sparkSession.sparkContext.defaultParallelism)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        encode = Encoder(tokenizer).encode
        name = f"ids-{uuid.uuid4().hex}.zst"

        def documents() -> Iterator[tuple[int | None, bytes]]:
            nonlocal first
            for ids, texts in batches_of(batches, "doc_id", "text"):
                for doc_id, text in zip(ids, texts):
                    first = doc_id if first is None else first
                    yield doc_id, encode(text) + end

        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            n_docs, n_ids = write_frames(out, documents())
        if n_docs == 0:
            store.delete_file(f"{root}/{name}")
            return
        yield pa.RecordBatch.from_pydict(
            {
                "file": [name], "n_docs": [n_docs], "n_ids": [n_ids], "first_id": pa.array([first], pa.int64()),
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
            }
        )

    # rows without an id, or of one id, may fill several ranges
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = slim.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return materialize(ranged.mapInArrow(run, MANIFEST), "token-files")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files, in their order: doc_id, start, n_tokens, ids_crc32, file, frame.

    ``start`` counts the ids of all documents before it, over all files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for files, bases in batches_of(batches, "file", "base"):
            for file, base in zip(files, bases):
                with store.open_input_file(f"{root}/{file}") as source:
                    frames = FrameFile(source)
                    sizes, sums = [], []
                    for k in range(len(frames)):
                        ids = frames.read(k)
                        sizes.append(len(ids))
                        sums.append(zlib.crc32(ids.tobytes()))
                starts = base + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[:-1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(frames.names, pa.int64()), "start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
                        "file": [file] * len(sizes), "frame": pa.array(range(len(sizes)), pa.int32()),
                    }
                )

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spread = placed.select("file", "base").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, frame int")


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the wanted doc_ids only; each file's frames of other documents stay compressed.

    ``wanted`` has a doc_id column. Of every file the two tables at its end are read, and only wanted frames besides.
    """

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for (files,) in batches_of(batches, "file"):
            for file in files:
                with store.open_input_file(f"{root}/{file}") as source:
                    found = FrameFile(source).names
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(found, pa.int64()), "file": [file] * len(found), "frame": pa.array(range(len(found)), pa.int32())}
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for files, frame_lists in batches_of(batches, "file", "frames"):
            for file, numbers in zip(files, frame_lists):
                with store.open_input_file(f"{root}/{file}") as source:
                    frames = FrameFile(source)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([frames.names[k] for k in numbers], pa.int64()),
                            "ids": pa.array([frames.read(k) for k in numbers], pa.list_(pa.int64())),
                        }
                    )

    spread = manifest.select("file").repartition(spark.sparkContext.defaultParallelism * 4)
    where = spread.mapInArrow(names, "doc_id long, file string, frame int")
    frames = where.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    # a file's frames are dealt in slices, so that no group holds a whole hot file
    sliced = frames.groupBy("file", (F.col("frame") / 1024).cast("int").alias("slice"))
    return sliced.agg(F.sort_array(F.collect_list("frame")).alias("frames")).mapInArrow(run, "doc_id long, ids array<long>")
