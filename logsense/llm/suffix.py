"""Removal of repeated byte strings across and within documents, by external suffix sorting.

1. Every text is cut into pieces around content-defined anchors (``anchors``): equal windows have equal
   anchors. The pieces of one anchor meet in one bucket; equal pieces are kept once per batch before that.
2. A piece equal to an earlier one is wholly repeated. Pieces whose anchor has other pieces may share
   some windows: their bytes go to suffix sorting. Pieces with an anchor of their own share none.
3. The suffixes of a shard's pieces are sorted by external induced sorting (``induced``). Neighbours in
   that order with a common prefix of a whole window are one string; all places but the first are repeated.
4. The repeated windows of each document become spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsense.llm.anchors import pieces
from logsense.llm.induced import CAP, LOW, SHIFT, Spill, sorted_suffixes
from logsense.llm.storage import open_store
from logsense.llm.texts import batches_of
from logsense.session import materialize, shared_dir

#: Bytes of text per bucket of pieces, and bytes of pieces per suffix sort, for choosing their numbers.
BUCKET_BYTES, SHARD_BYTES = 16 << 20, 4 << 20
#: The id of rows without one while they are processed: before all others.
NO_ID = -(1 << 63)
_U64 = np.uint64
_FIELDS = ("anchor", "whole", "doc", "text_key", "start", "n")
_TYPES = (np.uint64, np.uint64, np.int64, np.int64, np.uint32, np.uint8)


def _pack(columns: list[np.ndarray]) -> bytes:
    raw = b"".join(c.astype(t).tobytes() for c, t in zip(columns, _TYPES))
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blobs: list[bytes]) -> list[np.ndarray]:
    width = sum(np.dtype(t).itemsize for t in _TYPES)
    found: list[list[np.ndarray]] = [[] for _ in _TYPES]
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, at = len(raw) // width, 0
        for k, t in enumerate(_TYPES):
            found[k].append(np.frombuffer(raw, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(x) if x else np.empty(0, t) for x, t in zip(found, _TYPES)]


def _order(columns: list[np.ndarray]) -> list[np.ndarray]:
    """By anchor, piece, document and start."""
    anchor, whole, doc, _, start, _ = columns
    order = np.lexsort((start, doc, whole, anchor))
    return [c[order] for c in columns]


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _repeats(columns: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Rows later than the first one of their group; rows at the very place of the first are not later."""
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    return (columns[2] != columns[2][head]) | (columns[4] != columns[4][head])


def slim_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), text.alias("text"))


def text_key() -> Column:
    """64 bits that tell apart the texts of one id."""
    return F.xxhash64("text")


def _cut(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """Packed pieces by bucket, and as bucket < 0 the pieces that repeat within an Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # large batches, as equal pieces are kept once per batch
        for docs, keys, texts in batches_of(batches, "doc", "text_key", "text", rows=4096):
            cut = [pieces(text, length) for text in texts]
            sizes = [len(c) for c in cut]
            if not sum(sizes):
                continue
            rows = np.concatenate(cut)
            columns = [rows[:, 0], rows[:, 1], np.repeat(np.array(docs, np.int64), sizes), np.repeat(np.array(keys, np.int64), sizes), rows[:, 2], rows[:, 3]]
            columns = _order(columns)
            first = _changes(columns[0], columns[1])
            again = _repeats(columns, first)
            bucket = (columns[0] % _U64(buckets)).astype(np.int64)
            bucket[again] = -1 - bucket[again]
            by_bucket = np.argsort(bucket, kind="stable")
            columns, bucket = [c[by_bucket] for c in columns], bucket[by_bucket]
            edges = np.append(np.flatnonzero(_changes(bucket)), len(bucket))
            blobs = [_pack([c[a:b] for c in columns]) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[edges[:-1]], pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "blob"]
            )

    return texts.mapInArrow(run, "bucket long, blob binary")


_FOUND = "doc long, text_key long, start long, n long, anchor long, repeated boolean"


def _meet(table: pa.Table) -> pa.Table:
    """Of one bucket: repeated pieces, and the first of each of the different pieces of one anchor."""
    blobs, bucket = table.column("blob").to_pylist(), table.column("bucket").to_pylist()
    if bucket[0] < 0:
        columns = _unpack(blobs)
        repeated = np.ones(len(columns[0]), bool)
    else:
        columns = _order(_unpack(blobs))
        anchor_first = _changes(columns[0])
        first = anchor_first | _changes(columns[1])
        repeated = _repeats(columns, first)
        group = np.cumsum(anchor_first) - 1
        mixed = first & (np.bincount(group, weights=first)[group] > 1)
        # rows at one place, of rows that share an id, count once each
        keep = repeated | mixed | (~first & ~repeated & (np.bincount(group, weights=first)[group] > 1))
        columns, repeated = [c[keep] for c in columns], repeated[keep]
    anchor, _, doc, key, start, n = columns
    return pa.table(
        {
            "doc": pa.array(doc.astype(np.int64)), "text_key": pa.array(key.astype(np.int64)),
            "start": pa.array(start.astype(np.int64)), "n": pa.array(n.astype(np.int64)),
            "anchor": pa.array(anchor.view(np.int64)), "repeated": pa.array(repeated),
        }
    )


def _piece_bytes(texts: DataFrame, mixed: DataFrame, length: int) -> DataFrame:
    """The bytes of the pieces that have to be compared."""
    wanted = mixed.groupBy("doc", "text_key").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("wanted"))
    both = texts.join(wanted.hint("shuffle_hash"), ["doc", "text_key"])
    each = both.select("doc", "text_key", "text", F.explode("wanted").alias("w"))
    return each.select(
        "doc", "text_key", F.col("w.anchor").alias("anchor"), F.col("w.start").alias("start"),
        F.substring("text", F.col("w.start").cast("int") + 1, F.col("w.n").cast("int") + (length - 1)).alias("piece"),
    )


def _sort_shard(table: pa.Table, length: int, folder: str) -> pa.Table:
    """The repeated windows of one shard's pieces, as runs (doc, text_key, start, n)."""
    docs, keys, starts = (table.column(c).to_numpy() for c in ("doc", "text_key", "start"))
    parts = table.column("piece").to_pylist()
    sizes = np.array([len(p) for p in parts])
    raw = np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8)
    del parts
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    symbols = np.append(raw.astype(np.int32) + 2, np.int32(0))
    symbols[begins + sizes] = 1
    window = np.zeros(len(raw) + 1, bool)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    offset = np.arange(len(raw), dtype=np.int32) - begins.astype(np.int32)[owner]
    window[:-1] = offset + length <= sizes[owner]
    store, root = open_store(folder)
    spill, repeated = Spill(store, root), np.zeros(len(raw), bool)
    try:
        for batch in sorted_suffixes(symbols, spill, with_prefixes=True):
            places = batch & LOW
            at = np.flatnonzero(window[places])
            if len(at):
                # the prefix that neighbouring windows share is the least on the way from one to the next
                shared = np.minimum.reduceat(batch[: at[-1] + 1] >> SHIFT, at[:-1] + 1)
                group = np.concatenate([[0], np.cumsum(shared < length)])
                _mark(repeated, places[at], group, docs, starts, owner, offset)
    finally:
        spill.close()
    edge = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
    runs, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = owner[runs]
    return pa.table(
        {
            "doc": pa.array(docs[of]), "text_key": pa.array(keys[of]),
            "start": pa.array(starts[of] + offset[runs]), "n": pa.array(ends - runs),
        }
    )


def _mark(repeated, places, group, docs, starts, owner, offset) -> None:
    """Mark all places of a string but the first by document and start."""
    doc, start = docs[owner[places]], starts[owner[places]] + offset[places]
    order = np.lexsort((start, doc, group))
    places, group, doc, start = places[order], group[order], doc[order], start[order]
    later = _repeats([group, group, doc, group, start], _changes(group))
    repeated[places[later]] = True


def repeated_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_key, spans): per document the merged byte ranges (start, end) to remove, if any.

    ``doc`` is the id, or the least long for rows without one.
    """
    if not 72 <= length <= CAP:
        raise ValueError(f"windows of 72 to {CAP} bytes are needed")
    texts = slim_texts(docs, id_col, text_col).withColumn("text_key", text_key())
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cut = _cut(texts, length, max(1, size // BUCKET_BYTES))
    found = materialize(cut.groupBy("bucket").applyInArrow(_meet, _FOUND), "pieces")
    mixed = found.where("not repeated")
    n_mixed = mixed.agg(F.sum(F.col("n") + length)).first()[0] or 0
    shards = max(1, n_mixed // SHARD_BYTES, docs.sparkSession.sparkContext.defaultParallelism)
    folder = f"{shared_dir(docs.sparkSession)}/suffixes"

    def sort(table: pa.Table) -> pa.Table:
        return _sort_shard(table, length, folder)

    parts = _piece_bytes(texts, mixed.drop("repeated"), length)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    sorted_runs = parts.groupBy(shard).applyInArrow(sort, "doc long, text_key long, start long, n long")
    windows = found.where("repeated").select("doc", "text_key", "start", "n").unionByName(sorted_runs)
    spans = windows.groupBy("doc", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("n") + (length - 1)).alias("end")))).alias("spans")
    )
    return materialize(spans, "spans")


def _merged(spans: list[dict] | None) -> np.ndarray:
    if not spans:
        return np.empty((0, 2), np.int64)
    start = np.array([s["start"] for s in spans], np.int64)
    end = np.maximum.accumulate(np.array([s["end"] for s in spans], np.int64))
    new = np.append(True, start[1:] > end[:-1])
    return np.stack([start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]], 1)


def _without(text: bytes, spans: np.ndarray) -> bytes:
    at, kept = 0, []
    for start, end in spans.tolist():
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


def _whole_characters(text: bytes, spans: np.ndarray) -> np.ndarray:
    """The spans without the bytes of characters that they only cut into."""
    data = np.frombuffer(text, np.uint8)
    inside = np.append((data & 0xC0) == 0x80, False)
    fixed = []
    for start, end in spans.tolist():
        while start < end and inside[start]:
            start += 1
        while end > start and inside[end]:
            end -= 1
        if start < end:
            fixed.append((start, end))
    return np.array(fixed, np.int64).reshape(-1, 2)


def removal_digests(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    Each byte covered by a string of ``length`` bytes that also starts earlier is removed: in a document
    with a smaller id, or in the same one. Texts are UTF-8 bytes; null counts as empty. Rows without an id
    come before all others. Rows that share an id are versions of one document: of equal strings in them
    the one with the smaller start is earlier, and equal starts are all kept. An empty table gives an
    empty result; other columns of ``docs`` are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, spans in batches_of(batches, "doc", "text", "spans"):
            merged = [_merged(s) for s in spans]
            kept = [_without(t, m) for t, m in zip(texts, merged)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if i == NO_ID else i for i in ids], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
                    pa.array([len(m) for m in merged], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    texts = slim_texts(docs, id_col, text_col).withColumn("text_key", text_key())
    spans = repeated_spans(docs, length, id_col, text_col)
    return texts.join(spans.hint("shuffle_hash"), ["doc", "text_key"], "left").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings taken out of its texts; a character is never cut in two.

    All columns and rows stay, texts that are null as well. The rules are those of ``removal_digests``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, text_column = batch.column("row"), batch.column("text").to_pylist()
            merged = [_merged(s) for s in batch.column("spans").to_pylist()]
            kept = [_without(t, _whole_characters(t, m)).decode("utf-8", "replace") if len(m) else t.decode("utf-8", "replace") for t, m in zip(text_column, merged)]
            null = batch.column("no_text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [row, pa.array([None if x else k for k, x in zip(kept, null)], pa.string())], names=["row", "text"]
            )

    schema = docs.schema
    slim = slim_texts(docs, id_col, text_col).columns
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias(slim[0]),
        F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias(slim[1]),
        F.col(text_col).isNull().alias("no_text"),
    ).withColumn("text_key", text_key())
    spans = repeated_spans(docs, length, id_col, text_col)
    joined = whole.join(spans.hint("shuffle_hash"), ["doc", "text_key"], "left").select("row", "text", "spans", "no_text")
    row_type = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(run, f"row {row_type}, text string")
    return out.select(*[F.col("text").alias(f.name) if f.name == text_col else F.col("row").getField(f.name).alias(f.name) for f in schema])
