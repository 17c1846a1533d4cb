"""Words, hashes and stored tables shared by the corpus operators.

Words are the runs of ``[^\\x20\\x09-\\x0D]``. Tasks in Python get texts as bytes, where
``bytes.lower`` folds A-Z alone and ``bytes.split`` splits at exactly those six characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
#: Hashes of words that a worker keeps between documents.
CACHE_WORDS = 400_000
_U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def id_crc32(id_col: str) -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.col(id_col).cast("string"))


def id_and_bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator reads, under names of its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def split_words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


class WordHashes(dict):
    """64-bit hash of each word seen; dropped when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), dtype=_U64, count=len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def shingle_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, no word gives none."""
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    width = min(n, width)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width, dtype=_U64)
        for k in range(width):
            out = mix(out * _U64(0x9E3779B97F4A7C15) + word_hashes[k : n - width + 1 + k])
    return np.unique(out)


def batches_of(batches: Iterator, *columns: str, rows: int = 2048) -> Iterator[tuple[list, ...]]:
    """The columns of Arrow batches as Python lists, so many rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield tuple(part.column(c).to_pylist() for c in columns)
