"""Language of texts by string kernels: blended-spectrum presence, Nystroem landmarks, ridge regression.

The kernel of two texts is the number of character n-grams (1 to ``longest``) that both hold, over the
square root of the product of their own numbers. A text's kernel values with m landmark texts, times the
inverse root of the landmarks' own kernel matrix, are its features; one ridge regression per language
against all others is fitted on them. Scores are products of presence matrices with fixed matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsense.llm.texts import batches_of, mix

_U64 = np.uint64
UNDETERMINED = "und"


@dataclass(frozen=True)
class KernelConfig:
    """``sample_rows``: the bound of labelled rows that are fitted on, all languages together (about; by hash).

    ``landmarks`` of them carry the kernel. N-grams of 1 to ``longest`` characters are counted as present in one of
    ``2 ** bits`` hashed places. ``languages``: the most that a table may have.
    """

    sample_rows: int = 2000
    landmarks: int = 256
    longest: int = 3
    bits: int = 17
    ridge: float = 1e-2
    languages: int = 500
    seed: int = 5


@dataclass(frozen=True)
class KernelModel:
    """``weights``: (2 ** bits) x languages, the landmarks' presence times their part of the regression."""

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    config: KernelConfig


def presence(text: str, config: KernelConfig) -> np.ndarray:
    """The distinct hashed n-grams of a whole text, upper case folded."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(_U64)
    seen = np.zeros(1 << config.bits, bool)
    gram = np.zeros(len(codes), _U64)
    with np.errstate(over="ignore"):
        for n in range(1, min(config.longest, len(codes)) + 1):
            gram = gram[: len(codes) - n + 1] * _U64(0x100000001B3) + codes[n - 1 :] + _U64(n)
            seen[mix(gram) >> _U64(64 - config.bits)] = True
    return np.flatnonzero(seen).astype(np.int32)


def _presences(rows: DataFrame, config: KernelConfig) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, orders, texts in batches_of(batches, "lang", "order", "text"):
            grams = [presence(t.decode("utf-8", "replace"), config) for t in texts]
            yield pa.RecordBatch.from_pydict({"lang": langs, "order": orders, "grams": pa.array([g.tobytes() for g in grams], pa.binary())})

    return rows.mapInArrow(run, "lang string, order long, grams binary")


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", config: KernelConfig = KernelConfig()) -> KernelModel:
    """Learn from a bounded sample of the rows with a language and a text; each language gets an equal part.

    Distinct texts of a language are chosen by their hash, each once however many copies it has, so the model
    depends on neither order nor partitions. Only hashed n-grams of the sample come to the driver. Without any such row the model knows no language.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("binary").alias("text")).where(
        "lang is not null and octet_length(text) > 0"
    )
    order = F.xxhash64("text", F.lit(config.seed))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count_distinct(order).alias("n")).collect()}
    if not counts:
        return KernelModel((), np.zeros((1 << config.bits, 0), np.float32), np.zeros(0, np.float32), config)
    if len(counts) > config.languages:
        raise ValueError(f"{len(counts)} languages; at most {config.languages} can be learned")
    each = max(1, config.sample_rows // len(counts))
    part = lambda lang: F.lit(int(min(1.0, each / counts[lang]) * (2**31)))
    limit = F.lit(0)
    for lang in sorted(counts):
        limit = F.when(F.col("lang") == lang, part(lang)).otherwise(limit)
    chosen = rows.withColumn("order", order).where(F.pmod("order", F.lit(2**31)) <= limit)
    chosen = chosen.groupBy("lang", "order").agg(F.first("text").alias("text"))
    sample = _presences(chosen, config).collect()
    return _solve([(r["lang"], r["order"], np.frombuffer(r["grams"], np.int32)) for r in sample], sorted(counts), each, config)


def _solve(sample: list, languages: list[str], each: int, config: KernelConfig) -> KernelModel:
    sample.sort(key=lambda x: (x[1], x[0], x[2].tobytes()))
    by_lang = {lang: [x for x in sample if x[0] == lang][: 2 * each] for lang in languages}
    marks = [x[2] for lang in languages for x in by_lang[lang][: max(1, config.landmarks // len(languages))]]
    train = [x for lang in languages for x in by_lang[lang]]
    dense = np.zeros((1 << config.bits, len(marks)), np.float32)
    for k, grams in enumerate(marks):
        dense[grams, k] = 1 / np.sqrt(max(1, len(grams)))
    kernel = lambda grams: dense[grams].sum(axis=0, dtype=np.float64) / np.sqrt(max(1, len(grams)))
    values, vectors = np.linalg.eigh(np.array([kernel(g) for g in marks]))
    keep = values > 1e-8 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = np.array([kernel(x[2]) for x in train]) @ root
    target = np.array([[1.0 if x[0] == lang else 0.0 for lang in languages] for x in train])
    weight = np.array([1 / max(1, len(by_lang[x[0]])) for x in train])[:, None]
    weight = weight / weight.sum()
    mean_x, mean_y = (weight * features).sum(0), (weight * target).sum(0)
    x, y = (features - mean_x) * np.sqrt(weight), (target - mean_y) * np.sqrt(weight)
    solved = np.linalg.solve(x.T @ x + config.ridge * np.trace(x.T @ x) / x.shape[1] * np.eye(x.shape[1]), x.T @ y)
    weights = (dense @ (root @ solved)).astype(np.float32)
    return KernelModel(tuple(languages), weights, (mean_y - mean_x @ solved).astype(np.float32), config)


#: Cells of a block of grams x languages that are held at once, unless a single text has more.
_CELLS = 1 << 22


def _scores(model: KernelModel, grams: list[np.ndarray]) -> np.ndarray:
    """Regression values of a batch: its presence matrix (sparse rows) times the model's matrix, block by block."""
    sizes = np.array([len(g) for g in grams])
    sums = np.empty((len(grams), model.weights.shape[1]), np.float32)
    block = np.cumsum(sizes) * max(1, model.weights.shape[1]) // _CELLS
    bounds = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(grams)]
    for a, b in zip(bounds[:-1], bounds[1:]):
        rows = model.weights[np.concatenate(grams[a:b])]
        sums[a:b] = np.add.reduceat(rows, np.concatenate([[0], np.cumsum(sizes[a:b])])[:-1], axis=0)
    return sums / np.sqrt(sizes)[:, None] + model.bias


def predict(
    docs: DataFrame, model: KernelModel, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None
) -> DataFrame:
    """doc_id, lang_pred, score (and ``extra`` columns) for every row of ``docs``.

    ``lang_pred`` is the language with the largest regression value and ``score`` that value within 0 and 1; ``und``
    with score 0 for null texts, those without a letter, and if the model knows no language. Ties go to
    the first language in alphabetical order. Whole texts are read, and no other column of ``docs``.
    """
    # 2 ** bits x languages, both bounded; plain values, as tasks need not know this package's classes
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.bias, asdict(model.config)))
    extra = extra or {}
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
        *[c.alias(f"_{name}") for name, c in extra.items()],
    )
    out = slim.select("doc_id", *[f"_{name}" for name in extra]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights, bias, config = shared.value
        model = KernelModel(languages, weights, bias, KernelConfig(**config))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [(t or b"").decode("utf-8", "replace") for t in part.column("text").to_pylist()]
                lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                known = [k for k, t in enumerate(texts) if model.languages and any(map(str.isalpha, t))]
                if known:
                    values = _scores(model, [presence(texts[k], model.config) for k in known])
                    best = values.argmax(axis=1)
                    for k, b, v in zip(known, best, values):
                        lang[k], score[k] = model.languages[b], float(min(1.0, max(0.0, v[b])))
                kept = [part.column(f.name) for f in out.fields]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*out.names, "lang_pred", "score"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.fields)
    found = slim.mapInArrow(run, f"{fields}, lang_pred string, score double")
    return found.select("doc_id", *[F.col(f"_{name}").alias(name) for name in extra], "lang_pred", "score")
