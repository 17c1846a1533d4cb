"""Brown class-based bigram language model: exchange clustering, class transitions, word emissions.

Counts of words cover all training texts. The words with most tokens, up to fixed numbers, travel to
the tasks: ``head`` of them with their counts and the first ``exchange`` of these as members of ``classes``
classes. Every other word belongs to one further class, whatever the size of the vocabulary; its
count is found by a join. An exchange sweep counts, in one pass over all training texts, the classes
before and after each of the exchanged words; these counts have a size fixed by the model. On them the
words are moved one after another to the class that most raises the likelihood of the class bigrams.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsense.llm.texts import batches_of, split_words
from logsense.session import materialize

#: Longer words are never in the head, which so has a fixed largest size.
HEAD_BYTES = 64
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 300_000
#: Words of a block of counts, and partial sums of a block.
BLOCK, PARTS = 1024, 64


@dataclass(frozen=True)
class BrownConfig:
    """``backoff``: weight, in tokens, of the class frequencies in the transition probabilities. ``sweeps``: the most
    exchange sweeps; they stop when one no longer raises the likelihood.
    """

    classes: int = 32
    exchange: int = 16384
    head: int = 131072
    sweeps: int = 3
    backoff: float = 20.0

    @property
    def other(self) -> int:
        """The class of all words that are not exchanged; the next one is the end (and start) of a text."""
        return self.classes

    @property
    def all_classes(self) -> int:
        return self.classes + 2


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all ``texts`` (text as bytes), summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return batch

        for (found,) in batches_of(batches, "text"):
            for text in found:
                counts.update(split_words(text))
                if len(counts) >= COUNTED_WORDS:
                    yield flush()
        yield flush()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_words(counts: DataFrame, size: int) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``size``; whole steps of frequency, so that ties never split."""
    short = counts.where(F.octet_length("word") <= HEAD_BYTES)
    # frequencies to ten bits: a bounded number of steps
    shift = F.greatest(F.floor(F.log2(F.col("n").cast("double"))).cast("int") - 9, F.lit(0))
    step = F.expr("shiftleft(shiftright(n, s), s)")
    steps = short.select("n", shift.alias("s")).groupBy(step.alias("step")).count().collect()
    taken, least = 0, None
    for row in sorted(steps, key=lambda r: -r["step"]):
        taken += row["count"]
        if taken > size:
            break
        least = row["step"]
    if least is None:
        return []
    found = short.where(F.col("n") >= least).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in found), key=lambda x: (-x[1], x[0]))


_ENCODED = (
    "row long, doc_id long, held_out boolean, ids binary, n_tokens long, n_known long, base_sum double, other_sum double, "
    "n_other long, tail array<struct<word: binary, k: int>>"
)


def _encode(docs: DataFrame, head: list[tuple[bytes, int]], n_texts: int, config: BrownConfig) -> DataFrame:
    """Per text the exchanged words as 16-bit numbers, sums over the words of the head, and the others with counts."""
    index = {word: k for k, (word, _) in enumerate(head)}
    logs = np.log10(np.array([n for _, n in head] or [0], np.float64) + 0.5)
    shared = docs.sparkSession.sparkContext.broadcast((index, logs))
    end_log, exchange = float(np.log10(n_texts + 0.5)), config.exchange

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, logs = shared.value
        missing = len(index)
        for rows, ids, held, texts in batches_of(batches, "row", "doc_id", "held_out", "text"):
            out: dict[str, list] = {name: [] for name in ("ids", "n_tokens", "n_known", "base_sum", "other_sum", "n_other", "tail")}
            for text in texts:
                words = split_words(text)
                numbers = np.fromiter((index.get(w, missing) for w in words), np.int64, len(words))
                known = numbers[numbers < missing]
                plain = known[known >= exchange]
                others = (numbers >= exchange) | (numbers == missing)
                out["ids"].append(np.where(others, exchange, numbers).astype(np.uint16).tobytes())
                out["n_tokens"].append(len(words) + 1)
                out["n_known"].append(len(known) + (1 if n_texts else 0))
                out["base_sum"].append(float(logs[known].sum()) + end_log)
                out["other_sum"].append(float(logs[plain].sum()))
                out["n_other"].append(int(others.sum()))
                tail = Counter(words[k] for k in np.flatnonzero(numbers == missing).tolist())
                out["tail"].append([{"word": w, "k": k} for w, k in tail.items()])
            arrays = {"row": pa.array(rows, pa.int64()), "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_())}
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int32())])))
            yield pa.RecordBatch.from_pydict(arrays | {name: pa.array(v, kind) for (name, v), kind in zip(out.items(), kinds)})

    return docs.mapInArrow(run, _ENCODED)


def _neighbours(encoded: DataFrame, classes: np.ndarray, config: BrownConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over all training texts: classes before and after each exchanged word, and the class bigrams.

    Tasks count into arrays of fixed size, which are summed by block of words in two steps.
    """
    size, wide = config.exchange, config.all_classes
    shared = encoded.sparkSession.sparkContext.broadcast(np.append(classes, config.other).astype(np.int64))
    blocks = -(-size // BLOCK)
    cells = BLOCK * wide

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, boundary = shared.value, wide - 1
        before, after = np.zeros((2, blocks * cells), np.int64)
        bigrams = np.zeros(wide * wide, np.int64)
        for (texts,) in batches_of(batches, "ids", rows=10000):
            if not texts:
                continue
            words = [np.frombuffer(x, np.uint16) for x in texts]
            lengths = np.array([len(w) for w in words])
            # one sequence of classes, with a boundary before each text and after the last
            starts = np.concatenate([[0], np.cumsum(lengths + 1)])
            at = np.ones(starts[-1] + 1, bool)
            at[starts] = False
            flat = np.concatenate(words).astype(np.int64)
            chain = np.full(len(at), boundary, np.int64)
            chain[at] = class_of[flat]
            bigrams += np.bincount(chain[:-1] * wide + chain[1:], minlength=wide * wide)
            places = np.flatnonzero(at)
            own = flat < size
            flat, places = flat[own], places[own]
            before += np.bincount(flat * wide + chain[places - 1], minlength=len(before))
            after += np.bincount(flat * wide + chain[places + 1], minlength=len(after))
        part = TaskContext.get().partitionId() % PARTS
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = [
            pack(np.concatenate([x[b * cells : (b + 1) * cells] for x in (before, after)]).tobytes()) for b in range(blocks)
        ]
        rows.append(pack(bigrams.tobytes()))
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(range(blocks + 1), pa.int64()), "part": pa.array([part] * (blocks + 1), pa.int64()), "counts": pa.array(rows, pa.binary())}
        )

    def add(table: pa.Table) -> pa.Table:
        total = 0
        for packed in table.column("counts").to_pylist():
            total = total + np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int64)
        packed = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
        return pa.table({"block": table.column("block")[:1], "part": table.column("part")[:1], "counts": pa.array([packed], pa.binary())})

    schema = "block long, part long, counts binary"
    partial = encoded.where("not held_out").select("ids").mapInArrow(count, schema)
    summed = partial.groupBy("block", "part").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    before, after = np.zeros((2, blocks * cells), np.int64)
    bigrams = np.zeros(wide * wide, np.int64)
    for row in summed.collect():
        counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["counts"]), np.int64)
        if row["block"] == blocks:
            bigrams = counts
        else:
            cut = slice(row["block"] * cells, (row["block"] + 1) * cells)
            before[cut], after[cut] = counts.reshape(2, cells)
    return before.reshape(-1, wide)[:size], after.reshape(-1, wide)[:size], bigrams.reshape(wide, wide)


def exchange_sweep(classes: np.ndarray, before: np.ndarray, after: np.ndarray, bigrams: np.ndarray, config: BrownConfig) -> np.ndarray:
    """Each word in turn moves to the class with the largest gain in sum N(c,d) log N(c,d) - sums of class counts.

    Words come by frequency; the neighbours keep the classes they had when the sweep began.
    """

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    classes, n = classes.copy(), bigrams.astype(np.float64)
    k = config.classes
    for word in range(len(classes)):
        left, right = before[word].astype(np.float64), after[word].astype(np.float64)
        tokens = left.sum()
        if not tokens:
            continue
        own = classes[word]
        n[:, own] -= left
        n[own] -= right
        np.maximum(n, 0, out=n)
        into, out_of = n[:, :k], n[:k]
        sums_in, sums_out = into.sum(axis=0), out_of.sum(axis=1)
        gain = (f(into + left[:, None]) - f(into)).sum(axis=0) + (f(out_of + right) - f(out_of)).sum(axis=1)
        gain -= f(sums_in + tokens) - f(sums_in) + f(sums_out + tokens) - f(sums_out)
        best = int(gain.argmax())
        classes[word] = best
        n[:, best] += left
        n[best] += right
    return classes


def likelihood(bigrams: np.ndarray) -> float:
    """The part of the texts' log likelihood that depends on the classes."""
    n = bigrams.astype(np.float64)
    f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    return f(n) - f(n.sum(axis=0)) - f(n.sum(axis=1))


@dataclass(frozen=True)
class BrownModel:
    """``log_step[c, d]`` and, per exchanged word, ``log_emit`` in its class; ``classes`` of these words."""

    classes: np.ndarray
    log_step: np.ndarray
    log_emit: np.ndarray
    other_norm: float  # log10 of the denominator of all other words
    base_norm: float
    train_tokens: int


def _fit(encoded: DataFrame, head: list, n_texts: int, n_words: int, n_distinct: int, config: BrownConfig) -> BrownModel:
    own = np.array([n for _, n in head[: config.exchange]], np.float64)
    classes = np.arange(len(own)) % config.classes
    padded = lambda c: np.append(c, np.full(config.exchange - len(c), config.other))
    bigrams = np.zeros((config.all_classes, config.all_classes), np.int64)
    best = -np.inf
    for sweep in range(config.sweeps + 1):
        before, after, found = _neighbours(encoded, padded(now := classes if sweep == 0 else moved), config)
        if (value := likelihood(found)) <= best:
            break  # the last sweep made it no better: the classes before it stay
        best, classes, bigrams = value, now, found
        if sweep < config.sweeps:
            moved = exchange_sweep(classes, before, after, bigrams, config)
    into = bigrams.sum(axis=0)
    plain = (into + 1) / (into.sum() + config.all_classes)
    step = (bigrams + config.backoff * plain) / (bigrams.sum(axis=1, keepdims=True) + config.backoff)
    per_class = np.bincount(classes, weights=own, minlength=config.classes) if len(own) else np.ones(config.classes)
    emit = np.log10(own / per_class[classes]) if len(own) else np.zeros(0)
    tokens, distinct = n_words + n_texts, n_distinct + (1 if n_texts else 0)
    others = n_words - own.sum() + 0.5 * (n_distinct - len(own) + 1)
    return BrownModel(padded(classes), np.log10(step), emit, float(np.log10(others)), float(np.log10(tokens + 0.5 * (distinct + 1))), tokens)


def score_texts(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", config: BrownConfig = BrownConfig()
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity for every row of ``docs``.

    Learns from the rows where ``held_out`` is false (null counts as true) and scores all. A text's tokens
    are its words and one end; null and empty texts are the end alone. ``base_score`` is the unigram model,
    ``score`` the log10 probability of class transitions and emissions: P(class | class before), of
    bigram counts backed off to class frequencies, times P(word | class), where the class of all words
    not exchanged keeps room for unseen ones. Rows are scored each, repeated ones and those without an id too.
    Without training rows the counts are 0 and nothing is known. An empty table gives an empty result.
    """
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"), F.col(text_col).cast("binary").alias("text"),
    )
    training = slim.where("not held_out")
    counts = materialize(word_counts(training.select("text")), "word-counts")
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_texts = training.select("row").count()
    head = head_words(counts, config.head)
    encoded = materialize(_encode(slim, head, n_texts, config), "encoded")
    model = _fit(encoded, head, n_texts, n_words, n_distinct, config)
    words = encoded.select("row", F.inline("tail"))
    n = F.coalesce(F.col("n"), F.lit(0))
    tail = words.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(n + 0.5)).alias("tail_sum"), F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("tail_known")
    )
    # plain arrays, as tasks need not know this package's classes
    shared = docs.sparkSession.sparkContext.broadcast((model.classes, model.log_step, model.log_emit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, log_step, log_emit = shared.value
        wide = config.all_classes
        class_of = np.append(classes, config.other).astype(np.int64)
        emit = np.concatenate([log_emit, np.zeros(config.exchange + 1 - len(log_emit))])
        for batch in batches:
            scores = []
            for ids in batch.column("ids").to_pylist():
                words = np.frombuffer(ids, np.uint16).astype(np.int64)
                chain = np.concatenate([[wide - 1], class_of[words], [wide - 1]])
                scores.append(float(log_step[chain[:-1], chain[1:]].sum() + emit[words].sum()))
            kept = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores, pa.float64())], names=[*kept, "classes_sum"])

    kept = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, other_sum double, n_other long"
    scored = encoded.drop("tail").mapInArrow(run, f"{kept}, classes_sum double")
    both = scored.join(tail, "row", "left")
    tail_sum = F.coalesce(F.col("tail_sum"), F.lit(0.0))
    score = F.col("classes_sum") + F.col("other_sum") + tail_sum - F.col("n_other") * F.lit(model.other_norm)
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce(F.col("tail_known"), F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") + tail_sum - F.col("n_tokens") * F.lit(model.base_norm)).alias("base_score"), score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
