"""How filters interact: counts per part for every order of the filters, from a stream that takes back what proved wrong.

Each file is read once. A filter on the text alone is a bit of a mask; whether a text repeats one of a smaller id is known
only with all files. So the state of a text holds its smallest id so far with the counters it went to, and when a
smaller id arrives, those are taken back (counted with -1) and counted anew as repeated.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logsense.llm.streams import stream_table
from logsense.llm.texts import words
from logsense.session import scratch_path
from logsense.streaming.state import disk_state

#: Micro-batches in which a table is taken.
BATCHES = 3
COUNTERS = "part string, mask int, quality boolean, toxic boolean, n long"
#: Buckets of texts: most tasks that share the state. Fixed for the life of a checkpoint.
BUCKETS = 1024
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_REST = ["part", "mask", "quality", "toxic"]

#: Failure conditions of a text that is not null and of its words, by letter. Limits and characters.
FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
    "C": lambda text, words: 100 * (F.length(text) - F.length(F.translate(text, _UPPER, ""))) > 2 * F.length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The letter of the filter that a text fails if it is identical to a text of a smaller id.
REPEATED = "E"


def _masked(docs: DataFrame, filters: dict, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(key, doc_id, part, mask): ``key`` is the digest of the text, null for rows without an id, which repeat nothing."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text")
    ).withColumn("words", words(F.col("text")))
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())]
    mask = sum(bits[1:], bits[0])
    key = F.when(F.col("doc_id").isNotNull(), F.unhex(F.sha2(F.encode("text", "utf-8"), 256)))
    return slim.select(key.alias("key"), "doc_id", "part", mask.cast("int").alias("mask"))


def _labelled(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with booleans ``quality`` and ``toxic``; a row without a label has neither."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("quality"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    # rows without an id are spread over all tasks
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("part", "mask", F.rand(1))).otherwise(F.lit(0))
    met = rows.withColumn("_spread", spread).join(
        known.withColumn("_none", F.lit(0).cast("long")), (F.col("doc_id") == F.col("_id")) & (F.col("_spread") == F.col("_none")), "left"
    )
    return met.select(*rows.columns, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("quality", "toxic")])


def _combined(repeated_bit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the rows of one text in a batch those of the smallest id go on to its state; the rest repeat it and become counters."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(batches):
            rows = batch.to_pandas()
            least = rows.groupby("key")["doc_id"].transform("min")
            first = rows["doc_id"].notna() & (rows["doc_id"] == least)
            state = rows[first].groupby(["key", "doc_id", *_REST], as_index=False).size()
            rest = rows[~first]
            rest = rest.assign(mask=rest["mask"].where(rest["doc_id"].isna(), rest["mask"] | repeated_bit))
            state["bucket"] = [int.from_bytes(key[:4], "little") % BUCKETS for key in state["key"]]
            done = rest.groupby(_REST, as_index=False).size().assign(key=None, doc_id=-1, bucket=k % BUCKETS)
            both = pd.concat([f.astype({"doc_id": "int64", "mask": "int32"}) for f in (state, done) if len(f)] or [state], ignore_index=True)
            out = both.rename(columns={"size": "n"})[["bucket", "key", "doc_id", *_REST, "n"]]
            yield pa.RecordBatch.from_pandas(
                out, preserve_index=False, schema=pa.schema([
                    ("bucket", pa.int32()), ("key", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("quality", pa.bool_()),
                    ("toxic", pa.bool_()), ("n", pa.int64()),
                ]),
            )

    return combine


def settle(held: tuple | None, rows: list[tuple], repeated_bit: int) -> tuple[tuple, list[tuple]]:
    """The state of a text after ``rows`` (doc_id, part, mask, quality, toxic, n), and the changes of the counters.

    The state is (smallest id, mask, quality, toxic, parts, counts): the rows with that id, of which none is repeated.
    """
    least = min(r[0] for r in rows)
    if held is not None:
        least = min(least, held[0])
    changes, parts = [], {}
    if held is not None:
        old_id, mask, quality, toxic, old_parts, counts = held
        for part, n in zip(old_parts, counts):
            if old_id == least:
                parts[part] = n
            else:
                changes += [(part, mask, quality, toxic, -n), (part, mask | repeated_bit, quality, toxic, n)]
    same = held[1:4] if held is not None and held[0] == least else None
    for doc_id, part, mask, quality, toxic, n in rows:
        if doc_id == least:
            same = (mask, quality, toxic)
            parts[part] = parts.get(part, 0) + n
            changes.append((part, mask, quality, toxic, n))
        else:
            changes.append((part, mask | repeated_bit, quality, toxic, n))
    return (least, *same, list(parts), list(parts.values())), changes


class TextState(StatefulProcessor):
    """The state of the texts of a bucket, one value on disk per text; gives the changes of the counters."""

    def __init__(self, repeated_bit: int):
        self.repeated_bit = repeated_bit

    def init(self, handle: StatefulProcessorHandle) -> None:
        # the tuple of ``settle`` as JSON
        self.texts = handle.getMapState("texts", "digest binary", "held string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = self.texts.exists()
        for frame in rows:
            changes: Counter = Counter()
            texts: dict[bytes, list[tuple]] = {}
            for digest, *row in zip(*(frame[c].tolist() for c in ("key", "doc_id", *_REST, "n"))):
                if digest is None:  # counters on their way
                    changes[tuple(row[1:5])] += row[5]
                else:
                    texts.setdefault(bytes(digest), []).append(tuple(row))
            for digest, found in texts.items():
                before = self.texts.getValue((digest,)) if seen else None
                held, more = settle(before and json.loads(before[0]), found, self.repeated_bit)
                self.texts.updateValue((digest,), (json.dumps(held),))
                for *place, n in more:
                    changes[tuple(place)] += n
            seen = True
            yield pd.DataFrame([(*place, n) for place, n in changes.items()], columns=[*_REST, "n"])

    def close(self) -> None:
        pass


def absorb(
    spark: SparkSession, path: str, labels: DataFrame, checkpoint: str, counters: str, filters: dict | None = None,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", batches: int = BATCHES,
) -> None:
    """Take the files at ``path`` that ``checkpoint`` has not seen; each micro-batch writes its changes of the counters below ``counters``.

    A batch that is run again after a failure overwrites what it wrote.
    """
    filters = FILTERS if filters is None else filters
    bit = 1 << len(filters)
    rows = _labelled(_masked(stream_table(spark, path, batches), filters, id_col, text_col, part_col), labels, id_col)
    combined = rows.select("key", "doc_id", *_REST).mapInArrow(_combined(bit), f"bucket int, key binary, doc_id long, {COUNTERS}")
    changes = combined.groupBy("bucket").transformWithStateInPandas(TextState(bit), COUNTERS, "Append", "None")

    def count(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(*_REST).agg(F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{counters}/batch={batch_id}")

    with disk_state(spark):
        query = changes.writeStream.foreachBatch(count).outputMode("append").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()


def interactions(counters: DataFrame, letters: str) -> DataFrame:
    """The audit from (part, mask, quality, toxic, n): bit k of ``mask`` is set where the filter ``letters[k]`` fails.

    What a filter does after others depends on which they are, not on their order: so it is counted once per set.
    """
    size = len(letters)
    steps = [(f, s) for f in range(size) for s in range(1 << size) if not s >> f & 1]
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(s).alias("before")) for f, s in steps])).alias("step")
    mask_bit = F.expr("(shiftright(mask, step.f) & 1) = 1")
    passed = F.expr("(mask & step.before) = 0")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    by_set = counters.select("*", each).groupBy("part", "step.f", "step.before").agg(
        total(passed & ~mask_bit).alias("kept"), total(passed & mask_bit).alias("removed"), total(~passed & mask_bit).alias("redundant"),
        total(F.expr("mask = shiftleft(1, step.f)")).alias("unique_fails"), total(passed & mask_bit & F.col("quality")).alias("good_lost"),
        total(passed & mask_bit & F.col("toxic")).alias("toxic_lost"),
    )
    weights = [factorial(k) * factorial(size - 1 - k) for k in range(size)]
    ahead = F.bit_count("before")
    share = F.col("removed") * F.element_at(F.array(*map(F.lit, weights)), ahead + 1)
    of_filter = by_set.groupBy("part", "f").agg(F.sum(share).cast("long").alias("shapley"))
    by_set = by_set.join(of_filter, ["part", "f"])
    places: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in permutations(range(size)):
        seen = 0
        for step, f in enumerate(order, 1):
            places.setdefault((f, seen), []).append(("".join(letters[k] for k in order), step))
            seen |= 1 << f
    spark = counters.sparkSession
    orders = spark.createDataFrame(
        [(f, s, o, step) for (f, s), found in places.items() for o, step in found], "f int, before int, filter_order string, step int"
    )
    return by_set.join(F.broadcast(orders), ["f", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(
    spark: SparkSession, path: str, labels: DataFrame, filters: dict | None = None, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source", batches: int = BATCHES, folder: str | None = None,
) -> DataFrame:
    """part, filter_order, step and counts per part, order of all filters and place in it, for the Parquet table at ``path``.

    ``filters`` (FILTERS if not given) and the one for texts identical to a text of a smaller id (REPEATED) are applied in
    every order. kept: rows left after the step; removed: here; redundant: failing this filter and removed before;
    unique_fails: failing this filter alone; good_lost and toxic_lost: removed here with such a label; shapley: removed by
    this filter, summed over all orders. With a ``folder`` a later call goes on with the files added since.

    A null text is empty, a null part the empty string. Rows without an id neither repeat a text nor are repeated; rows that share
    an id and a text are not repeated by each other. Rows in ``labels`` without an id count for nothing, several of
    one id together. Empty tables give an empty result; other columns are not read.
    """
    filters = FILTERS if filters is None else filters
    folder = folder or scratch_path(spark, "audit")
    absorb(spark, path, labels, f"{folder}/checkpoint", f"{folder}/counters", filters, id_col, text_col, part_col, batches)
    counters = spark.read.schema(COUNTERS).parquet(f"{folder}/counters/*")
    total = counters.groupBy(*_REST).agg(F.sum("n").alias("n")).where("n <> 0")
    return interactions(total, "".join(filters) + REPEATED)
