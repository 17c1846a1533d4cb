"""Best-fit packing of documents into sequences, under conflicts of source and duplicate cluster.

Documents longer than a sequence are cut into whole sequences and a rest. Whole sequences need no search.
The rests are dealt to groups by a hash and each group is packed in one task, largest first: the search
goes from the tightest bin upwards and ends at the first that holds neither the source (more often than
allowed) nor the cluster of the piece. Bins live in a tree over their residual; a node knows which
sources and clusters all bins below it hold, so that bins full of a hot source are passed over at once.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.llm.texts import words
from logsense.session import materialize

#: Pieces that one task packs, for choosing the number of groups.
GROUP_PIECES = 1 << 16
PACKED = "doc_id long, piece long, word_start long, n_words long, bin string, bin_offset long"


class Bins:
    """Open bins by residual, each with a bitmap of what it holds (an int).

    ``best_fit`` finds the tightest bin with room and without a conflict. The tree is binary over the
    residuals; a node holds the bits that every bin below it has, and whether there is any.
    """

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.common: list[int | None] = [None] * (2 * self.leaves)  # None: no bin below
        self.at: list[dict[int, list[int]]] = [{} for _ in range(self.leaves)]  # bitmap -> bins of that residual
        self.residual: list[int] = []
        self.held: list[int] = []
        self.used: list[int] = []

    def _refresh(self, residual: int) -> None:
        node, common = residual + self.leaves, None
        for bitmap in self.at[residual]:
            common = bitmap if common is None else common & bitmap
            if not common:
                break
        self.common[node] = common
        node >>= 1
        while node:
            a, b = self.common[2 * node], self.common[2 * node + 1]
            new = b if a is None else a if b is None else a & b
            self.common[node] = new
            node >>= 1

    def _put(self, bin_no: int) -> None:
        residual = self.residual[bin_no]
        if residual:
            insort(self.at[residual].setdefault(self.held[bin_no], []), bin_no)
            self._refresh(residual)

    def open(self, capacity: int) -> int:
        self.residual.append(capacity)
        self.held.append(0)
        self.used.append(0)
        return len(self.residual) - 1

    def best_fit(self, size: int, bits: int) -> int | None:
        """The tightest bin with room for ``size`` and none of ``bits``, taken out of the tree; or None."""
        node = size + self.leaves
        stack = [node]
        while node > 1:  # the right siblings on the way up hold the larger residuals, nearest first
            if not node & 1:
                stack.append(node + 1)
            node >>= 1
        stack.reverse()
        while stack:
            node = stack.pop()
            common = self.common[node]
            if common is None or common & bits:
                continue
            if node < self.leaves:
                stack.append(2 * node + 1)
                stack.append(2 * node)
                continue
            found = [(bins[0], bitmap) for bitmap, bins in self.at[node - self.leaves].items() if not bitmap & bits]
            if found:
                bin_no, bitmap = min(found)
                bins = self.at[node - self.leaves][bitmap]
                bins.pop(0)
                if not bins:
                    del self.at[node - self.leaves][bitmap]
                self._refresh(node - self.leaves)
                return bin_no
        return None

    def add(self, bin_no: int, size: int, bits: int) -> int:
        """Put a piece in; its offset."""
        offset = self.used[bin_no]
        self.used[bin_no] += size
        self.residual[bin_no] -= size
        self.held[bin_no] |= bits
        self._put(bin_no)
        return offset


def pack_group(pieces: Iterable[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each (size, source, cluster), which come largest first; None conflicts with nothing."""
    bins, bit_of, out = Bins(capacity), {}, []
    for size, source, cluster in pieces:
        bits = 0
        for kind, value in ((0, source), (1, cluster)):
            if value is not None:
                bits |= 1 << bit_of.setdefault((kind, value), len(bit_of))
        bin_no = bins.best_fit(size, bits)
        if bin_no is None:
            bin_no = bins.open(capacity)
        out.append((bin_no, bins.add(bin_no, size, bits)))
    return out


def pack(
    docs: DataFrame, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source",
    cluster_col: str | None = None,
) -> DataFrame:
    """doc_id, piece, word_start, n_words, bin, bin_offset: where each piece of a document's words goes.

    A bin holds up to ``capacity`` words, and at most one rest of a source and of a cluster. Without
    ``cluster_col`` equal texts are a cluster. Every word of every document is in exactly one piece; a
    document without words (null, empty, blank) has one piece of none, in no bin (null). Null sources and
    clusters conflict with nothing. Repeated rows are packed each. Rows without an id are packed as well.
    An empty table gives an empty result; other columns of ``docs`` are not read. Bins are named
    "group:number" for rests and "id:piece:row" for whole sequences.
    """
    size = F.size(words(F.col(text_col))).cast("long")
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.sha2(F.col(text_col), 256)
    slim = materialize(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), size.alias("size"),
            (F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")).alias("source"),
            cluster.alias("cluster"), F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    whole = slim.where(F.col("size") >= capacity).select(
        "doc_id", "row", F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / capacity).cast("long") - 1)).alias("piece")
    )
    whole = whole.select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("word_start"), F.lit(capacity).cast("long").alias("n_words"),
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("piece").cast("string"), F.col("row").cast("string")).alias("bin"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    empty = slim.where("size = 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("word_start"),
        F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("string").alias("bin"), F.lit(None).cast("long").alias("bin_offset"),
    )
    rests = slim.where(F.col("size") % capacity > 0).withColumn("rest", F.col("size") % capacity)
    groups = max(1, -(-rests.count() // GROUP_PIECES))
    group = F.pmod(F.xxhash64("doc_id", "size", "cluster"), F.lit(groups)).alias("group")

    def run(table: pa.Table) -> pa.Table:
        ids, rows, sizes, rest, sources, clusters, numbers = (
            table.column(c).to_pylist() for c in ("doc_id", "row", "size", "rest", "source", "cluster", "group")
        )
        order = sorted(range(len(ids)), key=lambda k: (-rest[k], ids[k] is not None, ids[k] or 0, rows[k]))
        placed = pack_group(((rest[k], sources[k], clusters[k]) for k in order), capacity)
        start = np.array([sizes[k] - rest[k] for k in order], np.int64)
        return pa.table(
            {
                "doc_id": pa.array([ids[k] for k in order], pa.int64()), "piece": pa.array(start // capacity),
                "word_start": pa.array(start), "n_words": pa.array([rest[k] for k in order], pa.int64()),
                "bin": pa.array([f"{numbers[0]}:{b}" for b, _ in placed], pa.string()),
                "bin_offset": pa.array([o for _, o in placed], pa.int64()),
            }
        )

    packed = rests.withColumn("group", group).groupBy("group").applyInArrow(run, PACKED)
    return packed.unionByName(whole).unionByName(empty)
