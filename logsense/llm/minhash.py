"""Near duplicates: universal hash minima, banding, verification on full sets, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsense.llm.components import connected_components
from logsense.llm.texts import WordHashes, batches_of, id_and_bytes, mix, shingle_hashes, split_words
from logsense.session import materialize

_U64 = np.uint64
#: Shingles that meet all hash functions at once.
BLOCK = 4096


@dataclass(frozen=True)
class MinHash:
    """``percent``: least Jaccard similarity in percent of two linked sets. ``rows``: minima in a band.

    The number of bands follows from ``miss``, the chance that a pair just at the limit shares no band.
    """

    shingle: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 1e-7
    seed: int = 1

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log1p(-((self.percent / 100) ** self.rows)))

    @property
    def least_agreement(self) -> int:
        """Minima that a linked pair shares at least: six deviations below the mean."""
        n, p = self.bands * self.rows, self.percent / 100
        return max(1, math.floor(n * p - 6 * math.sqrt(n * p * (1 - p))))

    def functions(self) -> tuple[np.ndarray, np.ndarray]:
        """Factors (odd) and summands of x -> (a x + b) mod 2^64, of which the upper half is used."""
        rng = np.random.default_rng(self.seed)
        a, b = rng.integers(0, 2**64, size=(2, self.bands * self.rows, 1), dtype=_U64)
        return a | _U64(1), b

    def minima(self, shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Upper 32 bits of the least value of each function over a set."""
        least = np.full(len(a), np.iinfo(np.uint64).max, dtype=_U64)
        with np.errstate(over="ignore"):
            for at in range(0, len(shingles), BLOCK):
                np.minimum(least, (a * shingles[at : at + BLOCK] + b).min(axis=1), out=least)
        return (least >> _U64(32)).astype(np.uint32)

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """A 64-bit key per band, different for different bands."""
        keys = np.arange(1, self.bands + 1, dtype=_U64)
        with np.errstate(over="ignore"):
            for column in minima.reshape(self.bands, self.rows).astype(_U64).T:
                keys = mix(keys * _U64(0x9E3779B97F4A7C15) + column)
        return keys.view(np.int64)


FEATURES = "doc_id long, n_shingles long, set_key binary, bands array<long>"
SETS = "id long, n long, shingles array<long>, minima array<int>"


def features(docs: DataFrame, config: MinHash) -> DataFrame:
    """Per document the size of its shingle set, a 128-bit key of the set, and its band keys."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, (a, b) = WordHashes(), config.functions()
        for ids, texts in batches_of(batches, "doc_id", "text"):
            sizes, keys, bands = [], [], []
            for text in texts:
                found = shingle_hashes(cache.of(split_words(text)), config.shingle)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                bands.append(config.band_keys(config.minima(found, a, b)) if len(found) else np.empty(0, np.int64))
            offsets = np.cumsum([0, *map(len, bands)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(offsets, np.concatenate([*bands, np.empty(0, np.int64)])),
                ],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return docs.mapInArrow(run, FEATURES)


def full_sets(docs: DataFrame, config: MinHash) -> DataFrame:
    """Per document its whole shingle set and its minima, for the pairs that are tested."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, (a, b) = WordHashes(), config.functions()
        for ids, texts in batches_of(batches, "doc_id", "text"):
            sets = [shingle_hashes(cache.of(split_words(text)), config.shingle) for text in texts]
            minima = [config.minima(s, a, b).view(np.int32) for s in sets]
            lists = [
                pa.ListArray.from_arrays(
                    np.cumsum([0, *map(len, part)], dtype=np.int32), np.concatenate([*part, np.empty(0, kind)]).view(kind)
                )
                for part, kind in (([s.view(np.int64) for s in sets], np.int64), (minima, np.int32))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *lists],
                names=["id", "n", "shingles", "minima"],
            )

    return docs.mapInArrow(run, SETS)


def verified(pairs: DataFrame, sets: DataFrame, config: MinHash) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough: by size, by their minima, then exactly."""
    left, right = (
        sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("shingles").alias(f"s_{x}"), F.col("minima").alias(f"m_{x}"))
        for x in "uv"
    )
    both = pairs.join(left, "u").join(right, "v")
    sizes = 100 * F.least("n_u", "n_v") >= config.percent * F.greatest("n_u", "n_v")
    agree = F.size(F.filter(F.zip_with("m_u", "m_v", lambda x, y: x == y), lambda same: same))
    shared = F.size(F.array_intersect("s_u", "s_v"))
    exact = 100 * shared >= config.percent * (F.col("n_u") + F.col("n_v") - shared)
    keep = F.when(~sizes, False).when(agree < config.least_agreement, False).otherwise(exact)
    return both.where(keep).select("u", "v")


def _hubs(members: DataFrame, per_bucket: int) -> DataFrame:
    """(key, hub, hub_part, hub_n, hub_most): up to ``per_bucket`` members of each bucket, those with the largest ``meets`` first."""
    rank = F.struct(F.col("meets"), (-F.col("id")).alias("order"), F.col("part"), F.col("n"), F.col("most"))
    if per_bucket == 1:
        best = members.groupBy("key").agg(F.array(F.max(rank)).alias("best"))
    else:
        # the top of each slice of a bucket first, so that no task gathers a whole bucket
        cut = F.pmod(F.xxhash64("id"), F.lit(per_bucket)).alias("cut")
        best = members.groupBy("key", cut).agg(F.max(rank).alias("top")).groupBy("key").agg(F.collect_list("top").alias("best"))
    hub = best.select("key", F.explode("best").alias("hub"))
    return hub.select(
        "key", (-F.col("hub.order")).alias("hub"), F.col("hub.part").alias("hub_part"), F.col("hub.n").alias("hub_n"), F.col("hub.most").alias("hub_most")
    )


def _rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """(key, id, n, most): where sets meet by their rarest shingles; every two similar sets do.

    Two sets of n and m shingles are similar if they share ``percent * (n + m) / (100 + percent)``. With the
    shingles of all sets in one order, the rarest first, a first common shingle at place p (from 0) leaves
    room for n - p common ones. So a set of n meets others there only up to the size ``most``, and only
    within the ratio ``percent``. Sets with a common passage or template, whose rare shingles differ, thus do
    not meet. Keys are shingles by class of size; a set stands in the classes of its smaller partners and in its own.
    """
    each = sets.select("id", "n", F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("df"))
    ordered = each.join(common, "shingle").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("all")
    )
    length = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    first = ordered.select("id", "n", F.posexplode(F.slice("all", F.lit(1), length)).alias("place", "s")).where("s.df > 1")
    most = F.floor((F.col("n") - F.col("place")) * (100 + percent) / percent) - F.col("n")
    first = first.select("id", "n", "s.shingle", most.alias("most"))
    least = F.ceil(F.col("n") * percent / 100)
    size_class = lambda size: F.floor(F.log(size) / F.log(F.lit(1.04))).cast("int")
    top = F.least(F.col("most"), F.col("n"))
    classes = F.when(top >= least, F.sequence(size_class(least), size_class(top)))
    own = F.when(F.col("most") >= F.col("n"), F.array(size_class(F.col("n"))))
    none = F.array().cast("array<int>")
    in_classes = F.explode(F.array_union(F.coalesce(classes, none), F.coalesce(own, none)))
    placed = first.select("id", "n", "most", "shingle", in_classes.alias("class"))
    return placed.select(F.xxhash64("shingle", "class").alias("key"), "id", "n", "most")


def _may_meet() -> Column:
    """Whether a member and a hub of a bucket can be similar, by their sizes and by ``most`` of either."""
    return F.expr("n <= hub_most and hub_n <= most")


def _open(members: DataFrame, components: DataFrame) -> DataFrame:
    """(key, id, n, most, meets, part) of the buckets with members in different components.

    ``meets`` prefers the smallest parts: as hubs, a few of them settle a bucket that is nearly one component.
    """
    placed = members.select("key", "id", "n", "most").join(components.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", "n", "most", F.coalesce("component", "id").alias("part")
    )
    several = placed.groupBy("key").agg(
        F.min("part").alias("a"), F.max("part").alias("b"), F.min("n").alias("least_n"), F.max("most").alias("most_most")
    ).where("a <> b").drop("a", "b")
    still = placed.join(several, "key").where("most >= least_n and n <= most_most").drop("least_n", "most_most")
    still = materialize(still, "open-buckets")
    parts = still.groupBy("key", "part").agg((-F.count("*")).alias("meets"))
    return materialize(still.join(parts, ["key", "part"]).select("key", "id", "n", "most", "meets", "part"), "buckets")


def similar_links(reps: DataFrame, sets_of, config: MinHash) -> DataFrame:
    """(node, component) over all links between the sets of ``reps`` (id, n, bands).

    First one member of each bucket of a band, the one that meets most others, is tested against the rest,
    which links most of a family of near copies to its centre. Sets whose buckets still hold
    different components then meet by their rarest shingles, which loses no similar pair of them. There
    again hubs are tested against the rest, up to 32 of a bucket and 32 times as many in each further round; a tested hub
    leaves its buckets, so at the end every pair of a bucket was tested or is in one component.
    """
    rows = materialize(reps.select("id", "n", F.explode("bands").alias("key")), "bands")
    shared = rows.groupBy("key").agg(F.count("*").alias("in_bucket")).where("in_bucket > 1")
    members = rows.join(shared, "key")
    meets = members.groupBy("id").agg(F.sum("in_bucket").alias("meets"))
    most = F.floor(F.col("n") * 100 / config.percent).alias("most")
    members = materialize(
        members.select("key", "id", "n").join(meets, "id").select("key", "id", "n", most, "meets", F.col("id").alias("part")), "buckets"
    )
    sets = materialize(sets_of(members.select("id").distinct()), "sets")

    def tested(members: DataFrame, hubs: DataFrame) -> DataFrame:
        pairs = members.join(hubs, "key").where(F.expr("id <> hub and part <> hub_part") & _may_meet())
        pairs = materialize(pairs.select(F.least("id", "hub").alias("u"), F.greatest("id", "hub").alias("v")).distinct(), "pairs")
        return verified(pairs, sets, config)

    links = materialize(tested(members, _hubs(members, 1)), "links")
    components = materialize(connected_components(links), "components")
    undecided = _open(members, components).select("id").distinct()
    members = _open(materialize(_rare_first(sets.join(undecided, "id", "left_semi"), config.percent), "rare"), components)
    per_bucket = 32
    while not members.isEmpty():
        hubs = materialize(_hubs(members, per_bucket), "hubs")
        found = tested(members, hubs)
        links = materialize(links.unionByName(found), "links")
        components = materialize(connected_components(links), "components")
        untested = members.join(hubs.select("key", F.col("hub").alias("id")), ["key", "id"], "left_anti")
        members = _open(untested, components)
        per_bucket *= 32
    return components


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: MinHash = MinHash()
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two documents are linked when the Jaccard similarity of their sets of word shingles is at least
    ``config.percent``; a component is what links reach, named by its smallest id, which alone is kept.
    Equal sets are one node, so copies never meet in pairs. Null and empty texts, and those of blanks
    alone, have no shingle and are linked with nothing. A text of fewer words than a shingle is one
    shingle. Rows that share an id are one node of the graph. A row without an id counts for no
    component's name; it is kept if its component has no id. An empty table gives an empty result;
    other columns of ``docs`` are not read.
    """
    slim = id_and_bytes(docs, id_col, text_col)
    rows = materialize(features(slim, config), "features")
    reps = materialize(
        rows.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("id")), "set-names"
    )
    named = reps.where("id is not null")
    bands = rows.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "set_key", "bands").join(named, ["id", "set_key"], "left_semi")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = ids.select(F.col("id").alias("doc_id")).hint("shuffle_hash")
        return full_sets(slim.join(wanted, "doc_id", "left_semi"), config)

    components = similar_links(bands.select("id", "n", "bands"), sets_of, config)
    # rows of one id with different sets: the id stands for all of them
    ids = rows.where("set_key is not null and doc_id is not null").join(reps, "set_key").where("id <> doc_id")
    return _placed(rows, reps, components, ids, config)


def _placed(rows, reps, components, ids, config) -> DataFrame:
    shared_id = rows.where("set_key is not null").groupBy("doc_id").agg(
        F.min("set_key").alias("a"), F.max("set_key").alias("b")
    ).where("a <> b and doc_id is not null").select("doc_id")
    extra = ids.join(shared_id, "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("id").alias("v"))
    known = components.select(F.col("node").alias("u"), F.col("component").alias("v"))
    if not extra.isEmpty():
        components = connected_components(known.unionByName(extra))
    by_set = reps.join(components.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id")
    )
    placed = rows.drop("bands").join(by_set, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
