"""Merkle tree over a table with a proof for each row, by pointer jumping.

Leaves are numbered in their tree without a global sort in one task, levels are grouped by runs of ``ARITY``, and each
node holds the siblings on its way to an ancestor. A self-join of the nodes doubles that way, a join of the leaves with
the nodes they point to does the same for the proofs, until every leaf points beyond the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsense.operators.joins import lookup_join
from logsense.session import materialize

ARITY = 3
#: Rows per range of leaves, for choosing the number of ranges.
RANGE_ROWS = 1 << 18
#: The tree over the subroots, and a mark for rows whose proof is whole.
_TOP, _DONE = -1, -2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    """sha256 of each value, ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    return F.unhex(F.sha2(F.concat(*map(_field, values)), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, doc_id, leaf, tampered) with ``tree``, ``pos`` in it and ``n``, its number of leaves.

    The rows are dealt to ranges of (source, doc_id, leaf) once and stored; a source's rows may fill many ranges. Only
    counts per range and source cross ranges.
    """
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ranges = max(leaves.sparkSession.sparkContext.defaultParallelism, -(-leaves.count() // RANGE_ROWS))
    dealt = leaves.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = materialize(dealt.select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")
    ), "leaves")
    counts = dealt.groupBy("part", "source").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    of_source = Window.partitionBy("source")
    before = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.select(
        "part", "source", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("offset"),
        F.sum("rows").over(of_source).alias("n"), F.min("part").over(of_source).alias("first_part"),
    ), "sources")
    # trees are numbered in the order of sources: by the ranges in which they begin, then inside each
    begins = counts.where("part = first_part")
    totals = begins.groupBy("part").agg(F.count("*").alias("begun"))
    base = totals.select("part", F.coalesce(F.sum("begun").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_first())) - 1
    trees = begins.select("part", "source", rank.alias("rank")).join(F.broadcast(base), "part")
    trees = trees.select(F.col("source").alias("of"), (F.col("base") + F.col("rank")).alias("tree"))
    places = counts.join(trees, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("part").alias("in_part"), "of", "offset", "n", "tree"
    )
    met = dealt.join(places, (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("of")))
    numbered = met.select("doc_id", "leaf", "tampered", "tree", (F.col("at") + F.col("offset")).alias("pos"), "n")
    return materialize(numbered, "numbered")


def _levels(nodes: DataFrame, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Runs per level, and (tree, n, digest) of the trees' last nodes; ``nodes`` are (tree, pos, n, digest, payload).

    A run is (tree, pos, n, digest, kids): the parent, the number of nodes on its level, and what it was hashed from.
    """
    runs, ends = [], [nodes.where("n = 1").select("tree", "digest")]
    kid = ["pos", "digest", *payload]
    while not (rest := nodes.where("n > 1")).isEmpty():
        parent = F.expr(f"pos div {ARITY}").alias("parent")
        level = rest.groupBy("tree", parent, "n").agg(F.array_sort(F.collect_list(F.struct(*kid))).alias("kids"))
        digest = F.unhex(F.sha2(F.array_join(F.transform("kids", lambda k: _hex(k["digest"])), ""), 256))
        up = F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n")
        level = materialize(level.select("tree", F.col("parent").alias("pos"), up, digest.alias("digest"), "kids"), "level")
        runs.append(level)
        nodes, kid = level, ["pos", "digest"]
        ends.append(level.where("n = 1").select("tree", "digest"))
    return runs, reduce(DataFrame.unionByName, ends)


def _node(level: int, tree: Column, pos: Column, n: Column) -> Column:
    """Name of a node; the last node of a source's tree is a leaf of the tree over the subroots."""
    last = (tree != _TOP) & (n == 1)
    return F.struct(
        F.when(last, F.lit(_TOP)).otherwise(tree).cast("long").alias("tree"), F.when(last, F.lit(0)).otherwise(F.lit(level)).alias("level"),
        F.when(last, tree).otherwise(pos).cast("long").alias("pos"),
    )


def _members(run: DataFrame, level: int, payload: list[str]) -> DataFrame:
    """The kids of the runs whose parents are on ``level``: (tree, payload, digest, node, up, steps), ``steps`` with one step."""
    each = run.select("tree", "pos", "n", "kids", F.posexplode("kids").alias("i", "kid"))

    def beside(a: str, b: str) -> Column:
        kids = F.filter("kids", lambda k: (k["pos"] >= F.expr(a)) & (k["pos"] < F.expr(b)))
        return F.unhex(F.array_join(F.transform(kids, lambda k: F.hex(k["digest"])), ""))

    step = F.struct(beside("kid.pos - i", "kid.pos").alias("left"), beside("kid.pos + 1", "kid.pos + 3").alias("right"))
    node = F.struct(F.col("tree"), F.lit(level - 1).alias("level"), F.col("kid.pos").alias("pos"))
    return each.select(
        "tree", *[F.col(f"kid.{p}").alias(p) for p in payload], F.col("kid.digest").alias("digest"), node.alias("node"),
        _node(level, F.col("tree"), F.col("pos"), F.col("n")).alias("up"), F.array(step).alias("steps"),
    )


def merkle_proofs(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    Leaves of a source ascend by id (rows without one first, equal ids by their leaf), runs of three nodes become one until one is left, the subroot;
    subroots in the order of their sources (null first, bytewise) become the root in the same way. A proof lists each
    level's siblings from left to right; ``folded_root`` is the root that follows from it. Where the CRC of the id is
    even, the row is tampered with first: line breaks are taken out of its text; ``verified`` then tells whether
    that was noticed. Null is a value of its own in any field. Repeated rows have equal leaves and each its own place.
    An empty table gives an empty result; columns other than ``fields`` are not read.
    """
    values = {f: F.col(f) for f in fields}
    stripped = leaf_digest([F.regexp_replace(values[f], "\n", "") if f == text_col else values[f] for f in fields])
    tampered = F.when((F.crc32(F.col(id_col).cast("string")) % 2 == 0) & F.contains(F.col(text_col), F.lit("\n")), stripped)
    leaves = _numbered(docs.select(
        F.col(group_col).alias("source"), F.col(id_col).cast("long").alias("doc_id"), leaf_digest(list(values.values())).alias("leaf"),
        tampered.alias("tampered"),
    ))
    payload = ["doc_id", "tampered"]
    runs, subroots = _levels(leaves.select("tree", "pos", "n", F.col("leaf").alias("digest"), *payload), payload)
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("weight"))
    subroots = materialize(subroots.groupBy("tree").agg(F.first("digest").alias("subroot")).join(sizes, "tree"), "subroots")
    n_trees = subroots.count()
    top = subroots.select(F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).cast("long").alias("n"), F.col("subroot").alias("digest"))
    top_runs, root = _levels(top, [])
    root = root.first()
    root = F.lit(root["digest"].hex() if root else None).cast("string")

    alone = leaves.where("n = 1").select(
        "tree", *payload, F.col("leaf").alias("digest"), F.struct("tree", F.lit(0).alias("level"), "pos").alias("node"),
        _node(0, F.col("tree"), F.col("pos"), F.col("n")).alias("up"),
        F.array().cast("array<struct<left:binary,right:binary>>").alias("steps"),
    )
    proofs = alone
    if runs:
        proofs = _members(runs[0], 1, payload).unionByName(alone)
    inner = [_members(run, k, []) for k, run in list(enumerate(runs, 1))[1:]] + [_members(run, k, []) for k, run in enumerate(top_runs, 1)]
    longest, distance = len(runs) + len(top_runs), 1
    if inner:
        nodes = materialize(reduce(DataFrame.unionByName, inner).select("node", "up", "steps"), "nodes")
        while True:
            proofs = _jump(proofs, nodes)
            distance *= 2
            if distance > longest:
                break
            # leaves point to levels that the distance divides, in the trees of sources
            used = nodes.where((F.col("node.tree") == _TOP) | (F.col("node.level") % distance == 0))
            nodes = materialize(_jump(used, nodes), "nodes")
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    start = _hex(F.coalesce("tampered", "digest"))
    folded = F.aggregate("steps", start, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])), 256))
    narrow = proofs.select("tree", "doc_id", _hex(F.col("digest")).alias("leaf"), F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    found = lookup_join(narrow, subroots.select("tree", "subroot", "weight"), "tree", "weight")
    return found.select(
        "doc_id", "leaf", _hex(F.col("subroot")).alias("subroot"), root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def _jump(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` (up, steps, ...) moved on to where the nodes that they point to point, with the steps between."""
    targets = nodes.select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("steps").alias("_steps"))
    met = rows.join(targets, F.col("up") == F.col("_node"), "left")
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    # whoever has passed the root points to nothing, each row elsewhere, so that no join gets one hot key
    nothing = F.struct(F.lit(_DONE).cast("long").alias("tree"), F.lit(0).alias("level"), F.xxhash64("node").alias("pos"))
    return met.select(
        *[c for c in rows.columns if c not in ("up", "steps")], F.coalesce("_up", nothing).alias("up"),
        F.concat("steps", F.coalesce("_steps", none)).alias("steps"),
    )
