"""Distance thresholds: exact percentiles per cluster or over all, at any size."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsense.operators.clustering import MAX_CENTERS, ClusterModel, assign
from logsense.session import materialize

DIRECT_ROWS = 1_000_000
_SLICES = 1024


def group_percentiles(df: DataFrame, group: str, value: str, percent: float, direct_rows: int = DIRECT_ROWS) -> list[tuple]:
    """``(group, percentile, n)`` with linear interpolation, for at most MAX_CENTERS groups.

    The built-in percentile keeps all distinct values of a group in one buffer, so it only serves
    while no group exceeds ``direct_rows``. Larger groups are narrowed down: slice counts, added
    up on the map side, tell which slice holds the wanted rank, until few values are left.
    """
    values = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    stats = values.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    groups = stats.limit(MAX_CENTERS + 1).collect()
    if len(groups) > MAX_CENTERS:
        raise ValueError(f"more than {MAX_CENTERS} groups")
    if not groups:
        return []
    if max(r["n"] for r in groups) <= direct_rows:
        direct = values.groupBy("g").agg(F.percentile("v", F.lit(percent / 100)).alias("t"), F.count("*").alias("n"))
        return sorted((r["g"], r["t"], r["n"]) for r in direct.collect())

    targets = {}
    for r in groups:
        rank = percent / 100 * (r["n"] - 1)
        for wanted in {math.floor(rank), math.ceil(rank)}:
            targets[(r["g"], wanted)] = (r["lo"], r["hi"], wanted, r["n"])
    exact = _order_statistics(values, targets, direct_rows)
    out = []
    for r in groups:
        rank = percent / 100 * (r["n"] - 1)
        low, high = exact[(r["g"], math.floor(rank))], exact[(r["g"], math.ceil(rank))]
        part = rank - math.floor(rank)
        out.append((r["g"], low if part == 0 or low == high else (1 - part) * low + part * high, r["n"]))
    return sorted(out)


def _order_statistics(values: DataFrame, targets: dict, direct_rows: int) -> dict:
    """The value at each (group, rank); targets hold (lowest, highest, rank among them, rows)."""
    spark = values.sparkSession
    group_type = values.schema["g"].dataType.simpleString()
    schema = f"g {group_type}, wanted bigint, lo double, hi double, r bigint"
    running = Window.partitionBy("g", "wanted").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    stuck: set = set()  # ranges that slices cannot narrow, as with infinite values
    while True:
        open_ = {t: s for t, s in targets.items() if s[0] < s[1] and s[3] > direct_rows and t not in stuck}
        if not open_:
            break
        state = spark.createDataFrame([(g, w, s[0], s[1], s[2]) for (g, w), s in open_.items()], schema)
        share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        slot = F.least(F.floor(F.when(F.isnan(share), 1.0).otherwise(share) * _SLICES), F.lit(_SLICES - 1))
        rows = (
            values.join(F.broadcast(state), "g")
            .filter("v BETWEEN lo AND hi")
            .groupBy("g", "wanted", "r", slot.alias("slot"))
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .withColumn("below", F.coalesce(F.sum("n").over(running), F.lit(0)))
            .filter("below <= r AND r < below + n")
            .collect()
        )
        for x in rows:
            narrowed = (x["lo"], x["hi"], x["r"] - x["below"], x["n"])
            if narrowed[:2] == targets[(x["g"], x["wanted"])][:2]:
                stuck.add((x["g"], x["wanted"]))
            targets[(x["g"], x["wanted"])] = narrowed
    found = {t: s[0] for t, s in targets.items() if s[0] == s[1]}
    rest = {t: s for t, s in targets.items() if t not in found}
    if rest:
        state = spark.createDataFrame([(g, w, s[0], s[1], s[2]) for (g, w), s in rest.items()], schema)
        by_value = Window.partitionBy("g", "wanted").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        rows = (
            values.join(F.broadcast(state), "g")
            .filter("v BETWEEN lo AND hi")
            .groupBy("g", "wanted", "r", "v")
            .agg(F.count("*").alias("n"))
            .withColumn("below", F.coalesce(F.sum("n").over(by_value), F.lit(0)))
            .filter("below <= r AND r < below + n")
            .collect()
        )
        found.update({(x["g"], x["wanted"]): x["v"] for x in rows})
    return found


def sketched_percentiles(df: DataFrame, group: str, value: str, percent: float, accuracy: int) -> dict:
    """group -> (percentile, n), and None -> that of all rows, from sketches that tasks build and merge in one pass.

    A sketch holds a number of values that follows ``accuracy``, not the rows; ranks are off by n / ``accuracy`` at most.
    """
    values = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("g IS NOT NULL AND v IS NOT NULL")
    sketch = F.percentile_approx("v", percent / 100, accuracy)
    rows = values.rollup("g").agg(sketch.alias("t"), F.count("*").alias("n")).limit(MAX_CENTERS + 2).collect()
    if len(rows) > MAX_CENTERS + 1:
        raise ValueError(f"more than {MAX_CENTERS} groups")
    return {r["g"]: (r["t"], r["n"]) for r in rows if r["n"]}


def learn_thresholds(
    vectors: DataFrame,
    model: ClusterModel,
    percent: float = 99.0,
    vector_col: str = "embedding",
    direct_rows: int = DIRECT_ROWS,
    accuracy: int | None = None,
) -> ClusterModel:
    """The model with a threshold per cluster and a common one; an empty cluster has none.

    With ``accuracy`` the percentiles come from sketches instead, in one pass: a threshold is then a distance that occurs,
    and its rank is off by at most the number of vectors (of the cluster, or of all) / ``accuracy``.
    """
    if accuracy is not None:
        found = sketched_percentiles(assign(vectors.select(vector_col), model, vector_col), "cluster", "distance", percent, accuracy)
        common = found.pop(None, (None, 0))[0]
        limits, sizes = {g: t for g, (t, _) in found.items()}, {g: n for g, (_, n) in found.items()}
        return replace(model, thresholds=limits, sizes=sizes, common_threshold=common)
    distances = materialize(
        assign(vectors.select(vector_col), model, vector_col).select("cluster", "distance", F.lit(0).alias("all_rows")),
        "distances",
    )
    per_cluster = group_percentiles(distances, "cluster", "distance", percent, direct_rows)
    common = group_percentiles(distances, "all_rows", "distance", percent, direct_rows)
    return replace(
        model,
        thresholds={g: t for g, t, _ in per_cluster},
        sizes={g: n for g, _, n in per_cluster},
        common_threshold=common[0][1] if common else None,
    )
