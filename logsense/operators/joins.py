"""Left lookup join that stays balanced when single keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

HOT_KEYS = 1000
#: Most bytes of lookup rows in a broadcast; texts longer than that stay with the shuffled rest.
HOT_BYTES = 32 << 20
SALTS = 1024
#: Most rows of keys that go to all tasks.
SENT_ROWS = 1 << 20


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, weight: str, how: str = "left") -> DataFrame:
    """``rows`` joined to ``lookup`` (unique on ``key``), where ``weight`` counts the rows of a key.

    ``lookup`` is read twice: pass a stored table.

    The HOT_KEYS keys with the most rows are broadcast, as far as they have HOT_BYTES in all (a row's size is
    that of its text): a fixed bound, whatever the data size. Every other key holds less than 1/HOT_KEYS
    of the rows, so the shuffle for the rest is even; the rows already served are spread by a salt
    that no lookup row carries. Null keys are spread likewise. With ``how="inner"`` a lookup within HOT_BYTES
    is broadcast whole, so that rows without a match end there; a larger one is an inner join, whose
    hot keys adaptive execution splits.
    """
    values = [c for c in lookup.columns if c not in (key, weight)]
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in lookup.columns])))
    if how == "inner":
        small = (lookup.agg(F.sum(size)).first()[0] or 0) <= HOT_BYTES
        chosen = lookup.select(key, *values)
        joined = rows.join(F.broadcast(chosen) if small else chosen, key)
        return joined.select(*rows.columns, *values)
    hot = lookup.withColumn("_size", size).filter(F.col("_size") <= HOT_BYTES // HOT_KEYS)
    hot = hot.orderBy(F.desc(weight), key).limit(HOT_KEYS)
    hot = hot.select(key, F.struct(F.lit(True).alias("hit"), *values).alias("_hot"))
    cold = lookup.select(F.col(key).alias("_key"), F.lit(0).alias("_slot"), F.struct(*values).alias("_cold"))

    plain = [f.name for f in rows.schema if not isinstance(f.dataType, (MapType, VariantType))]
    spread = (F.pmod(F.xxhash64(*plain), F.lit(SALTS)) + 1).cast("int")
    served = rows.join(F.broadcast(hot), key, "left")
    keyed = served.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key))).withColumn(
        "_slot", F.when(F.col("_key").isNull(), spread).otherwise(F.lit(0))
    )
    joined = keyed.join(cold, ["_key", "_slot"], "left")

    def pick(name: str) -> Column:
        return F.when(F.col("_hot").isNotNull(), F.col("_hot")[name]).otherwise(F.col("_cold")[name])

    return joined.select(*rows.columns, *[pick(v).alias(v) for v in values])


def sent(keys: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """``keys``, a stored table of short rows, as the side of a join that goes to all tasks if it has ``most`` rows at most."""
    return F.broadcast(keys) if keys.count() <= most else keys
