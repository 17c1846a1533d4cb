"""Exact-size repeatable samples without sorting the data in one place."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, id_col: str, size: int, seed: int = 42) -> DataFrame:
    """The ``size`` rows that come first in the order of a hash of their id and the seed.

    A count tells which hash range must hold them; only keys of that range are sorted, and the
    rows are then picked by a plain filter. ``size <= 0`` or a size above the count means all rows.
    """
    total = df.count()
    if size <= 0 or size >= total:
        return df
    key = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    keys = df.select(key.alias("h"), F.col(id_col).alias("i"))
    share = (size + 6 * math.sqrt(size) + 16) / total
    while True:
        ranged = keys
        if share < 1:
            ranged = keys.filter(F.col("h") < f"{int(share * 16**8):08x}")
        last = ranged.orderBy("h", "i").offset(size - 1).first()
        if last is not None:
            break
        share *= 2
    return df.filter((key < last["h"]) | ((key == last["h"]) & (F.col(id_col) <= last["i"])))
