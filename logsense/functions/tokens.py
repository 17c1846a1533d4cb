"""Message tokens and the keys that route a message to its group of templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsense.functions.correction import WILDCARD
from logsense.functions.regex import PYTHON_SPACE
from logsense.functions.text import strip


def tokens_of(message: Column) -> Column:
    return F.split(strip(message), f"[{PYTHON_SPACE}]+")


def route_key(tokens: Column, routed: int) -> Column:
    """The leading tokens; one that holds a digit counts as a variable."""
    if routed == 0:
        return F.lit("")
    return F.regexp_replace(F.array_join(F.slice(tokens, 1, routed), " "), r"(?U)[^ ]*\d[^ ]*", WILDCARD)


def wide_hash(name: str, *cols: Column) -> list[Column]:
    """A 128-bit key as two columns: short to shuffle, safe from chance collisions at any scale."""
    return [F.xxhash64(*cols).alias(f"{name}_a"), F.xxhash64(F.lit(1), *cols).alias(f"{name}_b")]


def text_key(text: Column) -> Column:
    """A 128-bit key in one sortable column."""
    return F.unhex(F.md5(text))


def template_id(template: Column) -> Column:
    """A stable id: the first 60 bits of the MD5 of the template."""
    return F.conv(F.substring(F.md5(template), 1, 15), 16, 10).cast("bigint")
