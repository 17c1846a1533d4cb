"""Entry text -> typed log columns, as one projection without any Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsense.config import ParserConfig
from logsense.functions.regex import JavaPattern, to_java
from logsense.functions.text import blank_to_null, strip

_MARK = "\x01"  # separates captured groups on the fast path


def is_entry_start(line: Column, config: ParserConfig) -> Column:
    """A line opens an entry if any start pattern is found in it."""
    if not config.multiline:
        return F.lit(True)
    tests = [line.rlike(to_java(p).search()) for p in config.start_regexes]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def normalize_level(col: Column, level_map: dict[str, str]) -> Column:
    """Strip, drop brackets, then map by lower case or fall back to upper case."""
    bare = F.lower(strip(F.btrim(strip(col), F.lit("[]"))))
    known = {k.lower(): v for k, v in level_map.items()}
    mapped = F.upper(bare)
    if known:
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        mapped = F.coalesce(table[bare], mapped)
    return F.when(col != "", mapped)


def to_int(col: Column) -> Column:
    return F.coalesce(strip(col).try_cast("bigint"), F.lit(-1).cast("bigint"))


def _with_captures(df: DataFrame, pattern: JavaPattern, name: str, wanted: Column) -> DataFrame:
    """Add all groups of an anchored match as an array; null when the pattern does not match.

    One regex run writes the groups into one marked string; a text that holds the mark itself
    takes the group-by-group way.
    """
    rx, raw = pattern.anchored(), F.col("raw")
    if pattern.n_groups == 0:
        return df.withColumn(name, F.when(wanted & raw.rlike(rx), F.array().cast("array<string>")))
    numbers = range(1, pattern.n_groups + 1)
    slots = "".join(f"{_MARK}${i}" for i in numbers)
    held = raw.contains(_MARK)
    marked = F.when(wanted & ~held, F.regexp_replace(raw, rx + ".*", slots))
    singly = F.array(*[F.regexp_extract(raw, rx, i) for i in numbers])
    return (
        df.withColumn("_marked", marked)
        .withColumn(
            name,
            F.when(F.col("_marked").startswith(_MARK), F.split(F.expr("substring(_marked, 2)"), _MARK, -1)).when(
                wanted & held & raw.rlike(rx), singly
            ),
        )
        .drop("_marked")
    )


def parse_entries(entries: DataFrame, config: ParserConfig = ParserConfig()) -> DataFrame:
    """Apply the pattern cascade to ``raw``; the first pattern that matches wins.

    Input columns ``log_file, start_line_no, raw``; any others are carried along.
    """
    patterns = [to_java(p) for p in config.patterns]
    raw = F.col("raw")
    df = entries
    for i, pattern in enumerate(patterns):
        missed = reduce(lambda a, b: a & b, [F.col(f"_g{j}").isNull() for j in range(i)], F.lit(True))
        df = _with_captures(df, pattern, f"_g{i}", missed)

    # One pass through a generator: without it a filter on a parsed column would be pushed below
    # the captures and repeat all regexes inside itself.
    caught = [f"_g{i}" for i in range(len(patterns))]
    if caught:
        df = df.select(*entries.columns, F.inline(F.array(F.struct(*caught))))

    def field(name: str, convert, missing: Column, fallback: Column) -> Column:
        """The group of the matching pattern; ``missing`` if that pattern lacks it."""
        out = None
        for i, pattern in enumerate(patterns):
            hit = F.col(f"_g{i}").isNotNull()
            value = convert(F.col(f"_g{i}")[pattern.groups[name] - 1]) if name in pattern.groups else missing
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return fallback if out is None else out.otherwise(fallback)

    null = F.lit(None).cast("string")
    none = F.lit(-1).cast("bigint")
    any_hit = reduce(lambda a, b: a | b, [F.col(f"_g{i}").isNotNull() for i in range(len(patterns))], F.lit(False))
    own = {
        "parsing_status": F.when(any_hit, "parsed").otherwise("raw"),
        "timestamp": field("timestamp", blank_to_null, null, null),
        "level": field("level", lambda c: normalize_level(c, config.level_map), null, null),
        "component": field("component", blank_to_null, null, null),
        "pid": field("pid", to_int, none, none),
        "tid": field("tid", to_int, none, none),
        "file_guid_prefix": field("file_guid_prefix", blank_to_null, null, null),
        "line_no": field("line_no", to_int, none, F.col("start_line_no").cast("bigint")),
        "message": field("message", strip, strip(raw), raw),
    }
    first = [F.col("log_file"), raw] + [c.alias(n) for n, c in own.items()] + [F.col("start_line_no")]
    rest = [c for c in entries.columns if c not in {"log_file", "raw", "start_line_no", *own}]
    return df.select(*first, *rest)


def effective_message(message_col: str = "message") -> Column:
    """The message, or the raw text when it is empty; null when both are."""
    return F.coalesce(F.nullif(F.col(message_col), F.lit("")), F.nullif(F.col("raw"), F.lit("")))


def event_time(col: Column = None) -> Column:
    """The timestamp text as a time value where it reads as one, else null."""
    text = F.col("timestamp") if col is None else col
    return F.try_to_timestamp(F.translate(text, ",T", ". "))
