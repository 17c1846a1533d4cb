"""Template correction: variable-looking parts become ``<*>``, as a chain of column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsense.functions.regex import to_java
from logsense.functions.text import let, strip

# --- Fixed values: the rules, in order ---------------------------------------------------
WILDCARD = "<*>"
DIGITS = r"\b\d+\b"
BOOLEANS = r"\b(?:true|false)\b"
WINDOWS_PATH = r"(?<![A-Za-z0-9._-])(?:[A-Za-z]:\\(?:[^\\\s]+\\)*[^\\\s]+\\?)(?![A-Za-z0-9._-])"
UNIX_PATH = r"(?<![A-Za-z0-9._-])(?:~?/)(?:[A-Za-z0-9._-]+/)*[A-Za-z0-9._-]+/?(?![A-Za-z0-9._-])"
MIXED_TOKEN = r'''(?:(?<=^)|(?<=[\s,;:(){}\[\]"\'\']))[^ ,\s;:(){}\[\]"\'\']*<\*>[^,\s;:(){}\[\]"\'\']*(?=(?:$|[\s,;:(){}\[\]"\']))'''
DOTTED_CHAIN = r"(?:<\*>\s*\.\s*)+<\*>"
WILDCARD_RUN = r"(?:<\*>\s*)+<\*>"
BLANK_RUN = r"[ \t]{2,}"
BEFORE_USER_TERMS, AFTER_USER_TERMS = r"(?<!\w)(?:", r")(?!\w)"
# -----------------------------------------------------------------------------------------
_ANY_CASE = "(?iuUd)"


def _user_terms_pattern(terms: Iterable[str]) -> str | None:
    distinct = sorted({t for t in terms if t}, key=lambda t: (-len(t), t))
    if not distinct:
        return None
    return BEFORE_USER_TERMS + "|".join(re.sub(r"([^\w\s])", r"\\\1", t) for t in distinct) + AFTER_USER_TERMS


def correct_template(template: Column, user_strings: Iterable[str] = ()) -> Column:
    """Ten rules in a fixed order; null gives an empty string.

    A plain substring test keeps a pattern from running where it cannot match.
    """

    def rule(col: Column, pattern: str | None, flags: str = "(?Ud)") -> Column:
        return col if pattern is None else F.regexp_replace(col, flags + to_java(pattern).body, WILDCARD)

    def where(text: str, *patterns: str):
        return lambda c: F.when(c.contains(text), reduce(rule, patterns, c)).otherwise(c)

    out = rule(rule(F.coalesce(template, F.lit("")), DIGITS), BOOLEANS, _ANY_CASE)
    out = let(let(out, where(":\\", WINDOWS_PATH)), where("/", UNIX_PATH))
    out = rule(out, _user_terms_pattern(user_strings), _ANY_CASE)
    out = let(out, where(WILDCARD, MIXED_TOKEN, DOTTED_CHAIN, WILDCARD_RUN))
    runs = let(out, lambda c: F.when(c.contains("  ") | c.contains("\t"), F.regexp_replace(c, BLANK_RUN, " ")).otherwise(c))
    return strip(runs)


def with_correction(templates, enabled: bool, user_strings: Iterable[str] = ()):
    """Add ``corrected_template`` and ``was_corrected``; off means the template as it is."""
    corrected = correct_template(F.col("template"), user_strings) if enabled else F.col("template")
    return templates.withColumn("corrected_template", corrected).withColumn(
        "was_corrected", F.col("template") != F.col("corrected_template")
    )
