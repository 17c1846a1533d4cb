"""Line cleaning as plain column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: characters ------------------------------------------------------------
# Unicode white space as Python strips it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# A leading run of these is dropped: BOM, replacement character, and both when mis-decoded.
BAD_PREFIXES = ("\ufeff", "\ufffd", "\u00ef\u00bb\u00bf", "\u00ef\u00bf\u00bd")
NBSP = "\u00a0"
BOM = "\ufeff"
ZERO_WIDTH_AND_BIDI = "\u200b\u200c\u200d\u2060\u200e\u200f"
# -----------------------------------------------------------------------------------------


def strip(col: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def let(col: Column, body) -> Column:
    """``body(col)`` with ``col`` computed once, however often the body uses it."""
    return F.transform(F.array(col), body)[0]


def sanitize(col: Column) -> Column:
    """Drop the bad prefix run and invisible marks; a no-break space becomes a space.

    Pure ASCII text, told by its byte count, holds none of them and is left as it is.
    """
    no_prefix = F.regexp_replace(col, "^(?:" + "|".join(BAD_PREFIXES) + ")+", "")
    cleaned = F.translate(no_prefix, NBSP + BOM + ZERO_WIDTH_AND_BIDI, " ")
    return F.when(F.length(col) == F.octet_length(col), col).otherwise(cleaned)


def clean_line(col: Column) -> Column:
    """Strip first, then sanitize: a blank exposed by sanitizing stays."""
    return sanitize(strip(col))


def split_lines(col: Column) -> Column:
    """Lines of a whole text. ``\\n``, ``\\r\\n`` and a lone ``\\r`` end a line."""
    newline = F.lit("\n")
    body = F.replace(F.replace(col, F.lit("\r\n"), newline), F.lit("\r"), newline)
    parts = F.split(body, "\n", -1)
    ended = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.when(col == "", F.array().cast("array<string>")).otherwise(
        F.when(body.endswith("\n"), ended).otherwise(parts)
    )
