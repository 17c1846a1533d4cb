"""Quality rules as a short-circuit cascade, ordered by rejection per cost as measured on a sample."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsense.llm.texts import SPACE_CHARS, words
from logsense.session import materialize

SYMBOLS = "#*$%&|<>"
#: About so many rows of the table estimate costs and selectivities; they decide the order of rules alone.
SAMPLE_ROWS = 2000


def count_chars(text: Column, chars: str) -> Column:
    """How often any of ``chars`` stands in a text."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``rejects`` holds for bad texts; it may use ``text`` and the columns that ``text_counts`` adds."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    upper, lower = (count_chars(_text(), "".join(map(chr, range(ord(a), ord(a) + 26)))) for a in "Aa")
    lines = F.size(F.filter(F.split(_text(), "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0))
    return [
        Rule("symbols", F.expr("10 * n_symbols > n_words")),
        Rule("word_length", F.expr("word_chars < 2 * n_words or word_chars > 15 * n_words")),
        Rule("digits", 4 * count_chars(_text(), "0123456789") > F.col("word_chars")),
        Rule("shouting", upper > lower),
        Rule("dup_lines", 10 * F.col("n_dup_lines") > 6 * lines),
    ]


def text_counts(docs: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words beside ``doc_id`` and ``text``.

    Words are split off once. Windows of three words are compared as strings; only texts with a repeated
    window sort them to find the words they cover.
    """
    split = docs.select("doc_id", "text", words(F.col("text")).alias("w"))
    window = lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    windows = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), window))
    with_windows = split.select("doc_id", "text", F.size("w").cast("long").alias("n_words"), windows.alias("g"))
    repeats = F.size(F.array_distinct("g")) < F.size("g")
    ordered = F.when(repeats, F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("g"), i.alias("p")))))
    with_order = with_windows.select("doc_id", "text", "n_words", ordered.alias("s"))
    same = lambda x, k: F.coalesce(F.get("s", k - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get("s", k + 1)["g"] == x["g"], F.lit(False))
    places = F.transform(F.filter("s", same), lambda x: x["p"])
    with_places = with_order.select("doc_id", "text", "n_words", places.alias("p"))
    covered = F.size(F.array_distinct(F.concat(F.col("p"), F.transform("p", lambda x: x + 1), F.transform("p", lambda x: x + 2))))
    lines = F.filter(F.split(_text(), "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    with_lines = with_places.select(
        "doc_id", "text", "n_words", F.when(F.col("p").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
        lines.alias("lines"),
    )
    counts = F.struct(
        "n_words", F.length(F.translate(_text(), SPACE_CHARS, "")).cast("long").alias("word_chars"),
        count_chars(_text(), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
    )
    # through a generator, so that a filter on a count is not evaluated below it, with the split in its loops
    return with_lines.select("doc_id", "text", F.inline(F.array(counts)))


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def rules_by_gain(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, share rejected, seconds), best rejection per second first, from a sample chosen by a hash.

    The order affects only how soon a bad text leaves the cascade, never the verdict.
    """
    total = docs.count()
    part = max(1, total // max(1, sample_rows))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(part)) == 0)
    sample = materialize(text_counts(chosen), "rule-sample")

    def measured(column: Column) -> tuple[float, float]:
        runs = []
        for _ in range(2):
            began = time.perf_counter()
            row = sample.agg(F.avg(column.cast("int")), F.max("doc_id")).first()
            runs.append(time.perf_counter() - began)
        return float(row[0] or 0.0), min(runs)

    idle = measured(F.lit(False))[1]
    found = [(rule, *measured(rule.rejects)) for rule in rules]
    gains = [(rule, share, max(seconds - idle, 1e-4)) for rule, share, seconds in found]
    return sorted(gains, key=lambda x: (-x[1] / x[2], x[0].name))


def judge(
    docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and failed_rule for every row of ``docs``.

    A row is kept unless the base fails or a rule rejects it. ``failed_rule`` names the rule that ended the
    cascade ("base" first); where several would reject, it depends on the measured order. Null texts have
    no words and fail the base, as do empty ones. Repeated rows are judged each; other columns of ``docs``
    are not read; an empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cascade = F.when(base_failed(), F.lit("base"))
    for rule, _, _ in rules_by_gain(slim, default_rules() if rules is None else rules):
        cascade = cascade.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name))
    judged = text_counts(slim).withColumn("base_failed", base_failed()).withColumn("failed_rule", cascade)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("failed_rule").isNull().alias("kept"), "failed_rule",
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns; no join is needed."""
    cascade = F.when(base_failed(), F.lit("base"))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    for rule, _, _ in rules_by_gain(slim, default_rules() if rules is None else rules):
        cascade = cascade.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name))
    # the counts carry the whole row along as the id
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col(text_col).alias("text"))
    return text_counts(carried).where(cascade.isNull()).select("doc_id.*")
