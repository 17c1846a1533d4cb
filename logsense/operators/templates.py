"""The template table: sizes, ids, the match of messages, and assignment to log rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsense.config import MinerConfig
from logsense.functions.correction import WILDCARD, with_correction
from logsense.functions.tokens import route_key, template_id, tokens_of, wide_hash
from logsense.operators.frequency import distinct_messages
from logsense.operators.joins import lookup_join
from logsense.operators.template_trie import TemplateTrie
from logsense.session import materialize
from logsense.sources.paths import open_path


def template_table(assigned: DataFrame, config: MinerConfig = MinerConfig()) -> DataFrame:
    """``template, n`` per message -> one row per template with its size."""
    sized = assigned.groupBy("template").agg(F.sum("n").alias("size"))
    return describe_templates(sized, config)


def describe_templates(sized: DataFrame, config: MinerConfig = MinerConfig()) -> DataFrame:
    """``template, size`` -> the full template schema."""
    tokens = tokens_of(F.col("template"))
    return with_correction(
        sized.withColumn("cluster_id", template_id(F.col("template"))), config.apply_correction, config.user_strings
    ).select(
        "cluster_id",
        "template",
        "corrected_template",
        "was_corrected",
        "size",
        F.size(tokens).alias("n_tokens"),
        route_key(tokens, config.routed_tokens).alias("route_key"),
        tokens.alias("tokens"),
    )


def match_messages(messages: DataFrame, templates: DataFrame) -> DataFrame:
    """Distinct ``message, n`` -> the same rows with ``template, cluster_id`` or nulls.

    A template matches a message of equal length whose tokens equal all its constants; the match with the most constants
    wins, then the smallest id. So one that is the message itself wins, and one without a wildcard matches nothing else:
    these meet by their 128-bit ids. The templates with wildcards are stored in parts of at most TRIE_BYTES by length and first
    token, and a task builds the trie of a part when it meets a message for it. One part needs no shuffle; with more, a
    message goes to the part of its own first token and to that of the wildcard, and the better match is kept. The messages
    of a part are dealt over SALTS tasks, so that one that holds most of them is no bottleneck.
    """
    ids = ["id_a", "id_b"]
    is_wild = F.array_contains(F.split("template", " "), WILDCARD)
    known = templates.select("template", "cluster_id").filter("template is not null")
    size, plain = known.agg(
        F.sum(F.when(is_wild, F.octet_length("template") + _TRIE_OVERHEAD)), F.count(F.when(~is_wild, True))
    ).first()
    rest, same = messages.select("message", "n"), None
    if plain:
        text = F.array_join(tokens_of(F.col("message")), " ")
        own = known.filter(~is_wild).groupBy(*wide_hash("id", F.col("template"))).agg(F.min("cluster_id").alias("cluster_id"))
        met = messages.select("message", "n", *wide_hash("id", text)).join(own, ids, "left").drop(*ids)
        met = materialize(met, "met", codec=TEXT_CODEC)
        same = met.filter("cluster_id is not null").select("message", "n", text.alias("template"), "cluster_id")
        rest = met.filter("cluster_id is null").select("message", "n")
    matched = _match_wild(rest, known.filter(is_wild), max(1, -(-(size or 0) // TRIE_BYTES)))
    return matched if same is None else same.unionByName(matched)


def _match_wild(messages: DataFrame, templates: DataFrame, parts: int) -> DataFrame:
    """``message, n, template, cluster_id`` of the best template by tries of so many parts."""
    tokens = tokens_of(F.col("template"))
    part = F.pmod(F.xxhash64(F.size(tokens), F.get(tokens, F.lit(0))), F.lit(parts)).cast("int")
    slim = templates.select("template", "cluster_id", part.alias("part"))
    stored = materialize(slim.repartition(parts, "part"), "tries", ("part",))
    folder = stored._logsense_path
    named = messages.select("message", "n", tokens_of(F.col("message")).alias("tokens"))
    if parts == 1:
        return named.withColumn("part", F.lit(0)).mapInArrow(_matcher(folder), _MATCHED).select("message", "n", "template", "cluster_id")
    ids = ["id_a", "id_b"]
    keyed = materialize(named.select(*wide_hash("id", F.col("message")), "message", "n"), "named")
    tokens = tokens_of(F.col("message"))
    leads = F.array_distinct(F.array(F.get(tokens, F.lit(0)), F.lit(WILDCARD)))
    tries = keyed.select(*ids, tokens.alias("tokens"), F.explode(leads).alias("_lead")).select(
        *ids, "tokens", F.pmod(F.xxhash64(F.size("tokens"), "_lead"), F.lit(parts)).cast("int").alias("part")
    ).distinct()
    dealt = tries.repartition("part", F.pmod("id_a", F.lit(SALTS))).sortWithinPartitions("part")
    found = dealt.mapInArrow(_matcher(folder, ids), f"id_a bigint, id_b bigint, {_HIT}").filter("template is not null")
    best = found.groupBy(*ids).agg(F.max(F.struct("constants", (-F.col("cluster_id")).alias("_order"), "template", "cluster_id")).alias("_hit"))
    return keyed.join(best, ids, "left").select("message", "n", "_hit.template", "_hit.cluster_id")


#: How stored texts are packed where a job keeps several copies of them.
TEXT_CODEC = "zstd"
#: Most bytes of templates in a trie, counting a fixed number for each.
TRIE_BYTES, _TRIE_OVERHEAD = 32 << 20, 256
SALTS = 64
_HIT = "template string, cluster_id bigint, constants int"
_MATCHED = f"message string, n bigint, {_HIT}"


def _matcher(folder: str, kept: Sequence[str] = ("message", "n")) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(kept, tokens, part) -> (kept, template, cluster_id, constants), with the tries below ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, trie = None, TemplateTrie([])
        constants: list[int] = []
        for batch in batches:
            out: list[tuple] = []
            for tokens, part in zip(batch.column("tokens").to_pylist(), batch.column("part").to_pylist()):
                if part != loaded:
                    trie, loaded = TemplateTrie(_read_part(folder, part)), part
                    constants = [sum(t != WILDCARD for t in template.split(" ")) for template, _ in trie.templates]
                place = trie.best(tokens) if tokens else None
                if place is None:
                    out.append((None, None, None))
                else:
                    template, cluster_id = trie.templates[place]
                    out.append((template, cluster_id, constants[place]))
            names, ids, counts = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(ids, pa.int64()), pa.array(counts, pa.int32())],
                names=[*kept, "template", "cluster_id", "constants"],
            )

    return run


def _read_part(folder: str, part: int) -> list[tuple[str, int]]:
    system, root = open_path(f"{folder}/part={part}")
    files = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    found: list[tuple[str, int]] = []
    for info in files:
        if info.base_name.endswith(".parquet"):
            table = pq.read_table(info.path, filesystem=system, columns=["template", "cluster_id"], partitioning=None)
            found += zip(table["template"].to_pylist(), table["cluster_id"].to_pylist())
    return found


def message_templates(logs: DataFrame, templates: DataFrame, message_col: str = "message") -> DataFrame:
    """``message, n, template, is_new`` per distinct text of ``logs``, stored; an unmatched one is its own template."""
    messages = materialize(distinct_messages(logs, message_col), "messages")
    matched = match_messages(messages, materialize(templates, "templates"))
    lookup = matched.select(
        F.col("message").alias(message_col),
        "n",
        F.coalesce("template", "message").alias("template"),
        F.col("template").isNull().alias("is_new"),
    )
    return materialize(lookup, "lookup")


def match_logs(logs: DataFrame, templates: DataFrame, message_col: str = "message") -> DataFrame:
    """Give each log row its template; an unmatched message is its own template.

    Adds ``template`` and ``is_new``. Nothing is learned.
    """
    return with_templates(logs, message_templates(logs, templates, message_col), message_col)


def with_templates(logs: DataFrame, lookup: DataFrame, message_col: str = "message") -> DataFrame:
    """The log rows with what ``lookup`` has for their message; a row without text is its own template."""
    rows = lookup_join(logs, lookup, message_col, "n")
    return rows.withColumn("template", F.coalesce("template", F.col(message_col))).withColumn(
        "is_new", F.coalesce("is_new", F.lit(True))
    )


def new_messages(matched_logs: DataFrame, message_col: str = "message") -> DataFrame:
    """The rows no template matched."""
    return matched_logs.filter("is_new").select("log_file", F.col(message_col).alias("new_log_message"))


def assign_templates(logs: DataFrame, assigned: DataFrame, message_col: str = "message") -> DataFrame:
    """Training rows with the template found for their message; rows without text are left out."""
    lookup = assigned.select(F.col("message").alias(message_col), "n", "template")
    return lookup_join(logs.filter(F.col(message_col) != ""), materialize(lookup, "lookup"), message_col, "n", how="inner")
