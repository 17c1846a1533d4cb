"""Benchmark items in texts, verbatim or re-parameterised: bare and template windows, consistent slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsense.session import materialize

# Units of measure that count as such after a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hrs hour hours day days week weeks month months "
    "year years mph kmh hz khz mhz ghz w kw mw j kj cal kcal v a pa bar k c f usd eur gbp dollars euros cents percent"
).split()

#: Tokens of a template window, and the least number of them that are words and not placeholders.
WINDOW, LITERALS = 5, 3
#: An item is in a document if this share of its windows is, or this many that line up (13 tokens).
COVERAGE, RUN = 0.5, 9
#: Windows of benchmark items that may be broadcast; with more, the join shuffles.
BROADCAST_WINDOWS = 1_000_000

_NAME, _UNIT = "\u0001", "\u0002"


def marked_tokens(text: Column) -> Column:
    """Lower-case tokens; names carry the mark U+0001 and units after a number U+0002, numbers start with a digit.

    A name is a capitalised word after a word or comma and a blank or line break, not at the start of a sentence.
    """
    text = F.coalesce(text, F.lit(""))
    text = F.when(text.contains(_NAME) | text.contains(_UNIT), F.translate(text, _NAME + _UNIT, "  ")).otherwise(text)
    numbers = F.regexp_replace(text, r"[.,](?<=[0-9][.,])(?=[0-9])", "")
    units = F.regexp_replace(numbers, rf"(?i)(?<=[0-9]) ?({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f" {_UNIT}$1")
    text = F.when(text.rlike("[0-9]"), units).otherwise(text)
    # the cheaper test comes first at each place
    text = F.regexp_replace(text, r"(?=\p{Lu}\p{Ll})(?<=[\p{L}0-9,;](?: |\r?\n))", _NAME)
    return F.split(F.lower(text), r"[^\p{L}\p{N}\x01\x02]+")


def with_tokens(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the column ``tok`` of its marked tokens; only the first and last part of a split can be empty."""
    parts = df.withColumn("tok", marked_tokens(text))
    before = (F.get("tok", F.lit(0)) == "").cast("int")
    after = (F.element_at("tok", -1) == "").cast("int")
    return parts.withColumn("tok", F.slice("tok", before + 1, F.greatest(F.size("tok") - before - after, F.lit(0))))


def _kind(token: Column) -> Column:
    first = F.ascii(token)
    return F.when(first.between(48, 57), "<num>").when(first == 1, "<name>").when(first == 2, "<unit>")


def _bare(token: Column) -> Column:
    """A token without its mark."""
    return F.translate(token, _NAME + _UNIT, "")


def _special(token: Column) -> Column:
    """Whether a token is a placeholder: of all first characters only digits and the marks come before the colon."""
    return token < ":"


#: Forms of a token: all placeholders, names as plain words, bare.
_FORMS = ("named", "plain", "raw")


def _token_hashes(form: str) -> Column:
    def of(x: Column) -> Column:
        special = {"named": _kind(x), "plain": F.when(x < _UNIT, _bare(x)).otherwise(_kind(x)), "raw": _bare(x)}[form]
        return F.when(_special(x), F.xxhash64(special)).otherwise(F.xxhash64(x))

    return F.transform("tok", of).alias(form)


def _window_key(form: str, width: int = WINDOW) -> Column:
    """Hash of the tokens from ``at`` on, in one of their forms."""
    return F.xxhash64(*([] if width == WINDOW else [F.lit(width)]), *[F.get(form, F.col("at") + k) for k in range(width)])


def _places(texts: DataFrame, *keys: str, least: int = WINDOW) -> DataFrame:
    """(keys, tok, hashes of tokens per form, at): a row for each place of a text with ``least`` tokens from there."""
    hashed = texts.select(*keys, "tok", *map(_token_hashes, _FORMS))
    starts = F.when(F.size("tok") >= least, F.sequence(F.lit(0), F.size("tok") - least))
    return hashed.select(*keys, "tok", *_FORMS, F.explode(starts).alias("at"))


def _slots(tok: str, at: str) -> Column:
    """The tokens of a window that are placeholders, else null, so that two windows can be zipped."""
    return F.transform(F.slice(tok, F.col(at) + 1, WINDOW), lambda x: F.when(_kind(x).isNotNull(), x))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, item_key, n_windows, n_all, item_at, width, window, typed, template, item_slots) of the windows of all items.

    Each place is taken as bare tokens and, where enough words are left, with names as placeholders and as plain words:
    a document in one case has no names to be seen. ``typed``: one of the latter two is there (``template``: it is this
    window); ``n_windows`` counts these places and ``n_all`` all. An item of fewer tokens than a window is one window of bare tokens.
    """
    items = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null")
    items = with_tokens(items, F.col("text")).select("item_id", "tok")
    items = items.withColumn("item_key", F.xxhash64("tok"))
    kinds = F.transform(F.slice("tok", F.col("at") + 1, WINDOW), _kind)
    words = F.size(F.filter(kinds, lambda x: x.isNull()))
    words_and_names = F.size(F.filter(kinds, lambda x: x.isNull() | (x == "<name>")))
    templates = F.array(F.when(words >= LITERALS, _window_key("named")), F.when(words_and_names >= LITERALS, _window_key("plain")))
    templates = F.array_compact(templates)
    forms = F.array_distinct(F.concat(templates, F.array(_window_key("raw"))))
    long = _places(items, "item_id", "item_key").select(
        "item_id", "item_key", F.col("at").alias("item_at"), F.lit(WINDOW).alias("width"), (words_and_names >= LITERALS).alias("typed"),
        _slots("tok", "at").alias("item_slots"), templates.alias("templates"), F.explode(forms).alias("window"),
    )
    long = long.withColumn("template", F.array_contains("templates", F.col("window"))).drop("templates")
    width = F.size("tok")
    short = items.where(width.between(1, WINDOW - 1)).select("item_id", "item_key", "tok", _token_hashes("raw"), F.lit(0).alias("at"))
    key = F.coalesce(*[F.when(width == k, _window_key("raw", k)) for k in range(1, WINDOW)])
    short = short.select(
        "item_id", "item_key", F.col("at").alias("item_at"), width.alias("width"), F.lit(False).alias("typed"),
        F.array().cast("array<string>").alias("item_slots"), key.alias("window"), F.lit(False).alias("template"),
    )
    # ids may repeat: a window is named by its item, text, place and hash
    found = long.unionByName(short).dropDuplicates(["item_id", "item_key", "item_at", "window"])
    sizes = found.groupBy("item_id").agg(
        F.count_distinct(F.when(F.col("typed"), F.col("item_at"))).alias("n_windows"), F.count_distinct("item_at").alias("n_all")
    )
    return found.join(sizes, "item_id")


def _document_windows(docs: DataFrame, short: list[int]) -> DataFrame:
    """(doc_id, row, at, form, window, doc_slots): every window of a text in its forms, and bare ones of the ``short`` widths.

    ``form`` is 0 for the window with all placeholders; where there are none it is the only one. ``doc_slots`` holds
    the bare tokens of placeholders and null for words, or is null without placeholders. So no row carries more
    of its text than its window, and none of it is made before the join when the benchmark is broadcast.
    """
    keyed = docs.withColumn("row", F.xxhash64("tok"))
    placed = _places(keyed, "doc_id", "row", least=min([WINDOW, *short]))
    named, plain, raw = map(_window_key, _FORMS)
    special = named != raw
    # no lambda here: it would cut the generated code in two, and rows with whole texts would be passed on
    tokens = [F.get("tok", F.col("at") + k) for k in range(WINDOW)]
    slots = F.when(special, F.array(*[F.when(_special(x), _bare(x)) for x in tokens])).alias("doc_slots")
    left = F.size("tok") - F.col("at")
    forms = F.when(special, F.array(named, plain, raw)).otherwise(F.array(named))
    if short:
        none = F.array().cast("array<bigint>")
        parts = [F.when(left >= WINDOW, forms).otherwise(none)]
        forms = F.concat(*parts, *[F.when(left >= k, F.array(_window_key("raw", k))).otherwise(none) for k in short])
    return placed.select("doc_id", "row", "at", F.posexplode(forms).alias("form", "window"), slots)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_matched, n_windows, slots_changed): the benchmark items that documents hold.

    Texts become templates: numbers, units after numbers and names inside sentences are typed placeholders.
    Windows of five template tokens, three of them words, meet in a hash join, and so do all windows of bare tokens,
    so that a verbatim copy is found whatever its tokens are. Windows of one pair of texts that line up (same distance of
    places) form an occurrence. In it equal values of the item must stand for equal values of the document; windows
    over a value that stands for several do not count. An item is found if at least half of its windows with three words
    or half of all its windows are in occurrences, or one occurrence has nine. ``n_matched`` and ``n_windows`` count
    the first of these that suffice: windows with three words met by those with all placeholders, met in any form, all. ``slots_changed``: some value differs, so the item was re-parameterised.

    An item of fewer than five tokens is one window of bare tokens. Null or empty texts and items
    without an id are never found; documents without an id are reported with a null id, as one. Rows that share
    an id are reported together, but each is aligned on its own. Empty tables give an empty result; other columns are
    not read.
    """
    items = materialize(item_windows(benchmark, item_id_col, item_text_col), "item-windows")
    widths = {r["width"]: r["count"] for r in items.groupBy("width").count().collect()}
    small = sum(widths.values()) <= BROADCAST_WINDOWS
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    slim = with_tokens(slim, F.col("text")).select("doc_id", "tok")
    windows = _document_windows(slim, sorted(k for k in widths if k < WINDOW))
    met = windows.join(F.broadcast(items) if small else items, "window")
    # a value of the item over a plain word of the document is that word
    values = F.transform("item_slots", lambda x, k: F.struct(
        x.alias("item_slots"), F.coalesce(F.get("doc_slots", k), _bare(x)).alias("doc_slots")
    ))
    pairs = F.filter(values, lambda x: x["item_slots"].isNotNull())
    place = ["doc_id", "row", "item_id", "item_key", "n_windows", "n_all"]
    template = ((F.col("form") == 0) & F.col("template")).alias("template")
    hits = met.select(
        *place, (F.col("at") - F.col("item_at")).alias("distance"), F.struct("item_at", "typed", template, pairs.alias("pairs")).alias("hit")
    )
    lined_up = hits.groupBy(*place, "distance").agg(F.collect_set("hit").alias("hits"))
    values = F.array_distinct(F.flatten(F.transform("hits", lambda x: x["pairs"])))
    lined_up = lined_up.withColumn("values", F.array_sort(F.transform(values, lambda x: x["item_slots"])))
    # a value is listed once for each value that it stands for
    lined_up = lined_up.withColumn("several", F.filter("values", lambda x, k: (k > 0) & (x == F.get("values", k - 1))))
    counted = F.filter("hits", lambda x: ~F.exists(x["pairs"], lambda p: F.array_contains("several", p["item_slots"])))
    changed = F.exists("hits", lambda x: F.exists(x["pairs"], lambda p: _bare(p["item_slots"]) != p["doc_slots"]))
    ats = lambda hits: F.array_distinct(F.transform(hits, lambda x: x["item_at"]))
    consistent = lined_up.withColumn("hits", counted).where(F.size("hits") > 0).select(
        "doc_id", "item_id", "n_windows", "n_all", changed.alias("changed"), ats("hits").alias("all"),
        *[ats(F.filter("hits", lambda x: x[kind])).alias(kind) for kind in ("template", "typed")],  # noqa: B023
    )
    count = lambda places: F.size(F.array_distinct(F.flatten(F.collect_list(places)))).cast("long")
    kinds = ("template", "typed", "all")
    found = consistent.groupBy("doc_id", "item_id", "n_windows", "n_all").agg(
        F.max("changed").alias("slots_changed"), *[count(kind).alias(f"n_{kind}_found") for kind in kinds],
        *[F.max(F.size(kind)).alias(f"longest_{kind}") for kind in kinds],
    )

    def enough(kind: str, of: str) -> Column:
        matched = F.col(f"n_{kind}_found")
        return (matched > 0) & ((matched >= COVERAGE * F.col(of)) | (F.col(f"longest_{kind}") >= RUN))

    rules = [(kind, of, enough(kind, of)) for kind, of in zip(kinds, ("n_windows", "n_windows", "n_all"))]
    return found.where(rules[0][2] | rules[1][2] | rules[2][2]).select(
        "doc_id", "item_id", F.coalesce(*[F.when(met, F.col(f"n_{kind}_found")) for kind, _, met in rules]).alias("n_matched"),
        F.coalesce(*[F.when(met, F.col(of)) for _, of, met in rules]).alias("n_windows"), "slots_changed",
    )
