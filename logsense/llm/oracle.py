"""DuckDB SQL for the queries of the corpus operators, where SQL can express them.

Not here: best-fit packing (a greedy search), language and Brown models (fitted), token files (a tokenizer).
Tests hold these against plain loops.
"""

from __future__ import annotations

from logsense.llm.contamination import COVERAGE, LITERALS, RUN, UNITS, WINDOW
from logsense.llm.licenses import CONTAINMENT, NOTICES, SHINGLE, STEP
from logsense.llm.merkle import ARITY, FIELDS

_SPACE = r"'[\x20\x09-\x0D]+'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, {_SPACE}), lambda x: x <> '')"


def _count(chars: str) -> str:
    return f"(length(t) - length(regexp_replace(t, '[{chars}]', '', 'g')))"


_OP1 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_words('t')} AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, {_SPACE}, '', 'g') <> '') AS lines FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, t, lines, len(w)::BIGINT AS n_words, length(regexp_replace(t, {_SPACE}, '', 'g'))::BIGINT AS word_chars,
         {_count('#*$%&|<>')}::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 4 * {_count('0-9')} > word_chars OR {_count('A-Z')} > {_count('a-z')} OR 10 * n_dup_lines > 6 * len(lines)) AS kept
FROM failed
"""


def _marked(text: str) -> str:
    """As ``marked_tokens``; without lookaround a replacement runs twice, for matches that share a character."""
    units = "|".join(UNITS)
    t = f"regexp_replace(coalesce({text}, ''), '[\\x01\\x02]', ' ', 'g')"
    for _ in range(2):
        t = f"regexp_replace({t}, '([0-9])[.,]([0-9])', '\\1\\2', 'g')"
    t = f"regexp_replace({t}, '(?i)([0-9]) ?({units})([^\\pL\\pN]|$)', '\\1 ' || chr(2) || '\\2\\3', 'g')"
    for _ in range(2):
        t = f"regexp_replace({t}, '([\\pL0-9,;](?: |\\r?\\n))(\\p{{Lu}}\\p{{Ll}})', '\\1' || chr(1) || '\\2', 'g')"
    return f"list_filter(string_split_regex(lower({t}), '[^\\pL\\pN\\x01\\x02]+'), lambda x: x <> '')"


_KIND = "CASE WHEN x[1] BETWEEN '0' AND '9' THEN '<num>' WHEN x[1] = chr(1) THEN '<name>' WHEN x[1] = chr(2) THEN '<unit>' END"
_BARE = "translate(x, chr(1) || chr(2), '')"
#: A window with all placeholders, with names as plain words, and bare.
_FORMS = ", ".join(
    f"array_to_string(list_transform(w, lambda x: {x}), ' ')"
    for x in (f"coalesce({_KIND}, x)", f"CASE WHEN x[1] = chr(1) THEN {_BARE} ELSE coalesce({_KIND}, x) END", _BARE)
)
_OP3 = f"""
WITH items AS (SELECT DISTINCT item_id, {_marked('text')} AS tok FROM benchmark WHERE item_id IS NOT NULL),
cut AS (
  SELECT item_id, tok AS item_key, pos AS item_at, tok[pos + 1 : pos + {WINDOW}] AS w, {WINDOW} AS width
  FROM items, unnest(range(len(tok) - {WINDOW - 1})) AS u(pos)
  UNION ALL SELECT item_id, tok, 0, tok, len(tok) FROM items WHERE len(tok) BETWEEN 1 AND {WINDOW - 1}),
typed AS (
  SELECT *, list_transform(w, lambda x: CASE WHEN ({_KIND}) IS NOT NULL THEN x END) AS item_slots, [{_FORMS}] AS forms,
         len(list_filter(w, lambda x: ({_KIND}) IS NULL)) AS words,
         len(list_filter(w, lambda x: coalesce({_KIND}, '<name>') = '<name>')) AS words_and_names
  FROM cut),
item_windows AS (
  SELECT item_id, item_key, item_at, width, CASE WHEN width = {WINDOW} THEN item_slots ELSE [] END AS item_slots, f AS win,
         width = {WINDOW} AND words_and_names >= {LITERALS} AS typed,
         width = {WINDOW} AND (f = forms[1] AND words >= {LITERALS} OR f = forms[2] AND words_and_names >= {LITERALS}) AS template
  FROM (SELECT *, unnest(list_distinct(CASE WHEN width < {WINDOW} THEN [forms[3]] ELSE list_filter(
          [CASE WHEN words >= {LITERALS} THEN forms[1] END, CASE WHEN words_and_names >= {LITERALS} THEN forms[2] END, forms[3]],
          lambda x: x IS NOT NULL) END)) AS f FROM typed)),
sizes AS (
  SELECT item_id, count(DISTINCT item_at) FILTER (typed) AS n_windows, count(DISTINCT item_at) AS n_all FROM item_windows GROUP BY item_id),
doc_tok AS (SELECT doc_id, {_marked('text')} AS tok FROM documents),
doc_cut AS (
  SELECT doc_id, tok, pos, tok[pos + 1 : pos + width] AS w, width
  FROM doc_tok, (SELECT DISTINCT width FROM item_windows UNION SELECT {WINDOW}) AS widths, unnest(range(len(tok) - width + 1)) AS u(pos)),
doc_windows AS (
  SELECT doc_id, tok AS row_key, pos, width, list_transform(w, lambda x: {_BARE}) AS doc_slots, forms[i] AS win, i = 1 AS first_form
  FROM (SELECT *, [{_FORMS}] AS forms FROM doc_cut), range(1, 4) AS r(i) WHERE width = {WINDOW} OR i = 3),
met AS (
  SELECT doc_id, row_key, item_id, item_key, pos - item_at AS distance, item_at, typed, template AND first_form AS template, item_slots, doc_slots
  FROM doc_windows JOIN item_windows USING (width, win)),
slots AS (
  SELECT DISTINCT doc_id, row_key, item_id, item_key, distance, item_slots[k] AS item_slot, doc_slots[k] AS doc_slot
  FROM met, unnest(range(1, len(item_slots) + 1)) AS u(k) WHERE item_slots[k] IS NOT NULL),
several AS (
  SELECT doc_id, row_key, item_id, item_key, distance, list(item_slot) AS several
  FROM (SELECT doc_id, row_key, item_id, item_key, distance, item_slot FROM slots GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL),
counted AS (
  SELECT met.*, list_bool_or(list_transform(range(1, len(item_slots) + 1), lambda k:
           item_slots[k] IS NOT NULL AND translate(item_slots[k], chr(1) || chr(2), '') <> doc_slots[k])) AS changed
  FROM met LEFT JOIN several USING (doc_id, row_key, item_id, item_key, distance)
  WHERE NOT list_has_any(list_filter(item_slots, lambda x: x IS NOT NULL), coalesce(several, []))),
runs AS (
  SELECT doc_id, item_id, count(DISTINCT item_at) FILTER (template) AS a, count(DISTINCT item_at) FILTER (typed) AS b, count(DISTINCT item_at) AS c
  FROM counted GROUP BY doc_id, row_key, item_id, item_key, distance),
longest AS (SELECT doc_id, item_id, max(a) AS a, max(b) AS b, max(c) AS c FROM runs GROUP BY ALL),
found AS (
  SELECT doc_id, item_id, count(DISTINCT item_at) FILTER (template) AS n_a, count(DISTINCT item_at) FILTER (typed) AS n_b,
         count(DISTINCT item_at) AS n_c, coalesce(bool_or(changed), false) AS slots_changed
  FROM counted GROUP BY ALL),
judged AS (
  SELECT found.*, n_windows, n_all, n_a > 0 AND (n_a >= {COVERAGE} * n_windows OR a >= {RUN}) AS by_a, n_b > 0 AND (n_b >= {COVERAGE} * n_windows OR b >= {RUN}) AS by_b,
         n_c > 0 AND (n_c >= {COVERAGE} * n_all OR c >= {RUN}) AS by_c
  FROM found JOIN sizes USING (item_id) JOIN longest ON longest.item_id = found.item_id AND longest.doc_id IS NOT DISTINCT FROM found.doc_id)
SELECT doc_id, item_id, CASE WHEN by_a THEN n_a WHEN by_b THEN n_b ELSE n_c END AS n_matched,
       CASE WHEN by_a OR by_b THEN n_windows ELSE n_all END AS n_windows, slots_changed
FROM judged WHERE by_a OR by_b OR by_c
"""

_OP4 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS k FROM d, unnest(range(n_bytes - 99)) AS u(s)),
later AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM w) WHERE r > 1),
marked AS (SELECT *, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100, true) AS new FROM later),
grouped AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM marked),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM grouped GROUP BY doc_id, g),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p, a FROM spans
  UNION ALL SELECT doc_id, coalesce(max(b), 0), any_value(n_bytes) FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS h FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

_NOTICE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in NOTICES.items())


def _license_tokens(text: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({text}, '')), '[^a-z0-9]+'), lambda x: x <> '')"


_OP6 = f"""
WITH notices(license, text) AS (VALUES {_NOTICE_ROWS}),
t AS (SELECT DISTINCT license, array_to_string(tok[i : i + {SHINGLE - 1}], ' ') AS s
      FROM (SELECT license, {_license_tokens('text')} AS tok FROM notices), unnest(range(1, len(tok) - {SHINGLE - 2})) AS u(i)),
sizes AS (SELECT license, count(*) AS n, ceil(count(*) / {STEP}) * {STEP} AS reach FROM t GROUP BY license),
d AS (SELECT doc_id, i - 1 AS p, array_to_string(tok[i : i + {SHINGLE - 1}], ' ') AS s, len(tok) - {SHINGLE - 1} AS n_shingles
      FROM (SELECT doc_id, {_license_tokens('text')} AS tok FROM documents), unnest(range(1, len(tok) - {SHINGLE - 2})) AS u(i)),
hits AS (SELECT doc_id, license, p, s, n, reach, n_shingles FROM d JOIN t USING (s) JOIN sizes USING (license)),
near AS (
  SELECT doc_id, license, n, pos, count(DISTINCT s) AS shared
  FROM hits, unnest(range(0, n_shingles, {STEP})) AS u(pos)
  WHERE p >= pos - reach AND p < pos + {STEP} + reach GROUP BY ALL)
SELECT doc_id, license, max(shared / n)::DOUBLE AS containment FROM near WHERE shared / n >= {CONTAINMENT} GROUP BY ALL
"""

_OP8 = """
WITH RECURSIVE bits(b, k, v) AS (
  SELECT b, 0, b::UBIGINT FROM range(256) AS t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (
  SELECT doc_id, (length(h) // 2 + 16)::BIGINT AS size,
         xor(list_reduce(
               list_transform(range(length(h) // 2), lambda i:
                 ((instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)::UBIGINT),
               lambda a, x: xor(a >> 8, t[(xor(a, x) & 255)::BIGINT + 1]), 4294967295::UBIGINT),
             4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM d, crc),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS byte_end, sum(size) OVER () AS all_bytes,
         row_number() OVER (ORDER BY doc_id, size, text_crc32) AS row_end
  FROM sums),
placed AS (SELECT *, ((2 * byte_end - size) * 40 // (2 * all_bytes))::INT AS shard FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, (row_end - min(row_end) OVER (PARTITION BY shard))::BIGINT AS slot,
       NULL::INT AS grown_shard
FROM placed
"""

_OP9 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s FROM w, unnest(range(1, greatest(len(w) - 1, 2))) AS u(i) WHERE len(w) > 0),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes AS x ON x.doc_id = a.doc_id JOIN sizes AS y ON y.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least AS (SELECT u AS doc_id, min(v) AS m FROM reach GROUP BY u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"({_FIELD.format(f)})" for f in (*FIELDS[:-1], text)) + ")"


def _siblings(place: str) -> str:
    """Left and right siblings of the node at ``place`` in the list l, with a bar between."""
    run = f"{ARITY} * ({place} // {ARITY})"
    return f"array_to_string(l[{run} + 1 : {place}], '') || '|' || array_to_string(l[{place} + 2 : {run} + {ARITY}], '')"


_NEXT_LEVEL = f"list_transform(range((len(l) + {ARITY - 1}) // {ARITY}), lambda i: sha256(array_to_string(l[{ARITY} * i + 1 : {ARITY} * i + {ARITY}], '')))"
_OP11 = f"""
WITH RECURSIVE bits(b, k, v) AS (
  SELECT b, 0, b::UBIGINT FROM range(256) AS t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS other,
         list_reduce(list_transform(range(strlen(doc_id::VARCHAR)), lambda i: ascii((doc_id::VARCHAR)[i + 1])::UBIGINT),
                     lambda a, x: xor(a >> 8, t[(xor(a, x) & 255)::BIGINT + 1]), 4294967295::UBIGINT) & 1 = 1 AS even
  FROM documents, crc),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
levels(source, level, l) AS (
  SELECT source, 0, list(leaf ORDER BY pos) FROM leaves GROUP BY source
  UNION ALL SELECT source, level + 1, {_NEXT_LEVEL} FROM levels WHERE len(l) > 1),
subs AS MATERIALIZED (
  SELECT source, l[1] AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k FROM levels WHERE len(l) = 1),
tops(level, l) AS (
  SELECT 0, list(subroot ORDER BY k) FROM subs UNION ALL SELECT level + 1, {_NEXT_LEVEL} FROM tops WHERE len(l) > 1),
steps AS (
  SELECT leaves.source, pos, level AS step_no, {_siblings(f'(pos // ({ARITY} ** level)::BIGINT)')} AS s
  FROM leaves JOIN levels ON leaves.source IS NOT DISTINCT FROM levels.source WHERE len(l) > 1
  UNION ALL SELECT leaves.source, pos, height + level, {_siblings(f'(k // ({ARITY} ** level)::BIGINT)')}
  FROM leaves JOIN subs ON leaves.source IS NOT DISTINCT FROM subs.source, tops WHERE len(l) > 1),
proofs AS (SELECT source, pos, list(s ORDER BY step_no) AS steps FROM steps GROUP BY ALL),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT l[1] FROM tops WHERE len(l) = 1) AS root, coalesce(steps, []) AS steps,
         CASE WHEN even AND text_differs THEN other ELSE leaf END AS start
  FROM (SELECT *, other <> leaf AS text_differs FROM leaves) AS leaves JOIN subs ON leaves.source IS NOT DISTINCT FROM subs.source
  LEFT JOIN proofs ON leaves.source IS NOT DISTINCT FROM proofs.source AND leaves.pos = proofs.pos),
done AS (
  SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
         list_reduce(steps, lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), start) AS folded_root
  FROM folded)
SELECT *, folded_root = root AS verified FROM done
"""

_OP12 = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""

_OP13 = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS w,
         doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS repeated FROM documents),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * {_count('A-Z')} > 2 * length(t))::INT
         + 8 * (t <> translate(t, '#$%&*|', ''))::INT + 16 * coalesce(repeated, false)::INT AS mask,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM d LEFT JOIN known USING (doc_id) GROUP BY ALL),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM l AS a, l AS b, l AS c, l AS d, l AS e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT o, step, (1 << (ascii(o[step]) - 65)) AS bit,
         list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(o[i]) - 65))) AS before
  FROM orders, range(1, 6) AS r(step)),
counted AS (
  SELECT part, o AS filter_order, step::INT AS step, bit, sum(n) FILTER (mask & coalesce(before, 0)::BIGINT = 0 AND mask & bit = 0) AS kept,
         sum(n) FILTER (mask & coalesce(before, 0)::BIGINT = 0 AND mask & bit > 0) AS removed,
         sum(n) FILTER (mask & coalesce(before, 0)::BIGINT > 0 AND mask & bit > 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & coalesce(before, 0)::BIGINT = 0 AND mask & bit > 0) AS good_lost,
         sum(toxic) FILTER (mask & coalesce(before, 0)::BIGINT = 0 AND mask & bit > 0) AS toxic_lost
  FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": _OP1,
    "op3_decontamination": _OP3,
    "op4_suffix_dedup": _OP4,
    "op6_license_scan": _OP6,
    "op8_byte_shards": _OP8,
    "op9_minhash_dedup": _OP9,
    "op11_merkle_manifest": _OP11,
    "op12_exact_dedup": _OP12,
    "op13_filter_audit": _OP13,
}
