"""The same answers in DuckDB SQL, for every registered query that plain SQL can express."""

from __future__ import annotations

SUPPORT = 100
DIMS = 32

_STAMP = "'[' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ']'"
_BODY = "'user ' || user_id || ' sent ' || event_type || ' props ' || props"
EVENTS = f"""
ev AS (
  SELECT event_id, event_type, user_id, 'svc' || (user_id % 5) || '.log' AS log_file,
    CASE event_id % 10
      WHEN 3 THEN {_STAMP} || ' ' || user_id || ' ' || {_BODY}
      WHEN 7 THEN {_BODY}
      ELSE {_STAMP} || ' [' || rpad(event_type, 8, ' ') || '] [svc' || (user_id % 5) || '] [' || user_id || ': '
        || (event_id % 97) || '] [A' || (user_id % 7) || ': ' || (event_id % 1000) || '] ' || {_BODY}
    END AS raw
  FROM events),
hit AS (
  SELECT *,
    regexp_extract(raw, '^\\[(.*?)\\]\\s*\\[(\\w+)\\s*\\]\\s*\\[([-:.\\w]+)\\s*\\]\\s*\\[\\s*(\\d+):\\s*(\\d+)\\s*\\]\\s*\\[([A-Za-z0-9]+):\\s*(\\d+)\\s*\\]\\s*(.*)$',
      ['ts', 'level', 'component', 'pid', 'tid', 'guid', 'line_no', 'message']) AS a,
    regexp_extract(raw, '^\\[(.*?)\\]\\s*(\\d+)\\s*(.*)$', ['ts', 'pid', 'message']) AS b
  FROM ev),
parsed AS (
  SELECT event_id, event_type, log_file, raw,
    CASE WHEN a.ts <> '' OR b.ts <> '' THEN 'parsed' ELSE 'raw' END AS parsing_status,
    CASE WHEN a.ts <> '' THEN a.ts WHEN b.ts <> '' THEN b.ts END AS timestamp,
    CASE WHEN a.ts <> '' THEN upper(a.level) END AS level,
    CASE WHEN a.ts <> '' THEN a.component END AS component,
    CASE WHEN a.ts <> '' THEN TRY_CAST(a.pid AS BIGINT) WHEN b.ts <> '' THEN TRY_CAST(b.pid AS BIGINT) ELSE -1 END AS pid,
    CASE WHEN a.ts <> '' THEN TRY_CAST(a.tid AS BIGINT) ELSE -1 END AS tid,
    CASE WHEN a.ts <> '' THEN a.guid END AS file_guid_prefix,
    CASE WHEN a.ts <> '' THEN TRY_CAST(a.line_no AS BIGINT) WHEN b.ts <> '' THEN -1 ELSE event_id END AS line_no,
    CASE WHEN a.ts <> '' THEN a.message WHEN b.ts <> '' THEN b.message ELSE raw END AS message
  FROM hit)"""
_PARSED = "parsing_status, timestamp, level, component, pid, tid, file_guid_prefix, line_no, message"

_SPACE = (
    "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133) || "
    "chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || "
    "chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)
LINES = f"""
cut AS (
  SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') AS parts
  FROM documents WHERE length(text) > 0),
numbered AS (SELECT doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS line_no FROM cut),
lines AS (
  SELECT doc_id, line_no,
    regexp_replace(
      replace(regexp_replace(trim(part, {_SPACE}), '^(\\x{{FEFF}}|\\x{{FFFD}}|\\x{{EF}}\\x{{BB}}\\x{{BF}}|\\x{{EF}}\\x{{BF}}\\x{{BD}})+', ''),
        chr(160), ' '),
      '[\\x{{FEFF}}\\x{{200B}}\\x{{200C}}\\x{{200D}}\\x{{2060}}\\x{{200E}}\\x{{200F}}]', '', 'g') AS line
  FROM numbered)"""


def _entries(cap: int, sep: str) -> str:
    chunk = f"(line_no - min(line_no) OVER (PARTITION BY doc_id, g)) // {cap}" if cap else "0"
    return f"""
grouped AS (
  SELECT *, sum(CASE WHEN regexp_matches(line, '^[A-Z]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g
  FROM lines),
chunked AS (SELECT *, {chunk} AS c FROM grouped),
entries AS (
  SELECT doc_id, min(line_no) AS start_line_no, string_agg(line, {sep} ORDER BY line_no) AS raw, count(*)::INTEGER AS n_lines
  FROM chunked GROUP BY doc_id, g, c)"""


def _templates(source: str, having: str, prefix: str = "") -> str:
    """Token-frequency templates of a relation ``source`` with a ``message`` column."""
    p = prefix
    return f"""
{p}msg AS (SELECT message, count(*) AS n FROM {source} WHERE message <> '' GROUP BY message),
{p}tok AS (SELECT message, n, regexp_split_to_array(trim(message), '\\s+') AS t FROM {p}msg),
{p}routed AS (
  SELECT message, n, t, len(t) AS l,
    array_to_string(list_transform(t[1:2], lambda x: CASE WHEN regexp_matches(x, '\\d') THEN '<*>' ELSE x END), ' ') AS r
  FROM {p}tok),
{p}slots AS (SELECT message, n, l, r, unnest(t) AS w, unnest(range(0, len(t))) AS pos FROM {p}routed),
{p}kept AS (SELECT l, r, pos, w, true AS keep FROM {p}slots GROUP BY l, r, pos, w HAVING sum(n) >= {having}),
{p}assigned AS (
  SELECT message, any_value(n) AS n, string_agg(CASE WHEN keep THEN w ELSE '<*>' END, ' ' ORDER BY pos) AS template
  FROM {p}slots LEFT JOIN {p}kept USING (l, r, pos, w) GROUP BY message),
{p}templates AS (
  SELECT template, sum(n)::BIGINT AS size, ('0x' || substr(md5(template), 1, 15))::BIGINT AS cluster_id,
    regexp_split_to_array(template, ' ') AS tokens
  FROM {p}assigned GROUP BY template)"""


MESSAGES = f"source AS (SELECT event_id, event_type, {_BODY} AS message FROM events)"
QUIET = f"quiet AS (SELECT {_BODY} AS message FROM events WHERE event_type <> 'error')"
MATCHED = f"""{EVENTS}, {QUIET}, {_templates("quiet", str(SUPPORT))},
texts AS (SELECT DISTINCT message, regexp_split_to_array(trim(message), '\\s+') AS t FROM parsed WHERE message <> ''),
candidates AS (
  SELECT message, template, cluster_id, len(list_filter(tokens, lambda x: x <> '<*>')) AS constants
  FROM texts JOIN templates ON len(t) = len(tokens)
    AND len(list_filter(range(1, len(t) + 1), lambda i: tokens[i] <> '<*>' AND tokens[i] <> t[i])) = 0),
best AS (
  SELECT message, template FROM candidates
  QUALIFY row_number() OVER (PARTITION BY message ORDER BY constants DESC, cluster_id) = 1),
matched AS (
  SELECT p.*, coalesce(b.template, p.message) AS template, b.template IS NULL AS is_new
  FROM parsed p LEFT JOIN best b USING (message))"""


def _vectors(source: str, text: str) -> str:
    """Hashed word counts of unit length, one row per non-zero entry."""
    return f"""
words AS (
  SELECT {text} AS message, unnest(list_filter(regexp_split_to_array(lower({text}), '[^\\w]+'), lambda w: w <> '')) AS w
  FROM (SELECT DISTINCT {text} FROM {source})),
cells AS (
  SELECT message, (('0x' || substr(md5(w), 1, 8))::BIGINT % {DIMS})::INTEGER AS pos, count(*)::DOUBLE AS c
  FROM words GROUP BY ALL),
vectors AS (SELECT message, pos, c / sqrt(sum(c * c) OVER (PARTITION BY message)) AS value FROM cells)"""


VECS = "vecs AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
CENTERS = """
parts AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(0, len(v))) AS pos FROM vecs),
centers AS (
  SELECT label AS cluster, list(x ORDER BY pos) AS c
  FROM (SELECT label, pos, avg(x) AS x FROM parts GROUP BY ALL) GROUP BY label),
near AS (
  SELECT vec_id, label, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT vec_id, label, cluster, list_distance(v, c) AS d FROM vecs CROSS JOIN centers) GROUP BY ALL)"""
LIMITS = """
limits AS (SELECT cluster, quantile_cont(distance, 0.9) AS threshold, count(*) AS n FROM near GROUP BY cluster)"""


def _quality(labels: str) -> str:
    """Quality of each labeling of a relation (k, vec_id, label, v)."""
    return f"""
lab AS ({labels}),
pairs AS (
  SELECT a.k, a.vec_id, a.label AS own, b.label AS other, list_distance(a.v, b.v) AS d
  FROM lab a JOIN lab b ON a.k = b.k AND a.vec_id <> b.vec_id),
means AS (SELECT k, vec_id, own, other, avg(d) AS m FROM pairs GROUP BY ALL),
sil AS (
  SELECT k, avg(CASE WHEN i IS NULL THEN 0 ELSE (o - i) / greatest(o, i) END) AS silhouette
  FROM (SELECT k, vec_id, min(CASE WHEN own = other THEN m END) AS i, min(CASE WHEN own <> other THEN m END) AS o
        FROM means GROUP BY ALL) GROUP BY k),
lparts AS (SELECT k, label, unnest(v) AS x, unnest(range(0, len(v))) AS pos FROM lab),
lcent AS (
  SELECT k, label, list(x ORDER BY pos) AS c FROM (SELECT k, label, pos, avg(x) AS x FROM lparts GROUP BY ALL) GROUP BY ALL),
middle AS (SELECT k, list(x ORDER BY pos) AS c FROM (SELECT k, pos, avg(x) AS x FROM lparts GROUP BY ALL) GROUP BY k),
spread AS (
  SELECT k, label, any_value(c) AS c, count(*) AS n, avg(d) AS s, sum(d * d) AS w
  FROM (SELECT lab.k, lab.label, c, list_distance(v, c) AS d FROM lab JOIN lcent ON lab.k = lcent.k AND lab.label = lcent.label)
  GROUP BY k, label),
db AS (
  SELECT k, avg(r) AS davies_bouldin FROM (
    SELECT a.k, a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS r
    FROM spread a JOIN spread b ON a.k = b.k AND a.label <> b.label GROUP BY ALL) GROUP BY k),
ch AS (
  SELECT s.k, (sum(s.n * list_distance(s.c, m.c) ** 2) * (sum(s.n) - count(*))) / (sum(s.w) * (count(*) - 1)) AS calinski_harabasz
  FROM spread s JOIN middle m ON s.k = m.k GROUP BY s.k)"""


SWEEP = f"""{VECS}, {_quality("SELECT ks.k, vec_id, label % ks.k AS label, v FROM vecs CROSS JOIN (SELECT unnest([2, 4, 6, 8, 10])::BIGINT AS k) ks")},
lnear AS (
  SELECT lcent.k, vec_id, min(list_distance(v, c)) AS d FROM vecs CROSS JOIN lcent GROUP BY ALL),
inert AS (SELECT k, sum(d * d) AS inertia FROM lnear GROUP BY k),
sweep AS (
  SELECT k, inertia, silhouette, davies_bouldin, calinski_harabasz
  FROM inert JOIN sil USING (k) JOIN db USING (k) JOIN ch USING (k)),
ends AS (SELECT min(k) AS k0, max(k) AS k1, arg_min(inertia, k) AS y0, arg_max(inertia, k) AS y1 FROM sweep),
bend AS (
  SELECT k FROM sweep, ends
  ORDER BY abs((k1 - k0) * (y0 - inertia) - (k0 - k) * (y1 - y0)) / sqrt((k1 - k0) ** 2 + (y1 - y0) ** 2) DESC, k LIMIT 1),
best AS (
  SELECT (SELECT k FROM sweep ORDER BY silhouette DESC, k LIMIT 1) AS silhouette_best,
    (SELECT k FROM sweep ORDER BY davies_bouldin, k LIMIT 1) AS davies_bouldin_best,
    (SELECT k FROM sweep ORDER BY calinski_harabasz DESC, k LIMIT 1) AS calinski_harabasz_best,
    (SELECT k FROM bend) AS elbow_best),
votes AS (
  SELECT unnest([silhouette_best, davies_bouldin_best, calinski_harabasz_best, elbow_best]) AS k FROM best),
suggestion AS (
  SELECT *, (SELECT k FROM votes GROUP BY k ORDER BY count(*) DESC, k LIMIT 1) AS consensus_k FROM best)"""
SWEEP_GIVEN = f"""{VECS},
bparts AS (
  SELECT ks.k, label % ks.k AS label, unnest(v) AS x, unnest(range(0, len(v))) AS pos
  FROM vecs CROSS JOIN (SELECT unnest([2, 4, 6, 8, 10])::BIGINT AS k) ks),
bcent AS (
  SELECT k, label, list(x ORDER BY pos) AS c FROM (SELECT k, label, pos, avg(x) AS x FROM bparts GROUP BY ALL) GROUP BY ALL),
bnear AS (
  SELECT k, vec_id, arg_min(label, (d, label)) AS label, min(d) AS d, any_value(v) AS v
  FROM (SELECT k, vec_id, v, bcent.label, round(list_distance(v, c), 12) AS d FROM vecs CROSS JOIN bcent) GROUP BY k, vec_id),
{_quality("SELECT k, vec_id, label, v FROM bnear")},
inert AS (SELECT k, sum(d * d) AS inertia FROM bnear GROUP BY k),
sweep AS (SELECT k, inertia, silhouette, davies_bouldin, calinski_harabasz FROM inert JOIN sil USING (k) JOIN db USING (k) JOIN ch USING (k))"""


def _lloyd(rounds: int) -> str:
    """Relations m0 (the first ten vectors) to m<rounds>: (cluster, c) after so many steps."""
    steps = ["m0 AS (SELECT vec_id AS cluster, v AS c FROM vecs WHERE vec_id < 10)"]
    for r in range(rounds):
        steps.append(f"""
won{r} AS (
  SELECT vec_id, any_value(v) AS v, arg_min(cluster, (d, cluster)) AS cluster
  FROM (SELECT vec_id, v, cluster, round(list_distance(v, c), 12) AS d FROM vecs CROSS JOIN m{r}) GROUP BY vec_id),
cells{r} AS (SELECT cluster, unnest(v) AS x, unnest(range(0, len(v))) AS pos FROM won{r}),
means{r} AS (SELECT cluster, list(x ORDER BY pos) AS c FROM (SELECT cluster, pos, avg(x) AS x FROM cells{r} GROUP BY ALL) GROUP BY cluster),
m{r + 1} AS (SELECT m{r}.cluster, coalesce(means{r}.c, m{r}.c) AS c FROM m{r} LEFT JOIN means{r} USING (cluster))""")
    return ", ".join(steps)


def _power(rounds: int) -> str:
    """Relations p0 (the first axis) to p<rounds>: (w), the direction after so many rounds, not of unit length."""
    steps = ["""
cells AS (SELECT vec_id, unnest(v) AS x, unnest(range(0, len(v))) AS pos FROM vecs),
flat AS (SELECT vec_id, pos, x - avg(x) OVER (PARTITION BY pos) AS x FROM cells),
p0 AS (SELECT pos, (pos = 0)::INT::DOUBLE AS w FROM (SELECT DISTINCT pos FROM flat))"""]
    for r in range(rounds):
        steps.append(f"""
dots{r} AS (SELECT vec_id, sum(x * w) AS y FROM flat JOIN p{r} USING (pos) GROUP BY vec_id),
raw{r} AS (SELECT pos, sum(x * y) AS w FROM flat JOIN dots{r} USING (vec_id) GROUP BY pos),
p{r + 1} AS (SELECT pos, w / sqrt(sum(w * w) OVER ()) AS w FROM raw{r})""")
    return ", ".join(steps)


_SCORES = (
    "round(inertia, 6) AS inertia, round(silhouette, 6) AS silhouette, round(davies_bouldin, 6) AS davies_bouldin, "
    "round(calinski_harabasz, 6) AS calinski_harabasz"
)

_W = "\\p{L}\\p{N}_"
_D = "\\s,;:(){}\\[\\]\"''"


def _word(body: str, flags: str) -> str:
    """Replace whole words; twice, as neighbours share the character between them."""
    step = "regexp_replace({0}, '" + f"(^|[^{_W}])(?:{body})($|[^{_W}])" + "', '\\1<*>\\2', '" + flags + "')"
    return step.replace("{0}", step)


def _corrected(col: str) -> str:
    out = _word("\\d+", "g").replace("{0}", col)
    out = _word("true|false", "gi").replace("{0}", out)
    out = (
        f"regexp_replace({out}, "
        "'(^|[^A-Za-z0-9._-])(?:[A-Za-z]:\\\\(?:[^\\\\\\s]+\\\\)*[^\\\\\\s]+\\\\?)', '\\1<*>', 'g')"
    )
    out = (
        f"regexp_replace({out}, "
        "'(^|[^A-Za-z0-9._-])(?:~?/)(?:[A-Za-z0-9._-]+/)*[A-Za-z0-9._-]+/?', '\\1<*>', 'g')"
    )
    out = _word("admin|root|null|C\\+\\+", "gi").replace("{0}", out)
    out = f"regexp_replace({out}, '[^{_D}]*<\\*>[^{_D}]*', '<*>', 'g')"
    out = f"regexp_replace({out}, '(?:<\\*>\\s*\\.\\s*)+<\\*>', '<*>', 'g')"
    out = f"regexp_replace({out}, '(?:<\\*>\\s*)+<\\*>', '<*>', 'g')"
    return f"trim(regexp_replace({out}, '[ \\t]{{2,}}', ' ', 'g'), {_SPACE})"


DETECTED = f"""{MATCHED},
alltexts AS (SELECT template AS message FROM templates UNION SELECT template FROM matched),
{_vectors("alltexts", "message")},
protos AS (
  SELECT row_number() OVER (ORDER BY size DESC, template) - 1 AS cluster, template
  FROM templates ORDER BY size DESC, template LIMIT 4),
dense AS (
  SELECT message, list(coalesce(value, 0) ORDER BY pos) AS v
  FROM (SELECT DISTINCT message FROM vectors) CROSS JOIN (SELECT unnest(range({DIMS}))::INTEGER AS pos)
  LEFT JOIN vectors USING (message, pos) GROUP BY message),
dists AS (
  SELECT a.message, p.cluster, round(list_distance(a.v, q.v), 12) AS d
  FROM dense a CROSS JOIN protos p JOIN dense q ON q.message = p.template),
nearest AS (
  SELECT message AS template, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM dists GROUP BY message),
limits AS (
  SELECT cluster, quantile_cont(distance, 0.9) AS threshold FROM nearest JOIN templates USING (template) GROUP BY cluster),
found AS (
  SELECT m.event_id, m.level, m.component, m.template, m.is_new, n.distance, l.threshold
  FROM matched m JOIN nearest n USING (template) JOIN limits l USING (cluster) WHERE n.distance > l.threshold)"""
_FOUND = "round(distance, 6) AS distance, round(threshold, 6) AS threshold"


def _anomalies(threshold: str) -> str:
    return (
        f"WITH {VECS}, {CENTERS}, {LIMITS} SELECT vec_id, cluster::BIGINT AS cluster, round(distance, 6) AS distance, "
        f"round({threshold}, 6) AS threshold FROM near JOIN limits USING (cluster) WHERE distance > {threshold}"
    )


_THRESHOLDS = (
    f"WITH {VECS}, {CENTERS}, {LIMITS} SELECT cluster::BIGINT AS cluster, round(threshold, 6) AS threshold, n FROM limits"
)
_COMMON = "(SELECT quantile_cont(distance, 0.9) FROM near)"
_ENTRIES = "SELECT doc_id, start_line_no, raw, n_lines FROM entries"

def _axis(name: str, matrix: str) -> str:
    """Relation ``name`` (v, l): the unit vector to which 1000 products with the matrix m of a relation lead, and its eigenvalue."""
    product = "list_transform(m, lambda r: list_dot_product(r, v))"
    return f"""
{name}_steps(k, v) AS (
  SELECT 0, list_transform(range(len(m)), lambda i: 1.0::DOUBLE / (i + 1)) FROM {matrix}
  UNION ALL SELECT k + 1, list_transform({product}, lambda x: x / sqrt(list_dot_product({product}, {product})))
  FROM {name}_steps, {matrix} WHERE k < 1000),
{name} AS (SELECT v, list_dot_product(v, {product}) AS l FROM {name}_steps, {matrix} WHERE k = 1000)"""


_PCA = f"""
cells AS (SELECT vec_id, unnest(v) AS x, unnest(range(0, len(v))) AS pos FROM vecs),
flat AS (SELECT vec_id, pos, x - avg(x) OVER (PARTITION BY pos) AS x FROM cells),
cov AS (
  SELECT a.pos AS i, b.pos AS j, sum(a.x * b.x) / (count(*) - 1) AS c FROM flat a JOIN flat b USING (vec_id) GROUP BY ALL),
whole AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM cov GROUP BY i)),
{_axis("one", "whole")},
rest AS MATERIALIZED (
  SELECT list_transform(range(len(m)), lambda i: list_transform(range(len(m)), lambda j: m[i + 1][j + 1] - l * v[i + 1] * v[j + 1])) AS m
  FROM whole, one),
{_axis("two", "rest")}"""

ORACLE: dict[str, str] = {
    "events_level_counts": f"WITH {EVENTS} SELECT level, component, count(*) AS n FROM parsed GROUP BY ALL",
    "events_parse": f"WITH {EVENTS} SELECT event_id, {_PARSED} FROM parsed",
    "events_effective_message": f"WITH {EVENTS} SELECT event_id, CASE WHEN level IS NULL OR message = '' THEN raw ELSE message END AS text FROM parsed",
    "doc_lines_clean": f"WITH {LINES} SELECT doc_id, line_no, line FROM lines",
    "doc_entries": f"WITH {LINES}, {_entries(5, chr(39) + ' ' + chr(39))} {_ENTRIES}",
    "doc_entries_uncut": f"WITH {LINES}, {_entries(0, 'chr(10)')} {_ENTRIES}",
    "doc_entries_single": f"WITH {LINES} SELECT doc_id, line_no AS start_line_no, line AS raw, 1::INTEGER AS n_lines FROM lines",
    "page_excludes": """
WITH paths AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?:/', ''), '/$', '') AS p FROM pages)
SELECT page_id, regexp_matches(p, '(^|/)[^/]*/[^/]*\\.html$') OR regexp_matches(p, '(^|/)en/[^/][0-4][^/]*$')
  OR regexp_matches(p, '(^|/)blog\\.[^/]*/fr/[^/]*$') AS excluded FROM paths""",
    "doc_correct": f"""
WITH {LINES}, fixed AS (SELECT doc_id, line_no, line, {_corrected("line")} AS corrected_template FROM lines)
SELECT doc_id, line_no, corrected_template, line <> corrected_template AS was_corrected FROM fixed""",
    "template_freq": f"WITH {MESSAGES}, {_templates('source', str(SUPPORT))} SELECT message, n, template FROM assigned",
    "template_sizes": f"WITH {MESSAGES}, {_templates('source', str(SUPPORT))} "
    "SELECT cluster_id, template, size, len(tokens)::INTEGER AS n_tokens FROM templates",
    "template_assign": f"WITH {EVENTS}, {_templates('parsed', str(SUPPORT))} "
    "SELECT event_id, component, level AS log_level, template FROM parsed JOIN assigned USING (message)",
    "template_match": f"WITH {MATCHED} SELECT event_id, template, is_new FROM matched",
    "unmatched_messages": f"WITH {MATCHED} SELECT log_file, message AS new_log_message FROM matched WHERE is_new",
    "mine_events": f"WITH {MESSAGES} SELECT message, count(*) AS n, true AS fits, true AS firm, true AS apart FROM source GROUP BY message",
    "mine_documents": f"WITH {LINES} SELECT line AS message, count(*) AS n, true AS fits, true AS firm, true AS apart FROM lines WHERE line <> '' GROUP BY line",
    "mine_sizes": f"WITH {MESSAGES} SELECT len(regexp_split_to_array(trim(message), '\\s+'))::INTEGER AS n_tokens, "
    "count(*)::BIGINT AS messages FROM source GROUP BY ALL",
    "mine_stream": f"WITH {MESSAGES} SELECT len(regexp_split_to_array(trim(message), '\\s+'))::INTEGER AS n_tokens, "
    "count(*)::BIGINT AS messages, 0::BIGINT AS lost FROM source GROUP BY ALL",
    "mine_again": f"WITH {MESSAGES} SELECT message, count(*) AS n, true AS fits, true AS firm, true AS apart FROM source GROUP BY message",
    "embed_messages": f"WITH {MESSAGES}, {_vectors('source', 'message')} SELECT message, pos, round(value, 6) AS value FROM vectors",
    "embed_map_back": f"WITH {MESSAGES}, {_vectors('source', 'message')} "
    "SELECT event_id, round(sum(value), 6) AS total FROM source JOIN vectors USING (message) GROUP BY event_id",
    "embed_tfidf": f"WITH {MESSAGES} SELECT DISTINCT message, 1.0::DOUBLE AS norm FROM source",
    "embed_user_model": f"WITH {MESSAGES} SELECT DISTINCT message, length(message)::DOUBLE AS chars, "
    "(length(message) - length(replace(message, ' ', '')) + 1)::DOUBLE AS words FROM source",
    "l2_normalized": """
WITH parts AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS x, unnest(range(0, len(embedding))) AS pos FROM embeddings),
unit AS (SELECT vec_id, pos::INTEGER AS pos, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS value FROM parts)
SELECT vec_id, pos, round(value, 6) AS value FROM unit WHERE value <> 0""",
    "nearest_centers": f"WITH {VECS}, {CENTERS} SELECT vec_id, cluster::BIGINT AS cluster, round(distance, 6) AS distance FROM near",
    "label_inertia": f"WITH {VECS}, {CENTERS} SELECT round(sum(distance * distance), 6) AS inertia FROM near",
    "cluster_thresholds": _THRESHOLDS,
    "cluster_thresholds_large": _THRESHOLDS,
    "cluster_thresholds_sketch": f"WITH {VECS}, {CENTERS} SELECT cluster::BIGINT AS cluster, count(*) AS n, true AS within FROM near GROUP BY cluster",
    "common_threshold": f"WITH {VECS}, {CENTERS} SELECT round(quantile_cont(distance, 0.9), 6) AS threshold FROM near",
    "anomalies_per_cluster": _anomalies("threshold"),
    "anomalies_common": _anomalies(_COMMON),
    "scores_open_cluster": f"WITH {VECS}, {CENTERS}, {LIMITS} SELECT cluster::BIGINT AS cluster, count(*) AS n, "
    "sum(CASE WHEN cluster <> 0 AND distance > threshold THEN 1 ELSE 0 END)::BIGINT AS anomalies "
    "FROM near JOIN limits USING (cluster) GROUP BY cluster",
    "cluster_quality": f"WITH {VECS}, {_quality('SELECT 0 AS k, vec_id, label, v FROM vecs')} "
    "SELECT round(silhouette, 6) AS silhouette, round(davies_bouldin, 6) AS davies_bouldin, "
    "round(calinski_harabasz, 6) AS calinski_harabasz FROM sil JOIN db USING (k) JOIN ch USING (k)",
    "silhouette_fast": f"""
WITH {VECS}, pairs AS (
  SELECT a.vec_id, a.label AS own, b.label AS other, list_distance(a.v, b.v) ** 2 AS d FROM vecs a CROSS JOIN vecs b),
means AS (SELECT vec_id, own, other, sum(d) AS s, count(*) AS n FROM pairs GROUP BY ALL),
points AS (
  SELECT vec_id, min(CASE WHEN own = other THEN s / (n - 1) END) AS i, min(CASE WHEN own <> other THEN s / n END) AS o
  FROM means GROUP BY vec_id)
SELECT round(avg((o - i) / greatest(o, i)), 6) AS silhouette FROM points""",
    "k_eval": f"WITH {SWEEP} SELECT k, {_SCORES} FROM sweep",
    "k_suggestion": f"WITH {SWEEP} SELECT * FROM suggestion",
    "k_elbow": f"WITH {SWEEP} SELECT k AS elbow_best FROM bend",
    "k_metric_series": f"WITH {SWEEP} SELECT sweep.k, {_SCORES}, k = (SELECT consensus_k FROM suggestion) AS is_chosen FROM sweep",
    "k_sweep_given": f"WITH {SWEEP_GIVEN} SELECT k, {_SCORES} FROM sweep",
    "lloyd_rounds": f"WITH {VECS}, {_lloyd(3)}, o AS (SELECT cluster, unnest(c) AS value, unnest(range(0, len(c)))::INTEGER AS pos FROM m3) "
    "SELECT cluster, pos, round(value, 6) AS value FROM o",
    "power_rounds": f"WITH {VECS}, {_power(3)} SELECT pos::INTEGER AS pos, round(w, 6) AS value FROM p3",
    "pca_variances": f"WITH RECURSIVE {VECS}, {_PCA} SELECT round(one.l, 5) AS var1, round(two.l, 5) AS var2, true AS apart, "
    "(SELECT count(*) FROM vecs) AS n FROM one, two",
    "vector_sample": "SELECT vec_id, label FROM embeddings ORDER BY md5(vec_id || ':42'), vec_id LIMIT 200",
    "detect_events": f"WITH {DETECTED} SELECT event_id, level, component, template, is_new, {_FOUND} FROM found",
    "detection_rows": f"WITH {MATCHED}, {_vectors('matched', 'template')} SELECT event_id, is_new, round(sum(value), 6) AS total "
    "FROM matched JOIN vectors ON vectors.message = matched.template GROUP BY event_id, is_new",
    "text_file_lines": f"WITH {LINES} SELECT line, count(*) AS n FROM lines GROUP BY line",
    "text_file_parse": f"WITH {EVENTS} SELECT parsing_status, level, component, count(*) AS n, sum(pid)::BIGINT AS pids, "
    "sum(length(message))::BIGINT AS chars FROM parsed WHERE log_file <> 'svc4.log' GROUP BY ALL",
    "parsed_csv_roundtrip": f"WITH {EVENTS} SELECT event_id, {_PARSED} FROM parsed",
    "templates_json_roundtrip": f"WITH {MESSAGES}, {_templates('source', str(SUPPORT))} "
    "SELECT cluster_id, template, template AS corrected_template, false AS was_corrected, size FROM templates",
    "embeddings_roundtrip": f"WITH {MESSAGES}, {_templates('source', str(SUPPORT))}, {_vectors('templates', 'template')} "
    "SELECT message AS template, pos, round(value, 6) AS value FROM vectors",
    "model_roundtrip": _anomalies("threshold"),
    "evaluations_roundtrip": f"WITH {SWEEP} SELECT sweep.k, {_SCORES}, k = (SELECT consensus_k FROM suggestion) AS is_chosen FROM sweep",
    "report_csv_roundtrip": f"WITH {DETECTED}, sums AS (SELECT message AS template, sum(value) AS total FROM vectors GROUP BY message) "
    f"SELECT event_id, level, component, template, round(total, 6) AS total, {_FOUND} FROM found JOIN sums USING (template)",
    "projection_csv_roundtrip": f"WITH {VECS}, {CENTERS} SELECT cluster::BIGINT AS cluster_id, count(*) AS n, sum(vec_id)::BIGINT AS ids, "
    "count(*) AS placed FROM near GROUP BY cluster",
    "unreadable_files": f"WITH {LINES} SELECT source, count(*) AS lines, 0::BIGINT AS skipped "
    "FROM lines JOIN documents USING (doc_id) GROUP BY source",
    "stream_parse": f"WITH {EVENTS} SELECT event_id, {_PARSED} FROM parsed",
    "stream_score": _anomalies("threshold"),
    "stream_detect": f"WITH {DETECTED} SELECT event_id, level, component, template, is_new, {_FOUND} FROM found",
    "stream_entries": f"WITH {LINES}, {_entries(5, chr(39) + ' ' + chr(39))} {_ENTRIES}",
    "stream_level_windows": """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM events GROUP BY ALL""",
    "text_file_entries": f"""
WITH {LINES.replace("SELECT doc_id, regexp_split", "SELECT source AS doc_id, regexp_split").replace("FROM documents WHERE length(text) > 0",
    "FROM (SELECT source, string_agg(text || chr(10), '' ORDER BY doc_id) AS text FROM documents GROUP BY source)")},
{_entries(5, chr(39) + ' ' + chr(39))}
SELECT doc_id AS source, start_line_no, raw, n_lines FROM entries""",
    "training_assignment": f"WITH {MATCHED} SELECT event_id, component, level AS log_level, cluster_id, template, "
    "template AS corrected_template, false AS was_corrected FROM matched JOIN templates USING (template) WHERE NOT is_new",
}
ORACLE["stream_file_entries"] = ORACLE["text_file_entries"]
