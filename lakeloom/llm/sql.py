"""The queries that SQL can express, as DuckDB runs them on the same tables."""

from __future__ import annotations

from lakeloom.llm import decontaminate, mixing, quality, spelling, vector_search

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_LEVEL = """
sizes AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sizes),
weighed AS (SELECT *, [3, 1, 2][CAST(rank % 3 + 1 AS BIGINT)] AS weight, 2 * source_size AS cap FROM ranked),
stepped AS (SELECT *, row_number() OVER (ORDER BY cap / weight, rank) AS step,
  (sum(source_size) OVER () * 3 / 2 - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
first_open AS (SELECT min(step) AS step FROM stepped WHERE level * weight <= cap),
targets AS (SELECT s.source, s.source_size, s.rank,
  CASE WHEN f.step IS NULL OR s.step < f.step THEN CAST(s.cap AS DOUBLE)
       ELSE (SELECT level FROM stepped WHERE step = f.step) * s.weight END AS target
  FROM stepped s, first_open f)"""

_MIX = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len({WORDS.format("text")}), 0) AS size,
  md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
{_LEVEL},
queued AS (SELECT d.doc_id, d.size, t.source_size, t.rank, t.target,
  sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.draw, d.doc_id ROWS UNBOUNDED PRECEDING) AS served
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
places AS (SELECT doc_id, size, rank, (served + source_size * turn) / target AS finish
  FROM queued, (VALUES (0), (1)) AS turns(turn) WHERE size > 0 AND target > 0),
lined AS (SELECT *, sum(size) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) AS spent FROM places),
taken AS (SELECT doc_id, count(*) AS times FROM lined
  WHERE spent <= (SELECT sum(source_size) * 3 // 2 FROM targets) GROUP BY doc_id)
SELECT q.doc_id, q.size, CAST(q.source_size AS BIGINT) AS source_size, q.target,
  CAST(q.size * coalesce(t.times, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id"""


def _seeds(table: str) -> str:
    """Places and what each mask reads there."""
    parts = []
    for k, mask in enumerate(decontaminate.MASKS):
        read = " || ' ' || ".join(f"w[i + {p}]" for p, c in enumerate(mask) if c == "1")
        parts.append(
            f"SELECT *, '{k}:' || {read} AS seed FROM (SELECT *, unnest(range(1, len(w) - {decontaminate.SPAN} + 2)) AS i FROM {table})"
        )
    return " UNION ALL ".join(parts)


_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_R, _S = decontaminate.AROUND, decontaminate.SPAN
_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
b AS (SELECT item_id, {_TOKENS} AS w FROM benchmark),
ds AS ({_seeds("d")}), bs AS ({_seeds("b")}),
hits AS (SELECT ds.doc_id, bs.item_id, ds.w AS dw, bs.w AS bw, ds.i AS di, bs.i AS bi,
  least({_R}, ds.i - 1, bs.i - 1) AS l,
  least({_R}, len(ds.w) - ds.i - {_S} + 1, len(bs.w) - bs.i - {_S} + 1) AS r
  FROM ds JOIN bs ON ds.seed = bs.seed),
laid AS (SELECT *, list_transform(range(-l, {_S} + r), lambda x: CAST(dw[di + x] = bw[bi + x] AS INTEGER)) AS same FROM hits),
parts AS (SELECT doc_id, item_id, di, bi, di - 1 - i AS doc_at, i + {_S} + j AS length, list_sum(same[l - i + 1:l + {_S} + j]) AS equal
  FROM (SELECT *, unnest(range(0, r + 1)) AS j FROM (SELECT *, unnest(range(0, l + 1)) AS i FROM laid))),
good AS (SELECT * FROM parts WHERE equal >= {decontaminate.MIN_EQUAL} AND 100 * equal >= {decontaminate.MIN_PERCENT} * length),
seeded AS (SELECT doc_id, item_id, max({{'equal': CAST(equal AS BIGINT), 'short': -length, 'early': -doc_at}}) AS best FROM good GROUP BY doc_id, item_id),
counted AS (SELECT doc_id, item_id, count(*) AS hits FROM
  (SELECT doc_id, item_id, l, r, same, di, bi FROM laid) h
  WHERE EXISTS (SELECT 1 FROM good g WHERE g.doc_id = h.doc_id AND g.item_id = h.item_id AND g.di = h.di AND g.bi = h.bi)
  GROUP BY doc_id, item_id),
short AS (SELECT d.doc_id, s.item_id, len(s.w) AS n, unnest(list_filter(range(1, len(d.w) - len(s.w) + 2), lambda x: d.w[x:x + len(s.w) - 1] = s.w)) AS place
  FROM d, (SELECT * FROM b WHERE len(w) BETWEEN {decontaminate.MIN_SHORT} AND {_S} - 1) s)
SELECT doc_id, item_id, CAST(best.equal AS INTEGER) AS equal, CAST(-best.short AS INTEGER) AS length,
  CAST(-best.early AS INTEGER) AS doc_at, hits FROM seeded JOIN counted USING (doc_id, item_id)
UNION ALL SELECT doc_id, item_id, CAST(max(n) AS INTEGER), CAST(max(n) AS INTEGER), CAST(min(place) - 1 AS INTEGER), count(*)
FROM short GROUP BY doc_id, item_id"""

_COMMON = "[" + ", ".join(f"'{w}'" for w in quality.COMMON) + "]"
# the three histograms: where they are judged, their classes, the name of their distance and its limit
_HISTOGRAMS = {
    "chars": (f"word_chars >= {quality.MIN_CHARS_JUDGED}", len(quality.CLASSES) + 1, "char_distance", quality.MAX_CHAR_DISTANCE),
    "common": (
        f"n_words >= {quality.MIN_WORDS_JUDGED} AND list_sum(common) >= {quality.MIN_COMMON_JUDGED}",
        len(quality.COMMON), "word_distance", quality.MAX_WORD_DISTANCE,
    ),
    "share": (f"n_words >= {quality.MIN_WORDS_JUDGED}", 2, "share_distance", quality.MAX_SHARE_DISTANCE),
}
_PARTS = f"list_transform({{0}}, lambda x: CAST(floor(x * {quality.PARTS} / greatest(list_sum({{0}}), 1)) AS BIGINT))"


def _distance(p: str, q: str) -> str:
    share = "list_transform({0}, lambda x: x / greatest(list_sum({0}), 1))"
    term = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({1} + {0}) / 2)) ELSE 0 END"
    both = f"list_zip({share.format(p)}, {share.format(q)})"
    cell = f"({term.format('x[1]', 'x[2]')} + {term.format('x[2]', 'x[1]')}) / 2"
    return f"round(sqrt(greatest(list_sum(list_transform({both}, lambda x: {cell})), 0)), 6)"


_QUALITY = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w,
  list_transform(regexp_split_to_array(coalesce(text, ''), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda x: translate(x, '{quality.UPPER}', '{quality.LOWER}')) AS cut FROM documents),
m AS (SELECT *, len(w) AS n_words,
  [length(t) - length(regexp_replace(t, '[a-z]', '', 'g')), length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')),
   length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')), length(t) - length(regexp_replace(t, '[0-9]', '', 'g')),
   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')),
   length(t) - length(regexp_replace(t, '[!"''()+,\-./:;=?@\[\\\]^_`{{}}~]', '', 'g')),
   length(regexp_replace(t, '[\x09-\x0D\x20-\x7E]', '', 'g'))] AS chars,
  list_filter(cut, lambda x: x <> '') AS tokens,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  list_transform(range(1, greatest(len(w) - 4, 0) + 1), lambda i: array_to_string(w[i:i + 4], ' ')) AS wins FROM d),
u AS (SELECT doc_id, unnest(wins) AS win, unnest(range(1, len(wins) + 1)) AS i FROM m),
f AS (SELECT doc_id, i FROM u QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
c AS (SELECT doc_id, sum(least(5, i - coalesce(before, i - 5))) AS n FROM
  (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM f) GROUP BY doc_id),
h AS (SELECT m.doc_id, lang, n_words, CAST(list_sum(chars) - chars[3] AS BIGINT) AS word_chars, chars[5] AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, chars,
  list_transform({_COMMON}, lambda k: len(list_filter(tokens, lambda x: x = k))) AS common, len(tokens) AS n_tokens
  FROM m LEFT JOIN c ON c.doc_id = m.doc_id),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  [CAST(list_sum(common) AS BIGINT), CAST(n_tokens - list_sum(common) AS BIGINT)] AS share FROM h),
s AS (SELECT lang, {", ".join(f"CASE WHEN {long} THEN {_PARTS.format(h)} END AS {h}" for h, (long, *_) in _HISTOGRAMS.items())}
  FROM r WHERE NOT base_failed),
ref AS (SELECT lang, {", ".join(
    f"CASE WHEN count({h}) > 0 THEN [" + ", ".join(f"quantile_cont({h}[{k + 1}], 0.5)" for k in range(n)) + f"] END AS ref_{h}"
    for h, (_, n, *_) in _HISTOGRAMS.items())} FROM s GROUP BY lang),
j AS (SELECT r.*, {", ".join(f"CASE WHEN {long} THEN {_distance(h, 'ref_' + h)} END AS {name}" for h, (long, _, name, _) in _HISTOGRAMS.items())}
  FROM r LEFT JOIN ref ON r.lang IS NOT DISTINCT FROM ref.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(f"coalesce({name}, 0) <= {limit}" for _, _, name, limit in _HISTOGRAMS.values())} AS kept,
  {", ".join(name for _, _, name, _ in _HISTOGRAMS.values())} FROM j"""

# CRC-32 of a list of bytes, with the table ``tb`` of ``crc_table``
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i:
  list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tb)"""


def _crc(byte_list: str) -> str:
    step = "xor(a >> 8, tb[CAST((xor(a, b) & 255) + 1 AS BIGINT)])"
    return f"xor(list_reduce(list_prepend(4294967295, {byte_list}), lambda a, b: {step}), 4294967295)"


_DIGITS = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
_TRIE = f"""
WITH {_CRC_TABLE},
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST) AS place FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc(_DIGITS)} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
again AS (SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
lined AS (SELECT conv_id, md5(role || chr(1) || text) AS key, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM again),
paths AS (SELECT conv_id, depth, size, list(key) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM lined
  UNION ALL SELECT conv_id, 0, 0, [] FROM convs),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY depth, path),
up AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
children AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN children USING (depth, path)),
below AS (SELECT a AS depth, path[1:a] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM full_nodes) GROUP BY ALL)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM full_nodes JOIN below USING (depth, path)"""

_UTF8 = """flatten(list_transform(string_split({}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
  ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))"""
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS n FROM
  (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, {_crc(_UTF8.format("concat(doc_id, ':', run)"))} AS h FROM runs, crc_table),
slipped AS (SELECT n, CASE WHEN h % {spelling.SLIP} = 0 THEN concat(substr(run, 1, CAST(h % length(run) AS BIGINT)), substr(run, CAST(h % length(run) AS BIGINT) + 2)) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= {spelling.LETTERS} GROUP BY word HAVING sum(n) >= {spelling.TIMES}),
cut AS (SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE concat(substr(word, 1, i - 1), substr(word, i + 1)) END AS rest
  FROM (SELECT *, unnest(range(0, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.word <> b.word
  AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
named AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= {spelling.FACTOR} * w.n THEN b.near END AS form,
  CASE WHEN b.near_n >= {spelling.FACTOR} * w.n THEN b.near_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (SELECT word, word AS root, 0 AS step FROM named UNION ALL
  SELECT c.word, f.form, step + 1 FROM chain c JOIN named f ON f.word = c.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM named JOIN last USING (word)"""

_VECTORS = f"""
WITH v AS (SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: CAST(floor({vector_search.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS score
  FROM v q JOIN v c ON q.own <> c.own AND len(q.e) = len(c.e) WHERE q.vec_id % {vector_search.EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {vector_search.TOP}"""

assert mixing.WEIGHTS == (3, 1, 2) and mixing.SHARE == (3, 2) and mixing.MOST == 2

ORACLE: dict[str, str] = {
    "op4_quality": _QUALITY,
    "op5_decontamination": _DECONTAMINATION,
    "op6_mixing": _MIX,
    "op11_conversation_trie": _TRIE,
    "op12_spelling": _SPELLING,
    "op13_vector_search": _VECTORS,
}
