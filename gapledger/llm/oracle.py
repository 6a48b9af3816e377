"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .chat_format import CLOSE, CONTROL, OPEN, SEP
from .decontam import DRIFT, EXACT_FREE, EXACT_LEAST, MOST_SLOTS, NAME, NUMBER, RUN, RUNS, UNIT, UNITS, WINDOW

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _escaped(c: str) -> str:
    c = f"replace({c}, '\\', '\\\\')"
    for s in CONTROL:
        c = f"replace({c}, '{s}', '{s[0]}\\{s[1:]}')"
    return c


SQL = {
    "op1_chat_format": f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  sum({len(OPEN) + len(SEP) + len(CLOSE)} + length({_escaped('role')}) + length({_escaped('text')}))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id""",
    "op3_line_quality": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
grams AS (SELECT doc_id, i, ws[i:i+4] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cover AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM
  (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, source, text, trim(regexp_replace(regexp_replace({_LOW.format('l')}, '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS l FROM d)),
hot AS (SELECT source, line FROM lines WHERE line != '' GROUP BY source, line HAVING count(DISTINCT (coalesce(doc_id::VARCHAR, '') || ':' || text)) > 200),
gone AS (SELECT l.doc_id, sum(CASE WHEN h.line IS NULL THEN 0 ELSE len(string_split(l.line, ' ')) END) AS removed,
  sum(len(string_split(l.line, ' '))) AS total
  FROM lines l LEFT JOIN hot h ON l.source IS NOT DISTINCT FROM h.source AND l.line = h.line WHERE l.line != '' GROUP BY l.doc_id),
base AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cover USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT coalesce(100 * removed > 50 * total, false) AS kept
FROM base LEFT JOIN gone USING (doc_id)""",
    "op9_url_rules": f"""
WITH rules(action, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, {_LOW.format("regexp_extract(r, '^([^/?#]*)', 1)")} AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
hits AS (SELECT p.page_id, u.host || u.path AS rule, u.action FROM parts p JOIN rules u
  ON (p.host = u.host OR ends_with(p.host, '.' || u.host)) AND starts_with(p.path, u.path)),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM hits GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.action, 'allow') AS verdict FROM parts p LEFT JOIN best b USING (page_id)""",
}


def _units() -> str:
    return ", ".join(f"'{u}'" for u in UNITS)


def _templates(table: str, key: str) -> str:
    """Windows of template tokens: (key, row, copy, pos, g, slots); ``pos`` from 1."""
    return rf"""
t_{table} AS (SELECT {key} AS k, row_number() OVER () AS r, md5(coalesce(text, '')) AS copy, text, regexp_extract_all(coalesce(text, ''), '[.!?\n]|\p{{L}}+|[0-9]+(?:[.,][0-9]+)*') AS ts FROM {table}),
u_{table} AS (SELECT k, r, copy, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS i FROM t_{table}),
p_{table} AS (SELECT *, lag(t) OVER (PARTITION BY r ORDER BY i) AS p FROM u_{table}),
c_{table} AS (SELECT k, r, copy, i, t, CASE
  WHEN t >= '0' AND t < ':' THEN '{NUMBER}' WHEN p >= '0' AND p < ':' AND lower(t) IN ({_units()}) THEN '{UNIT}'
  WHEN t != lower(t) AND length(t) > 1 AND t[1] || lower(t)[2:] = t AND p NOT IN ('.', '!', '?', chr(10)) THEN '{NAME}'
  ELSE lower(t) END AS c FROM p_{table} WHERE t NOT IN ('.', '!', '?', chr(10))),
l_{table} AS (SELECT any_value(k) AS k, r, any_value(copy) AS copy, list(c ORDER BY i) AS cs,
  list(CASE c WHEN '{NUMBER}' THEN t WHEN '{UNIT}' THEN lower(t) WHEN '{NAME}' THEN lower(t) END ORDER BY i) AS vs FROM c_{table} GROUP BY r),
w_{table} AS (SELECT k, r, copy, pos, cs[pos:pos + {WINDOW - 1}] AS g, vs[pos:pos + {WINDOW - 1}] AS slots FROM
  (SELECT k, r, copy, cs, vs, unnest(range(1, len(cs) - {WINDOW - 2})) AS pos FROM l_{table}))"""


#: Scripts without spaces, as DuckDB's patterns name them.
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
_ENDS = "('.', '!', '?', chr(10), '。', '！', '？')"


def _exact(table: str) -> str:
    """Exact tokens of a text: (k, r, words, s, e), whether a sentence starts and
    ends with each. Letters of scripts without spaces are set apart first."""
    return rf"""
a_{table} AS (SELECT k, r, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS i FROM (SELECT k, r, regexp_extract_all(
  regexp_replace(coalesce(text, ''), '([{_UNSPACED}])', chr(1) || '\1' || chr(1), 'g'),
  '[.!?\n。！？]|[{_UNSPACED}]|\p{{L}}+|[0-9]+(?:[.,][0-9]+)*') AS ts FROM t_{table})),
b_{table} AS (SELECT *, coalesce(lag(t) OVER o, '.') IN {_ENDS} AS s, coalesce(lead(t) OVER o, '.') IN {_ENDS} AS e
  FROM a_{table} WINDOW o AS (PARTITION BY r ORDER BY i)),
x_{table} AS (SELECT any_value(k) AS k, r, list(lower(t) ORDER BY i) AS words, list(s ORDER BY i) AS s, list(e ORDER BY i) AS e
  FROM b_{table} WHERE t NOT IN {_ENDS} GROUP BY r)"""


SQL["op7_decontamination"] = rf"""
WITH {_templates('documents', 'doc_id')}, {_templates('benchmark', 'item_id')}, {_exact('documents')}, {_exact('benchmark')},
usable AS (SELECT * FROM w_benchmark WHERE len(list_filter(slots, lambda v: v IS NOT NULL)) <= {MOST_SLOTS}),
items AS (SELECT *, dense_rank() OVER (PARTITION BY item_id ORDER BY pos) AS nth FROM
  (SELECT DISTINCT k AS item_id, pos, g, slots FROM usable)),
n AS (SELECT item_id, count(DISTINCT pos) AS item_windows FROM items GROUP BY item_id),
found AS (SELECT d.k AS doc_id, d.copy, i.item_id, n.item_windows, i.pos, i.nth, d.pos - i.pos AS shift, d.slots AS ds, i.slots AS bs
  FROM w_documents d JOIN items i ON d.g = i.g JOIN n ON n.item_id = i.item_id),
lined AS (SELECT *, nth - dense_rank() OVER (PARTITION BY doc_id, copy, item_id, shift ORDER BY pos) AS run FROM found),
judged AS (
  SELECT *, 0 AS kind, '' AS part, 0 AS place, 0 AS streak FROM lined
  UNION ALL SELECT *, 1, copy, shift, 0 FROM lined
  UNION ALL SELECT *, 2, copy, floor(shift / {DRIFT})::BIGINT, 0 FROM lined
  UNION ALL SELECT *, 3, copy, floor((shift + {DRIFT // 2}) / {DRIFT})::BIGINT, 0 FROM lined
  UNION ALL SELECT *, {RUNS}, copy, shift, run FROM lined),
covered AS (SELECT doc_id, item_id, kind, part, place, streak, count(DISTINCT pos) AS matched_windows, max(item_windows) AS item_windows
  FROM judged GROUP BY ALL
  HAVING CASE WHEN kind = {RUNS} THEN count(DISTINCT pos) >= {RUN} ELSE count(DISTINCT pos) >= 0.4 * max(item_windows) END),
pairs AS (SELECT doc_id, item_id, kind, part, place, streak, b, min(d) = max(d) AS same FROM
  (SELECT doc_id, item_id, kind, part, place, streak, unnest(bs) AS b, unnest(ds) AS d FROM judged) WHERE b IS NOT NULL GROUP BY ALL),
slots AS (SELECT doc_id, item_id, kind, part, place, streak, count(*) AS n_slots, sum(same::INT)::BIGINT AS n_consistent
  FROM pairs GROUP BY ALL),
short AS (SELECT x.k AS item_id, x.words, len(list_distinct(list_filter(l.vs, lambda v: v IS NOT NULL)))::BIGINT AS n_slots,
  len(x.words) - len(list_filter(x.words, lambda w: regexp_matches(w, '^[{_UNSPACED}]'))) / 2 AS weight
  FROM x_benchmark x LEFT JOIN l_benchmark l ON l.r = x.r WHERE x.r NOT IN (SELECT r FROM usable)),
whole AS (SELECT DISTINCT *, weight >= {EXACT_FREE} AND len(list_filter(words, lambda w: NOT regexp_matches(w, '^[0-9]'))) > 0 AS free
  FROM short WHERE weight >= {EXACT_LEAST}),
said AS (SELECT x.*, unnest(range(1, len(words) + 1)) AS i FROM x_documents x),
passed AS (
  SELECT c.doc_id, c.item_id, matched_windows, coalesce(n_slots, 0) AS n_slots, coalesce(n_consistent, 0) AS n_consistent, item_windows
  FROM covered c LEFT JOIN slots s ON c.doc_id IS NOT DISTINCT FROM s.doc_id AND c.item_id IS NOT DISTINCT FROM s.item_id
    AND c.kind = s.kind AND c.part = s.part AND c.place = s.place AND c.streak = s.streak
  WHERE coalesce(n_consistent, 0) >= 0.8 * coalesce(n_slots, 0)
  UNION ALL SELECT d.k, w.item_id, 1, coalesce(w.n_slots, 0), coalesce(w.n_slots, 0), 1
  FROM said d JOIN whole w ON d.words[d.i] = w.words[1] AND d.words[d.i:d.i + len(w.words) - 1] = w.words
  WHERE w.free OR (d.s[d.i] AND d.e[d.i + len(w.words) - 1])),
best AS (SELECT doc_id, item_id, max({{'a': matched_windows, 'b': n_slots, 'c': n_consistent, 'd': item_windows}}) AS x FROM passed GROUP BY doc_id, item_id)
SELECT doc_id, item_id, x.a::BIGINT AS matched_windows, x.d::BIGINT AS item_windows, x.b::BIGINT AS n_slots, x.c::BIGINT AS n_consistent FROM best"""


# crc32 in SQL: the table of its polynomial, and one step per byte (UTF-8 of code points below 256)
_CRC_TABLE = """crc_table AS (SELECT list(list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t FROM range(256) r(i))"""


def _crc(text: str) -> str:
    """crc32 of ``text`` of code points below 256; ``t`` is the column of crc_table."""
    code = "unicode(c)::UBIGINT"
    units = f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN {code} < 128 THEN [{code}] ELSE [192 + ({code} >> 6), 128 + ({code} & 63)] END))"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {units}), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255)::BIGINT + 1])), 4294967295)"


SQL["op11_prefix_trie"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(x ORDER BY r) AS xs, {_crc("conv_id::VARCHAR")} % 4 AS h FROM turns, crc_table GROUP BY conv_id, t),
built AS (SELECT o.conv_id AS c, list_concat(coalesce(b.xs, [])[1:o.h::BIGINT], o.xs[o.h::BIGINT + 1:]) AS xs
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
rows AS (SELECT c, d, xs[1:d] AS p, CASE WHEN d > 0 THEN xs[1:d - 1] END AS above, d = len(xs) AS ends,
    CASE WHEN d > 0 THEN len(regexp_extract_all(xs[d].text, '[^ 	-
]+')) ELSE 0 END AS words
  FROM (SELECT c, xs, unnest(range(0, len(xs) + 1)) AS d FROM built)),
nodes AS (SELECT p, d, min(c) AS conv, count(*) AS n_convs, any_value(above) AS above, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM rows GROUP BY p, d),
linked AS (SELECT n.*, q.conv AS parent FROM nodes n LEFT JOIN nodes q ON n.d > 0 AND q.d = n.d - 1 AND q.p = n.above),
kids AS (SELECT n.*, (SELECT count(*) FROM linked k WHERE k.parent = n.conv AND k.d = n.d + 1) AS n_children FROM linked n),
up AS (SELECT conv AS leaf, d AS leaf_d, conv, d FROM kids
  UNION ALL SELECT leaf, leaf_d, k.parent, k.d - 1 FROM up JOIN kids k ON k.conv = up.conv AND k.d = up.d WHERE k.d > 0),
sums AS (SELECT up.conv, up.d, sum((k.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((k.n_convs - 1) * k.words)::BIGINT AS saved_tokens
  FROM up JOIN kids k ON k.conv = up.leaf AND k.d = up.leaf_d GROUP BY up.conv, up.d)
SELECT k.conv AS conv_id, k.d AS depth, k.parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM kids k JOIN sums s ON k.conv = s.conv AND k.d = s.d"""

SQL["op13_multi_index"] = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, CASE WHEN label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0 THEN embedding::DOUBLE[] END AS e FROM embeddings),
links AS (SELECT a.r AS x, b.r AS y, a.vec_id AS x_id, b.vec_id AS y_id FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r != b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT r AS x, r AS y FROM v UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
low AS (SELECT reach.x, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.y GROUP BY reach.x),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT v.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN low ON low.x = v.r LEFT JOIN n ON n.x = v.r"""


SQL["op12_spelling"] = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
low AS (SELECT id, {_LOW.format("run")} AS run FROM runs WHERE length(run) >= 7),
times AS (SELECT id, run, count(*) AS n FROM low GROUP BY id, run),
hashed AS (SELECT run, n, {_crc("id || ':' || run")} AS h FROM times, crc_table),
lost AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed),
w AS (SELECT word, sum(n)::BIGINT AS n FROM lost WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word != b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM cut a JOIN w ON w.word = a.rest
  UNION SELECT w.word, w.n, a.word, a.n FROM cut a JOIN w ON w.word = a.rest),
best AS (SELECT word, n, count(*) AS n_near, min((-other_n, other)) AS b FROM near GROUP BY word, n),
known AS (SELECT word, n_near, CASE WHEN -b[1] >= 10 * n THEN b[2] END AS form, CASE WHEN -b[1] >= 10 * n THEN -b[1] END AS form_n FROM best),
follow AS (SELECT word, form AS root, 1 AS step FROM known WHERE form IS NOT NULL
  UNION ALL SELECT f.word, k.form, step + 1 FROM follow f JOIN known k ON k.word = f.root WHERE k.form IS NOT NULL),
last AS (SELECT word, arg_max(root, step) AS root FROM follow GROUP BY word)
SELECT w.word, k.form, coalesce(l.root, w.word) AS root, w.n, coalesce(k.n_near, 0)::BIGINT AS n_near, k.form_n::BIGINT AS form_n
FROM w LEFT JOIN known k ON k.word = w.word LEFT JOIN last l ON l.word = w.word"""
