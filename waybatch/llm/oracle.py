"""DuckDB SQL of the conversation trie, of personal data, and of spelling variants."""

from __future__ import annotations

from waybatch.llm import sanitise

#: A row with the 256 remainders of crc32, for ``_crc``.
_REMAINDERS = ("SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t"
               " FROM (SELECT unnest(range(256)) AS i)")


def _crc(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text without code points beyond 0x7FF, next to a column ``t``."""
    utf8 = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT]"
            " ELSE [192 + (ord(c)::BIGINT >> 6), 128 + (ord(c)::BIGINT & 63)] END))")
    return f"xor(list_reduce(list_prepend(4294967295, {utf8}), lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295)"


def trie_sql() -> str:
    return f"""
WITH crc AS ({_REMAINDERS}),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc('conv_id::VARCHAR')} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc),
parts AS (
  SELECT c.conv_id, 0 AS part, t.r, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.r <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.r, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.r > c.h),
rebuilt AS (
  SELECT conv_id, coalesce(s, []) AS s FROM convs LEFT JOIN (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY part, r) AS s FROM parts GROUP BY conv_id) USING (conv_id)),
prefixes AS (
  SELECT conv_id, len(s) AS whole, d, s[1:d] AS p FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole = d), '')) AS ends,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(p[d].text)) END AS own
  FROM prefixes GROUP BY p, d),
tops AS (
  SELECT *, d > 0 AND p IS NOT NULL AS below, NOT EXISTS (SELECT 1 FROM nodes x WHERE x.d = n.d + 1 AND x.p[1:n.d] = n.p) AS leaf FROM nodes n),
sums AS (
  SELECT p, d, sum(leaf::BIGINT) AS leaves, sum(own) AS saved
  FROM (SELECT leaf, own, k AS d, q[1:k] AS p FROM (SELECT p AS q, leaf, own, unnest(range(d + 1)) AS k FROM tops)) GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
  s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.p = n.p
LEFT JOIN kids k ON k.d = n.d AND k.p = n.p
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]"""


#: The plain patterns; sanitise.PATTERNS are these in linear time.
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def personal_data_sql() -> str:
    matches = " UNION ALL ".join(
        f"SELECT row, {i} AS kind, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM d"
        for i, p in enumerate(_PATTERNS.values()))
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN 1 ELSE 2 END * reverse({digits})[i + 1]::BIGINT"
            f" - CASE WHEN i % 2 = 1 AND reverse({digits})[i + 1]::BIGINT > 4 THEN 9 ELSE 0 END)) % 10 = 0")
    joined = r"\p{L}\p{N}@._%+-"
    labels = ", ".join(f"'{k}'" for k in (*sanitise.KINDS, *sanitise.ACTIONS))
    context = lambda side: f"""
  SELECT row, entity, {side} AS c, {"start - length(before)" if side == "before" else '"end"'} AS pos FROM spans"""  # noqa: E731
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({matches}),
matched AS (
  SELECT *, sum(length(value) + length(before)) OVER (PARTITION BY row, kind ORDER BY i) AS "end"
  FROM (SELECT row, kind, i, m[i] AS value, g[i] AS before, g[i + 1] AS after FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found))),
spans AS (
  SELECT row, kind, value, ("end" - length(value))::BIGINT AS start, "end"::BIGINT AS "end",
    right(before, {sanitise.CONTEXT}) AS before, left(after, {sanitise.CONTEXT}) AS after,
    kind::VARCHAR || ':' || CASE WHEN kind < 2 THEN {_FOLD.format('value')} ELSE {digits} END AS entity
  FROM matched WHERE CASE kind WHEN 0 THEN true
    WHEN 1 THEN list_bool_and(list_transform(string_split(value, '.'), lambda p: length(ltrim(p, '0')) < 4 AND ('0' || right(p, 3))::INTEGER < 256))
    WHEN 2 THEN length({digits}) BETWEEN 12 AND 19 AND {luhn}
    ELSE length({digits}) BETWEEN 9 AND 15 END),
contexts AS ({context("before")} UNION ALL {context("after")}),
split_up AS (SELECT row, entity, pos, string_split_regex(c, '[^{joined}]+') AS w, regexp_extract_all(c, '[^{joined}]+') AS s FROM contexts),
words AS (
  SELECT row, entity, {_FOLD.format(rf"regexp_extract(w[i + 1], '^(\p{{L}}{{{sanitise.STEM + 1},}})[._%+-]*$', 1)")} AS term,
    pos + length(array_to_string(w[1:i], '')) + length(array_to_string(s[1:i], '')) AS start
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM split_up)),
terms AS (SELECT DISTINCT row, entity, term, start, start + length(term) AS "end" FROM words WHERE term <> ''),
tokens AS (SELECT DISTINCT row, entity, token FROM (
  SELECT row, entity, term AS token FROM terms UNION ALL SELECT row, entity, left(term, {sanitise.STEM}) FROM terms)),
pairs AS (SELECT entity, token, count(*) AS shared FROM tokens GROUP BY ALL HAVING count(*) >= {sanitise.SUPPORT}),
entities AS (SELECT entity, count(DISTINCT row) AS with_entity FROM spans GROUP BY entity),
said AS (
  SELECT DISTINCT row, rtrim(w, '._%+-') AS w
  FROM (SELECT row, unnest(string_split_regex({_FOLD.format('text')}, '[^{joined}]+')) AS w FROM d) WHERE length(rtrim(w, '._%+-')) > {sanitise.STEM}),
counts AS (SELECT token, count(*) AS documents FROM (
  SELECT row, w AS token FROM said UNION ALL SELECT DISTINCT row, left(w, {sanitise.STEM}) FROM said) GROUP BY token),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
scored AS (
  SELECT entity, token FROM pairs JOIN entities USING (entity) JOIN counts USING (token), n
  WHERE with_entity < n AND ln(n * shared / (with_entity::DOUBLE * documents)) / ln(n / with_entity) >= {sanitise.THRESHOLD}),
marks AS (
  SELECT DISTINCT row, start, "end", max(CASE WHEN g.token IS NULL THEN 4 ELSE 5 END) OVER (PARTITION BY row, start, "end") AS kind
  FROM terms t JOIN scored s ON s.entity = t.entity AND s.token = t.term
  LEFT JOIN scored g ON g.entity = t.entity AND g.token = left(t.term, {sanitise.STEM})),
every AS (SELECT row, start, "end", kind FROM spans UNION ALL SELECT row, start, "end", kind FROM marks),
shown AS (
  SELECT row, kind, start, ([{labels}])[kind + 1] || ':' || start::VARCHAR || ':' || "end"::VARCHAR AS s FROM every),
texts AS (
  SELECT row, {", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(sanitise.KINDS))},
    string_agg(s, ',' ORDER BY start, kind) FILTER (WHERE kind < 4) AS base, string_agg(s, ',' ORDER BY start, kind) AS spans
  FROM shown GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in sanitise.KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN texts USING (row)"""


def variants_sql() -> str:
    return f"""
WITH RECURSIVE crc AS ({_REMAINDERS}),
runs AS (
  SELECT r, {_crc("id || ':' || r")} AS h, c FROM (
    SELECT id, r, count(*) AS c FROM (
      SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_FOLD.format('text')}, '[a-zÀ-ÿ]+')) AS r FROM documents)
    WHERE length(r) >= 5 GROUP BY ALL), crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(r, (h % length(r))::INTEGER) || substring(r, (h % length(r) + 2)::INTEGER) ELSE r END AS word, c FROM runs),
vocab AS (SELECT word, sum(c)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cuts AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INTEGER AS i FROM vocab)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN vocab b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM pairs GROUP BY word, n),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form, CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n
  FROM vocab v LEFT JOIN best b ON b.word = v.word),
chain AS (
  SELECT word, word AS last, 0 AS steps FROM forms
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(last, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
