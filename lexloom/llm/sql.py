"""SQL of the operators that SQL can express, over the same tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"list_filter(string_split_regex({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_SPACED = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH items AS (
  SELECT DISTINCT item_id, {_PLAIN.format(_LOWER.format("text"))} AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL),
sought AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_PLAIN.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM sought) WHERE len(w) >= k)),
found AS (SELECT doc_id, k, i, item_id FROM windows JOIN sought USING (k, win)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, {_SPACED.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM repeated),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM docs),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM words ANTI JOIN covered USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

SIMILAR = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_SPACED.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reached AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT links.b, other FROM reached JOIN links ON a = doc_id),
named AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN named USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

_LETTERS = r"list_filter(string_split_regex({}, '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_SHARE = "CAST(1 + (CAST(1000000000 AS HUGEINT) * ({} + 2)) // ({} + 2 * {}) AS HUGEINT)"

DIVERGENCE = f"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTERS.format(_LOWER.format("coalesce(text, '')"))} AS w,
    row_number() OVER () AS d FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
terms AS (SELECT lang, source, d, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
present AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM present GROUP BY ALL),
shares AS (
  SELECT lang, g.source, k.term, coalesce(p.n, 0) AS n, {_SHARE.format("coalesce(p.n, 0)", "coalesce(t.total, 0)", "l.v")} AS p, {_SHARE.format("k.n", "l.total", "l.v")} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN present p USING (lang, source, term) LEFT JOIN totals t USING (lang, source)),
values_ AS (
  SELECT a.lang AS lang, a.source AS source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang
  LEFT JOIN (
    SELECT x.lang AS lang, x.source AS source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  WHERE a.source <> b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM values_)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 10
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"
_PARENTS = "[sha256(x[i] || coalesce(x[i + 1], '')) FOR i IN range(1, len(x) + 1, 2)]"
_CRC32 = (  # of a short ASCII string s, bit by bit; 3988292384 is the reversed polynomial
    "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(s, '')]), "
    "lambda a, b: list_reduce(list_concat([xor(a, b)], [CAST(0 AS BIGINT) FOR k IN range(8)]), "
    "lambda u, v: CASE WHEN u % 2 = 1 THEN xor(u // 2, 3988292384) ELSE u // 2 END)), 4294967295)"
)

MANIFEST = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_LEAF.format("n_chars")} AS leaf, {_LEAF.format("(n_chars + 1)")} AS changed, {_CRC32} % 7 = 0 AND n_chars IS NOT NULL AS tampered
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents)),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM rows),
layers AS (
  SELECT tree, 0 AS l, list(leaf ORDER BY p) AS x FROM placed GROUP BY tree
  UNION ALL SELECT tree, l + 1, {_PARENTS} FROM layers WHERE len(x) > 1),
subroots AS (SELECT tree, x[1] AS subroot, l AS height, row_number() OVER (ORDER BY tree) - 1 AS p FROM layers WHERE len(x) = 1),
tops AS (
  SELECT 0 AS l, list(subroot ORDER BY p) AS x FROM subroots
  UNION ALL SELECT l + 1, {_PARENTS} FROM tops WHERE len(x) > 1),
steps AS (
  SELECT tree, p, l, (p >> l) % 2 AS right_, coalesce(x[xor(p >> l, 1) + 1], '') AS sibling
  FROM placed JOIN layers USING (tree) WHERE len(x) > 1
  UNION ALL
  SELECT tree, q.p, height + l, (s.p >> l) % 2, coalesce(x[xor(s.p >> l, 1) + 1], '')
  FROM placed q JOIN subroots s USING (tree), tops WHERE len(x) > 1),
folding AS (
  SELECT tree, p, 0 AS l, CASE WHEN tampered THEN changed ELSE leaf END AS node FROM placed
  UNION ALL
  SELECT f.tree, f.p, f.l + 1, sha256(CASE WHEN right_ = 1 THEN sibling || node ELSE node || sibling END) FROM folding f JOIN steps s ON s.tree = f.tree AND s.p = f.p AND s.l = f.l),
proofs AS (SELECT tree, p, string_agg(sibling, '' ORDER BY l) AS proof FROM steps GROUP BY ALL),
folded AS (SELECT tree, p, arg_max(node, l) AS folded_root FROM folding GROUP BY ALL)
SELECT doc_id, leaf, subroot, x[1] AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = x[1] AS verified
FROM (SELECT q.doc_id, q.leaf, q.tree, q.p FROM placed q) JOIN (SELECT tree, subroot FROM subroots) USING (tree) JOIN folded USING (tree, p) LEFT JOIN proofs USING (tree, p), tops
WHERE len(x) = 1
"""

# Kind, pattern of candidates, test of a candidate m, score, context. National ids stand between
# characters that cannot continue them, so they are whole runs of such characters.
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (  # j counts from 1
    "list_sum([CASE WHEN j % 2 = 0 THEN d * 2 - CASE WHEN d > 4 THEN 9 ELSE 0 END ELSE d END "
    f"FOR d, j IN [CAST(c AS INTEGER) FOR c IN string_split(reverse({_DIGITS}), '')]])"
)
_ACCOUNT = "upper(replace(m, ' ', ''))"
_MOVED = f"string_split(substr({_ACCOUNT}, 5) || substr({_ACCOUNT}, 1, 4), '')"
_FOUR = "(?:[0-9][A-Z0-9]{3}|[A-Z][0-9][A-Z0-9]{2}|[A-Z]{2}[0-9][A-Z0-9]|[A-Z]{3}[0-9])"
_REST = "(?:[0-9][A-Z0-9]{0,2}|[A-Z][0-9][A-Z0-9]?|[A-Z]{2}[0-9])"
_IBAN = rf"(?i)\b[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|\x20[A-Z0-9]{{4}}(?:\x20{_FOUR}){{1,6}}(?:\x20{_REST})?)\b"
_MOD97 = (
    f"list_reduce([CAST(CASE WHEN c BETWEEN 'A' AND 'Z' THEN ascii(c) - 55 ELSE ascii(c) - 48 END AS BIGINT) FOR c IN {_MOVED}], "
    "lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97, CAST(0 AS BIGINT)) % 97 = 1"
)
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 0.9, r"(?i)\b((e-?)?mail|contact|write)\b"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len([p FOR p IN string_split(m, '.') IF CAST(p AS HUGEINT) > 255]) = 0", 0.6, r"(?i)\b(ip|host|server|address|login)\b"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"CASE WHEN length({_DIGITS}) BETWEEN 13 AND 19 THEN {_LUHN} % 10 = 0 ELSE false END", 0.8, r"(?i)\b(card|credit|visa|payment|pay)\b"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15", 0.6, r"(?i)\b(phone|tel|call|mobile|fax)\b"),
    ("iban", _IBAN, _MOD97, 0.9, r"(?i)\b(iban|bank|account)\b"),
    ("national_id", r"[0-9-]+", "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}')", 0.3, r"(?i)\b(ssn|social|security|identity)\b"),
)


def _spans(number: int, kind: tuple) -> str:
    name, pattern, test, score, context = kind
    return f"""{name}_all AS (
  SELECT doc_id, x, m, sum(length(s) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e
  FROM (SELECT doc_id, x, unnest(regexp_extract_all(x, '{pattern}')) AS m, unnest(string_split_regex(x, '{pattern}')[:-2]) AS s,
      generate_subscripts(regexp_extract_all(x, '{pattern}'), 1) AS i FROM texts WHERE regexp_matches(x, '{pattern}'))),
{name}_spans AS (
  SELECT doc_id, {number} AS kind, '{name}' AS name, e - length(m) AS b, e,
    least(CAST({score} AS DOUBLE) + CASE WHEN regexp_matches(right(left(x, CAST(e - length(m) AS BIGINT)), 40) || ' ' || left(substr(x, CAST(e + 1 AS BIGINT)), 40), '{context}')
      THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, CAST(1 AS DOUBLE)) AS score
  FROM {name}_all WHERE {test})"""


PERSONAL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
{", ".join(_spans(i, k) for i, k in enumerate(_KINDS))},
spans AS ({" UNION ALL ".join(f"SELECT * FROM {k[0]}_spans WHERE kind < 4 OR score >= 0.5" for k in _KINDS)}),
named AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{k[0]}" for i, k in enumerate(_KINDS))}, min(score) AS lowest_score,
    string_agg(name || ':' || CAST(b AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY kind, b) FILTER (kind < 4) AS base,
    string_agg(name || ':' || CAST(b AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY kind, b) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in _KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, lowest_score
FROM texts LEFT JOIN named USING (doc_id)
"""
