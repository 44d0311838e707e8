"""SQL for queries of this package that SQL can express by other means: no index, filter or walk."""

from __future__ import annotations

from tablecheck.llm import license_scan, spelling_variants

_LOWER = f"translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}')"

OP11_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all({_LOWER},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
n AS (SELECT r, doc_id, count(*) AS n FROM d GROUP BY r, doc_id),
g AS (SELECT count(*)::bigint AS docs, sum(n)::bigint AS terms FROM n),
q AS (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all({_LOWER},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT r, term, count(*)::bigint AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint AS w
  FROM tf, g GROUP BY term, docs),
i AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * docs) // terms)))) AS part
  FROM tf JOIN n USING (r) JOIN w USING (term), g),
s AS (SELECT item, item_id, doc_id, r, sum(part)::bigint AS score FROM q JOIN i USING (term) JOIN n USING (r)
  GROUP BY item, item_id, doc_id, r),
k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, r)::int AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_PHRASES = ", ".join(f"({_list(p.split(' '))}, '{label}')" for p, label in license_scan.PHRASES)
_TEMPLATES = ", ".join(
    f"({_list(w)}, '{label}', {-(-len(w) * license_scan.PERCENT // 100)})"
    for label, text in license_scan.TEMPLATES
    for w in [license_scan.template_words(text)]
)

OP12_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS (SELECT * FROM (VALUES {_PHRASES}) AS x(phrase, label)),
f AS (SELECT r, label, i FROM (SELECT r, ws, unnest(range(len(ws))) AS i FROM d) JOIN p ON ws[i + 1 : i + len(phrase)] = phrase),
b AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_distinct(list(label)) AS base FROM f GROUP BY r),
t AS (SELECT * FROM (VALUES {_TEMPLATES}) AS x(tokens, label, least)),
k AS (SELECT r, list_distinct(ws[s + 1 : s + {license_scan.WINDOW}]) AS block
  FROM (SELECT r, ws, unnest(range(0, len(ws), {license_scan.STRIDE})) AS s FROM d)),
m AS (SELECT r, list_distinct(list(label)) AS more, max(len(list_intersect(block, tokens)) / len(tokens)) AS share
  FROM k JOIN t ON len(list_intersect(block, tokens)) >= least GROUP BY r)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(n_base, 0)::bigint AS n_base, first_word::bigint AS first_word,
  last_word::bigint AS last_word, coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::double ELSE coalesce(share, 0.0)::double END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r)"""

# Fixed value: the polynomial of CRC-32. Letters from U+00C0 on are two bytes in UTF-8.
OP13_SQL = rf"""WITH RECURSIVE c AS (SELECT list(v ORDER BY x) AS crc FROM (SELECT x, list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
  FROM (SELECT unnest(range(256))::bigint AS x))),
d AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM d WHERE length(run) >= {spelling_variants.LEAST_CHARS} GROUP BY doc_id, run),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::bigint] ELSE [195::bigint, ord(x)::bigint - 64] END))),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM g, c),
o AS (SELECT CASE WHEN h % {spelling_variants.EVERY} = 0
    THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::bigint AS n FROM o WHERE length(word) >= {spelling_variants.LEAST_CHARS}
  GROUP BY word HAVING sum(n) >= {spelling_variants.LEAST_ROWS}),
v AS (SELECT DISTINCT word, n, i, word[1 : i] || word[i + 2 :] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
e AS (SELECT a.word AS word, b.word AS other FROM v a JOIN v b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION SELECT v.word, w.word FROM v JOIN w ON v.rest = w.word UNION SELECT w.word, v.word FROM v JOIN w ON v.rest = w.word),
k AS (SELECT e.word, e.other, w.n, count(*) OVER (PARTITION BY e.word) AS n_near,
  row_number() OVER (PARTITION BY e.word ORDER BY w.n DESC, encode(e.other)) AS place FROM e JOIN w ON w.word = e.other),
j AS (SELECT w.word, w.n, coalesce(k.n_near, 0) AS n_near, CASE WHEN k.n >= {spelling_variants.TIMES} * w.n THEN other END AS form,
  CASE WHEN k.n >= {spelling_variants.TIMES} * w.n THEN k.n END AS form_n FROM w LEFT JOIN k ON k.word = w.word AND place = 1),
r AS (SELECT word, word AS root, form AS next FROM j
  UNION ALL SELECT r.word, j.word, j.form FROM r JOIN j ON r.next = j.word)
SELECT j.word, j.n, j.n_near::bigint AS n_near, j.form, j.form_n::bigint AS form_n, r.root
FROM j JOIN r ON r.word = j.word AND r.next IS NULL"""
