"""DuckDB SQL of the queries that SQL can express, from their definitions."""

from __future__ import annotations

from itertools import permutations

WORD = r"[^\x20\x09-\x0D]+"

_WORDS = rf"""docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lists AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS ws FROM docs),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM lists)"""


def _windows(name: str, size: int) -> str:
    return f"""{name} AS (SELECT doc_id, p, string_agg(w, ' ') OVER f AS s, count(*) OVER f AS n FROM words
WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)),
{name}_twice AS (SELECT doc_id, p FROM {name} WHERE n = {size} QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
{name}_words AS (SELECT doc_id, count(DISTINCT p + k) AS c FROM {name}_twice, range({size}) r(k) GROUP BY doc_id)"""


OP6 = rf"""WITH {_WORDS}, {_windows("w8", 8)}, {_windows("w5", 5)}, {_windows("w51", 51)},
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS c FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
chars AS (SELECT doc_id, sum(length(w)) AS c FROM words GROUP BY doc_id),
base AS (SELECT l.doc_id, len(ws) AS n_words, coalesce(chars.c, 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups.c, 0) AS n_dup_lines,
  coalesce(w8_words.c, 0) AS n_repeat_words, coalesce(w5_words.c, 0) AS covered, coalesce(w51_words.c, 0) AS long_words
  FROM lists l LEFT JOIN chars USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN w8_words USING (doc_id)
  LEFT JOIN w5_words USING (doc_id) LEFT JOIN w51_words USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * covered <= 40 * n_words AND long_words = 0 AS kept FROM judged"""

OP7 = rf"""WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
words AS (SELECT doc_id, len(ws) AS total, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM texts),
runs AS (SELECT doc_id, total, string_agg(w, ' ') OVER f AS s, count(*) OVER f AS n, p FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
shingles AS (SELECT DISTINCT doc_id, s FROM runs WHERE n = 5 OR (p = 1 AND total < 5)),
sizes AS (SELECT doc_id, count(*) AS c FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.c >= 75 * (x.c + y.c - shared.c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.c, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)"""

_LETTERS = ("aeiou", "nrst", "dlmc", "., -")
_COUNTS = ", ".join(f"length(line) - length(translate(line, '{x}', '')) AS c{i}" for i, x in enumerate(_LETTERS))
_APART = " + ".join(f"abs(a.c{i} - b.c{i})" for i in range(len(_LETTERS)))

OP10 = rf"""WITH lists AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS k FROM lists),
worded AS (SELECT *, doc_id::HUGEINT * 2147483648 + k AS place FROM lines WHERE regexp_matches(line, '{WORD}')),
firsts AS (SELECT line, min(place) AS first, length(line) AS n, {_COUNTS} FROM worded GROUP BY line),
near AS (SELECT DISTINCT a.line FROM (SELECT *, n + d AS other FROM firsts, range(-2, 3) r(d)) a JOIN firsts b ON b.n = a.other
  WHERE a.n >= 24 AND b.n >= 24 AND a.first > b.first AND {_APART} <= 4 AND levenshtein(a.line, b.line) <= 2),
gone AS (SELECT doc_id, k, place > first AS is_copy FROM worded JOIN firsts USING (line)
  WHERE place > first OR line IN (SELECT line FROM near)),
marks AS (SELECT doc_id, count(*) FILTER (is_copy) AS c, count(*) FILTER (NOT is_copy) AS n,
  string_agg(k::VARCHAR, ',' ORDER BY k) AS dropped FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(c, 0) AS n_copies, coalesce(n, 0) AS n_near, coalesce(dropped, '') AS dropped
FROM lists LEFT JOIN marks USING (doc_id)"""



def _secrets() -> str:
    from lowtide.llm.secret_scan import BASE, FURTHER

    kinds = []
    for order, rule in enumerate(BASE + FURTHER):
        pattern = rule.pattern.replace("'", "''")
        kinds.append(f"""SELECT doc_id, {order} AS rank, '{rule.kind}' AS kind, {rule.least} AS least,
  unnest(regexp_extract_all(text, '{pattern}', 0)) AS m, unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS v,
  unnest(string_split_regex(text, '{pattern}')[1:len(regexp_extract_all(text, '{pattern}', 0))]) AS g,
  generate_subscripts(regexp_extract_all(text, '{pattern}', 0), 1) AS i FROM docs""")
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) {}, '')"
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(kinds)}),
placed AS (SELECT *, (sum(length(g)) OVER w + sum(length(m)) OVER w)::BIGINT AS e FROM found
  WINDOW w AS (PARTITION BY doc_id, rank ORDER BY i ROWS UNBOUNDED PRECEDING)),
spans AS (SELECT doc_id, rank, kind, e - length(m) AS s, e FROM placed WHERE length(v) >= least)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, sha256({listed.format(f"FILTER (rank < {len(BASE)})")}) AS base_sha256, {listed.format("")} AS spans
FROM docs LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


OP11 = f"""WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
judged AS (SELECT doc_id, part, len(ws) < 50 AS A, 100 * len(list_distinct(ws)) < 65 * len(ws) AS B,
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS C, regexp_matches(text, '[#$%&*|]') AS D,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS E FROM docs),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (SELECT part, concat(if(A, 'A', ''), if(B, 'B', ''), if(C, 'C', ''), if(D, 'D', ''), if(E, 'E', '')) AS f,
  count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged LEFT JOIN marks USING (doc_id) GROUP BY ALL),
orders AS (SELECT unnest([{", ".join(repr("".join(p)) for p in permutations("ABCDE"))}]) AS filter_order),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
parts AS (SELECT DISTINCT part FROM failed),
hits AS (SELECT part, filter_order, step, n, good, toxic, length(f) AS c, contains(f, filter_order[step]) AS own,
  step > 1 AND f <> '' AND regexp_matches(f, '[' || filter_order[1:step - 1] || '-]') AS gone FROM failed, steps),
totals AS (SELECT part, filter_order, step, sum(n) FILTER (NOT own AND NOT gone) AS kept, sum(n) FILTER (own AND NOT gone) AS removed,
  sum(n) FILTER (own AND gone) AS redundant, sum(n) FILTER (own AND c = 1) AS unique_fails,
  sum(good) FILTER (own AND NOT gone) AS good_lost, sum(toxic) FILTER (own AND NOT gone) AS toxic_lost FROM hits GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in
  ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM totals"""


def _clusters(k: int = 8, rounds: int = 10) -> str:
    near = """SELECT row, arg_min({{c: c, d: d}}, (d, c)) AS b FROM (SELECT q.row, s.c,
  list_sum(list_transform(range(1, 65), lambda j: (q.v[j] - s.v[j]) * (q.v[j] - s.v[j])))::BIGINT AS d FROM q, c{0} s) GROUP BY row"""
    parts = []
    for i in range(rounds):
        parts.append(f"""n{i} AS MATERIALIZED ({near.format(i)}),
m{i} AS MATERIALIZED (SELECT c, list(m ORDER BY j) AS v FROM (SELECT b.c AS c, j, sum(v[j])::BIGINT AS s, count(*) AS n,
  ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM n{i} JOIN q USING (row), range(1, 65) r(j) GROUP BY ALL) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m USING (c))""")
    return f"""WITH good AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM good),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM q ORDER BY c LIMIT {k}),
{", ".join(parts)}, n AS MATERIALIZED ({near.format(rounds)})
SELECT vec_id, b.c::INTEGER AS cluster, b.d AS distance, (sum(b.d) OVER (PARTITION BY b.c))::BIGINT AS cluster_inertia,
  (sum(b.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(s.v, ',')) AS centroid_sha256
FROM n JOIN q USING (row) JOIN c{rounds} s ON s.c = b.c"""


SQL = {"op6_repetition": OP6, "op7_ngram_join": OP7, "op8_secret_scan": _secrets(), "op10_line_dedup": OP10, "op11_filter_audit": OP11,
       "op13_bit_kmeans": _clusters()}
