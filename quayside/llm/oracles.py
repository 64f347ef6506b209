"""DuckDB SQL for the rows of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from quayside.llm import decontamination, secrets, url_rules

_UPPER, _LOWER = decontamination.UPPER, decontamination.LOWER


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substring(h, CAST(2 * i + 1 AS INTEGER), 200) AS s FROM d, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS t(i)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w),
r AS (SELECT doc_id, i, i > lag(i) OVER p + 100 OR lag(i) OVER p IS NULL AS new FROM f WHERE k > 1 WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY ALL),
e AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM s),
p AS (SELECT d.doc_id, h, sum(b - a) AS gone, count(a) AS runs, max(b) AS upto,
    string_agg(substring(h, CAST(2 * before + 1 AS INTEGER), CAST(2 * (a - before) AS INTEGER)), '' ORDER BY a) AS head
  FROM d LEFT JOIN e ON d.doc_id = e.doc_id GROUP BY d.doc_id, h)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, runs AS n_spans,
  sha256(unhex(coalesce(head, '') || substring(h, CAST(2 * coalesce(upto, 0) + 1 AS INTEGER)))) AS kept_sha256
FROM p
"""


def _secret_kind(code: int, kind: str, pattern: str, group: int) -> str:
    # the check engine has no look-behind; a greedy run begins where its characters do anyway
    plain = _q(pattern.replace(r"(?<![A-Za-z0-9+/_=-])", ""))
    return f"""SELECT doc_id, source, {code} AS code, {_q(kind)} AS kind, string_split_regex(text, {plain}) AS gaps,
      regexp_extract_all(text, {plain}) AS hits, regexp_extract_all(text, {plain}, {group}) AS vals FROM documents WHERE regexp_matches(text, {plain})"""


_PATTERNS = [*((k, p, 2 if k == "assign" else 0) for k, p in secrets.BASE.items()), ("mixed", secrets.MIXED, 0)]

SECRETS = f"""
WITH m AS ({' UNION ALL '.join(_secret_kind(i, *x) for i, x in enumerate(_PATTERNS))}),
u AS (SELECT doc_id, source, code, kind, unnest(range(1, 1 + len(hits))) AS k, gaps, hits, vals FROM m),
l AS (SELECT doc_id, source, code, kind, k, length(gaps[k]) + length(hits[k]) AS step, length(hits[k]) AS long, vals[k] AS val FROM u),
a AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, code ORDER BY k) AS fin FROM l),
c AS (SELECT doc_id, source, code, kind, fin - long AS beg, fin, val FROM a
  WHERE (code <> 0 OR length(val) >= 8) AND (code <> 3 OR (regexp_matches(val, '[0-9]') AND regexp_matches(val, '[a-z]')
    AND regexp_matches(val, '[A-Z]') AND len(list_distinct(string_split(val, ''))) >= 12))),
o AS (SELECT val, count(DISTINCT {{'owner': source}}) AS owners FROM c GROUP BY val),
j AS (SELECT c.*, owners <= 1 AS live, max(CASE WHEN code < 3 THEN fin END) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto,
    min(CASE WHEN code < 3 THEN beg END) OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next
  FROM c JOIN o USING (val) WINDOW b AS (PARTITION BY doc_id ORDER BY beg, code)),
s AS (SELECT *, concat(kind, ':', beg, ':', fin) AS told FROM j
  WHERE code < 3 OR (live AND coalesce(upto, 0) <= beg AND coalesce(next, fin) >= fin))
SELECT d.doc_id, count(*) FILTER (code = 0) AS n_assign, count(*) FILTER (code = 1) AS n_access, count(*) FILTER (code = 2) AS n_hex,
  count(*) FILTER (code = 3) AS n_mixed, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
  sha256(coalesce(string_agg(told, ',' ORDER BY beg, code) FILTER (code < 3), '')) AS base_sha256,
  coalesce(string_agg(told, ',' ORDER BY beg, code), '') AS spans
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS phrase, least(len(w), 10) AS n
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
s AS (SELECT DISTINCT n FROM p),
x AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase FROM d, s, unnest(range(1, len(w) - n + 2)) AS t(i)),
m AS (SELECT doc_id, i, x.n, item_id FROM x JOIN p USING (phrase, n)),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM m, unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM m GROUP BY doc_id),
o AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
c AS (SELECT term, count(*) AS seen FROM o GROUP BY term),
q AS (SELECT phrase, unnest(string_split(phrase, ' ')) AS term, unnest(range(n)) AS place FROM (SELECT DISTINCT phrase, n FROM p)),
r AS (SELECT q.*, row_number() OVER (PARTITION BY phrase ORDER BY seen, place) AS rank, count(*) OVER z = count(seen) OVER z AS whole
  FROM q LEFT JOIN c USING (term) WINDOW z AS (PARTITION BY phrase)),
l AS (SELECT *, max(rank) OVER (PARTITION BY phrase) AS needed FROM r WHERE whole AND rank <= 3),
v AS (SELECT doc_id, phrase, needed, {' + '.join(f'max(CAST(rank = {k} AS INTEGER)) OVER g' for k in range(1, 4))} AS near
  FROM (SELECT doc_id, phrase, rank, needed, pos - place AS start FROM o JOIN l USING (term))
  WINDOW g AS (PARTITION BY doc_id, phrase ORDER BY start RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
y AS (SELECT doc_id, count(DISTINCT phrase) AS n_near FROM v LEFT JOIN (SELECT DISTINCT doc_id, phrase, true AS got FROM m) USING (doc_id, phrase)
  WHERE got IS NULL AND near >= greatest(needed - 1, least(needed, 2)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_near, 0) AS n_near, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN y USING (doc_id)
"""


def _rules(rules) -> str:
    return ", ".join(f"({_q(r.name)}, {_q(r.pattern)}, {_q(r.verdict)}, {r.weight}, {str(r.listed).lower()})" for r in rules)


URLS = f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(name, pattern, verdict, weight, listed) AS (VALUES {_rules([*url_rules.LISTED, *url_rules.UNLISTED])}),
f AS (SELECT page_id, name, verdict, listed, row_number() OVER (PARTITION BY page_id ORDER BY listed DESC, weight DESC, name) AS k
  FROM u JOIN r ON regexp_matches(host || path, pattern))
SELECT u.page_id, host, path, CASE WHEN listed THEN name END AS rule, coalesce(verdict, 'allow') AS verdict,
  CASE WHEN NOT listed THEN name END AS pattern_rule
FROM u LEFT JOIN f ON u.page_id = f.page_id AND k = 1
"""


NEGATIVES = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
  WHERE k <= 5)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 3
"""
