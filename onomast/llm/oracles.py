"""The queries of this subpackage in SQL for DuckDB, where SQL can express them: op3 whole, and what no model decides of op6, op7 and op8."""

_SPACE = r"\x20\x09-\x0D"
_ALL = "regexp_extract_all"

PERSONAL = rf"""SELECT doc_id, len({_ALL}(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')) AS n_email,
 len(list_filter({_ALL}(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda x: list_max(list_transform(string_split(x, '.'), lambda p: CAST(p AS DOUBLE))) <= 255)) AS n_ip,
 len(list_filter(list_transform({_ALL}(t, '[0-9]([\x20-]?[0-9])+'), lambda x: regexp_replace(x, '[\x20-]', '', 'g')), lambda d: length(d) BETWEEN 13 AND 19 AND
   list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(d[length(d) - i] AS INT) ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][CAST(d[length(d) - i] AS INT) + 1] END)) % 10 = 0)) AS n_card,
 len(list_filter({_ALL}(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 9 AND 15)) AS n_phone
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)"""

SECRETS = rf"""SELECT doc_id, len(list_filter({_ALL}(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 8)) AS n_assign,
 len(list_filter({_ALL}(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 16)) AS n_access, len(list_filter({_ALL}(t, '[0-9a-f]+'), lambda x: length(x) >= 32)) AS n_hex
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)"""

RULES = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_ALL}(t, '[^{_SPACE}]+') AS w FROM d),
g AS (SELECT r, i, list_slice(w, i, i + 4) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
p AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i + unnest(range(5)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM g) WHERE k > 1) GROUP BY r)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM (
 SELECT doc_id, len(w) AS n_words, CAST(length(regexp_replace(t, '[{_SPACE}]', '', 'g')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
 FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS l FROM w) LEFT JOIN p USING (r))"""

# windows are cut from blocks of 400 bytes, so that a long text is not scanned from its beginning for each
SUBSTRINGS = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT r, doc_id, k * 400 AS o, substr(h, k * 800 + 1, 1000) AS h FROM (SELECT r, doc_id, h, unnest(range(length(h) // 800 + 1)) AS k FROM d)),
w AS (SELECT r, doc_id, o + i AS i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT *, unnest(range(least(400, length(h) // 2 - 99))) AS i FROM b)),
f AS (SELECT s, min({'d': doc_id, 'i': i}) AS f FROM w GROUP BY s HAVING count(*) > 1),
q AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w JOIN f USING (s) WHERE {'d': doc_id, 'i': i} > f),
p AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g FROM q),
c AS (SELECT r, g, min(i) AS lo, max(i) + 100 AS hi FROM p GROUP BY r, g),
k AS (SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY g), 0) AS a, lo AS z FROM c UNION ALL SELECT d.r, coalesce(max(hi), 0), length(any_value(h)) // 2 FROM d LEFT JOIN c ON d.r = c.r GROUP BY d.r),
s AS (SELECT d.r, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS kept FROM d JOIN k ON d.r = k.r GROUP BY d.r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN s ON d.r = s.r LEFT JOIN (SELECT r, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM c GROUP BY r) x ON d.r = x.r"""

ORACLES = {"op3_suffix_dedup": SUBSTRINGS, "personal_counts": PERSONAL, "secret_counts": SECRETS, "rule_counts": RULES}
