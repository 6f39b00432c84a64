"""DuckDB SQL for the queries of this package that SQL can express."""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS r(i) WHERE len(w) > 0),
pos AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS r(i) WHERE len(w) >= n),
hit AS (SELECT p.doc_id, p.i, p.n, k.item_id FROM pos p JOIN win k ON p.n = k.n AND p.win = k.win),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# fixed values: the rules as (kind, pattern, group whose length counts, least length)
_RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*(?:-[^-]+){0,12}-----END [A-Z ]{0,40}PRIVATE KEY-----"
                    r"|(?:[\x20\x09\x0A\x0D]+[A-Za-z0-9+/=]{16,}){0,60})", 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("url_login", r"://[^\s:@/]+:[^\s:@/]+@", 0, 0),
)


def _matches(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS kind, '{kind}' AS name, {least} AS least,
         list_transform(regexp_extract_all(text, '{quoted}', 0), lambda x: length(x)) AS m,
         list_transform(regexp_extract_all(text, '{quoted}', {group}), lambda x: length(x)) AS g,
         list_transform(string_split_regex(text, '{quoted}'), lambda x: length(x)) AS p
  FROM t WHERE regexp_matches(text, '{quoted}')"""


SECRETS = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(_matches(n, *r) for n, r in enumerate(_RULES))}),
e AS (SELECT doc_id, kind, name, least, unnest(m) AS m, unnest(g) AS g, unnest(list_slice(p, 1, len(m))) AS p,
             unnest(range(len(m))) AS i FROM m),
s AS (SELECT *, sum(p + m) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
k AS (SELECT doc_id, kind, (stop - m)::BIGINT AS start, name || ':' || (stop - m)::BIGINT || ':' || stop::BIGINT AS said
      FROM s WHERE g >= least),
d AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
             count(*) FILTER (WHERE kind = 2) AS n_hex,
             string_agg(said, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
             string_agg(said, ',' ORDER BY start, kind) AS spans FROM k GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN d USING (doc_id)
"""

# fixed values: the rules as (verdict, host, path), the method's globs as (verdict, glob, expression, literal characters)
_URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
              ("block", "net", "/es/"), ("block", "net", "/fr/"))
_URL_GLOBS = (
    ("block", "*adult**", r"[^/]*adult.*", 5), ("block", "*casino**", r"[^/]*casino.*", 6),
    ("block", "*cheap-pills**", r"[^/]*cheap-pills.*", 11), ("block", "*porn**", r"[^/]*porn.*", 4),
    ("block", "*xxx**", r"[^/]*xxx.*", 3), ("block", "ads.**", r"ads\..*", 4), ("block", "*.ads.**", r"[^/]*\.ads\..*", 5),
    ("block", "**/wp-login.php", r".*/wp-login\.php", 13), ("block", "**/wp-admin/**", r".*/wp-admin/.*", 10),
    ("block", "**/cgi-bin/**", r".*/cgi-bin/.*", 9), ("block", "**.exe", r".*\.exe", 4), ("block", "**.zip", r".*\.zip", 4),
    ("block", "*.*/*/login", r"[^/]*\.[^/]*/[^/]*/login", 8),
    ("allow", "*.adult-education.*/**", r"[^/]*\.adult-education\.[^/]*/.*", 18))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in r) + ")" for r in rows)


URLS = f"""
WITH rules(verdict, h, p) AS (VALUES {_values(_URL_RULES)}),
globs(verdict, pattern, re, size) AS (VALUES {_values(_URL_GLOBS)}),
u AS (
  SELECT page_id, row_number() OVER () AS row,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (
  SELECT row, h || p AS rule, verdict, row_number() OVER (PARTITION BY row ORDER BY length(h || p) DESC) AS k
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
g AS (
  SELECT row, pattern, verdict, row_number() OVER (PARTITION BY row ORDER BY size DESC, verdict DESC, pattern DESC) AS k
  FROM u JOIN globs ON regexp_full_match(host || path, '(?s)' || re))
SELECT page_id, host, path, rule, coalesce(r.verdict, g.verdict, 'allow') AS verdict,
       CASE WHEN rule IS NULL THEN pattern END AS own_glob
FROM u LEFT JOIN r ON r.row = u.row AND r.k = 1 LEFT JOIN g ON g.row = u.row AND g.k = 1
"""

COLLOCATIONS = f"""
WITH q AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM q),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS f
  FROM w, unnest(range(1, 5)) AS s(m), unnest(range(1, len(w) - m + 2)) AS r(i) WHERE len(w) >= m
  GROUP BY ALL HAVING count(*) >= 30),
k AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE m > 1),
cut AS (
  SELECT k.lang, k.phrase, a, x, l.f AS l, r.f AS r, 2000000::HUGEINT * a // (l.f + r.f) AS score
  FROM k, unnest(range(1, k.m)) AS t(x)
  JOIN c l ON l.lang = k.lang AND l.phrase = array_to_string(list_slice(w, 1, x), ' ')
  JOIN c r ON r.lang = k.lang AND r.phrase = array_to_string(list_slice(w, x + 1, k.m), ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, x) = 1),
gone AS (
  SELECT DISTINCT k.lang, k.phrase FROM k
  JOIN k AS big ON big.lang = k.lang AND big.m > k.m AND contains(' ' || big.phrase || ' ', ' ' || k.phrase || ' ')
  WHERE 100 * big.a >= 80 * k.a),
kept AS (SELECT best.* FROM best ANTI JOIN gone USING (lang, phrase)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

RESAMPLING = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
step AS (
  SELECT i, list_reduce(range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) AS v
  FROM range(256) AS t(i)),
crc AS (SELECT list(v ORDER BY i) AS t FROM step),
word AS (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
place AS (
  SELECT word, xor(list_reduce(
           list_transform(range(strlen(word)), lambda j: ('0x' || substr(hex(encode(word)), (2 * j + 1)::INT, 2))::BIGINT),
           lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM word, crc),
dw AS (SELECT row, bucket FROM (SELECT row, unnest(w) AS word FROM d) JOIN place USING (word)),
bw AS (SELECT bucket FROM (SELECT unnest(w) AS word FROM b) JOIN place USING (word)),
s AS (SELECT bucket, count(*) AS s FROM dw GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw GROUP BY bucket),
z AS (SELECT (SELECT count(*) FROM dw)::DOUBLE AS s_all, (SELECT count(*) FROM bw)::DOUBLE AS t_all),
gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000) / ((s::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket), z),
weight AS (SELECT row, floor(sum(g) / count(*))::BIGINT AS weight FROM dw JOIN gain USING (bucket) GROUP BY row),
noise AS (SELECT row, ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM d JOIN noise USING (row) LEFT JOIN weight USING (row)),
drawn AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
    PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) END AS k,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 10 * fit // 100 THEN k END::BIGINT AS rank FROM drawn
"""

ORACLE = {
    "op5_trigram_secrets": SECRETS, "op4_prefix_containment": DECONTAMINATION, "op11_shift_and_urls": URLS,
    "op12_fingerprint_phrases": COLLOCATIONS, "op13_importance_draw": RESAMPLING}
