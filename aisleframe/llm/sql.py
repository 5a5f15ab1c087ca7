"""DuckDB counterparts of the queries that SQL can express."""

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
WORDS_LOWER = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x20\\x09-\\x0D]+')")

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, hash(ws[i:i + 34]) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (
  SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN again USING (g)) GROUP BY doc_id),
cut AS (SELECT doc_id, len(ws) AS n_words,
  CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, k: NOT list_contains(ps, k)) END AS kept
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_words - len(kept) AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM cut"""

NGRAM_JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS_LOWER} AS ws FROM documents),
grams AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT a, b FROM ways UNION SELECT r.node, w.b FROM reach r JOIN ways w ON r.other = w.a),
root AS (SELECT node, min(other) AS other FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(root.other, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN root ON root.node = d.doc_id"""

_LEVEL = """
c{d} AS MATERIALIZED (SELECT host, coalesce(array_to_string(ts, '/'), '') AS above, toks[{d}] AS token, CAST(count(*) AS DOUBLE) AS n,
  CAST(sum(a) AS DOUBLE) AS a, CAST(sum(b) AS DOUBLE) AS b FROM s{e} WHERE len(toks) >= {d} GROUP BY ALL),
p{d} AS MATERIALIZED (SELECT host, above, sum(n) AS m, sum(n * n) AS q, count(*) FILTER (a + b > 0) AS k,
  (sum(b) + 0.5) / (sum(a) + sum(b) + 1) AS s FROM c{d} GROUP BY ALL),
w{d} AS MATERIALIZED (SELECT host, above, token, m * m >= q * 8 AND n * 20 < m AS rare,
  k > 1 AND a + b > 0 AND (b / greatest(a + b, 1) - s) * (b / greatest(a + b, 1) - s) * (a + b) <= s * (1 - s) * CAST(3.84 AS DOUBLE) AS branch
  FROM c{d} JOIN p{d} USING (host, above)),
s{d} AS MATERIALIZED (SELECT s.host, s.path, toks, a, b, CASE WHEN len(toks) < {d} THEN ts
    ELSE list_append(ts, CASE WHEN rare OR branch AND len(toks) > {d} THEN '*' ELSE toks[{d}] END) END AS ts
  FROM s{e} s LEFT JOIN w{d} w ON w.host = s.host AND w.above = coalesce(array_to_string(s.ts, '/'), '') AND w.token = s.toks[{d}]),"""
_LEVELS = "".join(_LEVEL.format(d=d, e=d - 1) for d in range(1, 9))

URL_FILTER = r"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rh, rp, says) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (SELECT page_id, arg_max(rh || rp, len(rh || rp)) AS rule, arg_max(says, len(rh || rp)) AS says
  FROM hp JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
urls AS (SELECT hp.*, rule, says FROM hp LEFT JOIN fits USING (page_id)),
cuts AS (SELECT host, path, max(CASE WHEN says = 'allow' THEN 1 ELSE 0 END) AS a, max(CASE WHEN says = 'block' THEN 1 ELSE 0 END) AS b,
  list_transform(string_split(path, '/')[2:], lambda s: regexp_replace(s, '[0-9]+', '<n>', 'g')) AS c FROM urls GROUP BY host, path),
s0 AS MATERIALIZED (SELECT host, path, a, b, CASE WHEN len(c) > 8 THEN list_append(c[1:7], array_to_string(c[8:], '/')) ELSE c END AS toks,
  CAST([] AS VARCHAR[]) AS ts FROM cuts),""" + _LEVELS + r"""
leaf AS (SELECT host, path, a, b, coalesce(array_to_string(ts[1:len(ts) - 1], '/'), '') AS parent, coalesce(ts[len(ts)], '') AS last FROM s8),
sib AS (SELECT host, parent, last, sum(a) AS a, sum(b) AS b FROM leaf GROUP BY ALL),
pool AS (SELECT host, parent, (CAST(sum(b) AS DOUBLE) + 0.5) / CAST(sum(a) + sum(b) + 1 AS DOUBLE) AS s FROM sib GROUP BY ALL),
dev AS (SELECT *, CAST(a + b AS DOUBLE) AS n, CAST(b AS DOUBLE) / CAST(greatest(a + b, 1) AS DOUBLE) - s AS o FROM sib JOIN pool USING (host, parent)),
merged AS (SELECT host, parent, last, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b,
  parent || '/' || CASE WHEN n = 0 OR o * o * n <= s * (1 - s) * CAST(3.84 AS DOUBLE) THEN '*' ELSE last END AS template FROM dev),
every AS (SELECT coalesce(sum(b) / nullif(sum(a) + sum(b), 0), 0) AS p FROM merged),
bt AS (SELECT template, (sum(b) + p * 5) / (sum(a) + sum(b) + 5) AS pt FROM merged, every GROUP BY template, p),
bh AS (SELECT host, sum(a) AS ha, sum(b) AS hb FROM merged GROUP BY host),
pur AS (SELECT host, template, (b + (hb + pt * 5) / (ha + hb + 5) * 5) / (a + b + 5) AS purity
  FROM (SELECT host, template, sum(a) AS a, sum(b) AS b FROM merged GROUP BY ALL) JOIN bt USING (template) JOIN bh USING (host))
SELECT u.page_id, u.host, u.path, u.rule, coalesce(u.says, CASE WHEN purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM urls u JOIN leaf USING (host, path) JOIN merged m USING (host, parent, last) JOIN pur USING (host, template)"""

DECONTAMINATION = r"""
WITH dl AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
il AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM benchmark),
iw AS (SELECT item_id, len(ws) AS n, least(len(ws), 13) AS width, unnest(ws) AS w, unnest(range(len(ws))) AS j FROM il WHERE len(ws) >= 5),
dw AS (SELECT doc_id, len(ws) AS m, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM dl),
diag AS (SELECT doc_id, item_id, i - j AS d, any_value(n) AS n, any_value(m) AS m, any_value(width) AS width, list(j) AS js
  FROM dw JOIN iw USING (w) GROUP BY doc_id, item_id, i - j
  HAVING count(*) >= CASE WHEN any_value(n) < 13 THEN any_value(n) ELSE 11 END),
win AS (SELECT *, unnest(range(greatest(0, -d), least(n, m - d) - width + 1)) AS s FROM diag),
ok AS (SELECT * FROM win WHERE len(list_filter(js, lambda x: x >= s AND x < s + width)) >= width - CASE WHEN n < 13 THEN 0 ELSE 2 END),
cov AS (SELECT doc_id, item_id, d, any_value(n) AS n, count(DISTINCT p) AS c FROM (
  SELECT *, unnest(range(s, s + width)) AS p FROM ok) GROUP BY doc_id, item_id, d)
SELECT doc_id, item_id, max(n) AS item_words, max(c) AS overlap_words FROM cov GROUP BY doc_id, item_id"""

_PIECES = (
    "regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[.,;:!?\\x0A-\\x0D]')")
COLLOCATIONS = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS p FROM documents),
ws AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS ws FROM piece),
total AS (SELECT lang, sum(len(ws)) AS n FROM ws GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g
  FROM ws, (VALUES (1), (2), (3)) sizes(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT c.*, x.f AS l, y.f AS r, cut_k, CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut_k FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.g = array_to_string(w[1:cut_k], ' ') JOIN f y ON y.lang = c.lang AND y.g = array_to_string(w[cut_k + 1:], ' ')),
weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut_k) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS g, max(a) AS most FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE k = 3) GROUP BY ALL),
ranked AS (SELECT weakest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
  FROM weakest LEFT JOIN inside USING (lang, g) WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
LEXICAL_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS ts FROM documents),
total AS (SELECT count(*) AS n, sum(len(ts)) AS l FROM d WHERE len(ts) > 0),
tf AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(ts) AS t FROM d) GROUP BY ALL),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, total GROUP BY t),
m AS (SELECT row, doc_id, 100 - 50 + (CAST(50 AS HUGEINT) * len(ts) * n) // l AS m FROM d, total),
scored AS (SELECT item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS score
  FROM wanted JOIN tf USING (t) JOIN w USING (t) JOIN m USING (row) GROUP BY ALL HAVING score > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM scored QUALIFY rank <= 50"""
