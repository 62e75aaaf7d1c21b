"""SQL that the registered queries are checked against."""

from __future__ import annotations

from html.entities import html5

from vellum.functions.scalars import WHITE

_CODED = r"""SELECT p_partkey, p_size, p_retailprice, CAST(regexp_extract(p_brand, '(\d+)', 1) AS INT) AS brand,
  CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 90 END AS kind FROM part"""

_RECODED = f"""SELECT p_partkey, CASE WHEN p_size = 1 THEN 1 WHEN p_size = 2 THEN 2 WHEN p_size = 3 THEN 3 WHEN brand = 1 THEN 4 WHEN brand = 2 THEN 5
  WHEN brand = 3 THEN 6 WHEN brand = 25 THEN 7 WHEN kind = 1 THEN 8 WHEN kind = 2 THEN 9 WHEN kind = 3 THEN 10 WHEN kind = 90 THEN 11 END AS ord FROM ({_CODED})"""

_NAMED = f"""SELECT p_partkey, ord, ['Size One', 'Size Two', 'Other Size', 'Brand One', 'Brand Two', 'Brand Three', 'Other Brand', 'Economy', 'Large', 'Medium', 'Other Type'][ord] AS trad FROM ({_RECODED})"""

_LINES = """SELECT o_orderstatus, year(o_orderdate) AS y, l_quantity, l_tax, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_NATION = """SELECT c_nationkey, year(o_orderdate) AS y, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS fips FROM orders JOIN customer ON o_custkey = c_custkey"""

_COUNTS = f"""SELECT c_nationkey, n, population FROM (SELECT c_nationkey, count(*) AS n FROM ({_NATION}) GROUP BY 1)
  JOIN (SELECT c_nationkey, count(*) AS population FROM customer GROUP BY 1) USING (c_nationkey)"""

_GRID = r"""SELECT page, row_idx, col_idx, text FROM (
  SELECT page, row_idx, unnest(range(len(ws))) AS col_idx, unnest(ws) AS text FROM (
    SELECT page, row_idx, string_split(line, ' ') AS ws FROM (
      SELECT doc_id AS page, unnest(range(len(ls))) AS row_idx, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))))"""

# ---- character references, as HTML has them: every name (some need no semicolon, the longest counts) and every number

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
_UNCLOSED = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
_WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)} | {0: "\ufffd", 13: "\r"}


def _listed(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


_REFERENCES = f"""refs AS MATERIALIZED (SELECT map({_listed(html5)}, {_listed(html5.values())}) AS names, map({_listed(_WINDOWS)}, {_listed(_WINDOWS.values())}) AS windows)"""


def _decoded(text: str) -> str:
    """The text with its character references decoded; needs ``refs`` of ``_REFERENCES`` in FROM."""
    number = "try_cast(CASE WHEN x[3] IN ('x', 'X') THEN '0x' || rtrim(x[4:], ';') ELSE rtrim(x[3:], ';') END AS BIGINT)"
    of_number = f"""CASE WHEN windows[CAST({number} AS VARCHAR)] IS NOT NULL THEN windows[CAST({number} AS VARCHAR)]
      WHEN {number} IS NULL OR {number} BETWEEN 55296 AND 57343 OR {number} > 1114111 THEN chr(65533)
      WHEN {number} IN (11, 127) OR {number} BETWEEN 1 AND 8 OR {number} BETWEEN 14 AND 31 OR {number} BETWEEN 64976 AND 65007 OR {number} % 65536 >= 65534 THEN ''
      ELSE chr(CAST({number} AS INT)) END"""
    start = f"nullif(regexp_extract(x[2:], '{_UNCLOSED}'), '')"
    of_name = f"CASE WHEN names[x[2:]] IS NOT NULL THEN names[x[2:]] WHEN {start} IS NOT NULL THEN names[{start}] || x[2 + length({start}):] ELSE x END"
    return f"array_to_string(list_transform(regexp_extract_all({text}, '{_REFERENCE}'), lambda x: CASE WHEN x[1] <> '&' OR x = '&' THEN x WHEN x[2] = '#' AND length(x) > 2 THEN {of_number} ELSE {of_name} END), '')"


_TRIMMED = f"'{WHITE}'"

_ISO = "strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')"

ORACLE_SQL = {
    "recode_first_match": f"SELECT p_partkey, trad, CAST(ord AS INT) AS ord FROM ({_NAMED})",
    "topk_labels": f"""
SELECT trad AS label, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY n DESC, o) AS INT) AS rank FROM (
  SELECT trad, sum(c) AS n, min(ord) AS o FROM ({_NAMED}) JOIN (SELECT l_partkey, count(*) AS c FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
  WHERE trad IS NOT NULL AND trad NOT LIKE 'Other%' GROUP BY 1) ORDER BY n DESC, o LIMIT 5""",
    "bucket_share_in_group": """
WITH c AS (SELECT c_custkey, c_acctbal, 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS nation FROM customer),
t AS (SELECT nation FROM orders JOIN c ON o_custkey = c_custkey GROUP BY 1 ORDER BY count(*) DESC, nation LIMIT 3),
b AS (SELECT nation, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2000 THEN '0-2k' WHEN c_acctbal < 4000 THEN '2-4k' WHEN c_acctbal < 6000 THEN '4-6k' WHEN c_acctbal < 8000 THEN '6-8k' ELSE '8k+' END AS bucket
  FROM c WHERE nation IN (SELECT nation FROM t)),
n AS (SELECT nation, bucket, count(*) AS n FROM b GROUP BY 1, 2),
p AS (SELECT *, n / sum(n) OVER (PARTITION BY nation) AS pct FROM n),
x AS (SELECT *, max(pct) FILTER (bucket = '8k+') OVER (PARTITION BY nation) AS pct_top FROM p)
SELECT nation, bucket, CAST(n AS BIGINT) AS n, round(pct, 4) AS pct, round(pct_top, 4) AS pct_top, CAST(dense_rank() OVER (ORDER BY pct_top DESC NULLS LAST, nation) AS INT) AS ord FROM x""",
    "mode_mean_by_group": """
WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2),
m AS (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS rn FROM c)
SELECT p_brand, 'mean' AS stat, round(avg(p_size), 4) AS value FROM part GROUP BY 1
UNION ALL SELECT p_brand, 'mode', round(CAST(p_size AS DOUBLE), 4) FROM m WHERE rn = 1""",
    "weighted_share_by_period": f"""
SELECT o_orderstatus, period, round(sum(CASE WHEN l_quantity <= 20 THEN 1 + l_tax ELSE 0 END) FILTER (l_quantity > 2) / sum(1 + l_tax) FILTER (l_quantity > 2), 4) AS share, count(*) FILTER (l_quantity > 2) AS n
FROM (SELECT *, CASE WHEN y BETWEEN 1995 AND 1997 THEN '1995-1997' WHEN y BETWEEN 1999 AND 2001 THEN '1999-2001' END AS period FROM ({_LINES})) WHERE period IS NOT NULL GROUP BY 1, 2""",
    "weighted_flag_mean": f"SELECT l_returnflag, round(sum(CASE WHEN y BETWEEN 1996 AND 1998 THEN l_quantity ELSE 0 END) / sum(l_quantity), 4) AS share, count(*) AS n FROM ({_LINES}) GROUP BY 1",
    "weighted_quantiles": """
WITH r AS (SELECT l_returnflag AS g, greatest(0, 85 - least(greatest(CAST(l_quantity AS INT) + 17, 18), 100)) AS x, 1 + l_tax AS w FROM lineitem),
s AS (SELECT g, x, sum(w) AS t FROM r GROUP BY 1, 2),
c AS (SELECT g, x, sum(t) OVER (PARTITION BY g ORDER BY x) AS cw, sum(t) OVER (PARTITION BY g) AS n FROM s),
o AS (SELECT c.*, label, 1 + (n - 1) * p AS o FROM c, (VALUES ('30%', 0.3::DOUBLE), ('40%', 0.4::DOUBLE), ('50%', 0.5::DOUBLE)) v(label, p)),
l AS (SELECT *, greatest(floor(o), 1) AS lo, least(greatest(floor(o), 1) + 1, n) AS hi, o - floor(o) AS f FROM o)
SELECT g AS l_returnflag, label AS threshold, round((1 - max(f)) * coalesce(min(x) FILTER (cw >= lo), max(x)) + max(f) * coalesce(min(x) FILTER (cw >= hi), max(x)), 4) AS years FROM l GROUP BY 1, 2""",
    "stat_join_back": """
WITH m AS (SELECT p_type, avg(p_retailprice) AS mean FROM part GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY mean, p_type) AS ord FROM m)
SELECT p_partkey, p_type, round(mean, 4) AS mean, CAST(ord AS INT) AS ord, CAST(CAST(round_even(p_retailprice / 10000 * 100, 0) AS BIGINT) AS VARCHAR) || '%' AS pct FROM part JOIN o USING (p_type)""",
    "first_per_key": "SELECT user_id, event_id, event_type, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1",
    "carry_forward": "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN 's' || event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS heading FROM events",
    "todo_minus_done": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "limit_then_anti": "SELECT doc_id, lang FROM (SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100) WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "explode_keep_parent": "SELECT doc_id, lang, turn FROM documents LEFT JOIN conversations ON conv_id = doc_id",
    "union_missing_columns": """
SELECT c_name AS name, round(c_acctbal, 4) AS acctbal, c_mktsegment AS segment, CAST(NULL AS INT) AS nation FROM customer
UNION ALL SELECT s_name, round(s_acctbal, 4), NULL, s_nationkey FROM supplier""",
    "nested_flatten_join": """
WITH x AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role || '-' || turn ELSE role END AS name FROM conversations)
SELECT conv_id, string_agg(name, '; ' ORDER BY turn) AS every, arg_min(name, turn) AS first FROM x GROUP BY 1""",
    "json_field_default": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'none' AS missing FROM events",
    "map_to_wide": "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p FROM orders GROUP BY 1",
    "run_counters": """
SELECT 'entities' AS metric, count(DISTINCT conv_id) AS n FROM conversations UNION ALL SELECT 'entries', count(*) FROM conversations
UNION ALL SELECT 'errors', count(DISTINCT conv_id) FROM conversations WHERE length(text) < 20""",
    "entity_chain": """
SELECT CAST(c_custkey AS VARCHAR) AS "GCFAId", count(o_orderkey) AS entries, count(DISTINCT s_name) AS churches, min(s_name) AS first_church
FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN supplier ON s_suppkey = o_orderkey % 100 GROUP BY 1""",
    "distinct_urls": """SELECT DISTINCT 'church?church=' || (o_custkey % 200) AS url, CAST(o_custkey % 200 AS VARCHAR) AS church_id FROM orders WHERE o_orderkey % 3 = 0""",
    "page_completeness": "SELECT conv_id, max(turn) + 1 AS expected, count(*) AS got, count(*) >= max(turn) + 1 AS complete FROM conversations GROUP BY 1",
    "idempotent_append": "SELECT 'file://documents/' || doc_id || '.txt' AS url, doc_id, lang FROM documents",
    "slug_names": r"""
SELECT 'd' || doc_id AS key, md5(regexp_replace(trim(regexp_replace(coalesce(text, ''), '[^\pL\pN_\s.-]', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)), '\s+', '_', 'g')) AS slug FROM documents
UNION ALL SELECT 'p' || p_partkey, regexp_replace(trim(regexp_replace(p_name || chr(160) || '(' || p_brand || ')', '[^\pL\pN_\s\x{00A0}-]', '', 'g')), '[\s\x{00A0}]+', '_', 'g') FROM part""",
    "filename_dates": f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 5 THEN {_ISO} END AS date, CASE o_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 END AS pattern,
  CASE o_orderkey % 7 WHEN 5 THEN strftime(CAST(o_orderdate AS DATE), '%m %d %Y') WHEN 6 THEN 'bad 13 45 2020 of' END AS title FROM orders""",
    "date_ranges": f"""
WITH d AS (SELECT o_orderkey, o_orderkey % 4 AS kind, o_orderkey % 20 AS odd, {_ISO} AS iso, strftime(CAST(o_orderdate AS DATE), '%-m-%-d-%Y') AS dashes, strftime(CAST(o_orderdate AS DATE) + 40, '%Y-%m-%d') AS later FROM orders)
SELECT o_orderkey, CASE WHEN kind = 2 THEN dashes WHEN odd = 9 THEN NULL ELSE iso END AS start_date, CASE WHEN kind = 3 THEN later WHEN odd = 9 THEN iso END AS end_date FROM d""",
    "text_dates": f"SELECT o_orderkey, CASE o_orderkey % 4 WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-01') WHEN 3 THEN 'Advent' ELSE {_ISO} END AS date FROM orders",
    "numeric_text": """
SELECT o_orderkey, printf('%.2f', o_totalprice) AS plain, format('{:,.2f}', o_totalprice) || ' km' AS kept, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey AS VARCHAR) ELSE '0' END AS counted,
  printf('%.2f', o_totalprice) AS fact, lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS code FROM orders""",
    "transcript_clean": r"""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '- Speaker 1: [intro' || chr(10) || 'music] ' || replace(text, chr(10), chr(10) || '♪ (aside) # sung line' || chr(10)) ELSE text END AS t FROM documents),
a AS (SELECT doc_id, replace(regexp_replace(regexp_replace(regexp_replace(t, 'Speaker \d+\s*:?\s*', '', 'g'), '(?s)\[.*?\]', '', 'g'), '(?s)\(.*?\)', '', 'g'), '♪', '') AS t FROM t)
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(t, '#[^\n]*', '', 'g'), '^\s*[-–—]\s*', ''), '\s+', ' ', 'g'))) AS clean_md5 FROM a""",
    "parse_move_text": """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN 'Person ' || o_custkey END AS person, CASE WHEN o_orderkey % 7 > 0 THEN 'Place ' || (o_orderkey % 50) END AS to_place,
  CASE WHEN o_orderkey % 7 > 0 AND o_orderkey % 3 > 0 THEN 'Town ' || o_orderstatus END AS from_place FROM orders""",
    "url_parts": r"""
SELECT page_id, 'https://base.example' || regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS link, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param,
  nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS page_no, regexp_extract(url, '^[a-z]+://[^/?#]+/(?:[^?#]*/)?([^/?#]*)', 1) AS name FROM pages""",
    "page_title_h1": rf"""
WITH {_REFERENCES}, p AS (SELECT page_id, nullif(regexp_extract_all(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1>', 1), [])[1] AS h, nullif(regexp_extract_all(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title>', 1), [])[1] AS t FROM pages),
d AS (SELECT page_id, {_decoded("h")} AS h, {_decoded("t")} AS t FROM p, refs WHERE h IS NOT NULL OR t IS NOT NULL)
SELECT page_id, coalesce(nullif(trim(string_split(trim(h, {_TRIMMED}), chr(10))[1], {_TRIMMED}), ''), trim(replace(t, ' - UMData', ''), {_TRIMMED})) AS name,
  trim(regexp_replace(h, '[{WHITE}]+', ' ', 'g'), {_TRIMMED}) AS heading FROM d""",
    "page_links": r"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS href, unnest(range(len(regexp_extract_all(html, '<a href="([^"]+)"', 1)))) AS i FROM pages),
f AS (SELECT page_id, replace(href, '&amp;', '&') AS href, min(i) AS i FROM l GROUP BY 1, 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS pos, href FROM f""",
    "page_list_items": rf"""
WITH {_REFERENCES}, l AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t, unnest(regexp_extract_all(html, '(?s)<li><a href="[^"]*">(.*?)</a></li>', 1)) AS x, unnest(range(len(regexp_extract_all(html, '(?s)<li><a href="[^"]*">(.*?)</a></li>', 1)))) AS i FROM pages)
SELECT page_id, CAST(i AS INT) AS pos, trim({_decoded("t")}, {_TRIMMED}) AS heading, trim({_decoded("x")}, {_TRIMMED}) AS text FROM l, refs""",
    "grid_is_table": f"""
WITH s AS (SELECT page, max(row_idx) + 1 AS r, max(col_idx) + 1 AS c, bool_or(row_idx = 0 AND contains(upper(text), 'GRAPH')) AS g, count(*) FILTER (text <> '') AS n FROM ({_GRID}) GROUP BY 1),
x AS (SELECT page, CASE WHEN r < 3 THEN 'few rows' WHEN c < 2 THEN 'few columns' WHEN g THEN 'graph header' WHEN n = 0 THEN 'empty' ELSE '' END AS reason FROM s)
SELECT page, reason = '' AS ok, reason FROM x""",
    "grid_headers_records": """
WITH d AS (SELECT doc_id AS page, list_transform(string_split(text, chr(10)), lambda x: string_split(x, ' ')) AS rs FROM documents),
m AS (SELECT page, rs, list_max(list_transform(rs, lambda x: len(x))) AS most FROM d),
e AS (SELECT page, CASE WHEN page % 3 = 0 THEN rs ELSE list_concat([list_filter(rs, lambda x: len(x) = most)[1]], rs) END AS rs FROM m),
o AS (SELECT page, unnest(rs) AS ws, unnest(range(len(rs))) AS row_idx FROM e),
g AS MATERIALIZED (SELECT page, row_idx, unnest(ws) AS text, unnest(range(len(ws))) AS col_idx FROM o),
h AS (SELECT page, col_idx, CASE WHEN trim(text) = '' THEN 'col_' || col_idx ELSE trim(text) END AS k FROM g WHERE row_idx = 0),
u AS (SELECT page, col_idx, k || CASE WHEN row_number() OVER (PARTITION BY page, k ORDER BY col_idx) > 1 THEN '_' || (row_number() OVER (PARTITION BY page, k ORDER BY col_idx) - 1) ELSE '' END AS header FROM h),
w AS (SELECT page, max(col_idx) AS last, count(*) AS n, count(DISTINCT header) AS heads FROM u GROUP BY 1),
b AS (SELECT page, row_idx, count(*) FILTER (trim(text) <> '') AS filled, max(col_idx) AS last FROM g WHERE row_idx > 0 GROUP BY 1, 2),
k AS (SELECT page, count(*) AS n_rows, sum(filled) AS filled, max(last) AS last FROM b WHERE filled > 0 GROUP BY 1 HAVING count(*) >= 2)
SELECT k.page, n_rows, CAST(n_rows * w.n AS BIGINT) AS n_cells, heads AS n_headers, CAST(n_rows * w.n - filled AS BIGINT) AS n_blank FROM k JOIN w ON k.page = w.page AND k.last <= w.last""",
    "diversity_by_area": """
WITH n AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2), p AS (SELECT *, n / sum(n) OVER (PARTITION BY c_nationkey) AS p FROM n)
SELECT c_nationkey, count(*) AS groups, CAST(sum(n) AS BIGINT) AS total, round(max(p), 4) AS largest_share, round(-sum(p * ln(p)), 4) AS shannon, round(1 - sum(p * p), 4) AS simpson FROM p GROUP BY 1""",
    "change_between_waves": f"""
WITH a AS (SELECT fips, count(*) AS n FROM ({_NATION}) WHERE y = 1996 GROUP BY 1), b AS (SELECT fips, count(*) AS n FROM ({_NATION}) WHERE y = 2000 GROUP BY 1)
SELECT fips, a.n AS before, b.n AS after, round((b.n - a.n) / a.n, 4) AS change FROM a FULL JOIN b USING (fips)""",
    "regression_residuals": f"""
WITH c AS ({_COUNTS}), l AS (SELECT regr_slope(n, population) AS s, regr_intercept(n, population) AS i FROM c)
SELECT c_nationkey, round(s, 4) AS slope, round(i, 4) AS intercept, round(n - (i + s * population), 4) AS residual FROM c, l""",
    "adjusted_rate": f"""
WITH c AS (SELECT c_nationkey, CASE WHEN c_nationkey % 5 <> 0 THEN n END / population AS rate, n_regionkey FROM ({_COUNTS}) JOIN nation ON n_nationkey = c_nationkey)
SELECT c_nationkey, round(rate, 4) AS rate, round(rate * CASE WHEN n_regionkey <> 2 THEN 1 + n_regionkey / 10 ELSE 1 END, 4) AS adjusted FROM c""",
}
