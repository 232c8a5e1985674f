"""Oracle SQL (DuckDB dialect) for the registered queries: the same result
written independently as plain SQL over the driver tables."""

from __future__ import annotations

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WS = r"[ \t\n\x0B\f\r]+"


def ratio(n: str, d: str) -> str:
    return (f"CASE WHEN {n} IS NULL OR {d} IS NULL THEN 0.0 WHEN {d} = 0 THEN "
            f"CASE WHEN {n} > 0 THEN 'inf'::DOUBLE WHEN {n} < 0 THEN '-inf'::DOUBLE ELSE 0.0 END "
            f"ELSE {n} / {d} END")


def coerce(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMERIC_TEXT}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def fmt_pct(x: str) -> str:
    return f"format('{{:.1f}}%', ({x}) * 100)"


SITES_ALL = r"""
sites_all AS (
  SELECT o_orderkey AS site_id,
         CAST(o_custkey AS VARCHAR) || '.0' AS bhcmis_raw,
         'Org ' || CAST(o_custkey AS VARCHAR) AS organization,
         'Site ' || CAST(o_orderkey AS VARCHAR) AS site_name,
         o_orderpriority AS city,
         'County ' || CAST(year(o_orderdate) AS VARCHAR) AS county,
         o_orderstatus AS type,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(40.5 AS DOUBLE) + o_totalprice / CAST(70000.0 AS DOUBLE) END AS latitude,
         CAST(-126.0 AS DOUBLE) + CAST(dayofyear(o_orderdate) AS DOUBLE) / CAST(33.0 AS DOUBLE) AS longitude,
         o_orderstatus AS state
  FROM orders)"""

SITES = SITES_ALL + """,
sites AS (SELECT * FROM sites_all WHERE latitude IS NOT NULL)"""

ORGS = r"""
per_order AS (
  SELECT l_orderkey, sum(l_quantity) AS l6,
    sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN l_quantity END) AS l7a,
    sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN l_quantity END) AS l7b,
    sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity END) AS l8a,
    sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity END) AS l8b
  FROM lineitem GROUP BY l_orderkey),
orgs0 AS (
  SELECT CASE WHEN o.o_custkey % 97 <> 0 THEN regexp_replace(CAST(o.o_custkey AS VARCHAR) || '.0', '\.0$', '') END AS bhcmis_id,
         c.c_mktsegment AS segment,
         sum(p.l6) AS total_patients,
         sum(p.l7a) + sum(p.l7b) AS uninsured,
         sum(p.l8a) + sum(p.l8b) AS medicaid
  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY o.o_custkey, c.c_mktsegment),
orgs AS (
  SELECT *, """ + ratio("uninsured", "total_patients") + r""" AS pct_uninsured,
         """ + ratio("medicaid", "total_patients") + r""" AS pct_medicaid
  FROM orgs0 WHERE bhcmis_id IS NOT NULL)"""

# every organisation, also those whose key the sheet leaves out
ORGS_ALL = ORGS.replace("CASE WHEN o.o_custkey % 97 <> 0 THEN ", "").replace(" END AS bhcmis_id", " AS bhcmis_id").replace(
    "FROM orgs0 WHERE bhcmis_id IS NOT NULL", "FROM orgs0")

JOINED = SITES + "," + ORGS + r""",
joined AS (
  SELECT s.site_id, regexp_replace(s.bhcmis_raw, '\.0$', '') AS bhcmis_id, s.organization,
         s.site_name, s.city, s.county, s.type, s.latitude, s.longitude,
         g.total_patients, g.uninsured, g.medicaid, g.pct_uninsured, g.pct_medicaid, g.segment,
         g.bhcmis_id IS NOT NULL AS matched
  FROM sites s LEFT JOIN (SELECT * FROM orgs WHERE segment <> 'HOUSEHOLD') g ON regexp_replace(s.bhcmis_raw, '\.0$', '') = g.bhcmis_id),
firsts AS (
  SELECT * FROM joined QUALIFY row_number() OVER (PARTITION BY bhcmis_id ORDER BY site_id) = 1)"""


def with_joined(body: str) -> str:
    return "WITH " + JOINED + "\n" + body


# --- search index: headings by splitting at their tags, anchors by windows ----
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
LINE_BREAKS = r"(?i)<br\s*/?>|</(p|div|li|tr|ul|ol|table|section|header|blockquote|pre)\s*>"
DROP = (r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<nav\b.*?</nav\s*>"
        r"|<footer\b.*?</footer\s*>|<!--.*?-->|<h1\b.*?</h1\s*>")


def decode_numeric(x: str) -> str:
    """Character references by a scan over the pieces that follow ``&#``."""
    code = "split_part(piece, ';', 1)"
    cp = (f"CASE WHEN lower(left({code}, 1)) = 'x' THEN TRY_CAST('0x' || substr({code}, 2) AS BIGINT) "
          f"ELSE TRY_CAST({code} AS BIGINT) END")
    char = (f"CASE WHEN {cp} = 60 THEN '&lt;' WHEN {cp} = 62 THEN '&gt;' WHEN {cp} = 38 THEN '&amp;' "
            f"WHEN {cp} BETWEEN 1 AND 3 THEN '' "
            f"WHEN {cp} BETWEEN 4 AND 55295 OR {cp} BETWEEN 57344 AND 1114111 THEN chr(CAST({cp} AS INTEGER)) "
            f"ELSE chr(65533) END")
    known = "regexp_matches(piece, '^([0-9]+|[xX][0-9a-fA-F]+);')"
    return (f"array_to_string(list_transform(string_split({x}, '&#'), lambda piece, i: CASE WHEN i = 1 THEN piece "
            f"WHEN {known} THEN {char} || substr(piece, strpos(piece, ';') + 1) ELSE '&#' || piece END), '')")


def clean(x: str) -> str:
    s = f"regexp_replace({x}, '{LINE_BREAKS}', chr(10), 'g')"
    s = f"regexp_replace({s}, '<[^>]*>', '', 'g')"
    for ent, ch in ENTITIES:
        s = f"replace({s}, '{ent}', '{ch}')"
    s = f"regexp_replace({s}, '[ \t\f\r\x0B]+', ' ', 'g')"
    s = f"regexp_replace({s}, ' *\n[ \n]*', chr(10), 'g')"
    return f"regexp_replace({s}, '^[ \n]+|[ \n]+$', '', 'g')"


def slug(x: str) -> str:
    kept = rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_. \t\n\r\f-]', '', 'g')"
    words = f"list_filter(string_split_regex({kept}, '{WS}'), lambda w: w <> '')"
    s = rf"regexp_replace(array_to_string({words}, '-'), '^[^\p{{L}}]+', '')"
    return f"(CASE WHEN {s} = '' THEN 'section' ELSE {s} END)"


RECORDS = r"""
pg0 AS (
  SELECT page_id, url, regexp_replace(html, '<p><b>([^<]*)<br>', '<h2>\1</h2>', 'g') AS h FROM pages),
pg1 AS (
  SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN replace(h, '<h2>', '<h2 class="x" id="part">') ELSE h END AS h FROM pg0),
pg AS (
  SELECT page_id, url,
         CASE WHEN page_id % 5 = 0 THEN replace(h, '</h2>', ' &#233;&#xD800;&#99999999999;</h2>') ELSE h END AS html FROM pg1),
pgd AS (
  SELECT page_id, url, """ + decode_numeric("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)") + r""" AS title_dec,
         regexp_replace(array_to_string(regexp_extract_all(html, '(?is)<article[^>]*>(.*?)</article>', 1), chr(10)),
                        '""" + DROP + r"""', '', 'g') AS dropped
  FROM pg),
pgp AS (
  SELECT page_id, url, """ + clean("title_dec") + r""" AS title, string_split(""" + decode_numeric("dropped") + r""", '<h2') AS parts
  FROM pgd),
sec0 AS (
  SELECT page_id, url, title, unnest(parts[2:]) AS p, unnest(range(1, len(parts))) AS position FROM pgp),
sec1 AS (
  SELECT page_id, url, title, position, regexp_extract(p, '^[^>]* id="([^"]*)"', 1) AS id,
         """ + clean("regexp_extract(p, '(?s)^[^>]*>(.*?)</h2>', 1)") + r""" AS head,
         """ + clean("substr(p, strpos(p, '</h2>') + 5)") + r""" AS body FROM sec0),
sec2 AS (
  SELECT *, CASE WHEN id <> '' THEN id ELSE """ + slug("head") + r""" END AS base FROM sec1),
sec AS (
  SELECT *, base || CASE WHEN row_number() OVER w = 1 THEN '' ELSE '-' || CAST(row_number() OVER w - 1 AS VARCHAR) END AS anchor
  FROM sec2 WINDOW w AS (PARTITION BY page_id, base ORDER BY position)),
records AS (
  SELECT p.page_id, p.url AS href, p.title, '' AS section,
         CASE WHEN """ + clean("p.parts[1]") + r""" <> '' THEN """ + clean("p.parts[1]") + r""" ELSE coalesce(s.body, '') END AS text,
         0 AS position
  FROM pgp p LEFT JOIN sec s ON s.page_id = p.page_id AND s.position = 1
  UNION ALL
  SELECT page_id, url || '#' || anchor, title, CASE WHEN position = 1 THEN '' ELSE head END,
         CASE WHEN position = 1 THEN body ELSE head || chr(10) || body END, CAST(position AS INTEGER)
  FROM sec)"""

TERMS = r"""
terms AS (
  SELECT CAST(item_id AS VARCHAR) || ':' || w AS query_id, w AS query, lower(w) AS term
  FROM (SELECT item_id, unnest(list_distinct(list_filter(regexp_split_to_array(text, '[^\p{L}]+'), lambda x: length(x) >= 2))) AS w
        FROM benchmark)),
hits AS (
  SELECT t.term, r.href, r.page_id, r.position,
    (CASE WHEN contains(lower(r.title), t.term) THEN 20 ELSE 0 END)
    + (CASE WHEN contains(lower(r.section), t.term) THEN 20 ELSE 0 END)
    + (CASE WHEN contains(lower(r.text), t.term) THEN 10 ELSE 0 END) AS score
  FROM records r, (SELECT DISTINCT term FROM terms) t
  WHERE contains(lower(r.title), t.term) OR contains(lower(r.section), t.term)
     OR contains(lower(r.text), t.term)),
top AS (
  SELECT *, row_number() OVER (PARTITION BY term ORDER BY score DESC, href, page_id, position) AS rnk
  FROM hits QUALIFY rnk <= 50),
results AS (
  SELECT q.query_id, q.query, t.rnk, t.href, t.score, r.text
  FROM top t JOIN terms q ON q.term = t.term
  JOIN records r ON r.page_id = t.page_id AND r.position = t.position)"""


def snippet_sql(t: str, q: str) -> str:
    """Mirror of the snippet expression, as nested sub-expressions."""
    s0 = f"(instr(lower({t}), lower({q})) - 1)"
    ql = f"length({q})"
    marked = (f"(substring({t}, 1, {s0}) || '<mark class=''search-match''>' || "
              f"substring({t}, {s0} + 1, {ql}) || '</mark>' || substring({t}, {s0} + 1 + {ql}, length({t}) + 1))")
    run_left = f"length(regexp_extract(reverse(substring({t}, 1, {s0})), '^[^ ,:]*'))"
    clip_from = f"(CASE WHEN {s0} < 50 THEN 0 WHEN {run_left} < {s0} THEN {s0} - {run_left} ELSE 0 END)"
    total = f"(length({t}) + 34)"
    cut = f"({clip_from} + 34 + 200)"
    tail = f"substring({marked}, {cut} + 1, {total} + 1)"
    run_right = f"length(regexp_extract({tail}, '^[^ ,:]*'))"
    found = f"({run_right} < length({tail}))"
    clip_to = f"(CASE WHEN {cut} > {total} THEN {total} WHEN {found} THEN {cut} + {run_right} ELSE {total} - 1 END)"
    body = f"substring({marked}, {clip_from} + 1, {clip_to} - {clip_from})"
    suffix = f"(CASE WHEN {cut} <= {total} AND {found} THEN '…' ELSE '' END)"
    return (f"(CASE WHEN {t} IS NULL OR {q} IS NULL OR {ql} = 0 OR {s0} < 0 THEN {t} "
            f"ELSE {body} || {suffix} END)")
