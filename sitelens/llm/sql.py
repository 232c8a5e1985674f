"""DuckDB SQL for the rows of the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


DECONTAMINATION = f"""
WITH b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, w[i : i + least(len(w), 10) - 1] AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
dw AS (SELECT doc_id, size, i, w[i : i + size - 1] AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
h AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.doc_id"""

CURRICULUM_MIX = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][k % 3 + 1] AS weight, [0.5, 0.0, -0.5][k % 3 + 1]::DOUBLE AS slope FROM s),
r AS (SELECT 0 AS step, []::BIGINT[] AS capped
      UNION ALL
      SELECT step + 1, (SELECT coalesce(list(w.k ORDER BY w.k), []) FROM w
                        WHERE list_contains(r.capped, w.k) OR
                              w.weight * ((SELECT sum(source_size) FROM w) - coalesce((SELECT sum(3 * source_size) FROM w x WHERE list_contains(r.capped, x.k)), 0))
                              / (SELECT sum(weight) FROM w x WHERE NOT list_contains(r.capped, x.k)) > 3 * w.source_size)
      FROM r WHERE step < (SELECT count(*) FROM w) AND len(r.capped) < (SELECT count(*) FROM w)),
f AS (SELECT capped FROM r ORDER BY step DESC LIMIT 1),
t AS (SELECT source, source_size, slope, CASE WHEN list_contains(f.capped, k) THEN (3 * source_size)::DOUBLE ELSE
        weight * ((SELECT sum(source_size) FROM w) - coalesce((SELECT sum(3 * source_size) FROM w x WHERE list_contains(f.capped, x.k)), 0))::DOUBLE
        / (SELECT sum(weight) FROM w x WHERE NOT list_contains(f.capped, x.k)) END AS target FROM w, f),
o AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
j AS (SELECT o.doc_id, o.size, t.source_size, t.target, t.slope, o.before,
             floor(target / greatest(source_size, 1)) AS whole FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, CAST(whole * size + greatest(0, least(size, round(target - whole * source_size) - before)) AS BIGINT) AS taken FROM j)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target, taken,
       CASE WHEN taken > 0 THEN round(CASE WHEN slope = 0 THEN before / target
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * before / target) - (1 - slope)) / (2 * slope) END + 0.0, 6) END AS position
FROM x"""

ARC_TO_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
q AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_page FROM q WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT q.page_id, payload_bytes, q.payload_digest,
       CASE WHEN first_page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_page <> page_id THEN first_page END AS refers_to
FROM q LEFT JOIN f ON q.payload_digest = f.payload_digest"""

JACCARD_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
                     FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY x, y),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS c FROM n UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.x WHERE r.c < l.y),
c AS (SELECT x, min(c) AS c FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.x = d.doc_id"""


def _vector_codes(rounds: int = 4) -> str:
    """Codebooks after each round as a table of their own."""
    nearest = """SELECT i, part, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d FROM (
  SELECT p.i, p.part, c.e, CAST(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
  FROM p JOIN c{r} c ON c.part = p.part) GROUP BY i, part"""
    steps = "".join(f"""
a{r} AS ({nearest.format(r=r)}),
m{r} AS (SELECT part, e, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY k) AS v FROM (
  SELECT p.part, a.e, k, sum(p.v[k]) AS s, count(*) AS n
  FROM p JOIN a{r} a ON a.i = p.i AND a.part = p.part, unnest(range(1, len(p.v) + 1)) AS u(k) GROUP BY p.part, a.e, k) GROUP BY part, e),
c{r + 1} AS (SELECT c.part, c.e, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.part = c.part AND m.e = c.e),""" for r in range(rounds))
    return f"""
WITH q AS (SELECT row_number() OVER () AS i, vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS q
           FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT i, vec_id, label, part, q[part * (len(q) // 4) + 1 : (part + 1) * (len(q) // 4)] AS v FROM q, unnest(range(0, 4)) AS u(part)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, v FROM p QUALIFY e < 256),{steps}
f AS ({nearest.format(r=rounds)}),
s AS (SELECT p.vec_id, p.label, string_agg(format('{{:02x}}', f.e), '' ORDER BY f.part) AS code, CAST(sum(f.d) AS BIGINT) AS error
      FROM p JOIN f ON f.i = p.i AND f.part = p.part GROUP BY p.i, p.vec_id, p.label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v[k] AS VARCHAR), ',' ORDER BY part, e, k)) FROM c{rounds}, unnest(range(1, len(v) + 1)) AS u(k)) AS codebooks_sha256
FROM s"""


VECTOR_CODES = _vector_codes()

_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
  lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""

PREFIX_TRIE = f"""
WITH o AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, s, CAST({_CRC32} % 9 AS BIGINT) AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(b.s[1 : h.h], []), h.s[h.h + 1 :]) AS s FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 5),
m AS (SELECT conv_id, len(s) AS len, d, s[1 : d] AS pre FROM r, unnest(range(0, len(s) + 1)) AS u(d)),
n AS (SELECT pre, d, min(conv_id) AS c, count(*) AS n,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = d), '')) AS ends FROM m GROUP BY pre, d),
k AS (SELECT pre[1 : d - 1] AS up, count(*) AS k FROM n WHERE d > 0 GROUP BY up),
x AS (SELECT n.*, coalesce(k.k, 0) AS k, CASE WHEN n.d > 0 THEN (n.n - 1) * octet_length(encode(n.pre[n.d].text)) ELSE 0 END AS w
      FROM n LEFT JOIN k ON k.up = n.pre),
t AS (SELECT pre[1 : a] AS top, sum((k = 0)::INT) AS leaves, sum(w) AS saved FROM x, unnest(range(0, d + 1)) AS u(a) GROUP BY top)
SELECT x.c AS conv_id, CAST(x.d AS BIGINT) AS depth, p.c AS parent_conv_id, CAST(x.n AS BIGINT) AS n_convs, CAST(x.k AS BIGINT) AS n_children,
       CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN t ON t.top = x.pre LEFT JOIN n p ON x.d > 0 AND p.pre = x.pre[1 : x.d - 1]"""
