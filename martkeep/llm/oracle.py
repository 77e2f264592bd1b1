"""DuckDB SQL of the queries that SQL can express on whole tables.

The others are tested against brute force, the tokenizer library or held-out labels: op1
and op2 (encodings and hashes), op3 (quantile sketches), op6 and op10 (trained models),
op7 (seeded draws), op11 (eigenvectors) and op12 (two tokenizers).
"""

# The pages of the given tables state no canonical link and no refresh, so rules decide
# here; links are covered by tests.
URL_FILTERS = r"""
WITH rules(verdict, host, path) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
urls AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
best AS (SELECT u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
           arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM urls) u JOIN rules r
      ON (u.host = r.host OR suffix(u.host, '.' || r.host)) AND prefix(u.path, r.path)
    GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN best USING (host, path)
"""

CHAT = r"""
WITH said AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS text
              FROM conversations),
speakers AS (SELECT DISTINCT conv_id, name AS perspective FROM said WHERE name <> 'system'),
seen AS (SELECT s.*, p.perspective,
           CASE WHEN name = 'system' THEN name WHEN name = perspective THEN 'assistant'
                ELSE 'user' END AS role
    FROM said s JOIN speakers p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (SELECT *, '<|' || CASE WHEN role = 'user' THEN 'user ' || name ELSE role END
                  || '|>' || chr(10) AS head FROM seen)
SELECT conv_id, perspective, turn, role, name, head || text || '<|end|>' || chr(10) AS segment,
       CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS learn,
       CAST(length(head) AS BIGINT) AS mask_start,
       CAST(CASE WHEN role = 'assistant' THEN length(text) + 8 ELSE 0 END AS BIGINT) AS mask_chars
FROM headed
"""

JACCARD = r"""
WITH RECURSIVE words AS (SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS grams
    FROM words),
sized AS (SELECT doc_id, grams, len(grams) AS n, md5(array_to_string(list_sort(grams), chr(10))) AS sid FROM sets),
classes AS (SELECT sid, min(doc_id) AS rep, any_value(n) AS n, any_value(grams) AS grams FROM sized WHERE n > 0 GROUP BY sid),
incidence AS (SELECT sid, n, unnest(grams) AS gram FROM classes),
pairs AS (SELECT a.sid AS x, b.sid AS y FROM incidence a JOIN incidence b ON a.gram = b.gram AND a.sid <> b.sid
    GROUP BY a.sid, b.sid, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(sid, other) AS (SELECT sid, sid FROM classes UNION SELECT r.sid, p.y FROM reach r JOIN pairs p ON r.other = p.x),
lowest AS (SELECT r.sid, min(c.rep) AS component_id FROM reach r JOIN classes c ON r.other = c.sid GROUP BY r.sid)
SELECT doc_id, CAST(s.n AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sized s LEFT JOIN lowest l ON s.n > 0 AND s.sid = l.sid
"""

WARC = r"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT page_id, html, hex, array_to_string([lpad(bin(instr('0123456789abcdef', hex[i]) - 1), 4, '0')
    FOR i IN range(1, 41)], '') AS bits FROM hashed),
coded AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, hex, array_to_string([
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum([CAST(bits[5 * i + j] AS INT) * (1 << (5 - j)) FOR j IN range(1, 6)])::INT]
    FOR i IN range(0, 32)], '') AS payload_digest FROM bits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM coded)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

# CRC32 byte by byte, with its table made by the rule of its polynomial.
SHARDING = r"""
WITH RECURSIVE steps(value, step, crc) AS (
    SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
    UNION ALL SELECT value, step + 1, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
    FROM steps WHERE step < 8),
tab AS (SELECT list(crc ORDER BY value) AS t FROM steps WHERE step = 8),
whole AS (SELECT doc_id, text, coalesce('=' || source, '-') AS stratum, hex(encode(coalesce(text, ''))) AS hex FROM documents),
described AS (SELECT doc_id, stratum, CAST(length(hex) / 2 + 1 AS BIGINT) AS size,
    xor(list_reduce([CAST('0x' || hex[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(0, CAST(length(hex) / 2 AS BIGINT))],
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32,
    CAST('0x' || md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '-') || coalesce(':' || text, ''))[1:15] AS BIGINT) AS shuffled
    FROM whole, tab),
ranked AS (SELECT *, count(*) OVER (PARTITION BY stratum) AS n,
    row_number() OVER (PARTITION BY stratum ORDER BY shuffled, doc_id, size, text_crc32) AS rank FROM described),
fractions AS (SELECT *, (CAST(rank - 1 AS DOUBLE)
    + CAST(CAST('0x' || md5('13:' || stratum)[1:13] AS BIGINT) AS DOUBLE) / 4503599627370496.0) / n AS fraction FROM ranked),
placed AS (SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY fraction, stratum, rank) - 1 AS place FROM fractions)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 8 // total AS INTEGER) AS shard,
       place - ((place * 8 // total) * total + 7) // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

SQL: dict[str, str] = {
    "op4_url_filters": URL_FILTERS,
    "op5_chat": CHAT,
    "op8_jaccard_join": JACCARD,
    "op9_warc": WARC,
    "op13_sharding": SHARDING,
}
