"""SQL counterparts of the registered queries that SQL can express."""

from __future__ import annotations

LINES = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS n FROM docs),
keyed AS (
    SELECT doc_id, n, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split
),
frequent AS (
    SELECT key, max(doc_id) AS top_doc FROM keyed WHERE length(key) >= 40 AND doc_id IS NOT NULL
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
    SELECT k.doc_id, k.n, k.line, coalesce(f.top_doc <> k.doc_id, FALSE) AS dropped
    FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

URLS = r"""
WITH captures AS (
    SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetched_on,
        lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
        regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1) AS path
    FROM pages
),
named AS (
    SELECT 'hosts' AS kind, host AS entry, 4 AS one_in FROM captures WHERE host <> ''
    UNION SELECT 'domains', regexp_replace(host, '^[^.]+\.', ''), 8 FROM captures WHERE host <> ''
    UNION SELECT 'prefixes', host || regexp_extract(path, '^(/[^/]+/)', 1), 8 FROM captures
    WHERE host <> '' AND regexp_extract(path, '^(/[^/]+/)', 1) <> ''
),
hashed AS (SELECT kind, entry, one_in, md5(kind || ':' || entry) AS m FROM named),
numbers AS (
    SELECT kind, entry, one_in, CAST('0x' || substr(m, 1, 4) AS INTEGER) AS a, CAST('0x' || substr(m, 5, 3) AS INTEGER) AS b,
        CAST('0x' || substr(m, 8, 2) AS INTEGER) AS c, CAST('0x' || substr(m, 10, 3) AS INTEGER) AS d,
        CAST('0x' || substr(m, 13, 3) AS INTEGER) AS e
    FROM hashed
),
listed AS (
    SELECT entry, kind || '-' || ['adult', 'ads', 'malware'][d % 3 + 1] AS list_name, e % 3 AS fate,
        DATE '2024-01-01' + b % 300 AS first, DATE '2024-01-01' + b % 300 + 30 + c % 64 AS gone
    FROM numbers WHERE a % one_in = 0
),
periods AS (
    SELECT entry, list_name, first AS active_from, CASE WHEN fate <> 0 THEN gone END AS active_to FROM listed
    UNION ALL SELECT entry, list_name, gone + 60, NULL FROM listed WHERE fate = 1
),
keys AS (
    SELECT DISTINCT url, fetched_on, entry FROM (
        SELECT url, fetched_on, host AS entry FROM captures WHERE host <> ''
        UNION ALL
        SELECT url, fetched_on, array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
        FROM captures, range(2, 40) AS r(i) WHERE i < len(string_split(host, '.'))
        UNION ALL
        SELECT url, fetched_on, host || array_to_string(list_slice(string_split(path, '/'), 1, i), '/') || '/'
        FROM captures, range(1, 400) AS r(i) WHERE host <> '' AND i < len(string_split(path, '/'))
    )
),
hits AS (
    SELECT k.url, k.fetched_on, min(p.list_name) AS list_name, count(*) AS n_entries
    FROM keys k JOIN (SELECT DISTINCT * FROM periods) p
        ON k.entry = p.entry AND k.fetched_on >= p.active_from AND (p.active_to IS NULL OR k.fetched_on < p.active_to)
    GROUP BY k.url, k.fetched_on
)
SELECT c.page_id, c.url, c.host, strftime(c.fetched_on, '%Y-%m-%d') AS fetched_on, h.url IS NOT NULL AS blocked, h.list_name,
    coalesce(h.n_entries, 0) AS n_entries
FROM captures c LEFT JOIN hits h ON c.url = h.url AND c.fetched_on = h.fetched_on
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text, where a CTE ``crc`` with the table ``t`` is at hand."""
    numbers = f"[CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT) FOR i IN range(octet_length(encode({text})))]"
    step = "lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])"
    return f"xor(list_reduce({numbers}, {step}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


CRC_TABLE = """
crc AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END, i)
        ORDER BY i) AS t
    FROM range(256) AS r(i)
)"""

SPELLINGS = f"""
WITH RECURSIVE {CRC_TABLE},
texts AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
runs AS (
    SELECT doc, run, count(*) AS n FROM (SELECT doc, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]+')) AS run FROM texts)
    WHERE length(run) >= 5 GROUP BY doc, run
),
hashed AS (SELECT run, n, {_crc32("doc || ':' || run")} AS h FROM runs, crc),
changed AS (
    SELECT n, CASE WHEN h % 97 = 0
        THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM hashed
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
without AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, 200) AS r(i) WHERE i <= length(word)
),
pairs AS (
    SELECT a.word AS a, b.word AS b FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word FROM words a JOIN without b ON a.word = b.rest
    UNION SELECT b.word, a.word FROM words a JOIN without b ON a.word = b.rest
),
near AS (
    SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, b)) AS best, max(w.n) AS best_n
    FROM pairs JOIN words w ON w.word = b GROUP BY a
),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
        CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
    FROM words LEFT JOIN near USING (word)
),
chain AS (
    SELECT word, word AS last FROM forms
    UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.last = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON f.word = c.word JOIN forms e ON e.word = c.last WHERE e.form IS NULL
"""

TRIE = f"""
WITH {CRC_TABLE},
turns AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS first, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS head
    FROM (SELECT DISTINCT conv_id FROM turns), crc
),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.first AND t.pos <= c.head
    UNION ALL
    SELECT c.conv_id, t.pos - c.head + least(c.head, coalesce(s.n, 0)), t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.head LEFT JOIN sizes s ON s.conv_id = c.first
),
members AS (
    SELECT conv_id, pos AS depth, length(text) AS n_chars,
        string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
),
nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_chars) AS saved FROM members GROUP BY depth, prefix
),
places AS (SELECT m.conv_id AS member, n.conv_id, n.depth FROM members m JOIN nodes n ON m.depth = n.depth AND m.prefix = n.prefix),
linked AS (SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN places p ON p.member = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c ON c.conv_id = l.conv_id AND c.depth = l.depth),
totals AS (
    SELECT p.conv_id, p.depth, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, CAST(sum(f.saved) AS BIGINT) AS saved_tokens
    FROM full_nodes f JOIN places p ON p.member = f.conv_id AND p.depth <= f.depth GROUP BY p.conv_id, p.depth
),
ends AS (
    SELECT p.conv_id, p.depth, string_agg(CAST(p.member AS VARCHAR), ',' ORDER BY p.member) AS ids
    FROM places p JOIN (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id) w ON w.conv_id = p.member AND w.depth = p.depth
    GROUP BY p.conv_id, p.depth
)
SELECT f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, t.n_leaves, t.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_nodes f JOIN totals t ON t.conv_id = f.conv_id AND t.depth = f.depth
LEFT JOIN ends e ON e.conv_id = f.conv_id AND e.depth = f.depth
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filters": URLS,
        "op4_line_dedup": LINES,
        "op11_spelling_variants": SPELLINGS,
        "op12_conversation_prefix_trie": TRIE,
    }
