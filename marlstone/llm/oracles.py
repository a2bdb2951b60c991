"""SQL twins of corpus queries, for one-node engines: plain, and quadratic where the operators aren't."""

from __future__ import annotations

from .secret_scan import RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT = """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = rf"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM (SELECT *, least(13, len(w)) AS n FROM items) WHERE n > 0),
    docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    runs AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs CROSS JOIN (SELECT DISTINCT n FROM windows))),
    hits AS (SELECT doc_id, i, n, item FROM runs JOIN windows USING (n, g)),
    hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
    hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND coalesce(n_hit, 0) * 20 >= len(w) AS contaminated
    FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

CLASSES = rf"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    both_in AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM both_in JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
    reach(d, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT d, y FROM reach JOIN links ON r = x)
    SELECT doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN sizes ON sizes.doc_id = d JOIN documents ON documents.doc_id = d GROUP BY documents.doc_id
"""
CLASSES = CLASSES.replace("SELECT doc_id, CAST(coalesce(max(n)", "SELECT documents.doc_id AS doc_id, CAST(coalesce(max(n)")


def _spans(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
        SELECT doc_id, {order} AS o, '{kind}' AS kind, CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s, len(ms[i]) AS n
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {group}) AS vs, string_split_regex(t, '{p}') AS gaps FROM texts WHERE regexp_matches(t, '{p}')))
        WHERE len(vs[i]) >= {least}"""


SECRETS = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    spans AS ({" UNION ALL ".join(_spans(i, r.kind, r.pattern, r.group, r.least) for i, r in enumerate(RULES))}),
    digests AS (SELECT doc_id, count(*) FILTER (WHERE o = 0) AS a, count(*) FILTER (WHERE o = 1) AS b, count(*) FILTER (WHERE o = 2) AS c, string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, o) FILTER (WHERE o < 3) AS base, string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, o) AS every FROM spans GROUP BY 1)
    SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access, CAST(coalesce(c, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
    FROM texts LEFT JOIN digests USING (doc_id)
"""
