"""SQL for DuckDB where it can express a query of this subpackage."""

from __future__ import annotations

OP4 = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM split
), grams AS (SELECT doc_id, md5_number(unnest(s)) AS g FROM sets
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * common >= 80 * (len(x.s) + len(y.s) - common)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(r) AS component_id, sets.doc_id = min(r) AS kept
FROM sets JOIN reach USING (doc_id) GROUP BY sets.doc_id, s
"""

OP8 = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents
), keyed AS (
    SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), owners AS (
    SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT keyed.doc_id, line, n, owner IS NOT NULL AND owner <> keyed.doc_id AS dropped FROM keyed LEFT JOIN owners USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP9 = r"""
WITH normal AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)
"""


def oracle() -> dict[str, str]:
    return {"op4_near_duplicates": OP4, "op8_line_dedup": OP8, "op9_exact_dedup": OP9}
