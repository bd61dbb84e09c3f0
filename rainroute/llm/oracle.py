"""DuckDB SQL with the same results as the queries whose rows SQL can express, from the definitions."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SPACED = r"'[^\x20\x09-\x0D]+'"

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (SELECT doc_id, i, md5(b[i:i + 399]) AS h FROM d, unnest(range(1, octet_length(b) - 398)) t(i)),
starts AS (
    SELECT doc_id, i FROM windows
    WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
),
spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 399 AS z
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span
          FROM (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh
                FROM starts))
    GROUP BY doc_id, span
),
cuts AS (
    SELECT doc_id, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1 AS x, a - 1 AS y FROM spans
    UNION ALL
    SELECT doc_id, coalesce(max(z), 0) + 1, max(octet_length(b)) FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id
),
kept AS (SELECT doc_id, string_agg(hex(b[x:y]), '' ORDER BY x) AS k FROM cuts JOIN d USING (doc_id) WHERE x <= y GROUP BY doc_id),
counts AS (SELECT doc_id, sum(z - a + 1) AS n, count(*) AS m FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(m, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op2_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM benchmark),
patterns AS (
    SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
    FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0
),
windows AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
    FROM d, (SELECT DISTINCT n FROM patterns) s, unnest(range(1, len(w) - n + 2)) t(i)
),
found AS (SELECT doc_id, i, n, item FROM windows JOIN patterns USING (n, p)),
hits AS (
    SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM found, unnest(range(n)) t(j) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op6_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM d, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
    GROUP BY x.doc_id, y.doc_id
    HAVING 100 * count(*) >= 75 * (max(p.n) + max(q.n) - count(*))
),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    SELECT doc_id, b FROM reach JOIN links ON a = other
)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
    "op7_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM d, unnest(range(1, len(w) - 33)) t(i)),
hits AS (
    SELECT DISTINCT doc_id, i + j AS p FROM windows, range(35) t(j)
    WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
),
places AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) t(p)),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS k
    FROM places ANTI JOIN hits USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
}
