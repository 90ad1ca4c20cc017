"""The SQL each query must equal, from the base tables alone."""

from __future__ import annotations

SPACE = r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{SPACE}+|{SPACE}+$', '', 'g')"


# Distinct hashed positions of all substrings of length 1 to 3 of texts(id, text).
POSITIONS = """
trios AS (
    SELECT id, unnest(list_zip(c, c[2:], c[3:])) AS z
    FROM (SELECT id, string_split(text, '') AS c FROM texts WHERE length(text) > 0)
),
grams AS (
    SELECT DISTINCT id, g
    FROM (SELECT id, unnest([z[1], z[1] || z[2], z[1] || z[2] || z[3]]) AS g FROM trios)
    WHERE g IS NOT NULL
),
pos AS (SELECT DISTINCT id, ('0x' || substr(md5(g), 1, 8))::UBIGINT % 2048 AS p FROM grams)
"""

FINGERPRINT_BITS = f"""
WITH texts AS (SELECT doc_id AS id, text FROM documents), {POSITIONS}
SELECT i.id AS doc_id,
       string_agg(CASE WHEN pos.p IS NULL THEN '0' ELSE '1' END, '' ORDER BY i.p) AS fingerprint
FROM (SELECT id, unnest(range(2048)) AS p FROM texts) i
LEFT JOIN pos ON pos.id = i.id AND pos.p = i.p
GROUP BY i.id
"""

SCORES = f"""
WITH texts AS (
    SELECT 'doc-' || doc_id AS id, text FROM documents
    UNION ALL SELECT 'item-' || item_id, text FROM benchmark
), {POSITIONS},
sizes AS (SELECT id, count(*) AS n FROM pos GROUP BY id),
shared AS (
    SELECT t.id AS tid, s.id AS sid, count(*) AS n
    FROM pos t JOIN pos s ON t.p = s.p
    WHERE t.id LIKE 'item-%' GROUP BY t.id, s.id
),
full_scores AS (
    SELECT t.id AS tid, s.id AS sid, coalesce(b.n, 0) / (t.n + s.n - coalesce(b.n, 0)) AS score
    FROM sizes t CROSS JOIN sizes s LEFT JOIN shared b ON b.tid = t.id AND b.sid = s.id
    WHERE t.id LIKE 'item-%' AND t.id <> s.id
)
"""

TANIMOTO_FULL = f"""{SCORES}
SELECT tid AS target_chembl_id, sid AS source_chembl_id, score AS similarity_score FROM full_scores
"""

TANIMOTO_TOPK = f"""{SCORES},
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tid ORDER BY score DESC, sid) AS rn FROM full_scores
),
tenth AS (SELECT tid, score FROM ranked WHERE rn = 10),
ties AS (
    SELECT r.tid, count(*) AS n FROM ranked r JOIN tenth t ON t.tid = r.tid AND t.score = r.score
    WHERE r.rn > 10 GROUP BY r.tid
)
SELECT r.tid AS target_chembl_id, r.sid AS source_chembl_id, r.score AS tanimoto_similarity,
       (r.rn = 10 AND coalesce(t.n, 0) > 0) AS has_duplicates_of_last_largest_score
FROM ranked r LEFT JOIN ties t ON t.tid = r.tid WHERE r.rn <= 10
"""

LINES = f"""
WITH numbered AS (
    SELECT doc_id AS file, unnest(generate_series(1, len(l))) AS line, unnest(l) AS content
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
),
parts AS (
    SELECT *, strpos(content, ',') AS comma,
           {_strip("left(content, greatest(strpos(content, ',') - 1, 0))")} AS chembl_id,
           {_strip("substr(content, strpos(content, ',') + 1)")} AS smiles
    FROM numbered
),
judged AS (
    SELECT *, CASE WHEN line = 1 THEN 'header'
                   WHEN {_strip("content")} = '' THEN 'blank'
                   WHEN comma = 0 THEN 'malformed'
                   WHEN strlen(content) <> length(content) THEN 'non-ascii'
                   WHEN strpos(smiles, ',') > 0 THEN 'extra comma' END AS reason
    FROM parts
),
first_rows AS (
    SELECT * FROM judged WHERE reason IS NULL
    QUALIFY row_number() OVER (PARTITION BY chembl_id ORDER BY file, line) = 1
)
"""


def _count(mark: str) -> str:
    return f"(length(smiles) - length(replace(smiles, '{mark}', '')))"


TARGET_REJECTS = f"""{LINES}
SELECT * FROM (
    SELECT chembl_id, smiles,
           CASE WHEN smiles = '' THEN 'empty'
                WHEN regexp_matches(smiles, '[\\t\\n\\x0B\\f\\r ]') THEN 'white space'
                WHEN {_count("(")} <> {_count(")")} THEN 'parentheses'
                WHEN {_count("[")} <> {_count("]")} THEN 'brackets' END AS reason
    FROM first_rows
) WHERE reason IS NOT NULL
"""

ENVELOPE = """
SELECT doc_id, len(l)::BIGINT AS total_count, unnest(l) AS line
FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS l FROM documents) WHERE lang <> 'es'
"""

JSON_VALIDATE = """
WITH judged AS (
    SELECT event_id, event_type, value, user_id,
           value < 1 AS bad_last,
           CASE WHEN event_type = 'error' THEN 'absent' WHEN user_id % 10 = 0 THEN 'null'
                WHEN user_id % 10 = 1 THEN 'number' ELSE 'text' END AS status_kind
    FROM events
)
SELECT event_id, 'E' || event_id AS chembl_id, event_type AS entity_type,
       CASE WHEN bad_last OR (value >= 5 AND value < 6) THEN NULL ELSE value END AS last_active,
       CASE WHEN status_kind = 'text' THEN 'ACTIVE' END AS status,
       concat_ws('; ', CASE WHEN bad_last THEN 'last_active: not a double' END,
                 CASE status_kind WHEN 'absent' THEN 'status: absent' WHEN 'null' THEN 'status: required'
                                  WHEN 'number' THEN 'status: not a string' END) AS faults
FROM judged
"""

FACT = """
fact AS (
    SELECT l_suppkey AS source_chembl_id, l_partkey AS target_chembl_id, max(round(l_discount * 100) / 16) AS tanimoto_similarity
    FROM lineitem GROUP BY ALL
)
"""

PROPERTIES = """
properties AS (
    SELECT p_partkey AS chembl_id,
           CASE WHEN p_type <> 'SMALL' THEN length(p_type) END AS aromatic_rings, p_size AS heavy_atoms,
           CASE WHEN p_type <> 'SMALL' THEN round(p_retailprice * 100) END AS alogp
    FROM part
)
"""

PIVOT_IDS = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]
PIVOT_COLUMNS = ", ".join(
    f"max(CASE WHEN source_chembl_id = {i} THEN tanimoto_similarity END) AS source_{i}" for i in PIVOT_IDS
)

ORACLE = {
    "fingerprint_bits": FINGERPRINT_BITS,
    "fingerprint_decode": """
WITH signed AS (
    SELECT vec_id, label,
           list_sum([CASE WHEN embedding[i + 1] > 0 THEN 1::HUGEINT << (63 - i)::INT ELSE 0::HUGEINT END
                     FOR i IN range(64)]) AS forward,
           list_sum([CASE WHEN embedding[i + 1] > 0 THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END
                     FOR i IN range(64)]) AS mirrored,
           len([x FOR x IN embedding IF x > 0]) AS n
    FROM embeddings
)
SELECT vec_id,
       CASE WHEN label <> 0 THEN (CASE WHEN forward >= 9223372036854775808
            THEN forward - 18446744073709551616 ELSE forward END)::BIGINT END AS word_1,
       CASE WHEN label <> 0 THEN (CASE WHEN mirrored >= 9223372036854775808
            THEN mirrored - 18446744073709551616 ELSE mirrored END)::BIGINT END AS word_2,
       CASE WHEN label <> 0 THEN 2 * n ELSE -1 END::INTEGER AS n_set
FROM signed
""",
    "fingerprint_scan": "SELECT doc_id, text FROM documents WHERE text IS NOT NULL",
    "fingerprint_file_faults": """
WITH p AS (SELECT CAST(doc_id % 8 AS INTEGER) AS part, count(*) AS n, count(text) AS filled FROM documents GROUP BY ALL)
SELECT part, CASE part WHEN 1 THEN 'no column text' WHEN 2 THEN 'column text is bigint, not string' WHEN 3 THEN 'made with'
                       WHEN 4 THEN 'unreadable' WHEN 5 THEN 'column doc_id is string, not bigint' END AS fault,
       CASE WHEN part <> 4 THEN n END AS n_rows, CASE WHEN part IN (0, 6, 7) AND filled > 0 THEN filled END AS rows_read
FROM p
""",
    "structure_scan": "SELECT doc_id AS chembl_id, text AS canonical_smiles FROM documents",
    "split_scan": "SELECT event_id, CAST(pow(event_id % 20, 7) AS BIGINT) * 1000000000 + event_id AS skewed_id, event_type, "
    "true AS even FROM events",
    "limit_offset": "SELECT doc_id AS chembl_id, text AS canonical_smiles FROM documents "
    "ORDER BY doc_id LIMIT 150 OFFSET 100",
    "tanimoto_full": TANIMOTO_FULL,
    "tanimoto_topk": TANIMOTO_TOPK,
    "tanimoto_postings": TANIMOTO_TOPK,
    "tanimoto_banded": TANIMOTO_TOPK,
    "csv_clean": f"{LINES} SELECT file, line::INTEGER AS line, chembl_id, smiles FROM judged WHERE reason IS NULL",
    "csv_reject_reasons": f"{LINES} SELECT file, line::INTEGER AS line, reason FROM judged "
    "WHERE reason NOT IN ('header', 'blank')",
    "monthly_targets": f"{LINES} SELECT chembl_id, smiles FROM first_rows",
    "target_rejects": TARGET_REJECTS,
    "month_prefix": "SELECT o_orderkey, strftime(o_orderdate, 'data_%m_%Y') AS prefix FROM orders",
    "dedup_keep_first": """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""",
    "duplicate_members": """
SELECT event_id, user_id, value FROM events QUALIFY count(*) OVER (PARTITION BY user_id, value) > 1
""",
    "count_distinct": "SELECT count(DISTINCT doc_id) AS n_distinct FROM documents",
    "reconcile_counts": """
SELECT e AS expected, a AS actual, e = a AS matches
FROM (SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS e, (SELECT count(*) FROM labels) AS a)
""",
    "version_reconcile": """
WITH lines AS (SELECT DISTINCT l_orderkey AS key FROM lineitem),
held AS (
    SELECT DISTINCT o_orderkey AS key FROM orders
    WHERE (o_orderkey % 6 < 3 AND o_orderkey IN (SELECT key FROM lines)) OR o_orderkey % 6 = 3
       OR (o_orderkey % 6 = 4 AND o_orderstatus = 'F')
), sides AS (
    SELECT coalesce(l.key, h.key) % 6 AS version, l.key IS NOT NULL AND h.key IS NULL AS missing, l.key IS NULL AS extra
    FROM lines l FULL JOIN held h ON l.key = h.key
)
SELECT version, CASE WHEN bool_or(missing OR extra) THEN 'keys' ELSE 'sketch' END AS checked,
       count(*) FILTER (missing) AS n_missing, count(*) FILTER (extra) AS n_extra
FROM sides GROUP BY version
""",
    "pk_violations": """
SELECT l_suppkey, l_partkey, count(*) AS n_rows FROM lineitem GROUP BY ALL
HAVING count(*) > 1 OR l_suppkey IS NULL OR l_partkey IS NULL
""",
    "fk_violations": """
SELECT 'l_partkey' AS key_column, l_partkey AS key_value, count(*) AS n_rows FROM lineitem
WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY l_partkey
UNION ALL
SELECT 'l_suppkey', l_suppkey, count(*) FROM lineitem
WHERE l_suppkey NOT IN (SELECT c_custkey FROM customer) GROUP BY l_suppkey
""",
    "paged_scan": "SELECT page_id, url, html, count(*) OVER () AS total_count FROM pages",
    "json_envelope_unnest": ENVELOPE,
    "page_reconcile": """
WITH p AS (
    SELECT doc_id % 10 AS c, length(text) - length(replace(text, chr(10), '')) + 1 AS n FROM documents
), faults AS (
    SELECT CASE c WHEN 1 THEN 'lost' WHEN 2 THEN 'broken' WHEN 3 THEN 'no list of records' ELSE 'short' END AS kind,
           count(*) AS n_pages, CAST(sum(CASE WHEN c = 4 THEN n - 1 ELSE 0 END) AS BIGINT) AS n_records
    FROM p WHERE c BETWEEN 1 AND 4 GROUP BY 1
)
SELECT * FROM faults
UNION ALL
SELECT 'with records', count(*) FILTER (n - CASE WHEN c = 4 THEN 1 ELSE 0 END > 0),
       CAST(sum(n - CASE WHEN c = 4 THEN 1 ELSE 0 END) AS BIGINT)
FROM p WHERE c NOT BETWEEN 1 AND 3
""",
    "staging_key_violations": """
SELECT 'orders' AS table_name, o_orderkey::VARCHAR AS key_value, count(*) AS n_rows FROM orders GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'lineitem', l_orderkey || ',' || l_suppkey, count(*) FROM lineitem GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'labels', doc_id::VARCHAR, count(*) FROM labels GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'conversations', conv_id::VARCHAR, count(*) FROM conversations GROUP BY ALL HAVING count(*) > 1
""",
    "json_validate": JSON_VALIDATE,
    "normalize_dictionary": """
SELECT 'M' || doc_id AS chembl_id, lang AS molecule_type, source AS pref_name, n_chars AS chirality,
       n_chars % 2 = 1 AS oral, n_chars / 4 AS usan_year, -1::BIGINT AS orphan
FROM documents
""",
    "normalize_properties": """
SELECT 'M' || doc_id AS chembl_id, quality::VARCHAR AS alogp, toxic::DOUBLE AS heavy_atoms, 'NULL' AS cx_most_apka
FROM documents JOIN labels USING (doc_id)
""",
    "normalize_structures": """
SELECT 'M' || doc_id AS chembl_id, text AS canonical_smiles FROM documents WHERE lang <> 'de'
""",
    "nan_to_null": """
SELECT vec_id, place - 1 AS place, CASE WHEN value >= 0 THEN value::DOUBLE END AS value
FROM (SELECT vec_id, unnest(range(1, len(embedding) + 1))::INTEGER AS place, unnest(embedding) AS value FROM embeddings)
""",
    "avg_score": f"""
WITH {FACT} SELECT source_chembl_id, avg(tanimoto_similarity) AS avg FROM fact GROUP BY source_chembl_id
""",
    "avg_deviation": f"""
WITH {FACT}, {PROPERTIES}
SELECT source_chembl_id, avg(abs(t.alogp - s.alogp)) AS average_alogp_deviation
FROM fact JOIN properties s ON source_chembl_id = s.chembl_id JOIN properties t ON target_chembl_id = t.chembl_id
GROUP BY source_chembl_id
""",
    "pivot_scores": f"""
WITH {FACT}
SELECT target_chembl_id, {PIVOT_COLUMNS} FROM fact
WHERE source_chembl_id IN ({", ".join(map(str, PIVOT_IDS))}) GROUP BY target_chembl_id
""",
    "next_most_similar": f"""
WITH {FACT}, scored AS (
    SELECT source_chembl_id, target_chembl_id, nullif(tanimoto_similarity, 5 / 16) AS tanimoto_similarity FROM fact
)
SELECT source_chembl_id, target_chembl_id, tanimoto_similarity,
       lead(tanimoto_similarity, 1) OVER (
           PARTITION BY target_chembl_id ORDER BY tanimoto_similarity DESC NULLS FIRST, source_chembl_id
       ) AS next_most_similar_target,
       nth_value(target_chembl_id, 2) OVER (
           PARTITION BY source_chembl_id ORDER BY tanimoto_similarity DESC NULLS FIRST, target_chembl_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
       ) AS second_most_similar_target
FROM scored WHERE source_chembl_id <> target_chembl_id
""",
    "grouped_averages": f"""
WITH {FACT}, {PROPERTIES}
SELECT CASE WHEN grouping(source_chembl_id) = 0 THEN source_chembl_id::VARCHAR ELSE 'TOTAL' END AS source_molecule,
       CASE WHEN grouping(aromatic_rings) = 0 THEN aromatic_rings::VARCHAR ELSE 'TOTAL' END AS aromatic_rings,
       CASE WHEN grouping(heavy_atoms) = 0 THEN heavy_atoms::VARCHAR ELSE 'TOTAL' END AS heavy_atoms,
       avg(tanimoto_similarity) AS avg
FROM fact JOIN properties ON chembl_id = source_chembl_id
GROUP BY GROUPING SETS ((source_chembl_id), (aromatic_rings, heavy_atoms), (heavy_atoms), ())
""",
    "fact_upsert": """
WITH old AS (
    SELECT l_suppkey AS s, l_partkey AS t, max(round(l_discount * 100) / 16) AS v FROM lineitem WHERE l_linenumber <= 4 GROUP BY ALL
), new AS (
    SELECT l_suppkey AS s, l_partkey AS t, max(round(l_discount * 100) / 16) AS v FROM lineitem WHERE l_linenumber > 4 GROUP BY ALL
)
SELECT coalesce(new.s, old.s) AS source_chembl_id, coalesce(new.t, old.t) AS target_chembl_id,
       coalesce(new.v, old.v) AS tanimoto_similarity
FROM old FULL OUTER JOIN new ON old.s = new.s AND old.t = new.t
""",
    "key_union": """
SELECT l_suppkey AS chembl_id FROM lineitem UNION SELECT l_partkey FROM lineitem
""",
    "dim_molecules": """
SELECT DISTINCT p_partkey AS chembl_id, o_orderstatus AS molecule_type, p_retailprice AS mw_freebase,
       CASE WHEN p_size <= 25 THEN p_retailprice END AS alogp, p_size::DOUBLE AS psa, 1000.0::DOUBLE AS cx_logp,
       p_type AS molecular_species, p_retailprice AS full_mwt,
       round_even(p_size / 2, 0)::INTEGER AS aromatic_rings, round_even(p_size + 0.25, 0)::INTEGER AS heavy_atoms
FROM part JOIN orders ON p_partkey = o_orderkey
WHERE p_partkey IN (SELECT l_suppkey FROM lineitem UNION SELECT l_partkey FROM lineitem)
""",
}
