"""SQL of the llm queries that DuckDB can answer on whole tables."""

_CURRENT = """SELECT id, text FROM (SELECT id, text, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST) AS rn
  FROM course_subs WHERE id IS NOT NULL) WHERE rn = 1"""

_TERMS = f"""
WITH rec AS (SELECT id, lower(text) AS t FROM ({_CURRENT}) WHERE text IS NOT NULL),
runs AS (SELECT id, unnest(regexp_extract_all(regexp_replace(t, '([\\x{{4E00}}-\\x{{9FFF}}]+)', ' \\1 ', 'g'), '[\\p{{L}}\\p{{N}}]+')) AS r FROM rec),
occ AS (
  SELECT id, r AS term FROM runs WHERE NOT regexp_matches(r, '^[\\x{{4E00}}-\\x{{9FFF}}]') OR length(r) = 1
  UNION ALL
  SELECT id, unnest(list_transform(range(1, length(r)), lambda i: substr(r, i, 2))) FROM runs
  WHERE regexp_matches(r, '^[\\x{{4E00}}-\\x{{9FFF}}]') AND length(r) > 1),
cnt AS (SELECT term, count(*) AS n, count(DISTINCT id) AS records FROM occ GROUP BY term),
lst AS (SELECT DISTINCT lower(regexp_replace(vocab, '^\\s+|\\s+$', '', 'g')) AS term FROM vocab_terms WHERE vocab IS NOT NULL),
allt AS (SELECT coalesce(c.term, l.term) AS term, coalesce(n, 0) AS n, coalesce(records, 0) AS records
  FROM cnt c FULL JOIN (SELECT term FROM lst WHERE term <> '') l ON c.term = l.term),
marked AS (SELECT term, CAST(n AS BIGINT) AS n, CAST(records AS BIGINT) AS records,
  CASE WHEN records <= 2 THEN 'rare' WHEN records * 5 > (SELECT count(*) FROM rec) THEN 'common' END AS mark FROM allt)
"""

_SPLIT = f"""
WITH item AS (SELECT 'documents' AS src, CAST(doc_id AS VARCHAR) AS item, text, 2000 AS lim FROM documents
  UNION ALL SELECT 'course_subs', id, text, 400 FROM ({_CURRENT}))
"""

ORACLE = {
    "p1_counts": _TERMS + "SELECT term, n, records, mark FROM marked",
    "p1_found": _TERMS + "SELECT term, mark FROM marked WHERE mark IS NOT NULL",
    "p3_found": _SPLIT
    + """SELECT src, item, CASE WHEN list_max(list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}\\p{M}]+'), lambda r: len(CAST(r AS VARCHAR)))) > lim
      THEN 'hard' ELSE 'soft' END AS cut_kind FROM item WHERE length(text) > lim""",
}
