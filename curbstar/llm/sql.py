"""The same results in SQL for DuckDB, for the operators that SQL can express."""

MINHASH_DEDUP = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, list_distinct(
           CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
           END) AS s
  FROM words
), classes AS (
  SELECT list_sort(s) AS s, min(doc_id) AS node FROM shingles WHERE len(s) > 0 GROUP BY list_sort(s)
), members AS (
  SELECT node, len(s) AS n, unnest(s) AS shingle FROM classes
), meetings AS (
  SELECT a.node AS a, b.node AS b, count(*) AS shared, any_value(a.n) AS an, any_value(b.n) AS bn
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.node <> b.node
  GROUP BY a.node, b.node
), links AS (
  SELECT a, b FROM meetings WHERE 100 * shared >= 85 * (an + bn - shared)
), reach AS (
  SELECT node, node AS other FROM classes
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), roots AS (
  SELECT node, min(other) AS root FROM reach GROUP BY node
), placed AS (
  SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(r.root, s.doc_id) AS component_id
  FROM shingles s LEFT JOIN classes c ON len(s.s) > 0 AND list_sort(s.s) = c.s
  LEFT JOIN roots r ON r.node = c.node
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM placed
"""

FILTER_INTERACTIONS = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good,
         max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), judged AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM texts
), classes AS (
  SELECT part, fails, count(*) AS docs, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM judged LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT CAST('' AS VARCHAR) AS o
  UNION ALL
  SELECT o || l FROM orders, letters WHERE NOT contains(o, l)
), steps AS (
  SELECT o AS filter_order, s AS step, substr(o, s, 1) AS filter, substr(o, 1, s - 1) AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) AS n(s) WHERE length(o) = 5
), placed AS (
  SELECT c.*, s.*, contains(fails, filter) AS failing,
         length(translate(fails, before, '')) < length(fails) AS gone
  FROM classes c, steps s
), counted AS (
  SELECT part, filter_order, step, filter,
         sum(CASE WHEN NOT gone AND NOT failing THEN docs ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failing THEN docs ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failing THEN docs ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = filter THEN docs ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""

ARC_TO_WARC = r"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(encode(coalesce(html, ''))) AS payload_digest
  FROM pages
), placed AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM placed
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM worded
  UNION ALL
  SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM worded
  UNION ALL
  SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
  FROM worded
  UNION ALL
  SELECT lang, 4, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]
                          FOR i IN range(1, len(w) - 2)]) FROM worded
), totals AS (
  SELECT lang, count(*) AS n FROM grams WHERE words = 1 GROUP BY lang
), counts AS (
  SELECT lang, words, phrase, count(*) AS f, string_split(phrase, ' ') AS w
  FROM grams GROUP BY lang, words, phrase HAVING count(*) >= 30
), cuts AS (
  SELECT lang, words, phrase, f AS a, w, unnest(range(1, words)) AS k FROM counts WHERE words > 1
), halves AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.w, c.k, x.f AS l, y.f AS r,
         (CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), candidates AS (
  SELECT * FROM halves
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), places AS (
  SELECT lang, words, w, f, unnest(range(1, words)) AS first FROM counts WHERE words > 2
), sizes AS (
  SELECT *, unnest(range(2, words)) AS size FROM places
), inner_parts AS (
  SELECT lang, array_to_string(w[first:first + size - 1], ' ') AS phrase, max(f) AS most
  FROM sizes WHERE first + size - 1 <= words GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_parts i USING (lang, phrase)
  WHERE i.most IS NULL OR 100 * i.most < 80 * c.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL = {
    "op1_minhash_dedup": MINHASH_DEDUP,
    "op11_filter_interactions": FILTER_INTERACTIONS,
    "op12_arc_to_warc": ARC_TO_WARC,
    "op13_collocations": COLLOCATIONS,
}
