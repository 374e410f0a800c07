"""The operators in SQL, where SQL can express them."""

MIX = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight,
         source_size * 2.0::DOUBLE AS most FROM sizes),
leveled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER ahead, 0.0::DOUBLE))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0.0::DOUBLE)) AS level
  FROM ranked WINDOW ahead AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT min_by(level, most / weight) AS level FROM leveled WHERE level * weight < most),
targets AS (
  SELECT source, source_size, CASE WHEN (SELECT level FROM level) * weight < most THEN (SELECT level FROM level) * weight ELSE most END AS target FROM ranked),
placed AS (
  SELECT docs.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source),
turned AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS turns FROM placed)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(turns * size + least(greatest(budget - turns * source_size - before, 0), size) AS BIGINT) AS taken FROM turned
"""

EXACT = r"""
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
named AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size, sha256(text) AS text_sha256 FROM docs)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM named
"""

WARC = r"""
WITH records AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
parts AS (
  SELECT *, list_transform(range(4), lambda i: CAST('0x' || substr(digest, CAST(1 + 10 * i AS BIGINT), 10) AS BIGINT)) AS forty FROM records)
SELECT page_id, url, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((forty[CAST(k // 8 + 1 AS BIGINT)] >> CAST(35 - 5 * (k % 8) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM parts
"""

COLLOCATIONS = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (SELECT lang, w[i] AS x, CASE WHEN i + 1 <= len(w) THEN w[i + 1] END AS y, CASE WHEN i + 2 <= len(w) THEN w[i + 2] END AS z FROM places),
f1 AS (SELECT lang, x, count(*) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*) AS f FROM grams WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM grams WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.f AS a, 1 AS k, p.f AS l, q.f AS r FROM f2
  JOIN f1 p ON p.lang = f2.lang AND p.x = f2.x JOIN f1 q ON q.lang = f2.lang AND q.x = f2.y
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.x = f2.x AND f3.y = f2.y AND 100 * f3.f >= 50 * f2.f)
    AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.y = f2.x AND f3.z = f2.y AND 100 * f3.f >= 50 * f2.f)
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, 1, p.f, q.f FROM f3
  JOIN f1 p ON p.lang = f3.lang AND p.x = f3.x JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.f, 2, p.f, q.f FROM f3
  JOIN f2 p ON p.lang = f3.lang AND p.x = f3.x AND p.y = f3.y JOIN f1 q ON q.lang = f3.lang AND q.x = f3.z),
scores AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scores),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE cut = 1),
totals AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SEARCH = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sizes AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
items AS (
  SELECT row_number() OVER () AS item, item_id,
         list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark),
wanted AS (SELECT item, unnest(terms) AS term FROM items),
every AS (SELECT row, len(terms) AS n, unnest(terms) AS term FROM docs),
postings AS (SELECT row, n, term, count(*) AS tf FROM every WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, sizes GROUP BY term),
scores AS (
  SELECT item, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term), sizes GROUP BY item, row),
ranked AS (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN docs USING (row) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 10
"""

ORACLES = {"op2_mixing": MIX, "op6_exact_dedup": EXACT, "op10_warc": WARC, "op11_ranked_search": SEARCH, "op12_collocations": COLLOCATIONS}
