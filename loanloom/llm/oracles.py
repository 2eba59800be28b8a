"""The queries that SQL can express, in DuckDB SQL over the same tables."""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS words FROM documents
), items AS (
    SELECT item_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, words[k : k + 9] AS span
    FROM (SELECT item_id, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS k FROM items WHERE len(words) > 0)
), sizes AS (
    SELECT DISTINCT len(span) AS size FROM windows
), places AS (
    SELECT r, words, unnest(generate_series(1, len(words) - size + 1)) AS k, size
    FROM d, sizes WHERE len(words) >= size
), hits AS (
    SELECT r, k, size, item_id FROM places JOIN windows ON words[k : k + size - 1] = span
), hit_words AS (
    SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + size - 1)) AS w FROM hits) GROUP BY r
), hit_items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

MIX = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
    SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1)::INTEGER % 3 + 1] AS weight FROM totals
), fill AS (
    SELECT *, coalesce(sum(source_size) OVER earlier, 0)::BIGINT AS full_before, coalesce(sum(weight) OVER earlier, 0)::BIGINT AS weight_before,
           row_number() OVER (ORDER BY source_size::DOUBLE / weight, source IS NULL, encode(source)) AS place
    FROM ranked
    WINDOW earlier AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), whole AS (
    SELECT sum(source_size)::BIGINT AS words, sum(weight)::BIGINT AS weights FROM ranked
), leveled AS (
    SELECT *, (words * 3 - full_before * 2 * 2)::DOUBLE / ((weights - weight_before) * 2)::DOUBLE AS own_level FROM fill, whole
), level AS (
    SELECT arg_min(own_level, place) AS level FROM leveled WHERE own_level * weight <= source_size * 2
), targets AS (
    SELECT source, source_size, least(level * weight, (source_size * 2)::DOUBLE) AS target FROM leveled, level
), queued AS (
    SELECT doc_id, s.source, size, source_size, target,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':mix'), size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS queued
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT size, (queued + k * source_size + size::DOUBLE / 2) / target AS at_time
    FROM queued, (VALUES (0), (1)) AS v(k) WHERE size > 0
), run AS (
    SELECT at_time, size, sum(size) OVER (ORDER BY at_time, size ROWS UNBOUNDED PRECEDING) AS total FROM copies
), cut AS (
    SELECT coalesce(max(at_time) FILTER (WHERE 2 * (2 * total - size) <= 2 * 3 * words), 0) AS cut FROM run, whole
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0
            ELSE size * (((queued + size::DOUBLE / 2) / target <= cut)::BIGINT
                         + ((queued + source_size + size::DOUBLE / 2) / target <= cut)::BIGINT) END::BIGINT AS taken
FROM queued, cut
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, words[k : k + 4] AS shingle
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS k FROM d WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared s JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE s.n >= 0.8 * (p.n + q.n - s.n)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM d
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT x AS doc_id, min(y) AS component_id, x = min(y) AS kept FROM reach GROUP BY x
"""

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest FROM pages
), first AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload) END AS head FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN head IS NOT NULL AND head IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head IS DISTINCT FROM page_id THEN head END AS refers_to
FROM first
"""

SEARCH = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS words FROM documents
), whole AS (
    SELECT count(*) FILTER (WHERE len(words) > 0)::BIGINT AS docs, sum(len(words))::BIGINT AS terms FROM d
), items AS (
    SELECT item_id, row_number() OVER () AS q, list_distinct(coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), [])) AS words FROM benchmark
), wanted AS (
    SELECT q, item_id, unnest(words) AS term FROM items
), counted AS (
    SELECT r, doc_id, len(words)::BIGINT AS n, term, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, words, unnest(words) AS term FROM d) SEMI JOIN wanted USING (term) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counted, whole GROUP BY term
), scored AS (
    SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM wanted JOIN counted USING (term) JOIN weights USING (term), whole GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""

EMBEDDINGS = """
WITH RECURSIVE e AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
), usable AS (
    SELECT * FROM e
    WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(x, lambda c: c <> 0)) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98
), counted AS (
    SELECT x, count(*) AS n FROM links GROUP BY x
), reach AS (
    SELECT vec_id AS x, vec_id AS y FROM e
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), smallest AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT s.x AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, s.x = component_id AS kept
FROM smallest s LEFT JOIN counted c ON c.x = s.x
"""
