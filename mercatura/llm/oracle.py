"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


URL_FILTER = f"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {_AZ}) AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE WHEN {_fits("www.example.com", "/en/")} THEN 'www.example.com/en/'
                 WHEN {_fits("example.com", "/en/")} THEN 'example.com/en/'
                 WHEN {_fits("net", "/es/")} THEN 'net/es/'
                 WHEN {_fits("net", "/fr/")} THEN 'net/fr/'
                 WHEN {_fits("com", "/")} THEN 'com/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

EXACT_TOP_K = """
WITH usable AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum([x[1] * x[2] FOR x IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(w[s:s + 9]) AS n, array_to_string(w[s:s + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM windows))
), found AS (
  SELECT doc_id, s, n, item_id FROM places JOIN windows USING (n, phrase)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM found))
  GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d)
), repeated AS (
  SELECT doc_id, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY phrase) AS first FROM windows)
  WHERE doc_id > first
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM repeated
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM placed ANTI JOIN covered USING (doc_id, p)
  GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, {_AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM grams a JOIN grams b USING (gram)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT doc_id, y FROM reached JOIN links ON x = other
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_FINITE = """embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"""


def _assigned(books: str) -> str:
    """Nearest entry of each part of each row, with its distance."""
    return f"""
  SELECT id, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance
  FROM (SELECT id, part, entry, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(v, c)]) AS distance
        FROM parts JOIN {books} USING (part))
  GROUP BY id, part"""


def _updated(books: str, assigned: str) -> str:
    """Entries as the floor of the mean of their parts; unused ones stay."""
    return f"""
  SELECT part, entry, coalesce(m, c) AS c
  FROM {books} LEFT JOIN (
    SELECT part, entry, list(m ORDER BY place) AS m
    FROM (SELECT part, entry, place, floor(sum(x) / count(*))::BIGINT AS m
          FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS place
                FROM parts JOIN {assigned} USING (id, part))
          GROUP BY part, entry, place)
    GROUP BY part, entry) USING (part, entry)"""


VECTOR_CODES = (
    f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
         [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE {_FINITE}
), parts AS MATERIALIZED (
  SELECT id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS v
  FROM kept, (SELECT unnest(range(4)) AS part)
), books0 AS MATERIALIZED (SELECT part, id AS entry, v AS c FROM parts WHERE id < 256)"""
    + "".join(
        f""", assigned{k} AS MATERIALIZED ({_assigned(f"books{k}")}
), books{k + 1} AS MATERIALIZED ({_updated(f"books{k}", f"assigned{k}")}
)"""
        for k in range(4)
    )
    + f""", final AS MATERIALIZED ({_assigned("books4")}
), coded AS (
  SELECT id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
  FROM final GROUP BY id
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books4
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id), digest
"""
)

HARD_NEGATIVES = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum([x[1] * x[2] FOR x IN list_zip(a.v, b.v)])::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

STATEMENTS = {
    "op4_url_filter": URL_FILTER,
    "op7_substring_dedup": SUBSTRING_DEDUP,
    "op8_ngram_jaccard": NGRAM_JACCARD,
    "op9_decontamination": DECONTAMINATION,
    "op10_exact_top_k": EXACT_TOP_K,
    "op11_vector_codes": VECTOR_CODES,
    "op12_hard_negatives": HARD_NEGATIVES,
}
