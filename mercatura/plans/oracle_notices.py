"""DuckDB statements that state the near-duplicate queries on the same tables."""

from __future__ import annotations

# Written out here, so that a pattern of the library that is wrong doesn't go unseen. Fixed values.
_BLANKS = r"[\t-\r\x1C-\x20\x{85}\p{Z}]+"
_NOISE = (
    r"(?i)\b(?:npas|spc|pwd|mc|ref|tn)[-/A-Za-z0-9]+\b",
    r"\b\d{1,4}[-/\.]\d{1,2}[-/\.]\d{1,4}\b",
    r"(?i)\b\d{1,2}\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{2,4}\b",
    r"(?i)\b(?:rs\.?|inr|rupees)\s*[\d,]+(?:\.\d+)?(?:\s*(?:lakh|cr|crore|only))?\b",
)
_PHRASES = ("NATIONAL PROCUREMENT AGGREGATION SERVICE", "STATE PROCUREMENT CELL")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _removed(text: str, pattern: str, by: str = "' '") -> str:
    return f"regexp_replace({text}, {_quoted(pattern)}, {by}, 'g')"


def _folded(text: str) -> str:
    blanked = _removed(text, r"[^\x00-\x7F\p{L}\p{N}]")
    return _removed(blanked, r"[^\x00-\x7F]", "'_'")


def _squeezed(text: str) -> str:
    return f"trim({_removed(f'lower({text})', '[^a-z0-9]+')})"


def _cleaned(text: str) -> str:
    text = _folded(text)
    for pattern in _NOISE:
        text = _removed(text, pattern)
    return _squeezed(text)


def _cleaned_simple(text: str) -> str:
    text = f"upper(replace({text}, 'ß', 'SS'))"
    for phrase in _PHRASES:
        text = f"replace({text}, {_quoted(phrase)}, '')"
    text = _removed(text, r"\p{Nd}+", "''")
    text = _removed(text, r"[^\p{L}\p{N}_\t-\r\x1C-\x20\x{85}\p{Z}]", "''")
    return f"trim({_removed(text, _BLANKS)})"


def _grams(table: str, key: str, text: str, k: int, keep_short: bool) -> str:
    short = f"[{text}]" if keep_short else "[]::VARCHAR[]"
    return f"""
        SELECT DISTINCT {key}, unnest(
            CASE WHEN {text} = '' THEN []::VARCHAR[] WHEN length({text}) < {k} THEN {short}
                 ELSE list_transform(range(1, length({text}) - {k - 2}),
                                     lambda i: substr({text}, i, {k})) END) AS gram
        FROM {table}"""


def _bigrams(table: str, key: str) -> str:
    return f"""
        SELECT DISTINCT {key}, unnest(
            CASE WHEN len(ws) < 2 THEN ws
                 ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)
            AS shingle
        FROM (SELECT {key}, string_split(clean, ' ') AS ws FROM {table} WHERE clean <> '')"""


def _signature(rows: str, size: int) -> str:
    return f"""
        SELECT doc, i AS position, min((h * a + b) % 2147483647) AS min_hash
        FROM (SELECT doc, ('0x' || md5(shingle)[1:8])::BIGINT AS h FROM {rows}), coef
        WHERE i < {size} GROUP BY doc, i"""


def _bands(signature: str, rows: int) -> str:
    return f"""
        SELECT doc, (position // {rows})::INTEGER AS band_id,
               substr(md5(string_agg(min_hash::VARCHAR, ',' ORDER BY position)), 1, 12) AS bucket_hash
        FROM {signature} GROUP BY doc, position // {rows}"""


def _jaccard(grams: str, key: str, gram: str) -> str:
    """Scores of the labelled pairs; a pair with nothing in common scores 0."""
    return f"""
        SELECT l.notice_id_a, l.notice_id_b,
               coalesce(shared / (na.n + nb.n - shared), 0.0)::DOUBLE AS jaccard
        FROM pairs l
        LEFT JOIN (SELECT notice_id_a, notice_id_b, count(*) AS shared
                   FROM pairs JOIN {grams} x ON x.{key} = notice_id_a
                   JOIN {grams} y ON y.{key} = notice_id_b AND x.{gram} = y.{gram}
                   GROUP BY ALL) s USING (notice_id_a, notice_id_b)
        LEFT JOIN (SELECT {key}, count(*) AS n FROM {grams} GROUP BY ALL) na
          ON na.{key} = l.notice_id_a
        LEFT JOIN (SELECT {key}, count(*) AS n FROM {grams} GROUP BY ALL) nb
          ON nb.{key} = l.notice_id_b"""


def _shared(bands: str) -> str:
    """Buckets shared by each labelled pair."""
    return f"""
        SELECT notice_id_a AS doc_a, notice_id_b AS doc_b, label, coalesce(n, 0) AS n
        FROM labelled LEFT JOIN (
            SELECT notice_id_a, notice_id_b, count(*) AS n
            FROM pairs JOIN {bands} x ON x.doc = notice_id_a
            JOIN {bands} y ON y.doc = notice_id_b AND x.band_id = y.band_id
                          AND x.bucket_hash = y.bucket_hash
            GROUP BY ALL) USING (notice_id_a, notice_id_b)"""


def _sizes(bands: str) -> str:
    return f"SELECT band_id, bucket_hash, count(*) AS n_members FROM {bands} GROUP BY ALL"


PARTS = {
    "notices": "SELECT doc_id AS notice_id, source AS portal_id, lang, text AS body FROM documents",
    "started": """
        SELECT *, CASE
            WHEN portal_id IN ('src1', 'src2', 'src5') AND strpos(body, 'Licensed under the') > 0
                THEN substr(body, strpos(body, 'Licensed under the'))
            WHEN portal_id IN ('src3', 'src4', 'src6') AND strpos(body, 'Released under the') > 0
                THEN substr(body, strpos(body, 'Released under the'))
            ELSE body END AS from_start
        FROM notices""",
    "stripped": """
        SELECT *, CASE
            WHEN portal_id IN ('src1', 'src2', 'src5') AND strpos(from_start, 'All rights reserved.') > 0
                THEN substr(from_start, 1, strpos(from_start, 'All rights reserved.') - 1)
            ELSE from_start END AS inner_text
        FROM started""",
    "cleaned": f"SELECT notice_id, portal_id, {_cleaned('inner_text')} AS clean FROM stripped",
    "docs": """
        SELECT min(notice_id) AS doc, count(*) AS n_copies, clean
        FROM cleaned WHERE clean <> '' GROUP BY clean""",
    "doc_shingles": _bigrams("docs", "doc, n_copies"),
    "notice_shingles": _bigrams("(SELECT notice_id AS doc, clean FROM cleaned)", "doc"),
    "frequency": """
        SELECT shingle, sum(n_copies)::BIGINT AS df FROM doc_shingles GROUP BY shingle""",
    "stop": """
        SELECT shingle, df FROM frequency WHERE df / (SELECT count(*) FROM notices) > 0.10""",
    "kept": "SELECT * FROM doc_shingles ANTI JOIN stop USING (shingle)",
    "kept_notice": "SELECT * FROM notice_shingles ANTI JOIN stop USING (shingle)",
    "coef": """
        SELECT i, ('0x' || md5('20240917/a/' || i)[1:8])::BIGINT % 2147483646 + 1 AS a,
               ('0x' || md5('20240917/b/' || i)[1:8])::BIGINT % 2147483646 + 1 AS b
        FROM range(256) t(i)""",
    "sig": _signature("kept", 128),
    "bands": _bands("sig", 4),
    "sig_notice": _signature("kept_notice", 128),
    "notice_bands": _bands("sig_notice", 4),
    "sig_unpruned": _signature("notice_shingles", 128),
    "unpruned_bands": _bands("sig_unpruned", 4),
    "sig_long": _signature("notice_shingles", 256),
    "simple": f"SELECT notice_id, {_cleaned_simple('body')} AS clean FROM notices",
    "simple_grams": _grams("simple", "notice_id", "clean", 3, False),
    "sig_older": _signature("(SELECT notice_id AS doc, gram AS shingle FROM simple_grams)", 126),
    "flat": f"""
        SELECT notice_id, trim({_removed('lower(body)', _BLANKS)}) AS flat_text FROM notices""",
    "raw_grams": _grams("flat", "notice_id", "flat_text", 5, True),
    "words": f"""
        SELECT notice_id, unnest(string_split({_squeezed(_folded('body'))}, ' ')) AS w FROM notices""",
    "blocks": """
        SELECT notice_id, 'w:' || max(lpad(length(w)::VARCHAR, 6, '0') || w) AS block
        FROM words GROUP BY notice_id
        UNION ALL SELECT notice_id, 's:' || portal_id || ':' || lang FROM notices""",
    "pairs": """
        SELECT DISTINCT notice_id_a, notice_id AS notice_id_b
        FROM blocks JOIN (SELECT block, min(notice_id) AS notice_id_a FROM blocks GROUP BY block)
             USING (block)
        WHERE notice_id_a <> notice_id""",
    "raw_scores": _jaccard("raw_grams", "notice_id", "gram"),
    "labelled": """
        SELECT notice_id_a, notice_id_b, jaccard AS raw_jaccard,
               CASE WHEN jaccard >= 0.8 THEN 'same' ELSE 'different' END AS label
        FROM raw_scores""",
    "clean_scores": _jaccard("notice_shingles", "doc", "shingle"),
    "scored": """
        SELECT label, raw_jaccard, c.jaccard, notice_id_a, notice_id_b
        FROM labelled JOIN clean_scores c USING (notice_id_a, notice_id_b)""",
    "features": """
        SELECT label, 'raw_char_5' AS feature, raw_jaccard AS score FROM scored
        UNION ALL SELECT label, 'clean_word_2', jaccard FROM scored""",
    "shared_buckets": _shared("notice_bands"),
    "candidates": """
        SELECT DISTINCT x.doc AS doc_a, y.doc AS doc_b
        FROM bands x JOIN bands y ON x.band_id = y.band_id AND x.bucket_hash = y.bucket_hash
                                 AND x.doc < y.doc""",
    "ranked": """
        SELECT doc, shingle, count(*) OVER (PARTITION BY doc) AS n,
               row_number() OVER (PARTITION BY doc ORDER BY df, shingle) AS rank
        FROM doc_shingles JOIN frequency USING (shingle)""",
    "rare": "SELECT * FROM ranked WHERE rank <= n - ceil(n * 0.55 - 1e-6) + 1",
    "met": """
        SELECT DISTINCT doc_a, doc_b
        FROM candidates JOIN rare x ON x.doc = doc_a JOIN rare y ON y.doc = doc_b AND x.shingle = y.shingle
        WHERE least(x.n, y.n) >= greatest(x.n, y.n) * 0.55 - 1e-6""",
    "verified": """
        SELECT doc_a, doc_b, jaccard FROM (
            SELECT doc_a, doc_b, shared / (a.n + b.n - shared) AS jaccard
            FROM (SELECT doc_a, doc_b, count(*) AS shared
                  FROM candidates JOIN doc_shingles x ON x.doc = doc_a
                  JOIN doc_shingles y ON y.doc = doc_b AND x.shingle = y.shingle GROUP BY ALL)
            JOIN (SELECT doc, count(*) AS n FROM doc_shingles GROUP BY doc) a ON a.doc = doc_a
            JOIN (SELECT doc, count(*) AS n FROM doc_shingles GROUP BY doc) b ON b.doc = doc_b)
        WHERE jaccard >= 0.55""",
    "edges": """
        SELECT doc_a AS x, doc_b AS y FROM verified
        UNION ALL SELECT doc_b, doc_a FROM verified""",
    "reach": """
        SELECT doc, doc AS other FROM docs
        UNION SELECT reach.doc, y FROM reach JOIN edges ON other = x""",
    "roots": "SELECT doc, min(other) AS root FROM reach GROUP BY doc",
    "copy_members": """
        SELECT notice_id, coalesce(doc, notice_id) AS canonical_notice_id,
               'OPP_' || coalesce(doc, notice_id) AS opportunity_id
        FROM cleaned LEFT JOIN docs USING (clean)""",
    "members": """
        SELECT notice_id, coalesce(root, notice_id) AS canonical_notice_id,
               'OPP_' || coalesce(root, notice_id) AS opportunity_id
        FROM cleaned LEFT JOIN docs USING (clean) LEFT JOIN roots USING (doc)""",
    "close_reach": """
        SELECT doc, doc AS other FROM docs
        UNION SELECT close_reach.doc, y FROM close_reach JOIN (
            SELECT doc_a AS x, doc_b AS y FROM verified WHERE jaccard >= 0.75
            UNION ALL SELECT doc_b, doc_a FROM verified WHERE jaccard >= 0.75) ON other = x""",
    "close_members": """
        SELECT notice_id, 'OPP_' || coalesce(root, notice_id) AS opportunity_id
        FROM cleaned LEFT JOIN docs USING (clean)
        LEFT JOIN (SELECT doc, min(other) AS root FROM close_reach GROUP BY doc) USING (doc)""",
    "steps": """
        SELECT c.opportunity_id AS old_id, min(m.opportunity_id) AS new_id
        FROM copy_members c JOIN close_members m USING (notice_id)
        GROUP BY c.opportunity_id HAVING c.opportunity_id <> min(m.opportunity_id)
        UNION ALL
        SELECT c.opportunity_id, min(m.opportunity_id) FROM close_members c JOIN members m USING (notice_id)
        GROUP BY c.opportunity_id HAVING c.opportunity_id <> min(m.opportunity_id)""",
    "walk": """
        SELECT old_id, new_id, 1 AS n FROM steps
        UNION ALL SELECT walk.old_id, steps.new_id, n + 1 FROM walk JOIN steps ON walk.new_id = steps.old_id""",
    "cluster_size": "SELECT opportunity_id, count(*) AS size FROM members GROUP BY ALL",
    "aliases": """
        SELECT c.opportunity_id AS old_opportunity_id, min(m.opportunity_id) AS active_opportunity_id
        FROM copy_members c JOIN members m USING (notice_id)
        GROUP BY c.opportunity_id HAVING c.opportunity_id <> min(m.opportunity_id)""",
    "first_run": """
        SELECT notice_id, 'OPP_' || CASE WHEN doc IS NULL THEN notice_id
                                         ELSE min(notice_id) OVER (PARTITION BY clean) END AS opportunity_id
        FROM cleaned LEFT JOIN docs USING (clean) WHERE notice_id NOT IN (SELECT doc_id FROM labels)""",
    "run_owners": """
        SELECT notice_id, f.opportunity_id AS o1, m.opportunity_id AS o2, c.opportunity_id AS o3
        FROM copy_members c JOIN members m USING (notice_id) LEFT JOIN first_run f USING (notice_id)""",
    "first_merges": """
        SELECT o1 AS old_id, min(o2) AS new_id FROM run_owners
        WHERE o1 IS NOT NULL AND o1 NOT IN (SELECT o2 FROM run_owners) GROUP BY o1""",
}


def _skew(bands: str, cap: int) -> str:
    implied = "n_members::DOUBLE * (n_members - 1) / 2"
    return f"""
        SELECT count(*) AS n_buckets, max(n_members) AS largest_bucket,
               sum({implied}) AS implied_pairs,
               count(*) FILTER (n_members > {cap}) AS hot_buckets,
               max(n_members) FILTER (n_members <= {cap}) AS largest_kept,
               coalesce(sum({implied}) FILTER (n_members <= {cap}), 0) AS implied_pairs_kept,
               {cap}::INTEGER AS cap
        FROM ({_sizes(bands)})"""


def _recall(cap: int) -> str:
    kept = f"""(SELECT b.* FROM notice_bands b
                JOIN ({_sizes('notice_bands')}) s USING (band_id, bucket_hash)
                WHERE n_members <= {cap})"""
    return f"""
        SELECT count(*) AS same_pairs, count(*) FILTER (u.n > 0) AS retrieved_before,
               count(*) FILTER (k.n > 0) AS retrieved_after,
               round(count(*) FILTER (u.n > 0) / count(*), 6) AS recall_before,
               round(count(*) FILTER (k.n > 0) / count(*), 6) AS recall_after, {cap}::INTEGER AS cap
        FROM shared_buckets u JOIN ({_shared(kept)}) k USING (doc_a, doc_b)
        WHERE u.label = 'same'"""


def _mitigation(name: str, bands: str) -> str:
    return f"""
        SELECT '{name}' AS variant, count(*) AS n_buckets, max(n_members) AS largest_bucket,
               sum(n_members::DOUBLE * (n_members - 1) / 2) AS implied_pairs,
               (SELECT round(count(*) FILTER (n > 0) / count(*), 6) FROM ({_shared(bands)})
                WHERE label = 'same') AS recall
        FROM ({_sizes(bands)})"""


_SWEEP = """
    SELECT tau, count(*) FILTER (label = 'same' AND jaccard >= tau) AS tp,
           count(*) FILTER (label <> 'same' AND jaccard >= tau) AS fp,
           count(*) FILTER (label = 'same' AND jaccard < tau) AS fn
    FROM scored, (VALUES (0.40::DOUBLE), (0.50::DOUBLE), (0.55::DOUBLE)) t(tau) GROUP BY tau"""

_LARGEST = f"{_sizes('notice_bands')} ORDER BY n_members DESC, band_id, bucket_hash"

_LOOKUP = """
        SELECT x.doc AS incoming_doc, y.doc AS stored_doc, count(*)::INTEGER AS shared_bands
        FROM bands x JOIN bands y USING (band_id, bucket_hash)
        JOIN met ON doc_a = least(x.doc, y.doc) AND doc_b = greatest(x.doc, y.doc)
        WHERE x.doc IN (SELECT doc FROM docs WHERE clean IN (
                  SELECT clean FROM cleaned WHERE notice_id IN (SELECT doc_id FROM labels)))
          AND y.doc NOT IN (SELECT doc FROM docs WHERE clean IN (
                  SELECT clean FROM cleaned WHERE notice_id IN (SELECT doc_id FROM labels)))
        GROUP BY ALL"""

SELECTS = {
    "clean_text": "SELECT * FROM cleaned",
    "clean_text_simple": "SELECT * FROM simple",
    "word_bigrams": """
        SELECT notice_id, count(shingle) AS n_grams,
               md5(coalesce(string_agg(shingle, '|' ORDER BY shingle), '')) AS grams_md5
        FROM cleaned LEFT JOIN notice_shingles ON doc = notice_id GROUP BY notice_id""",
    "char_kgrams": """
        SELECT notice_id, n_raw5, raw5_md5, n_clean3, clean3_md5
        FROM (SELECT notice_id, count(gram) AS n_raw5,
                     md5(coalesce(string_agg(gram, '|' ORDER BY gram), '')) AS raw5_md5
              FROM notices LEFT JOIN raw_grams USING (notice_id) GROUP BY notice_id)
        JOIN (SELECT notice_id, count(gram) AS n_clean3,
                     md5(coalesce(string_agg(gram, '|' ORDER BY gram), '')) AS clean3_md5
              FROM notices LEFT JOIN simple_grams USING (notice_id) GROUP BY notice_id)
        USING (notice_id)""",
    "pair_scores": f"""
        SELECT notice_id_a, notice_id_b, label, round(s.jaccard, 9) AS jaccard
        FROM labelled JOIN ({_jaccard('simple_grams', 'notice_id', 'gram')}) s
             USING (notice_id_a, notice_id_b)""",
    "score_separation": """
        SELECT feature, label, count(*) AS n_pairs, round(avg(score), 6) AS mean_score,
               round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
               any_value(inverted) AS inverted
        FROM features JOIN (
            SELECT feature, avg(score) FILTER (label <> 'same') > avg(score) FILTER (label = 'same')
                AS inverted
            FROM features GROUP BY feature) USING (feature)
        GROUP BY feature, label""",
    "doc_frequency": "SELECT * FROM frequency",
    "stop_shingles": "SELECT * FROM stop",
    "df_pruned_shingles": """
        SELECT doc, n_copies, count(*) AS n_kept, min(shingle) AS first_shingle FROM kept GROUP BY ALL""",
    "minhash_signature": "SELECT doc, position::INTEGER AS position, min_hash FROM sig",
    "minhash_error": """
        SELECT k::INTEGER AS k, count(*) AS n_pairs, round(avg(abs(jaccard - estimate)), 6) AS mean_abs_error,
               round(sqrt(avg((jaccard - estimate) * (jaccard - estimate))), 6) AS root_mean_sq_error,
               round(max(abs(jaccard - estimate)), 6) AS max_error,
               round(1 / (2 * sqrt(k)), 6) AS standard_error_bound, (k * 4)::INTEGER AS signature_bytes
        FROM (SELECT k, jaccard,
                     count(*) FILTER (x.min_hash = y.min_hash AND x.position < k) / k AS estimate
              FROM scored JOIN sig_long x ON x.doc = notice_id_a
              JOIN sig_long y ON y.doc = notice_id_b AND x.position = y.position,
              (VALUES (32), (64), (128), (256)) v(k)
              GROUP BY k, jaccard, notice_id_a, notice_id_b)
        GROUP BY k""",
    "lsh_bands": "SELECT * FROM bands",
    "lsh_bands_older": _bands("sig_older", 9),
    "lsh_s_curve": """
        SELECT similarity, n_pairs, n_retrieved,
               round(1 - pow(1 - pow(similarity, 8), 16), 4) AS p_16x8,
               round(1 - pow(1 - pow(similarity, 4), 32), 4) AS p_32x4,
               round(1 - pow(1 - pow(similarity, 2), 64), 4) AS p_64x2
        FROM (SELECT floor(jaccard * 10 + 1e-9) / 10.0::DOUBLE AS similarity, count(*) AS n_pairs,
                     count(*) FILTER (n > 0) AS n_retrieved
              FROM scored JOIN shared_buckets ON doc_a = notice_id_a AND doc_b = notice_id_b
              GROUP BY 1)""",
    "lsh_candidates": "SELECT * FROM candidates",
    "lsh_lookup_batch": _LOOKUP,
    "lsh_lookup_indexed": _LOOKUP,
    "shared_bands": "SELECT doc_a, doc_b, label, n::INTEGER AS shared_bands FROM shared_buckets",
    "verified_pairs": """
        SELECT doc_a, doc_b, round(jaccard, 9) AS jaccard, a.n_copies AS copies_a, b.n_copies AS copies_b
        FROM verified JOIN docs a ON a.doc = doc_a JOIN docs b ON b.doc = doc_b""",
    "threshold_sweep": f"""
        SELECT *, tau = (SELECT arg_min(tau, (fp * 50000 + fn * 100, tau)) FROM ({_SWEEP})) AS cheapest
        FROM (SELECT *, round(tp / nullif(tp + fp, 0), 6) AS precision,
                     round(tp / nullif(tp + fn, 0), 6) AS recall, fp * 50000 + fn * 100 AS cost,
                     coalesce(tp / nullif(tp + fp, 0) >= 50000 / 50100, false) AS worth_merging
              FROM ({_SWEEP}))""",
    "bucket_skew_topk": f"{_LARGEST} LIMIT 5",
    "bucket_skew_profile": f"""
        SELECT 'n_buckets' AS measure, '' AS item, count(*)::DOUBLE AS amount
        FROM ({_sizes('notice_bands')})
        UNION ALL SELECT 'largest_bucket', '', max(n_members) FROM ({_sizes('notice_bands')})
        UNION ALL SELECT 'implied_pairs', '', sum(n_members::DOUBLE * (n_members - 1) / 2)
                  FROM ({_sizes('notice_bands')})
        UNION ALL SELECT 'size_by_rank',
                         (row_number() OVER (ORDER BY n_members DESC, band_id, bucket_hash))::VARCHAR,
                         n_members FROM ({_LARGEST} LIMIT 10)
        UNION ALL SELECT 'source_in_largest', portal_id, count(*)
                  FROM notice_bands JOIN ({_LARGEST} LIMIT 1) USING (band_id, bucket_hash)
                  JOIN notices ON doc = notice_id GROUP BY portal_id""",
    "hot_bucket_cap": f"{_skew('notice_bands', 2)} UNION ALL {_skew('notice_bands', 100)}",
    "retrieval_recall": f"{_recall(2)} UNION ALL {_recall(100)}",
    "mitigation_report": f"""
        {_mitigation('unpruned', 'unpruned_bands')}
        UNION ALL {_mitigation('pruned', 'notice_bands')}""",
    "clusters": "SELECT * FROM members",
    "clusters_incremental": "SELECT * FROM members",
    "cluster_histogram": """
        SELECT size, count(*) AS n_clusters, size * count(*) AS n_notices,
               size * (size - 1) / 2 * count(*) AS duplicate_pairs
        FROM cluster_size GROUP BY size""",
    "alias_update": "SELECT * FROM aliases",
    "alias_chain": """
        SELECT old_id AS old_opportunity_id, arg_max(new_id, n) AS active_opportunity_id, max(n)::BIGINT AS n_steps
        FROM walk GROUP BY old_id""",
    "cluster_register": """
        SELECT 'opportunity_id' AS entry, id, substr(id, 5) AS target, 'night ' || min(n) AS since
        FROM (SELECT o1 AS id, 1 AS n FROM run_owners UNION ALL SELECT o2, 2 FROM run_owners
              UNION ALL SELECT o3, 3 FROM run_owners)
        WHERE id IS NOT NULL GROUP BY id
        UNION ALL
        SELECT 'notice_id', notice_id::VARCHAR, o3,
               CASE WHEN o2 <> o3 THEN 'night 3' WHEN o1 = o2 THEN 'night 1' ELSE 'night 2' END
        FROM run_owners
        UNION ALL
        SELECT 'old_opportunity_id', old_id, CASE WHEN back THEN old_id ELSE new_id END,
               CASE WHEN back THEN 'night 3' ELSE 'night 2' END
        FROM (SELECT *, old_id IN (SELECT o3 FROM run_owners) AS back FROM first_merges)""",
    "alias_resolve": """
        SELECT notice_id, opportunity_id AS filed_under,
               coalesce(active_opportunity_id, opportunity_id) AS opportunity_id
        FROM copy_members LEFT JOIN aliases ON old_opportunity_id = opportunity_id""",
    "cluster_quality": """
        SELECT *, round(tp / nullif(tp + fp, 0), 6) AS precision,
               round(tp / nullif(tp + fn, 0), 6) AS recall
        FROM (SELECT count(*) FILTER (label = 'same' AND a.opportunity_id = b.opportunity_id) AS tp,
                     count(*) FILTER (label <> 'same' AND a.opportunity_id = b.opportunity_id) AS fp,
                     count(*) FILTER (label = 'same' AND a.opportunity_id <> b.opportunity_id) AS fn
              FROM labelled JOIN members a ON a.notice_id = notice_id_a
              JOIN members b ON b.notice_id = notice_id_b)""",
    "label_base_rate": """
        SELECT *, round(duplicate_pairs / possible_pairs, 9) AS corpus_rate,
               round(n_same / n_labelled, 9) AS label_rate
        FROM (SELECT sum(size)::BIGINT AS n_notices,
                     sum(size::DOUBLE * (size - 1) / 2) AS duplicate_pairs,
                     sum(size)::DOUBLE * (sum(size) - 1) / 2 AS possible_pairs,
                     (SELECT count(*) FROM labelled) AS n_labelled,
                     (SELECT count(*) FROM labelled WHERE label = 'same') AS n_same
              FROM cluster_size)""",
    "source_volume": """
        SELECT portal_id, count(*) AS n_notices,
               (SELECT count(DISTINCT portal_id) FROM notices) AS n_sources
        FROM notices GROUP BY portal_id ORDER BY n_notices DESC, portal_id LIMIT 15""",
}
