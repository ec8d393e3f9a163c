"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

#: The one-record form of an accession.
_ACC = "replace(regexp_replace(accession, '^accession_', ''), '|', '_')"

_VALID = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"


#: Of oversized pairs: ``runs`` between natural boundaries, and ``whole`` with the residues t, their number n, the boundaries nat and the overlap o.
_RUNS = f"""q AS (
              SELECT DISTINCT {_ACC} AS accession, CAST(q.embedding_type_id AS BIGINT) AS embedding_type_id, piece_limit, greatest(0, least(coalesce(piece_overlap, 0), piece_limit - 1)) AS o,
                upper(regexp_replace(regexp_replace(sequence, '[^A-Za-z*-]', '', 'g'), '^[*-]+|[*-]+$', '', 'g')) AS s
              FROM query_embedding q JOIN model_limits m ON m.embedding_type_id = q.embedding_type_id
              WHERE sequence IS NOT NULL AND accession IS NOT NULL),
            big AS (SELECT * FROM q WHERE length(regexp_replace(s, '[^A-Z]', '', 'g')) > piece_limit),
            ended AS (SELECT *, regexp_replace(regexp_replace(s, '[*-]+', '|', 'g'), '(X{{5,}})', '\\1|', 'g') AS t FROM big),
            runs AS (SELECT *, string_split(t, '|') AS parts, length(replace(t, '|', '')) AS n FROM ended),
            whole AS (SELECT accession, embedding_type_id, piece_limit, o, replace(t, '|', '') AS t, n,
                list_sort(list_distinct(list_filter(list_transform(range(1, len(parts) + 1), lambda i: CAST(length(array_to_string(parts[1:i], '')) AS BIGINT)), lambda x: x > 0 AND x < n))) AS nat FROM runs)"""


def _letters(col: str) -> str:
    return f"upper(regexp_replace({col}, '[^A-Za-z]', '', 'g'))"


#: From ``texts`` (t, l, r: distinct texts and their sides): ``alike`` (a, b) of
#: texts that share at least 80 % of the residues of both in runs of eight.
_SIMILAR = """
            grams AS (SELECT t, l, r, i AS pos, substring(t, i, 8) AS g FROM texts, LATERAL (SELECT unnest(range(1, length(t) - 6)) AS i)),
            met AS (SELECT DISTINCT x.t AS a, y.t AS b FROM grams x JOIN grams y ON x.g = y.g AND x.t <> y.t WHERE x.l AND y.r),
            ways AS (SELECT a AS t, b AS o FROM met UNION SELECT b, a FROM met),
            hits AS (SELECT DISTINCT w.t, w.o, x.pos FROM ways w JOIN grams x ON x.t = w.t JOIN grams y ON y.t = w.o AND y.g = x.g),
            cover AS (SELECT t, o, count(DISTINCT pos + k) / length(t) AS share FROM hits, LATERAL (SELECT unnest(range(8)) AS k) GROUP BY t, o),
            alike AS (SELECT m.a, m.b FROM met m JOIN cover c ON c.t = m.a AND c.o = m.b JOIN cover e ON e.t = m.b AND e.o = m.a WHERE c.share >= 0.8 AND e.share >= 0.8
              UNION SELECT t, t FROM texts WHERE l AND r)"""
#: Cosines (q, o, s) of all usable vectors of one model and layer.
_PAIRS = f"""v AS (SELECT DISTINCT vec_id, embedding_type_id, layer_index, embedding::DOUBLE[] AS e FROM query_embedding WHERE vec_id IS NOT NULL AND {_VALID}),
            length AS (SELECT embedding_type_id, len(e) AS n FROM v GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY embedding_type_id ORDER BY count(*) DESC, n DESC) = 1),
            u AS (SELECT v.* FROM v JOIN length l ON l.embedding_type_id = v.embedding_type_id AND len(e) = n),
            pairs AS (SELECT a.vec_id AS q, b.vec_id AS o, a.embedding_type_id, a.layer_index, round(list_cosine_similarity(a.e, b.e), 6) AS s
              FROM u a JOIN u b ON a.embedding_type_id = b.embedding_type_id AND a.layer_index IS NOT DISTINCT FROM b.layer_index AND a.vec_id <> b.vec_id)"""
_REFS = f"refs AS (SELECT DISTINCT ref_idx, {_letters('sequence_reference')} AS t FROM raw_results WHERE ref_idx IS NOT NULL AND sequence_reference IS NOT NULL)"

_HELD = "(s LIKE 'te%' OR s LIKE 'ts%' OR s LIKE 'v%' OR s LIKE 'dev%')"
#: ``leaked`` (accession, ref_idx), from ``queries`` (accession, t) and ``refs`` (ref_idx, t).
_OVERLAPS = f"""{_REFS},
            wanted AS (SELECT DISTINCT {_ACC} AS accession FROM (SELECT accession, lower(regexp_replace(split, '[^A-Za-z]', '', 'g')) AS s FROM query_split) WHERE {_HELD}),
            queries AS (SELECT DISTINCT accession, {_letters('sequence_query')} AS t FROM (SELECT {_ACC} AS accession, sequence_query FROM raw_results WHERE sequence_query IS NOT NULL) WHERE accession IN (SELECT accession FROM wanted)),
            texts AS (SELECT t, bool_or(l) AS l, bool_or(NOT l) AS r FROM (SELECT t, TRUE AS l FROM queries UNION SELECT t, FALSE FROM refs) WHERE length(t) >= 8 GROUP BY t), {_SIMILAR},
            leaked AS (SELECT DISTINCT accession, ref_idx FROM alike s JOIN queries q ON q.t = s.a JOIN refs r ON r.t = s.b)"""

#: ``met``: places i of documents and j of passages from which ten words are equal.
_SPANS = r"""d AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
            p AS (SELECT item_id, regexp_extract_all(lower(strip_accents(passage)), '[\p{L}\p{N}]+') AS w FROM eval_passages WHERE passage IS NOT NULL),
            dg AS (SELECT doc_id, i, array_to_string(w[i:i + 9], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 8)) AS i)),
            pg AS (SELECT item_id, i AS j, array_to_string(w[i:i + 9], ' ') AS g FROM p, LATERAL (SELECT unnest(range(1, len(w) - 8)) AS i)),
            met AS (SELECT doc_id, item_id, i, j FROM dg JOIN pg USING (g))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": f"""
            WITH r AS (
              SELECT DISTINCT {_ACC} AS accession, result_id, reliability_index AS ri, CASE WHEN isnan(distance) THEN NULL ELSE distance END AS dist
              FROM raw_results WHERE accession IS NOT NULL AND reliability_index IS NOT NULL AND NOT isnan(reliability_index)),
            best AS (SELECT *, row_number() OVER (PARTITION BY accession, result_id ORDER BY ri DESC, dist ASC NULLS LAST) AS rn FROM r)
            SELECT accession, result_id FROM best WHERE rn = 1
            QUALIFY row_number() OVER (PARTITION BY accession ORDER BY ri DESC, dist ASC NULLS LAST, result_id) <= 5""",
        "p1_found": f"""
            WITH {_RUNS}
            SELECT accession, embedding_type_id, CAST(0 AS BIGINT) AS boundary_at FROM runs
            UNION SELECT accession, embedding_type_id, unnest(nat) FROM whole""",
        "p1_pieces": f"""
            WITH RECURSIVE {_RUNS},
            cut AS (SELECT *, 0 AS no, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS z FROM whole
              UNION ALL SELECT * EXCLUDE (goal) REPLACE (no + 1 AS no, CASE WHEN z = 0 THEN 0 ELSE z - o END AS a, CASE WHEN goal >= n THEN n ELSE coalesce(list_max(list_filter(nat, lambda x: x > z AND x <= goal)), goal) END AS z)
              FROM (SELECT *, CASE WHEN z = 0 THEN piece_limit ELSE z - o + piece_limit END AS goal FROM cut WHERE z < n))
            SELECT accession, embedding_type_id, CAST(no AS BIGINT) AS piece_no, CAST(a AS BIGINT) AS start_at, CAST(z AS BIGINT) AS end_at, z = n OR list_contains(nat, z) AS natural_end, substring(t, a + 1, z - a) AS piece FROM cut WHERE no > 0""",
        "p3_found": f"""
            WITH {_REFS}, texts AS (SELECT DISTINCT t, TRUE AS l, TRUE AS r FROM refs WHERE length(t) >= 8), {_SIMILAR}
            SELECT DISTINCT least(x.ref_idx, y.ref_idx) AS ref_idx_a, greatest(x.ref_idx, y.ref_idx) AS ref_idx_b
            FROM alike s JOIN refs x ON x.t = s.a JOIN refs y ON y.t = s.b WHERE x.ref_idx <> y.ref_idx""",
        "p3_groups": f"""
            WITH RECURSIVE {_REFS}, texts AS (SELECT DISTINCT t, TRUE AS l, TRUE AS r FROM refs WHERE length(t) >= 8), {_SIMILAR},
            links AS (SELECT a, b FROM alike UNION SELECT b, a FROM alike),
            reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
            named AS (SELECT a AS t, min(md5(b)) AS group_key, count(*) AS group_texts FROM reach GROUP BY 1)
            SELECT DISTINCT ref_idx, md5(refs.t) AS text_key, group_key, group_texts FROM refs JOIN named USING (t)""",
        "p6_found": f"""
            WITH {_OVERLAPS} SELECT DISTINCT accession, ref_idx FROM leaked""",
        "p6_report": f"""
            WITH {_OVERLAPS}, exact AS (SELECT DISTINCT accession, ref_idx FROM queries q JOIN refs r ON r.t = q.t WHERE q.t <> ''),
            leaks AS (SELECT accession, bool_or(exact) AS exact, count(DISTINCT ref_idx) AS n FROM (SELECT *, TRUE AS exact FROM exact UNION SELECT *, FALSE FROM leaked) GROUP BY 1),
            held AS (SELECT DISTINCT {_ACC} AS accession, CASE WHEN s LIKE 'te%' OR s LIKE 'ts%' THEN 'test' ELSE 'validation' END AS split, nullif(lower(trim(source)), '') AS source
              FROM (SELECT *, lower(regexp_replace(split, '[^A-Za-z]', '', 'g')) AS s FROM query_split) WHERE accession IS NOT NULL AND {_HELD})
            SELECT split, source, count(DISTINCT accession) AS accessions, count(DISTINCT CASE WHEN exact THEN accession END) AS exact_accessions, count(DISTINCT CASE WHEN n > 0 THEN accession END) AS overlapping_accessions,
              CAST(coalesce(sum(n), 0) AS BIGINT) AS overlaps FROM held LEFT JOIN leaks USING (accession) GROUP BY 1, 2""",
        "p4_limits": f"""
            WITH q AS (SELECT DISTINCT {_ACC} AS accession, CAST(q.embedding_type_id AS BIGINT) AS embedding_type_id, batch_capacity AS cap, {_letters('sequence')} AS t
              FROM query_embedding q JOIN model_limits m ON m.embedding_type_id = q.embedding_type_id WHERE sequence IS NOT NULL AND accession IS NOT NULL AND batch_capacity > 0),
            s AS (SELECT embedding_type_id, count(*) AS texts, CAST(sum(length(t)) AS BIGINT) AS tokens, CAST(sum(length(replace(t, 'X', ''))) AS BIGINT) AS loss_tokens, CAST(sum(ceil(length(t) / cap)) AS BIGINT) AS items FROM q WHERE t <> '' GROUP BY 1)
            SELECT run, embedding_type_id, items, items AS distinct_items, tokens, loss_tokens, TRUE AS within_capacity, TRUE AS within_segments, TRUE AS within_loss, TRUE AS "full" FROM s, (VALUES ('capacity'), ('all')) r(run)""",
        "p5_found": f"""
            WITH {_PAIRS}, near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY q ORDER BY s DESC, o) <= 5)
            SELECT DISTINCT least(q, o) AS vec_id_a, greatest(q, o) AS vec_id_b FROM near WHERE s >= 0.9""",
        "p5_exact": f"""
            WITH {_PAIRS} SELECT q AS vec_id, o AS neighbour, s AS similarity FROM pairs WHERE q % 20 = 0 QUALIFY row_number() OVER (PARTITION BY q ORDER BY s DESC, o) <= 5""",
        "p5_recall_reached": f"""
            WITH {_PAIRS}, near AS (SELECT * FROM pairs WHERE q % 20 = 0 QUALIFY row_number() OVER (PARTITION BY q ORDER BY s DESC, o) <= 5)
            SELECT CAST(embedding_type_id AS BIGINT) AS embedding_type_id, CAST(layer_index AS BIGINT) AS layer_index, count(DISTINCT q) AS queries, count(*) AS neighbours, TRUE AS recall_at_least_90_percent FROM near GROUP BY 1, 2""",
        "p7_found": f"WITH {_SPANS} SELECT DISTINCT doc_id, item_id FROM met",
        "p8_limits": """
            WITH docs AS (SELECT lower(trim(source)) AS source, count(*) AS documents FROM documents WHERE length(text) > 0 AND doc_id IS NOT NULL GROUP BY 1),
            t AS (SELECT lower(trim(m.source)) AS source, target_share, max_repeats, coalesce(documents, 0) AS documents FROM mix_targets m LEFT JOIN docs d ON d.source = lower(trim(m.source)))
            SELECT source, target_share, max_repeats, documents, round(CASE WHEN documents > 0 THEN target_share / sum(CASE WHEN documents > 0 THEN target_share END) OVER () ELSE 0 END, 6) AS reachable_share,
              TRUE AS budget_met, TRUE AS cap_kept, TRUE AS share_reached FROM t""",
        "p7_report": f"""
            WITH {_SPANS}, runs AS (SELECT doc_id, item_id, i, i - row_number() OVER (PARTITION BY doc_id, item_id, i - j ORDER BY i) AS run, i - j AS shift FROM met),
            spans AS (SELECT doc_id, item_id, count(*) + 9 AS span FROM runs GROUP BY doc_id, item_id, shift, run),
            hit AS (SELECT item_id, count(DISTINCT doc_id) AS documents, max(span) AS longest_span FROM spans GROUP BY 1)
            SELECT item_id, suite, split, coalesce(documents, 0) AS documents, coalesce(longest_span, 0) AS longest_span FROM eval_passages LEFT JOIN hit USING (item_id)""",
    }
