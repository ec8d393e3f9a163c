"""SQL counterparts of the registered queries."""

from __future__ import annotations

#: Taxa that the queries exclude or keep exclusively, model thresholds, cutoffs
#: and the (model, layer) columns of the wide table.
EXCLUDE, INCLUDE = ["9100000", "9100074"], ["9100037", "9100074", "9100111"]
THRESHOLDS: dict[str, float | None] = {"Lumen-S": 0.5, "Corva-M": None, "Tessel-L": 0.6}
CUTOFFS = [0.3, 0.5, 0.9]
#: Columns (output, metric, aggregate) and weights of the two summaries, written out.
FULL_COLUMNS = [("max_ri", "reliability_index", "max"), ("min_id_g", "identity", "min"), ("max_id_g", "identity", "max"), ("mean_id_g", "identity", "mean"), ("min_id_l", "identity_sw", "min"), ("max_id_l", "identity_sw", "max"), ("mean_id_l", "identity_sw", "mean")]
FULL_WEIGHTS = {"max_ri": 0.4, "max_id_g": 0.2, "max_id_l": 0.2, "count": 0.2}
NARROW_COLUMNS, NARROW_WEIGHTS = [("max_ri", "reliability_index", "max")], {"max_ri": 0.8, "count": 0.2}
SPACES: list[tuple[str, int | None]] = [("Corva-M", 0), ("Corva-M", 12), ("Lumen-S", 0), ("Orbit-XS", 0), ("Quill2-Base", 0), ("Quill2-Base", 8), ("Tessel-L", None), ("Tessel-L", 0)]

_ACC = "replace(regexp_replace(accession, '^accession_', ''), '|', '_')"
_LETTERS = "upper(regexp_replace({0}, '[^A-Za-z]', '', 'g'))"
_VALID = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"


def _list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _allowed(exclude: list[str], include: list[str], keeps_null: bool) -> str:
    parts = ["TRUE"]
    if exclude:
        parts.append(f"(trim(taxonomy_id) NOT IN {_list(exclude)}" + (" OR taxonomy_id IS NULL)" if keeps_null else ")"))
    if include:
        parts.append(f"trim(taxonomy_id) IN {_list(include)}")
    return " AND ".join(parts)


def _vectors(exclude: list[str] = [], include: list[str] = []) -> str:  # noqa: B006
    return f"""
        qv AS (SELECT accession, embedding_type_id, layer_index, embedding::DOUBLE[] AS qe, sequence AS qs FROM (SELECT * REPLACE ({_ACC} AS accession) FROM query_embedding WHERE accession IS NOT NULL AND {_VALID})
          QUALIFY row_number() OVER (PARTITION BY accession, embedding_type_id, layer_index ORDER BY coalesce(created_at, TIMESTAMP '1970-01-01'), vec_id) = 1),
        rv AS (SELECT sequence_id, embedding_type_id, layer_index, min(embedding)::DOUBLE[] AS re
          FROM reference_embedding WHERE sequence_id IS NOT NULL AND {_VALID}
            AND sequence_id IN (SELECT id FROM ref_sequences)
            AND sequence_id IN (SELECT sequence_id FROM protein WHERE sequence_id IS NOT NULL AND {_allowed(exclude, include, False)})
          GROUP BY 1, 2, 3)"""


def _knn(k: int, metric: str = "cosine", threshold: float | None = None, exclude: list[str] = [], include: list[str] = [], mask: str = "", more: str = "") -> str:  # noqa: B006
    d = "1 - list_dot_product(qe, re) / (sqrt(list_dot_product(qe, qe)) * sqrt(list_dot_product(re, re)))"
    if metric == "euclidean":
        d = "list_distance(qe, re)"
    return f"""{_vectors(exclude, include)}{more},
        pairs AS (SELECT q.accession, r.sequence_id AS ref_sequence_id, round({d}, 10) AS d, q.embedding_type_id, q.layer_index
          FROM qv q JOIN rv r ON q.embedding_type_id = r.embedding_type_id AND q.layer_index IS NOT DISTINCT FROM r.layer_index AND len(qe) = len(re)),
        knn AS (SELECT * FROM pairs WHERE TRUE {f"AND d <= {threshold}" if threshold is not None else ""} {mask}
          QUALIFY row_number() OVER (PARTITION BY accession, embedding_type_id, layer_index ORDER BY d, ref_sequence_id) <= {k})"""


_HITS = "SELECT accession, ref_sequence_id, round(d, 6) AS distance, embedding_type_id, layer_index FROM knn"
_BOTH = f"""both_sides AS (SELECT DISTINCT CAST(id AS VARCHAR) AS identifier, 'r' AS side, {_LETTERS.format("sequence")} AS s FROM ref_sequences WHERE id IS NOT NULL AND sequence IS NOT NULL
          UNION SELECT accession, 'q', {_LETTERS.format("qs")} FROM qv WHERE qs IS NOT NULL)"""
_MASK = """masked AS (SELECT DISTINCT q.identifier AS accession, CAST(r.identifier AS BIGINT) AS ref_sequence_id
          FROM both_sides q JOIN both_sides r ON md5(q.s) = md5(r.s) WHERE q.side = 'q' AND r.side = 'r')"""


def _annotations(exclude: list[str] = [], include: list[str] = [], evidence: list[str] = []) -> str:  # noqa: B006
    return f"""
        SELECT p.sequence_id, p.protein_id, p.organism, p.gene_name, p.taxonomy_id, a.go_id, a.evidence_code, t.category, t.go_description
        FROM (SELECT DISTINCT sequence_id, id AS protein_id, organism, gene_name, trim(taxonomy_id) AS taxonomy_id FROM protein
              WHERE sequence_id IS NOT NULL AND id IS NOT NULL AND {_allowed(exclude, include, True)}) p
        JOIN (SELECT DISTINCT protein_id, go_id, upper(evidence_code) AS evidence_code FROM protein_go_term_annotation) a ON a.protein_id = p.protein_id
        JOIN (SELECT DISTINCT go_id, upper(category) AS category, description AS go_description FROM go_terms) t ON t.go_id = a.go_id
        {f"WHERE a.evidence_code IN {_list(evidence)}" if evidence else ""}"""


_RAW = f"""raw AS (SELECT * REPLACE ({_ACC} AS accession) FROM raw_results
          QUALIFY row_number() OVER (PARTITION BY result_id ORDER BY coalesce(loaded_at, TIMESTAMP '1970-01-01') DESC) = 1)"""


def _fine(col: str, precision: int = 4) -> str:
    return f"round(CASE WHEN isnan({col}) THEN NULL ELSE {col} END, {precision})"


def _metrics(columns: list[tuple[str, str, str]], k: int = 1, raw: str = "raw") -> str:
    aggs = []
    for name, metric, agg in columns:
        x = _fine(metric)
        if agg == "mean":
            aggs.append(f"CAST(sum(CAST(round({x} * 10000) AS BIGINT)) AS BIGINT) / (count({x}) * 10000.0::DOUBLE) AS {name}")
        else:
            aggs.append(f"{agg}({x}) AS {name}")
    return f"SELECT accession, go_id, model_name, layer_index, {', '.join(aggs)}, CAST(count(*) AS DOUBLE) / {float(k)} AS count FROM {raw} WHERE accession IS NOT NULL AND go_id IS NOT NULL GROUP BY 1, 2, 3, 4"


def _weighted(weights: dict[str, float]) -> str:
    parts = [f"round(coalesce({c}, 0.0::DOUBLE) * {w!r}::DOUBLE, 4) AS w_{c}" for c, w in weights.items()]
    total = " + ".join(f"w_{c}" for c in weights)
    return f"SELECT *, round({total}, 6) AS final_score FROM (SELECT *, {', '.join(parts)} FROM m)"


_STATS = "SELECT accession, go_id, count(*) AS term_count, coalesce(string_agg(DISTINCT protein_id, '|' ORDER BY protein_id), '') AS proteins FROM raw WHERE accession IS NOT NULL AND go_id IS NOT NULL GROUP BY 1, 2"


def _pivot(raw: str = "", k: int = 1) -> str:
    values = [n for n, _, _ in NARROW_COLUMNS] + ["count"] + ["w_" + c for c in NARROW_WEIGHTS] + ["final_score"]
    cols = []
    for model, layer in SPACES:
        here = f"model_name = '{model}' AND layer_index IS NOT DISTINCT FROM {'NULL' if layer is None else layer}"
        cols += [f"""max(CASE WHEN {here} THEN {v} END) AS "{v}_{model}_L{'legacy' if layer is None else layer}" """ for v in values]
    return f"WITH {raw or _RAW}, m AS ({_metrics(NARROW_COLUMNS, k)}), w AS ({_weighted(NARROW_WEIGHTS)}), s AS ({_STATS}), p AS (SELECT accession, go_id, {', '.join(cols)} FROM w GROUP BY 1, 2) SELECT * FROM s LEFT JOIN p USING (accession, go_id)"


_TOPGO = f"""topgo AS (SELECT model_name, coalesce(CAST(layer_index AS VARCHAR), 'legacy') AS layer, upper(category) AS category, accession, go_id, {_fine("reliability_index")} AS reliability_index
          FROM raw WHERE accession IS NOT NULL AND go_id IS NOT NULL AND category IS NOT NULL AND reliability_index IS NOT NULL AND NOT isnan(reliability_index))"""

_NUM = "coalesce(CASE WHEN isnan({0}) THEN NULL ELSE {0} END, {1})"
_IDENTITY = _NUM.format("identity", "-1.0")
_DONOR_COLS = ["protein_id", "organism", "gene_name", "distance", "reliability_index", "identity", "query_len", "ref_len"]
_TEXT = "coalesce(nullif(CAST({0} AS VARCHAR), 'nan'), '')"
#: The latest raw results with a missing accession as the empty one, and the key of their donor.
_KEYED = f"""{_RAW}, keyed AS (SELECT * REPLACE (coalesce(accession, '') AS accession), concat_ws(chr(31), {", ".join(_TEXT.format(c) for c in _DONOR_COLS)}) AS donor FROM raw)"""


def _donors(threshold: float) -> str:
    return f"""{_KEYED}, best AS (SELECT accession, donor FROM keyed WHERE {_IDENTITY} <= {threshold}
          QUALIFY row_number() OVER (PARTITION BY accession ORDER BY {_NUM.format("reliability_index", "-1.0")} DESC, {_NUM.format("distance", "'inf'::DOUBLE")}, {", ".join(_TEXT.format(c) for c in _DONOR_COLS)}) = 1),
        selected AS (SELECT r.* FROM keyed r JOIN best b USING (accession, donor) WHERE {_IDENTITY} <= {threshold})"""


def _counters(t: float) -> str:
    return f"""(WITH {_donors(t)}, per AS (SELECT accession, donor, count(*) AS n, max({_IDENTITY}) <= {t} AS ok FROM keyed GROUP BY ALL),
        of_acc AS (SELECT accession, sum(n) AS n, count(*) AS donors, count(*) FILTER (ok) AS kept, coalesce(sum(n) FILTER (NOT ok), 0) AS over_rows FROM per GROUP BY 1)
        SELECT {t}::DOUBLE AS identity_threshold, CAST(coalesce(sum(n), 0) AS BIGINT) AS input_rows, (SELECT count(*) FROM selected) AS kept_rows, CAST(coalesce(sum(over_rows), 0) AS BIGINT) AS filtered_out_rows,
          count(*) FILTER (kept > 0) AS selected_donors, count(*) FILTER (kept = 0) AS accessions_with_no_surviving_donor, CAST(coalesce(sum(donors), 0) AS BIGINT) AS input_donors,
          CAST(coalesce(sum(donors - kept), 0) AS BIGINT) AS filtered_out_donors FROM of_acc)"""


_SPLIT_IDS = f"ids AS (SELECT DISTINCT {_ACC} AS accession FROM query_split WHERE accession IS NOT NULL)"
_ORDERED = f"""ordered AS (SELECT {_LETTERS.format("sequence")} AS sequence, {_ACC} AS accession, vec_id FROM query_embedding WHERE sequence IS NOT NULL AND accession IS NOT NULL),
        idx AS (SELECT sequence, row_number() OVER (ORDER BY first, sequence) - 1 AS idx FROM (SELECT sequence, min(vec_id) AS first FROM ordered GROUP BY 1))"""
_SAFE = "CASE WHEN trim({0}) IS NULL OR trim({0}) = '' THEN 'model' ELSE regexp_replace(regexp_replace(lower(trim({0})), '\\s+', '_', 'g'), '[^a-z0-9._-]', '_', 'g') END"


def oracle_sql() -> dict[str, str]:
    names = "model_name, distance_threshold"
    on = " ".join(f"WHEN '{m}' THEN {t}" for m, t in THRESHOLDS.items() if t is not None)
    seq = _LETTERS.format("sequence")
    return {
        "pipeline_summary": _pivot(f"{_knn(3)}, ann AS ({_annotations()}), raw AS (SELECT accession, go_id, e.name AS model_name, layer_index, 1 - d AS reliability_index, protein_id FROM knn JOIN ann ON ann.sequence_id = knn.ref_sequence_id LEFT JOIN (SELECT DISTINCT id, name FROM embedding_type) e ON e.id = embedding_type_id)", 3),
        "knn_cosine_topk": f"WITH {_knn(3)} {_HITS}",
        "knn_declarative": f"WITH {_knn(3)} {_HITS}",
        "knn_euclidean_topk": f"WITH {_knn(3, 'euclidean')} {_HITS}",
        "knn_threshold": f"WITH {_knn(5, threshold=0.45)} {_HITS}",
        "knn_taxonomy_exclude": f"WITH {_knn(3, exclude=EXCLUDE)} {_HITS}",
        "knn_taxonomy_include": f"WITH {_knn(3, include=INCLUDE)} {_HITS}",
        "knn_redundancy_mask": f"WITH {_knn(3, more=f', {_BOTH}, {_MASK}', mask='AND (accession, ref_sequence_id) NOT IN (SELECT (accession, ref_sequence_id) FROM masked)')} {_HITS}",
        "redundancy_mask": f"WITH {_vectors()}, {_BOTH}, {_MASK} SELECT * FROM masked",
        "cluster_sizes": f"WITH {_vectors()}, {_BOTH} SELECT md5(s) AS cluster, count(*) FILTER (side = 'q') AS queries, count(*) FILTER (side = 'r') AS \"references\" FROM (SELECT DISTINCT s, identifier, side FROM both_sides) GROUP BY 1",
        "sequence_union": f"WITH {_vectors()}, {_BOTH} SELECT DISTINCT identifier, side, s AS sequence FROM both_sides",
        "annotation_join": _annotations(),
        "annotation_taxonomy_exclude": _annotations(EXCLUDE),
        "annotation_taxonomy_include": _annotations(EXCLUDE, INCLUDE),
        "annotation_evidence": _annotations(evidence=["IDA", "IMP"]),
        "reference_semi_dedupe": f"WITH {_vectors(EXCLUDE)} SELECT sequence_id, embedding_type_id, layer_index, CAST(len(re) AS BIGINT) AS dimension FROM rv",
        "reference_cap": f"WITH {_vectors()} SELECT sequence_id FROM rv WHERE embedding_type_id = 1 AND layer_index = 0 ORDER BY sequence_id LIMIT 20",
        "annotate_hits": f"""WITH {_knn(2)}, ann AS ({_annotations()}), named AS (SELECT knn.*, e.name AS model_name, CASE e.name {on} END::DOUBLE AS distance_threshold FROM knn LEFT JOIN (SELECT DISTINCT id, name FROM embedding_type) e ON e.id = knn.embedding_type_id)
            SELECT accession, model_name, embedding_type_id, layer_index, ref_sequence_id, go_id, category, evidence_code, protein_id, distance_threshold, round(d, 6) AS distance, round(1 - d, 6) AS reliability_index
            FROM named JOIN ann ON ann.sequence_id = named.ref_sequence_id WHERE distance_threshold IS NULL OR d <= distance_threshold""",
        "threshold_map": f"SELECT {names} FROM (SELECT name AS model_name, CASE name {on} END::DOUBLE AS distance_threshold FROM embedding_type)",
        "reliability_index": f"WITH {_RAW} SELECT result_id, round(1 - distance, 6) AS cosine, round(0.5 / (0.5 + distance), 6) AS euclidean, round(1 / (1 + distance), 6) AS other FROM raw WHERE distance IS NOT NULL",
        "sequence_lengths": f"""WITH {_RAW}, {_vectors()}, q AS (SELECT accession, min({_LETTERS.format("qs")}) AS s FROM qv GROUP BY 1), r AS (SELECT id, min({seq}) AS s FROM ref_sequences WHERE id IS NOT NULL GROUP BY 1)
            SELECT p.accession, p.ref_idx AS ref_sequence_id, length(q.s) AS query_len, length(r.s) AS ref_len FROM (SELECT DISTINCT accession, ref_idx FROM raw WHERE accession IS NOT NULL) p LEFT JOIN q ON q.accession = p.accession LEFT JOIN r ON r.id = p.ref_idx""",
        "summary_metrics": f"WITH {_RAW} {_metrics(FULL_COLUMNS)}",
        "summary_weighted": f"WITH {_RAW}, m AS ({_metrics(FULL_COLUMNS)}) {_weighted(FULL_WEIGHTS)}",
        "term_stats": f"WITH {_RAW} {_STATS}",
        "summary_pivot": _pivot(),
        "topgo_per_model": f"WITH {_RAW}, {_TOPGO} SELECT DISTINCT * FROM topgo WHERE model_name IS NOT NULL",
        "topgo_ensemble": f"WITH {_RAW}, {_TOPGO} SELECT category, accession, go_id, max(reliability_index) AS reliability_index FROM topgo GROUP BY 1, 2, 3",
        "leakage_select": f"WITH {_donors(0.5)} SELECT accession, result_id FROM selected",
        "leakage_filtered": f"WITH {_KEYED} SELECT accession, result_id FROM keyed WHERE {_IDENTITY} > 0.5",
        "leakage_no_survivor": f"WITH {_KEYED} SELECT accession FROM keyed GROUP BY 1 HAVING min({_IDENTITY}) > 0.3",
        "leakage_donors": f"WITH {_donors(0.5)} SELECT accession, protein_id, organism, gene_name, query_len, ref_len, min(coalesce(source_file, '')) AS source_file, count(*) AS rows_kept_for_selected_donor FROM selected GROUP BY 1, 2, 3, 4, 5, 6",
        "leakage_summary": " UNION ALL ".join(_counters(t) for t in CUTOFFS),
        "coverage_report": f"WITH {_vectors()}, {_SPLIT_IDS} SELECT accession, CASE WHEN accession IN (SELECT accession FROM qv) THEN 'yes' ELSE 'no' END AS embedded FROM ids",
        "coverage_missing": f"WITH {_vectors()}, {_SPLIT_IDS} SELECT accession FROM ids WHERE accession NOT IN (SELECT accession FROM qv)",
        "coverage_counts": f"WITH {_vectors()}, {_SPLIT_IDS}, c AS (SELECT accession IN (SELECT accession FROM qv) AS e FROM ids) SELECT count(*) AS total, count(*) FILTER (e) AS embedded, count(*) FILTER (NOT e) AS missing FROM c",
        "merge_shards": "WITH per AS (SELECT source_file, count(*) AS rows FROM raw_results GROUP BY 1) SELECT source_file, 1 AS files, rows, FALSE AS total FROM per UNION ALL SELECT NULL, count(source_file), CAST(sum(rows) AS BIGINT), TRUE FROM per",
        "raw_casts": f"WITH {_RAW} SELECT result_id, CASE WHEN gene_name IS NULL THEN round(distance, 6) END AS distance, ref_idx FROM raw",
        "sanitize_names": f"SELECT name, {_SAFE.format('name')} AS safe FROM (SELECT source AS name FROM documents UNION SELECT model_name FROM embedding_type)",
        "accession_forms": f"SELECT DISTINCT accession, {_ACC} AS record FROM raw_results",
        "split_names": """SELECT split, CASE WHEN s LIKE 'tr%' THEN 'train' WHEN s LIKE 'te%' OR s LIKE 'ts%' THEN 'test' WHEN s LIKE 'v%' OR s LIKE 'dev%' THEN 'validation' END AS kind
            FROM (SELECT DISTINCT split, lower(regexp_replace(split, '[^A-Za-z]', '', 'g')) AS s FROM query_split)""",
        "sequence_index": f"WITH {_ORDERED} SELECT sequence, idx FROM idx",
        "query_mapping": f"""WITH {_ORDERED} SELECT idx AS query_idx, concat('Q', idx) AS query_fasta_id, string_agg(DISTINCT accession, ';' ORDER BY accession) AS accessions, length(o.sequence) AS sequence_length
            FROM ordered o JOIN idx USING (sequence) GROUP BY idx, o.sequence""",
        "fasta_sink": f"""WITH {_ORDERED}, refs AS (SELECT s, row_number() OVER (ORDER BY first, s) - 1 AS idx FROM (SELECT {seq} AS s, min(id) AS first FROM ref_sequences WHERE sequence IS NOT NULL GROUP BY 1))
            SELECT CAST(0 AS BIGINT) AS side, idx, '>Q' || idx || chr(10) || sequence AS value FROM idx UNION ALL SELECT 1, idx, '>R' || idx || chr(10) || s FROM refs""",
        "fasta_scan": f"SELECT DISTINCT 'sp_' || id AS identifier, {seq} AS sequence FROM ref_sequences WHERE id IS NOT NULL AND sequence IS NOT NULL",
        "first_vectors": f"SELECT {_ACC} AS accession, embedding_type_id, layer_index, min(vec_id) AS stored_id FROM query_embedding WHERE accession IS NOT NULL GROUP BY 1, 2, 3",
        "layer_discovery": "SELECT embedding_type_id, coalesce(string_agg(DISTINCT CAST(layer_index AS VARCHAR), ',' ORDER BY CAST(layer_index AS VARCHAR)), '') AS layers, bool_or(layer_index IS NULL) AS has_legacy FROM query_embedding GROUP BY 1",
        "effective_layers": """WITH want(m, k) AS (VALUES (1, 0), (1, 3), (2, 12), (2, 0), (2, 5), (5, 8), (9, 0))
            SELECT embedding_type_id, coalesce((SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM want WHERE m = h.embedding_type_id AND list_contains(h.ks, k)), '') AS layers
            FROM (SELECT embedding_type_id, list(DISTINCT layer_index) AS ks FROM query_embedding GROUP BY 1) h WHERE embedding_type_id IN (SELECT m FROM want)""",
        "layer_filter": "SELECT embedding_type_id, layer_index, count(DISTINCT vec_id) AS vectors FROM query_embedding WHERE (embedding_type_id = 2 AND layer_index = 12) OR embedding_type_id = 3 GROUP BY 1, 2",
        "truncate_sequences": f"SELECT DISTINCT id, left({seq}, 120) AS sequence FROM (SELECT DISTINCT id, {seq} AS sequence FROM ref_sequences)",
        "model_layer_cross": f"""SELECT CAST(s.id AS VARCHAR) AS accession, e.id AS embedding_type_id, e.name AS model_name, l.k AS layer_index, length(s.sequence) AS length
            FROM (SELECT DISTINCT id, {seq} AS sequence FROM ref_sequences WHERE id IS NOT NULL AND sequence IS NOT NULL) s
            CROSS JOIN (SELECT 'lumen-s' AS n, 0 AS k UNION SELECT 'tessel-l', 0 UNION SELECT 'tessel-l', 1) l JOIN embedding_type e ON lower(trim(e.name)) = l.n""",
        "collapse_best_model_layer": f"""WITH {_RAW}, x AS (SELECT *, CASE WHEN isnan(reliability_index) THEN NULL ELSE reliability_index END AS ri FROM raw WHERE accession IS NOT NULL),
            best AS (SELECT accession, model_name, layer_index FROM (SELECT accession, model_name, layer_index, max(ri) AS m FROM x GROUP BY 1, 2, 3)
              QUALIFY row_number() OVER (PARTITION BY accession ORDER BY m DESC NULLS LAST, model_name NULLS FIRST, layer_index NULLS FIRST) = 1)
            SELECT x.accession, go_id, x.model_name, x.layer_index, result_id FROM x JOIN best b ON b.accession = x.accession AND b.model_name IS NOT DISTINCT FROM x.model_name AND b.layer_index IS NOT DISTINCT FROM x.layer_index
            WHERE go_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY x.accession, go_id ORDER BY ri DESC NULLS LAST, result_id NULLS FIRST) = 1""",
        "normalize_by_accession": f"""WITH {_RAW}, x AS (SELECT result_id, accession, CASE WHEN isnan(alignment_score) THEN NULL ELSE alignment_score END AS v FROM raw WHERE accession IS NOT NULL), y AS (SELECT *, max(v) OVER (PARTITION BY accession) AS m FROM x)
            SELECT result_id, round(CASE WHEN m > 0 THEN coalesce(v, 0) / m ELSE 0 END, 6) + 0.0 AS normalized FROM y""",
        "distinct_pairs": f"""SELECT DISTINCT md5({_LETTERS.format("sequence_query")}) AS query, md5({_LETTERS.format("sequence_reference")}) AS reference FROM raw_results WHERE sequence_query IS NOT NULL AND sequence_reference IS NOT NULL""",
    }
