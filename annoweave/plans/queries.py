"""Registered queries of the engine's own operators, over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from annoweave.config import Summary
from annoweave.functions import vectors as V
from annoweave.functions.align import alignment
from annoweave.functions.text import accession, letters, safe_name, split_name
from annoweave.operators import annotate, collapse, coverage, exports, knn, leakage, prepare, redundancy, reference, summary
from annoweave.plans import pipeline
from annoweave.plans.sql import CUTOFFS, EXCLUDE, INCLUDE, SPACES, THRESHOLDS, oracle_sql  # noqa: F401
from annoweave.runtime import materialise, spread, table
from annoweave.sources import fasta, raw as raw_source, sinks

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}

#: The summary of the shipped settings, and narrow ones for the wide table.
FULL = Summary(k=1)
NARROW = Summary(metrics={"reliability_index": ("max",)}, weights={"max_ri": 0.8, "count": 0.2}, k=1)
NARROW_3 = replace(NARROW, k=3)


def _query(f: Query) -> Query:
    _ALL[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_ALL)


def _latest(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """The latest delivery of every raw result, accessions in one form; only the wanted columns are read."""
    r = table(spark, d, "raw_results")
    row = F.struct(*[accession(c).alias(c) if c == "accession" else F.col(c) for c in cols])
    when = F.coalesce(F.col("loaded_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    return r.groupBy("result_id").agg(F.max_by(row, when).alias("r")).select("result_id", "r.*")


def _hits(df: DataFrame) -> DataFrame:
    return df.select("accession", "ref_sequence_id", F.round("distance", 6).alias("distance"), "embedding_type_id", "layer_index")


def _search(spark: SparkSession, d: str, **conf) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    refs = reference.reference_vectors(t.references, t.sequences, t.proteins, conf.pop("exclude", None), conf.pop("include", None))
    return _hits(knn.blocked(t.queries, refs, **conf))


@_query
def pipeline_summary(spark: SparkSession, d: str) -> DataFrame:
    """Search, annotation, scores, weighted aggregation and the wide table in one run."""
    t = pipeline.Tables.at(spark, d)
    raw = pipeline.raw_results(t, pipeline.Lookup(k=3, align=False, keep_sequences=False))
    return summary.summary(raw, NARROW_3, SPACES)


@_query
def pipeline_aligned(spark: SparkSession, d: str) -> DataFrame:
    """The same as a shipped run does it: every hit aligned, the whole summary of the settings."""
    t = pipeline.Tables.at(spark, d)
    raw = materialise(pipeline.raw_results(t, pipeline.Lookup(k=1, keep_sequences=False)), "raw")
    return summary.summary(raw, FULL, SPACES)


@_query
def knn_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d, k=3)


@_query
def knn_euclidean_topk(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d, k=3, metric="euclidean")


@_query
def knn_threshold(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d, k=5, threshold=0.45)


@_query
def knn_declarative(spark: SparkSession, d: str) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    return _hits(knn.declarative(t.queries, reference.reference_vectors(t.references, t.sequences, t.proteins), k=3))


@_query
def knn_taxonomy_exclude(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d, k=3, exclude=EXCLUDE)


@_query
def knn_taxonomy_include(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d, k=3, include=INCLUDE)


def _equal_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of equal residues, as an external cluster table would come."""
    t = pipeline.Tables.at(spark, d)
    return prepare.all_sequences(t.sequences, t.queries).select(F.md5(letters("sequence")).alias("cluster"), "identifier", "side").distinct()


@_query
def redundancy_mask(spark: SparkSession, d: str) -> DataFrame:
    return redundancy.mask(_equal_clusters(spark, d))


@_query
def cluster_sizes(spark: SparkSession, d: str) -> DataFrame:
    return redundancy.sizes(_equal_clusters(spark, d))


@_query
def knn_redundancy_mask(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d, k=3, masked=redundancy.mask(_equal_clusters(spark, d)))


@_query
def sequence_clusters(spark: SparkSession, d: str) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    return redundancy.cluster(prepare.all_sequences(t.sequences, t.queries), identity=0.9, coverage=0.7)


@_query
def knn_cluster_mask(spark: SparkSession, d: str) -> DataFrame:
    """Search without neighbours of the query's own cluster at identity 0.9 and coverage 0.7."""
    return _search(spark, d, k=3, masked=redundancy.mask(sequence_clusters(spark, d)))


@_query
def sequence_union(spark: SparkSession, d: str) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    return prepare.all_sequences(t.sequences, t.queries).select("identifier", "side", letters("sequence").alias("sequence")).distinct()


def _annotations(spark: SparkSession, d: str, **conf) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    return reference.annotations(t.proteins, t.links, t.terms, **conf)


@_query
def annotation_join(spark: SparkSession, d: str) -> DataFrame:
    return _annotations(spark, d)


@_query
def annotation_taxonomy_exclude(spark: SparkSession, d: str) -> DataFrame:
    return _annotations(spark, d, exclude=EXCLUDE)


@_query
def annotation_taxonomy_include(spark: SparkSession, d: str) -> DataFrame:
    return _annotations(spark, d, include=INCLUDE, exclude=EXCLUDE)


@_query
def annotation_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _annotations(spark, d, evidence=["IDA", "imp"])


@_query
def reference_semi_dedupe(spark: SparkSession, d: str) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    out = reference.reference_vectors(t.references, t.sequences, t.proteins, EXCLUDE)
    return out.select("sequence_id", "embedding_type_id", "layer_index", F.size("embedding").cast("long").alias("dimension"))


@_query
def reference_cap(spark: SparkSession, d: str) -> DataFrame:
    """The row cap of the reference scan, by sequence id; the cap is the feature."""
    t = pipeline.Tables.at(spark, d)
    only = reference.by_layer(reference.reference_vectors(t.references, t.sequences, t.proteins), 1, 0)
    return only.orderBy("sequence_id").limit(20).select("sequence_id")


@_query
def annotate_hits(spark: SparkSession, d: str) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    raw = pipeline.raw_results(t, pipeline.Lookup(k=2, thresholds=THRESHOLDS, align=False))
    cols = ["accession", "model_name", "embedding_type_id", "layer_index", "ref_sequence_id", "go_id", "category", "evidence_code", "protein_id", "distance_threshold"]
    return raw.select(*cols, F.round("distance", 6).alias("distance"), F.round("reliability_index", 6).alias("reliability_index"))


@_query
def threshold_map(spark: SparkSession, d: str) -> DataFrame:
    return annotate.threshold_map(table(spark, d, "embedding_type").select(F.col("name").alias("model_name")), THRESHOLDS)


@_query
def reliability_index(spark: SparkSession, d: str) -> DataFrame:
    r = _latest(spark, d, "distance").where("distance is not null")
    return r.select("result_id", *[F.round(V.reliability("distance", m), 6).alias(m) for m in ("cosine", "euclidean", "other")])


@_query
def sequence_lengths(spark: SparkSession, d: str) -> DataFrame:
    t = pipeline.Tables.at(spark, d)
    pairs = _latest(spark, d, "accession", "ref_idx").select("accession", F.col("ref_idx").alias("ref_sequence_id")).distinct()
    q = t.queries.select("accession", letters("sequence").alias("sequence"))
    r = t.sequences.select("id", letters("sequence").alias("sequence"))
    return annotate.sequences_of(pairs.where("accession is not null"), q, r).select("accession", "ref_sequence_id", "query_len", "ref_len")


@_query
def summary_metrics(spark: SparkSession, d: str) -> DataFrame:
    raw = _latest(spark, d, "accession", "go_id", "model_name", "layer_index", "reliability_index", "identity", "identity_sw")
    return summary.metrics(raw, FULL)


@_query
def summary_weighted(spark: SparkSession, d: str) -> DataFrame:
    return summary.weighted(summary_metrics(spark, d), FULL)


@_query
def term_stats(spark: SparkSession, d: str) -> DataFrame:
    return summary.term_stats(_latest(spark, d, "accession", "go_id", "protein_id"))


@_query
def summary_pivot(spark: SparkSession, d: str) -> DataFrame:
    raw = _latest(spark, d, "accession", "go_id", "model_name", "layer_index", "protein_id", "reliability_index")
    return summary.summary(raw, NARROW, SPACES)


_TOPGO = ("accession", "go_id", "category", "model_name", "layer_index", "reliability_index")


@_query
def topgo_per_model(spark: SparkSession, d: str) -> DataFrame:
    return exports.topgo_per_model(_latest(spark, d, *_TOPGO))


@_query
def topgo_ensemble(spark: SparkSession, d: str) -> DataFrame:
    return exports.topgo_ensemble(_latest(spark, d, *_TOPGO))


def _donor_rows(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d, "accession", "source_file", *leakage.DONOR)


@_query
def leakage_select(spark: SparkSession, d: str) -> DataFrame:
    return leakage.best_donor_rows(_donor_rows(spark, d), 0.5).select("accession", "result_id")


@_query
def leakage_filtered(spark: SparkSession, d: str) -> DataFrame:
    return leakage.filtered_out(_donor_rows(spark, d), 0.5).select("accession", "result_id")


@_query
def leakage_no_survivor(spark: SparkSession, d: str) -> DataFrame:
    return leakage.no_survivor(_donor_rows(spark, d), 0.3)


@_query
def leakage_donors(spark: SparkSession, d: str) -> DataFrame:
    out = leakage.selected_donors(leakage.best_donor_rows(_donor_rows(spark, d), 0.5))
    return out.select("accession", "protein_id", "organism", "gene_name", "query_len", "ref_len", "source_file", "rows_kept_for_selected_donor")


@_query
def leakage_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = materialise(_donor_rows(spark, d), "donors")
    return reduce(DataFrame.union, [leakage.counters(rows, t) for t in CUTOFFS])


def _split_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "query_split").select(accession("accession").alias("accession"))


@_query
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    return coverage.report(_split_ids(spark, d), pipeline.Tables.at(spark, d).queries)


@_query
def coverage_missing(spark: SparkSession, d: str) -> DataFrame:
    return coverage.missing(_split_ids(spark, d), pipeline.Tables.at(spark, d).queries)


@_query
def coverage_counts(spark: SparkSession, d: str) -> DataFrame:
    return coverage.counts(coverage_report(spark, d))


@_query
def merge_shards(spark: SparkSession, d: str) -> DataFrame:
    """Rows per shard after a type-relaxed union of two halves with different columns."""
    r = table(spark, d, "raw_results")
    halves = [r.where("layer_index is null").select("result_id", "source_file"), r.where("layer_index is not null").select("result_id", "source_file", "layer_index")]
    return raw_source.merge_statistics(raw_source.union(halves))


@_query
def raw_casts(spark: SparkSession, d: str) -> DataFrame:
    """Numbers read from text, null where they cannot be."""
    r = _latest(spark, d, "gene_name", "distance", "ref_idx")
    text = r.select("result_id", F.coalesce("gene_name", F.col("distance").cast("string")).alias("distance"), F.col("ref_idx").cast("string").alias("ref_idx"))
    return raw_source.casts(text).select("result_id", F.round("distance", 6).alias("distance"), "ref_idx")


@_query
def sanitize_names(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "documents").select(F.col("source").alias("name")).union(table(spark, d, "embedding_type").select("model_name")).distinct()
    return names.select("name", safe_name("name").alias("safe"))


@_query
def accession_forms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_results").select("accession").distinct().select("accession", accession("accession").alias("record"))


@_query
def split_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "query_split").select("split").distinct().select("split", split_name("split").alias("kind"))


def _ordered_queries(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "query_embedding").where("sequence is not null and accession is not null")
    return q.select("vec_id", accession("accession").alias("accession"), letters("sequence").alias("sequence"))


@_query
def sequence_index(spark: SparkSession, d: str) -> DataFrame:
    return annotate.sequence_index(_ordered_queries(spark, d), "sequence", "vec_id")


@_query
def query_mapping(spark: SparkSession, d: str) -> DataFrame:
    q = _ordered_queries(spark, d)
    return annotate.query_mapping(annotate.sequence_index(q, "sequence", "vec_id"), q)


@_query
def fasta_sink(spark: SparkSession, d: str) -> DataFrame:
    q = annotate.sequence_index(_ordered_queries(spark, d), "sequence", "vec_id")
    r = annotate.sequence_index(table(spark, d, "ref_sequences").select("id", letters("sequence").alias("sequence")), "sequence", "id")
    return sinks.fasta_lines(q, r).select(F.col("side").cast("long").alias("side"), "idx", "value")


@_query
def fasta_scan(spark: SparkSession, d: str) -> DataFrame:
    """References written as wrapped, lower-case FASTA text and read again."""
    wrapped = F.regexp_replace(F.lower(letters("sequence")), "(.{60})", "$1\n")
    texts = table(spark, d, "ref_sequences").where("id is not null and sequence is not null").select(F.concat(F.lit(">sp|"), F.col("id").cast("string"), F.lit(" some name OS=1\n"), wrapped).alias("text"))
    return fasta.parse(texts, "text").select(accession("identifier").alias("identifier"), "sequence").distinct()


@_query
def first_vectors(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "query_embedding").select("accession", "embedding_type_id", "layer_index", "vec_id")
    return sinks.new_vectors(q.withColumn("stored_id", F.col("vec_id")), None, "vec_id")


@_query
def layer_discovery(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "query_embedding")
    out = reference.available_layers(q)
    return out.select("embedding_type_id", F.array_join("layers", ",").alias("layers"), "has_legacy")


@_query
def effective_layers(spark: SparkSession, d: str) -> DataFrame:
    have = reference.available_layers(table(spark, d, "query_embedding"))
    out = prepare.effective_layers(have, {1: [0, 3], 2: [12, 0, 5], 5: [8], 9: [0]})
    return out.select("embedding_type_id", F.array_join("layers", ",").alias("layers"))


@_query
def layer_filter(spark: SparkSession, d: str) -> DataFrame:
    out = prepare.in_layers(table(spark, d, "query_embedding"), {2: [12], 3: []})
    return out.groupBy("embedding_type_id", "layer_index").agg(F.countDistinct("vec_id").alias("vectors"))


@_query
def truncate_sequences(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "ref_sequences").select("id", letters("sequence").alias("sequence")).distinct()
    return s.select("id", prepare.truncated("sequence", 120).alias("sequence"))


@_query
def model_layer_cross(spark: SparkSession, d: str) -> DataFrame:
    models = prepare.enabled_models(table(spark, d, "embedding_type"), {"lumen-s": [0], "TESSEL-L": [1, 0, 1]})
    seqs = table(spark, d, "ref_sequences").select(F.col("id").cast("string").alias("accession"), letters("sequence").alias("sequence")).distinct()
    return prepare.tasks(seqs, models).select("accession", "embedding_type_id", "model_name", "layer_index", F.length("sequence").cast("long").alias("length"))


@_query
def collapse_best_model_layer(spark: SparkSession, d: str) -> DataFrame:
    r = _latest(spark, d, "accession", "go_id", "model_name", "layer_index", "reliability_index").where("accession is not null")
    return collapse.collapse(r, "reliability_index", ["result_id"]).select("accession", "go_id", "model_name", "layer_index", "result_id")


@_query
def normalize_by_accession(spark: SparkSession, d: str) -> DataFrame:
    r = _latest(spark, d, "accession", "alignment_score").where("accession is not null")
    return collapse.normalized(r, "alignment_score", "normalized").select("result_id", F.round("normalized", 6).alias("normalized"))


@_query
def distinct_pairs(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_results").select("sequence_query", "sequence_reference").distinct()
    pairs = annotate.distinct_pairs(r.select(letters("sequence_query").alias("sequence_query"), letters("sequence_reference").alias("sequence_reference")))
    return pairs.select(F.md5("sequence_query").alias("query"), F.md5("sequence_reference").alias("reference"))


@_query
def alignment_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Global and local alignment of every distinct pair of sequences in the raw results."""
    r = table(spark, d, "raw_results").select("sequence_query", "sequence_reference").distinct()
    pairs = annotate.distinct_pairs(r.select(letters("sequence_query").alias("sequence_query"), letters("sequence_reference").alias("sequence_reference")))
    measured = spread(pairs, F.xxhash64("sequence_query", "sequence_reference")).withColumn("m", alignment("sequence_query", "sequence_reference"))
    return measured.select(F.md5("sequence_query").alias("query"), F.md5("sequence_reference").alias("reference"), "m.*")
