"""The runs: import of a reference, embedding, lookup, and what follows a lookup."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from annoweave.config import Summary
from annoweave.functions import vectors as V
from annoweave.functions.text import accession, letters
from annoweave.operators import annotate, embed, exports, knn, prepare, redundancy, reference, summary
from annoweave.runtime import materialise, table
from annoweave.sources import fasta, sinks


@dataclass(frozen=True)
class Lookup:
    """Settings of a lookup. Thresholds are per model name; ``align`` and ``keep_sequences`` cost the most."""

    k: int = 1
    metric: str = "cosine"
    thresholds: dict[str, float | None] = field(default_factory=dict)
    exclude: list[str] = field(default_factory=list)
    include: list[str] = field(default_factory=list)
    evidence: list[str] = field(default_factory=list)
    redundancy_identity: float = 0.0
    redundancy_coverage: float = 0.7
    align: bool = True
    keep_sequences: bool = True
    precision: int = 4


@dataclass
class Tables:
    """The tables of a run."""

    queries: DataFrame
    references: DataFrame
    sequences: DataFrame
    proteins: DataFrame
    links: DataFrame
    terms: DataFrame
    models: DataFrame

    @classmethod
    def at(cls, spark: SparkSession, d: str, fasta_path: str | None = None, limit: int | None = None, vectors: str | None = None) -> Tables:
        """From a data folder. Sequences are brought to their letters.

        Query vectors are brought to one per accession, model and layer: the first
        that was stored, with the sequence that came with it. With ``fasta_path``
        the queries are the records of FASTA files, still without vectors, of
        which ``limit`` keeps the first; of records of one accession the first counts.
        ``vectors`` is another table of query vectors.
        """
        names = {"references": "reference_embedding", "sequences": "ref_sequences", "proteins": "protein", "links": "protein_go_term_annotation", "terms": "go_terms", "models": "embedding_type"}
        t = {k: table(spark, d, n) for k, n in names.items()}
        t["references"] = t["references"].where(V.is_vector("embedding"))
        t["sequences"] = t["sequences"].withColumn("sequence", letters("sequence"))
        if fasta_path:
            rows = fasta.read(spark, fasta_path, limit).select(accession("identifier").alias("accession"), "sequence", F.struct("path", "position").alias("_at"))
            q = rows.groupBy("accession").agg(F.min_by("sequence", "_at").alias("sequence"))
            return cls(queries=q, **t)
        return cls(queries=first_stored(spark.read.parquet(vectors) if vectors else table(spark, d, "query_embedding")), **t)


def first_stored(vectors: DataFrame) -> DataFrame:
    """(accession, embedding_type_id, layer_index, embedding, sequence), the first usable delivery of each key."""
    q = vectors.withColumn("accession", accession("accession")).where(F.col("accession").isNotNull() & V.is_vector("embedding"))
    at = [F.coalesce(F.col("created_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))] if "created_at" in q.columns else []
    at += [F.col("vec_id")] if "vec_id" in q.columns else []
    first = F.struct(*at, F.xxhash64("embedding", "sequence"))
    # two aggregates of one order, so that a job that needs no vectors does not shuffle them
    of = [F.min_by(x, first).alias(c) for c, x in (("embedding", F.col("embedding")), ("sequence", letters("sequence")))]
    return q.groupBy("accession", "embedding_type_id", "layer_index").agg(*of)


def hits(t: Tables, conf: Lookup, masked: DataFrame | None = None) -> DataFrame:
    """Nearest neighbours with model names and thresholds applied.

    The taxonomy acts before the search, so an excluded neighbour makes room for
    the next. A threshold keeps only nearer neighbours, so applying it after the
    limit gives the same rows.
    """
    refs = reference.reference_vectors(t.references, t.sequences, t.proteins, conf.exclude, conf.include)
    found = knn.blocked(t.queries, refs, conf.k, conf.metric, masked=masked)
    found = annotate.threshold_map(annotate.model_names(found, t.models), conf.thresholds)
    return found.where(F.col("distance_threshold").isNull() | (F.col("distance") <= F.col("distance_threshold")))


def clusters(t: Tables, conf: Lookup) -> DataFrame | None:
    """Clusters of both sides' sequences, if a run asks for them."""
    if conf.redundancy_identity <= 0:
        return None
    return redundancy.cluster(prepare.all_sequences(t.sequences, t.queries), conf.redundancy_identity, conf.redundancy_coverage)


@dataclass
class Found:
    """What a lookup gives: raw results, and the numbered sequences of both sides."""

    raw: DataFrame
    queries: DataFrame
    references: DataFrame


def lookup(t: Tables, conf: Lookup, groups: DataFrame | None = None) -> Found:
    """Raw results of a lookup: hits, annotations, sequences, indexes, scores, alignments.

    Only ids travel through the search; annotations and sequences are joined to
    its few hits, and numbers of sequences to the ids. Hits are a written table,
    since several joins read them.
    """
    # the first deliveries are chosen once; the search reads their vectors, the numbering their sequences alone
    t = replace(t, queries=materialise(t.queries, "queries"))
    found = materialise(hits(t, conf, redundancy.mask(groups) if groups is not None else None), "hits")
    ann = reference.annotations(t.proteins, t.links, t.terms, conf.exclude, conf.include, conf.evidence)
    q = t.queries.join(found.select("accession").distinct(), "accession", "left_semi").groupBy("accession").agg(F.min("sequence").alias("sequence_query"))
    r = t.sequences.withColumnRenamed("id", "ref_sequence_id").join(found.select("ref_sequence_id").distinct(), "ref_sequence_id", "left_semi")
    r = r.groupBy("ref_sequence_id").agg(F.min("sequence").alias("sequence_reference"))
    q = annotate.numbered(q, "accession", "sequence_query", "query_idx")
    r = annotate.numbered(r, "ref_sequence_id", "sequence_reference", "ref_idx")

    def sized(df: DataFrame, text: str, n: str) -> DataFrame:
        df = df.withColumn(n, F.length(text).cast("long"))
        return df if conf.align or conf.keep_sequences else df.drop(text)

    out = found.join(sized(q, "sequence_query", "query_len"), "accession", "left").join(sized(r, "sequence_reference", "ref_len"), "ref_sequence_id", "left")
    out = annotate.scored(out, conf.metric)
    if conf.align:
        out = annotate.aligned(out)
    if not conf.keep_sequences:
        out = out.drop("sequence_query", "sequence_reference")
    return Found(annotate.expand(out, ann), q, r)


def raw_results(t: Tables, conf: Lookup) -> DataFrame:
    return lookup(t, conf, clusters(t, conf)).raw


def spaces(models: DataFrame, vectors: DataFrame) -> list[tuple[str, int | None]]:
    """(model name, layer) that occur, sorted: a handful, from the model table and the layers."""
    rows = annotate.model_names(vectors.select(F.col("embedding_type_id").cast("long").alias("embedding_type_id"), "layer_index").distinct(), models).select("model_name", "layer_index").distinct().collect()
    return sorted(((r[0], r[1]) for r in rows if r[0] is not None), key=lambda x: (x[0], -1 if x[1] is None else x[1]))


def post_process(t: Tables, raw: DataFrame, conf: Summary, path: str, topgo: bool = True) -> None:
    """Writes the summary and, if wanted, the enrichment exports."""
    sinks.write_summary(summary.summary(raw, conf, spaces(t.models, t.queries)), f"{path}/summary")
    if topgo:
        sinks.write_topgo(exports.topgo_per_model(raw, conf.precision), exports.topgo_ensemble(raw, conf.precision), path)


def run(
    t: Tables,
    path: str,
    conf: Lookup,
    post: Summary,
    models: dict[str, list[int]] | None = None,
    only_lookup: bool = False,
    only_embedding: bool = False,
    max_length: int | None = None,
    topgo: bool = True,
) -> None:
    """A whole run: embedding, lookup, summary and exports, written below ``path``.

    With ``only_lookup`` the queries hold vectors already; with ``only_embedding``
    it ends with them. ``models`` are the enabled ones with their layers (none:
    all); of a model with an empty list all layers are searched.
    """
    if only_lookup and only_embedding:
        raise ValueError("only_lookup and only_embedding exclude each other")
    spark = t.models.sparkSession
    if not only_lookup:
        wanted = prepare.enabled_models(t.models, models or {})
        seqs = t.queries.groupBy("accession").agg(F.min(prepare.truncated("sequence", max_length)).alias("sequence"))
        vectors = prepare.checked_tasks(embed.embed(prepare.tasks(seqs, wanted))).withColumn("_order", F.lit(0))
        sinks.write_vectors(vectors, f"{path}/vectors", "_order")
        if only_embedding:
            return
        t = replace(t, queries=first_stored(spark.read.parquet(f"{path}/vectors")))
    if models:
        named = t.models.groupBy(F.lower(F.trim("name")).alias("low")).agg(F.min("id").alias("id"))
        ids = {r["low"]: r["id"] for r in named.collect()}  # the few models
        layers = {ids[name.strip().lower()]: ks for name, ks in models.items() if name.strip().lower() in ids}
        t = replace(t, queries=prepare.in_layers(t.queries, layers), references=prepare.in_layers(t.references, layers))
    groups = clusters(t, conf)
    if groups is not None:
        groups = materialise(groups, "clusters")
        sinks.write_table(groups.select("cluster", "identifier", "side"), f"{path}/clusters", sep="\t")
    found = lookup(t, conf, groups)
    raw = materialise(found.raw, "raw")
    sinks.write_raw(raw, f"{path}/raw_results", conf.precision)
    q = materialise(found.queries.where("query_idx is not null").select(F.col("sequence_query").alias("sequence"), F.col("query_idx").alias("idx"), "accession"), "queries")
    r = found.references.where("ref_idx is not null").select(F.col("sequence_reference").alias("sequence"), F.col("ref_idx").alias("idx"))
    sinks.write_fasta(q.select("sequence", "idx").dropDuplicates(["idx"]), r.dropDuplicates(["idx"]), f"{path}/sequences")
    sinks.write_table(annotate.mapping(q), f"{path}/query_index_mapping")
    post_process(t, raw, post, path, topgo)
