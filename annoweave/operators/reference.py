"""The reference side: vectors that may be searched, and the annotations they lead to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from annoweave.operators import taxonomy


def reference_vectors(vectors: DataFrame, sequences: DataFrame, proteins: DataFrame, exclude: list[str] | None = None, include: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Vectors of sequences that have a protein and pass the taxonomy, one per sequence, model and layer.

    The joins are semi joins: several proteins of a sequence neither multiply
    nor need merging. A repeated (sequence, model, layer) keeps one row. A cap
    takes the least sequence ids, so it is the same in every run.
    """
    allowed = taxonomy.allowed_sequences(proteins, exclude or [], include or [])
    known = sequences.select(F.col("id").alias("sequence_id"))
    out = vectors.where("sequence_id is not null").join(known, "sequence_id", "left_semi").join(allowed, "sequence_id", "left_semi")
    out = out.select("sequence_id", "embedding_type_id", "layer_index", "embedding")
    out = out.groupBy("sequence_id", "embedding_type_id", "layer_index").agg(F.min("embedding").alias("embedding"))
    return out.orderBy("sequence_id").limit(limit) if limit else out


def annotations(proteins: DataFrame, links: DataFrame, terms: DataFrame, exclude: list[str] | None = None, include: list[str] | None = None, evidence: list[str] | None = None) -> DataFrame:
    """sequence ⋈ protein ⋈ annotation ⋈ term: one row per sequence, protein and term annotation.

    Equal rows count once. ``evidence`` keeps only the listed codes (upper case);
    by default all.
    """
    p = proteins.where("sequence_id is not null and id is not null")
    p = p.where(taxonomy.allowed_annotation(F.trim("taxonomy_id"), exclude or [], include or []))
    p = p.select("sequence_id", F.col("id").alias("protein_id"), "organism", "gene_name", F.trim("taxonomy_id").alias("taxonomy_id")).distinct()
    a = links.select("protein_id", "go_id", F.upper("evidence_code").alias("evidence_code")).distinct()
    if evidence:
        a = a.where(F.col("evidence_code").isin([e.upper() for e in evidence]))
    t = terms.select("go_id", F.upper("category").alias("category"), F.col("description").alias("go_description")).distinct()
    return p.join(a, "protein_id").join(t, "go_id")


def by_layer(vectors: DataFrame, model: int, layer: int | None) -> DataFrame:
    """The vectors of one model and layer; None is the layer of vectors without one."""
    return vectors.where((F.col("embedding_type_id") == model) & F.col("layer_index").eqNullSafe(F.lit(layer).cast("int")))


def available_layers(vectors: DataFrame) -> DataFrame:
    """Per model the sorted layers that occur, and whether vectors without a layer do."""
    return vectors.groupBy("embedding_type_id").agg(F.sort_array(F.collect_set("layer_index")).alias("layers"), F.max(F.col("layer_index").isNull()).alias("has_legacy"))
