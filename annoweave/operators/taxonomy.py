"""Taxonomy filters. The two sides treat a missing taxon differently, on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from annoweave.runtime import free, materialise


def allowed_vector(taxon: Column, exclude: list[str], include: list[str]) -> Column:
    """Vector side: SQL logic, so a missing taxon fails any active filter. Both lists must hold."""
    ok = F.lit(True)
    if exclude:
        ok = ok & F.coalesce(~taxon.isin(exclude), F.lit(False))
    if include:
        ok = ok & F.coalesce(taxon.isin(include), F.lit(False))
    return ok


def allowed_annotation(taxon: Column, exclude: list[str], include: list[str]) -> Column:
    """Annotation side: a missing taxon passes an exclusion but not an exclusive list."""
    ok = F.lit(True)
    if exclude:
        ok = ok & (taxon.isNull() | ~taxon.isin(exclude))
    if include:
        ok = ok & F.coalesce(taxon.isin(include), F.lit(False))
    return ok


def allowed_sequences(proteins: DataFrame, exclude: list[str], include: list[str]) -> DataFrame:
    """Distinct sequence ids of which at least one protein passes the vector side."""
    return proteins.where(allowed_vector(F.trim("taxonomy_id"), exclude, include) & F.col("sequence_id").isNotNull()).select("sequence_id").distinct()


def descendants(edges: DataFrame, roots: list[str], include_roots: bool = True) -> DataFrame:
    """All taxa below ``roots`` in a (parent, child) table.

    Cycles and repeated edges are harmless: a taxon counts once. Not part of a
    run (expansion is disabled there); call it to build an explicit list.
    """
    spark = edges.sparkSession
    frontier = spark.createDataFrame([(r,) for r in roots], "taxon string").distinct()
    seen = frontier
    pairs = edges.where("parent is not null and child is not null").select(F.col("parent").cast("string"), F.col("child").cast("string")).distinct()
    while True:
        frontier = materialise(frontier.join(pairs, F.col("taxon") == F.col("parent")).select(F.col("child").alias("taxon")).distinct().join(seen, "taxon", "left_anti"), "taxa")
        if frontier.isEmpty():
            break
        old, seen = seen, materialise(seen.union(frontier), "taxa")
        free(old)
    return seen if include_roots else seen.where(~F.col("taxon").isin(roots))
