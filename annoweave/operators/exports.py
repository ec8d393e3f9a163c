"""Enrichment-ready exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from annoweave.operators.summary import rounded


def _valid(raw: DataFrame, precision: int) -> DataFrame:
    out = raw.select("accession", "go_id", F.upper("category").alias("category"), "model_name", "layer_index", rounded("reliability_index", precision).alias("reliability_index"))
    return out.where("accession is not null and go_id is not null and category is not null and reliability_index is not null and not isnan(reliability_index)")


def topgo_per_model(raw: DataFrame, precision: int = 4) -> DataFrame:
    """Distinct (accession, go_id, reliability_index) per model, layer and category.

    Rows without category or reliability go; a missing layer is ``legacy``.
    """
    v = _valid(raw, precision).where("model_name is not null")
    return v.select("model_name", F.coalesce(F.col("layer_index").cast("string"), F.lit("legacy")).alias("layer"), "category", "accession", "go_id", "reliability_index").distinct()


def topgo_ensemble(raw: DataFrame, precision: int = 4) -> DataFrame:
    """The best reliability per (accession, go_id, category) over all models and layers."""
    return _valid(raw, precision).groupBy("category", "accession", "go_id").agg(F.max("reliability_index").alias("reliability_index"))
