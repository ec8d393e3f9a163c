"""Choosing the best model and layer of every accession (an optional step)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def number_or_null(col: str) -> Column:
    x = F.expr(f"try_cast(`{col}` as double)")
    return F.when(~F.isnan(x), x)


def normalized(df: DataFrame, col: str, out: str) -> DataFrame:
    """``col`` over its accession's maximum; 0 where it is missing or the maximum is not positive."""
    top = F.max(number_or_null(col)).over(Window.partitionBy("accession"))
    return df.withColumn(out, F.when(top > 0, F.coalesce(number_or_null(col), F.lit(0.0)) / top).otherwise(0.0))


def best_space(df: DataFrame, score: str) -> DataFrame:
    """Per accession the (model_name, layer_index) with the highest score, as ``score_global``.

    Ties: model name, then layer, a missing one first. Aggregated first, so the
    window sees one row per accession, model and layer.
    """
    per = df.where("accession is not null").groupBy("accession", "model_name", "layer_index").agg(F.max(number_or_null(score)).alias("score_global"))
    w = Window.partitionBy("accession").orderBy(F.col("score_global").desc_nulls_last(), F.col("model_name").asc_nulls_first(), F.col("layer_index").asc_nulls_first())
    return per.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def collapse(df: DataFrame, score: str, tie: list[str]) -> DataFrame:
    """The rows of each accession's best model and layer, one per term: the best score, ties by ``tie``."""
    best = best_space(df, score)
    same = (df["accession"] == best["accession"]) & df["model_name"].eqNullSafe(best["model_name"]) & df["layer_index"].eqNullSafe(best["layer_index"])
    kept = df.join(best, same, "left_semi").where("go_id is not null")
    w = Window.partitionBy("accession", "go_id").orderBy(number_or_null(score).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie])
    return kept.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
