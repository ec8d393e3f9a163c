"""Aggregation of raw results to one wide row per accession and term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from annoweave.config import Summary

UNIT = ["accession", "go_id"]


def rounded(col: Column | str, precision: int) -> Column:
    """Rounded as a DOUBLE (a rounded decimal literal would stay a decimal)."""
    return F.round((F.col(col) if isinstance(col, str) else col).cast("double"), precision)


def _aggregate(metric: str, agg: str, precision: int) -> Column:
    x = rounded(metric, precision)
    # NaN is no measurement
    x = F.when(~F.isnan(x), x)
    if agg == "mean":
        # an exact integer sum: the mean of rounded values does not hang on the order of addition
        scale = 10**precision
        return F.sum(F.round(x * scale).cast("long")) / (F.count(x) * F.lit(float(scale)))
    return F.min(x) if agg == "min" else F.max(x)


def metrics(raw: DataFrame, conf: Summary, *more: Column) -> DataFrame:
    """Aggregates and support count per (accession, go_id, model_name, layer_index).

    Values are rounded before they are aggregated, nulls are skipped, and a null
    layer is a group. The count is rows over k, so it can exceed 1 where a
    sequence has several proteins. ``more`` are further aggregates of the same pass.
    """
    aggs = [_aggregate(m, a, conf.precision).alias(name) for name, m, a in conf.columns()]
    if conf.include_counts:
        n = F.count(F.lit(1))
        aggs.append((n / F.lit(float(conf.k)) if conf.normalize_count else n.cast("double")).alias("count"))
        if conf.raw_count:
            aggs.append(n.alias("count_raw"))
    return raw.where("accession is not null and go_id is not null").groupBy(*UNIT, "model_name", "layer_index").agg(*aggs, *more)


def weighted(table: DataFrame, conf: Summary) -> DataFrame:
    """Adds every weighted column, rounded, and their sum ``final_score`` (a missing value counts 0)."""
    active = conf.active()
    if not active:
        return table
    parts = {f"{conf.prefix}{c}": rounded(F.coalesce(F.col(c), F.lit(0.0)) * F.lit(w), conf.precision) for c, w in active.items()}
    out = table.select("*", *[x.alias(c) for c, x in parts.items()])
    total = sum((F.col(c) for c in parts), F.lit(0.0))
    return out.withColumn("final_score", rounded(total, conf.precision + 2))


def term_stats(raw: DataFrame) -> DataFrame:
    """Per (accession, go_id): raw rows over all models, and the distinct proteins, sorted and joined by |."""
    return raw.where("accession is not null and go_id is not null").groupBy(*UNIT).agg(F.count(F.lit(1)).alias("term_count"), F.array_join(F.array_sort(F.collect_set("protein_id")), "|").alias("proteins"))


def label(model: str, layer: int | None) -> str:
    return f"{model}_L{'legacy' if layer is None else layer}"


def _columns(values: list[str], spaces: list[tuple[str, int | None]]) -> list[Column]:
    """``{column}_{model}_L{layer|legacy}`` of every given space, as aggregates."""
    key = F.concat(F.col("model_name"), F.lit("_L"), F.coalesce(F.col("layer_index").cast("string"), F.lit("legacy")))
    return [F.max(F.when(key == label(m, k), F.col(c))).alias(f"{c}_{label(m, k)}") for m, k in spaces for c in values]


def summary(raw: DataFrame, conf: Summary, spaces: list[tuple[str, int | None]]) -> DataFrame:
    """The whole summary, one row per (accession, go_id); sort it by them where it is written.

    One aggregation per model and layer takes the metrics, the number of rows and
    the proteins together; a second one merges them and spreads the metrics over
    the columns of ``spaces``, which are fixed beforehand, so no job looks for
    them and every run has the same header.
    """
    per = weighted(metrics(raw, conf, F.count(F.lit(1)).alias("_rows"), F.collect_set("protein_id").alias("_proteins")), conf)
    values = [c for c in per.columns if c not in (*UNIT, "model_name", "layer_index", "_rows", "_proteins")]
    proteins = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_proteins")))), "|")
    return per.groupBy(*UNIT).agg(F.sum("_rows").alias("term_count"), proteins.alias("proteins"), *_columns(values, spaces))
