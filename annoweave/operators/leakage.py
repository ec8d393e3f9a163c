"""Donor selection under an identity cutoff, for evaluations free of leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The fields that make a donor.
DONOR = ["protein_id", "organism", "gene_name", "distance", "reliability_index", "identity", "query_len", "ref_len"]


def label(threshold: float) -> str:
    """Units and hundredths of a cutoff around a p: 0p50 of one half."""
    return "%dp%02d" % divmod(round(threshold * 100), 100)


def number(col: str, default: float) -> Column:
    """A float from a column of any type; null, blank, NaN or unreadable values are the default."""
    x = F.expr(f"try_cast(nullif(trim(cast(`{col}` as string)), '') as double)")
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(default))


def text(col: str) -> Column:
    """A field as the text that a file of results holds; missing and NaN are empty."""
    x = F.col(col).cast("string")
    return F.coalesce(F.when(x != "NaN", x), F.lit(""))


def donors(raw: DataFrame) -> DataFrame:
    """Rows with ``donor``, a key of the donor fields; a missing accession is the empty one."""
    key = F.concat_ws("\x1f", *[text(c) for c in DONOR])
    return raw.withColumn("accession", text("accession")).withColumn("donor", F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.reverse(key)).alias("g")))


def best_donor_rows(raw: DataFrame, threshold: float) -> DataFrame:
    """All rows of each accession's best donor at or under the cutoff.

    A missing identity passes. Best: highest reliability (missing: -1), then least
    distance (missing: infinite), then protein, and then the donor fields in their
    order, all compared as text, a missing one as the empty text.
    """
    ok = donors(raw).where(number("identity", -1.0) <= threshold)
    w = Window.partitionBy("accession").orderBy(number("reliability_index", -1.0).desc(), number("distance", float("inf")), *[text(c) for c in DONOR])
    # the best donor by a limited window, then its rows: partial limits keep the shuffle small
    best = ok.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("accession", "donor")
    return ok.join(best, ["accession", "donor"], "left_semi").drop("donor")


def filtered_out(raw: DataFrame, threshold: float) -> DataFrame:
    """Rows whose identity is over the cutoff."""
    return raw.withColumn("accession", text("accession")).where(number("identity", -1.0) > threshold)


def no_survivor(raw: DataFrame, threshold: float) -> DataFrame:
    """Accessions all of whose donors are over the cutoff."""
    return raw.groupBy(text("accession").alias("accession")).agg(F.min(number("identity", -1.0)).alias("_least")).where(F.col("_least") > threshold).select("accession")


def selected_donors(selected: DataFrame) -> DataFrame:
    """One row per accession: its donor, the first file that it comes from, and how many rows it brought."""
    origin = [F.min(text("source_file")).alias("source_file")] if "source_file" in selected.columns else []
    return selected.groupBy("accession", *DONOR).agg(*origin, F.count(F.lit(1)).alias("rows_kept_for_selected_donor"))


def counters(raw: DataFrame, threshold: float) -> DataFrame:
    """The eight counters of a cutoff, in one row."""
    d = donors(raw).select("accession", "donor", (number("identity", -1.0) <= threshold).alias("ok"))
    per = d.groupBy("accession", "donor").agg(F.count(F.lit(1)).alias("n"), F.max("ok").alias("ok"))
    of = per.groupBy("accession").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("donors"),
        F.count_if("ok").alias("kept"),
        F.sum(F.when(F.col("ok"), 0).otherwise(F.col("n"))).alias("over"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    first = of.agg(
        F.lit(float(threshold)).alias("identity_threshold"),
        zero(F.sum("n")).alias("input_rows"),
        zero(F.sum("over")).alias("filtered_out_rows"),
        zero(F.count_if(F.col("kept") > 0)).alias("selected_donors"),
        zero(F.count_if(F.col("kept") == 0)).alias("accessions_with_no_surviving_donor"),
        zero(F.sum("donors")).alias("input_donors"),
        zero(F.sum(F.col("donors") - F.col("kept"))).alias("filtered_out_donors"),
    )
    chosen = best_donor_rows(raw, threshold).agg(F.lit(float(threshold)).alias("identity_threshold"), F.count(F.lit(1)).alias("kept_rows"))
    return first.join(chosen, "identity_threshold")
