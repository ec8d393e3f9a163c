"""Which input records were embedded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def report(inputs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(accession, embedded yes/no) of the distinct inputs."""
    have = vectors.where("accession is not null").select("accession").distinct().withColumn("_have", F.lit(True))
    out = inputs.where("accession is not null").select("accession").distinct().join(have, "accession", "left")
    return out.select("accession", F.when(F.col("_have"), "yes").otherwise("no").alias("embedded"))


def missing(inputs: DataFrame, vectors: DataFrame) -> DataFrame:
    return inputs.where("accession is not null").select("accession").distinct().join(vectors.select("accession"), "accession", "left_anti")


def counts(rep: DataFrame) -> DataFrame:
    """One row: inputs, embedded, missing."""
    yes = F.count_if(F.col("embedded") == "yes")
    return rep.agg(F.count(F.lit(1)).alias("total"), yes.alias("embedded"), (F.count(F.lit(1)) - yes).alias("missing"))
