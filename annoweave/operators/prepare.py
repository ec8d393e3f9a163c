"""Preparing sequences and models for embedding and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def truncated(sequence: Column | str, most: object) -> Column:
    """The first ``most`` residues; anything but a positive int switches truncation off."""
    col = F.col(sequence) if isinstance(sequence, str) else sequence
    return F.substring(col, 1, most) if isinstance(most, int) and not isinstance(most, bool) and most > 0 else col


def enabled_models(models: DataFrame, wanted: dict[str, list[int]]) -> DataFrame:
    """(embedding_type_id, model_name, layer_index) of the wanted models; names match in any case.

    ``wanted`` maps a model name to its layers. If several table rows match a
    name, the least id counts.
    """
    spark = models.sparkSession
    rows = [(name.strip().lower(), k) for name, ks in wanted.items() for k in sorted({int(x) for x in ks})]
    want = spark.createDataFrame(rows, "low string, layer_index int")
    own = models.groupBy(F.lower(F.trim("name")).alias("low")).agg(F.min_by(F.struct("id", "name"), "id").alias("m"))
    return own.join(want, "low").select(F.col("m.id").alias("embedding_type_id"), F.col("m.name").alias("model_name"), "layer_index")


def tasks(sequences: DataFrame, models: DataFrame) -> DataFrame:
    """Every sequence for every enabled model and layer. The model side has one row per model and layer, a list from the configuration."""
    return sequences.where("accession is not null and sequence is not null").crossJoin(F.broadcast(models))


def in_layers(vectors: DataFrame, wanted: dict[int, list[int]]) -> DataFrame:
    """Vectors of the listed models; a model with an empty list keeps all its layers, legacy ones too."""
    ok = F.lit(False)
    for model, ks in wanted.items():
        here = F.col("embedding_type_id") == model
        ok = ok | (here & F.col("layer_index").isin(ks) if ks else here)
    return vectors.where(F.coalesce(ok, F.lit(False)))


def effective_layers(available: DataFrame, wanted: dict[int, list[int]]) -> DataFrame:
    """Wanted layers that occur, per model; ``available`` is of reference.available_layers."""
    rows = [(m, [int(x) for x in ks]) for m, ks in wanted.items()]
    want = available.sparkSession.createDataFrame(rows, "embedding_type_id int, wanted array<int>")
    return available.join(want, "embedding_type_id").select("embedding_type_id", F.array_sort(F.array_intersect("wanted", "layers")).alias("layers"))


def all_sequences(references: DataFrame, queries: DataFrame) -> DataFrame:
    """Both sides' sequences with a ``side`` (r or q), as input of the clustering. Rows may repeat."""
    r = references.select(F.col("id").cast("string").alias("identifier"), "sequence", F.lit("r").alias("side"))
    q = queries.select(F.col("accession").alias("identifier"), "sequence", F.lit("q").alias("side"))
    return r.unionByName(q).where("identifier is not null and sequence is not null")


def checked_tasks(df: DataFrame) -> DataFrame:
    """Stops the job if a vector to be stored lacks one of its four keys."""
    need = ["accession", "embedding_type_id", "sequence", "embedding"]
    ok = F.assert_true(F.lit(True))
    for c in need:
        ok = F.coalesce(ok, F.assert_true(F.col(c).isNotNull(), F.lit(f"a vector without {c}")))
    return df.withColumn("_ok", ok).where(F.col("_ok").isNull()).drop("_ok")
