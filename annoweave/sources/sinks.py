"""Sinks. All of them overwrite what they wrote before, so a repeated run repeats nothing."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from annoweave.functions.text import accession, safe_name
from annoweave.operators import leakage
from annoweave.schema import RAW


def new_vectors(incoming: DataFrame, stored: DataFrame | None, order: str) -> DataFrame:
    """Incoming vectors not yet stored; of several for one (accession, model, layer) the first by ``order``.

    Accessions take their one-record form first.
    """
    keys = ["accession", "embedding_type_id", "layer_index"]
    rest = [c for c in incoming.columns if c not in (*keys, order)]
    one = incoming.withColumn("accession", accession("accession")).where("accession is not null")
    first = one.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_v")).select(*keys, "_v.*")
    if stored is None:
        return first
    s = stored.select(*keys)
    same = (first["accession"] == s["accession"]) & (first["embedding_type_id"] == s["embedding_type_id"]) & first["layer_index"].eqNullSafe(s["layer_index"])
    return first.join(s, same, "left_anti")


def write_vectors(incoming: DataFrame, path: str, order: str) -> None:
    """Appends new vectors to a table partitioned by model and layer; stored ones stay as they are."""
    spark = incoming.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
    new_vectors(incoming, spark.read.parquet(path) if there else None, order).write.mode("append").partitionBy("embedding_type_id", "layer_index").parquet(path)


def formatted(df: DataFrame, precision: int) -> DataFrame:
    """Floating columns rounded to ``precision`` decimals."""
    return df.select(*[F.round(c, precision).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def write_raw(df: DataFrame, path: str, precision: int = 4, fmt: str = "parquet") -> None:
    """Raw results partitioned by sanitised model name and layer, in the fixed column order."""
    cols = [c for c in RAW.fieldNames() if c in df.columns]
    out = formatted(df.select(*cols), precision).withColumn("model", safe_name("model_name")).withColumn("layer", F.coalesce(F.col("layer_index").cast("string"), F.lit("legacy")))
    writer = out.write.mode("overwrite").partitionBy("model", "layer")
    writer.csv(path, header=True) if fmt == "csv" else writer.parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """The summary as CSV parts in global order of accession and term; the parts' names follow the order."""
    df.orderBy("accession", "go_id").write.mode("overwrite").csv(path, header=True)


def write_topgo(per_model: DataFrame, ensemble: DataFrame, path: str) -> None:
    """Headerless TSVs (accession, term, reliability) by model, layer and category, and by category."""
    row = ["accession", "go_id", "reliability_index"]
    split = ["model_name", "layer", "category"]
    per_model.select(*row, *split).write.mode("overwrite").partitionBy(*split).csv(f"{path}/topgo", sep="\t", header=False)
    ensemble.select(*row, "category").write.mode("overwrite").partitionBy("category").csv(f"{path}/topgo_ensemble", sep="\t", header=False)


def fasta_lines(queries: DataFrame, references: DataFrame) -> DataFrame:
    """``>Q{i}`` records, then ``>R{i}`` records; both inputs are (sequence, idx)."""
    q = queries.select(F.lit(0).alias("side"), "idx", F.concat(F.lit(">Q"), F.col("idx").cast("string"), F.lit("\n"), F.col("sequence")).alias("value"))
    r = references.select(F.lit(1).alias("side"), "idx", F.concat(F.lit(">R"), F.col("idx").cast("string"), F.lit("\n"), F.col("sequence")).alias("value"))
    return q.unionByName(r)


def write_fasta(queries: DataFrame, references: DataFrame, path: str) -> None:
    fasta_lines(queries, references).orderBy("side", "idx").select("value").write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, sep: str = ",") -> None:
    """Mappings, clusters and reports: one delimited table with a header."""
    df.write.mode("overwrite").csv(path, header=True, sep=sep)


def write_merged(df: DataFrame, path: str, add_source_file: bool = False) -> None:
    """Shards as one table with one header in every part, in the order of their files."""
    out = df.orderBy("source_file")
    (out if add_source_file else out.drop("source_file")).write.mode("overwrite").csv(path, header=True)


def write_leakage(raw: DataFrame, path: str, threshold: float) -> None:
    """Selected and filtered rows, donors, accessions without a survivor, and counters of one cutoff."""
    out = f"{path}/global_identity_le_{leakage.label(threshold)}"
    selected = leakage.best_donor_rows(raw, threshold)
    write_table(selected, f"{out}/selected_rows")
    write_table(leakage.filtered_out(raw, threshold), f"{out}/filtered_out_rows")
    write_table(leakage.selected_donors(selected), f"{out}/selected_donors")
    leakage.no_survivor(raw, threshold).orderBy("accession").write.mode("overwrite").text(f"{out}/no_survivor")
    leakage.counters(raw, threshold).write.mode("overwrite").json(f"{out}/summary")


def experiment_name(prefix: str, now: datetime) -> str:
    return f"{prefix}_{now:%Y%m%d%H%M%S}"


def experiment_dir(spark: SparkSession, base: str, prefix: str, conf: Mapping[str, Any], now: datetime | None = None) -> str:
    """Makes ``{prefix}_{timestamp}`` with the effective configuration in it, in any file system that Spark knows."""
    path = f"{base.rstrip('/')}/{experiment_name(prefix, now or datetime.now())}"
    text = json.dumps(conf, indent=1, sort_keys=True, default=str)
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/config.json")
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return path


def latest_experiment(names: DataFrame, prefix: str) -> DataFrame:
    """The latest experiment folder of a prefix, by its timestamp."""
    stamp = F.regexp_extract("name", rf"^{prefix}_(\d{{14}})$", 1)
    return names.where(stamp != "").agg(F.max_by("name", stamp).alias("name"))


def add_manifest(spark: SparkSession, path: str, row: dict[str, Any]) -> None:
    """One more row of the embedding manifest (organism, taxid, model, path, exit, log)."""
    cols = ["organism", "taxid", "model", "path", "exit", "log"]
    spark.createDataFrame([tuple(str(row.get(c, "")) for c in cols)], ", ".join(f"{c} string" for c in cols)).write.mode("append").csv(path, sep="\t")
