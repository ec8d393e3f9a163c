"""Search over a stream of query vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from annoweave import schema
from annoweave.operators import knn


def vector_stream(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    """New parquet files of query vectors as they arrive."""
    return spark.readStream.schema(schema.QUERY_VECTORS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def search_stream(queries: DataFrame, references: DataFrame, out: str, checkpoint: str, k: int = 1, metric: str = "cosine", threshold: float | None = None) -> StreamingQuery:
    """Hits of every micro-batch, written under its batch number.

    Micro-batches take the place of a broker's queue: each is searched against
    the same reference by blocks, and a batch that is delivered again overwrites
    its own folder, so nothing is counted twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        hits = knn.blocked(batch, references, k=k, metric=metric, threshold=threshold)
        hits.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return queries.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sequence_batches(sequences: DataFrame, size: int) -> DataFrame:
    """Sequences per batch for an embedder fed in portions: a hash spreads them, no order is kept."""
    n = max(1, -(-sequences.count() // max(1, size)))
    return sequences.withColumn("batch", F.pmod(F.xxhash64("accession"), F.lit(n)))
