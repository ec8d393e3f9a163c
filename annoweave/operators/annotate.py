"""From hits to raw results: annotations, sequences, indexes, scores, alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from annoweave.functions.align import alignment
from annoweave.functions.vectors import reliability
from annoweave.runtime import materialise, spread


def expand(hits: DataFrame, annotations: DataFrame) -> DataFrame:
    """One row per hit and annotation of its sequence; hits without annotation go."""
    return hits.join(annotations.withColumnRenamed("sequence_id", "ref_sequence_id"), "ref_sequence_id")


def model_names(df: DataFrame, models: DataFrame) -> DataFrame:
    return df.join(models.select(F.col("id").cast("long").alias("embedding_type_id"), F.col("name").alias("model_name")).distinct(), "embedding_type_id", "left")


def threshold_map(df: DataFrame, thresholds: dict[str, float | None]) -> DataFrame:
    """``distance_threshold`` by model name; null where a model has none. A literal map, so no join."""
    on = {m: t for m, t in thresholds.items() if t is not None}
    if not on:
        return df.withColumn("distance_threshold", F.lit(None).cast("double"))
    pairs = F.create_map(*[F.lit(x) for m, t in sorted(on.items()) for x in (m, float(t))])
    return df.withColumn("distance_threshold", F.try_element_at(pairs, F.col("model_name")))


def sequences_of(df: DataFrame, queries: DataFrame, references: DataFrame) -> DataFrame:
    """Left joins of the query's and the reference's sequence and their lengths; null where unknown."""
    q = queries.where("accession is not null").groupBy("accession").agg(F.min("sequence").alias("sequence_query"))
    r = references.where("id is not null").groupBy(F.col("id").alias("ref_sequence_id")).agg(F.min("sequence").alias("sequence_reference"))
    out = df.join(q, "accession", "left").join(r, "ref_sequence_id", "left")
    return out.withColumn("query_len", F.length("sequence_query").cast("long")).withColumn("ref_len", F.length("sequence_reference").cast("long"))


def scored(df: DataFrame, metric: str) -> DataFrame:
    return df.withColumn("reliability_index", reliability("distance", metric)).withColumn("distance_metric", F.lit(metric))


def sequence_index(df: DataFrame, sequence: str, order: str) -> DataFrame:
    """(sequence, idx): dense numbers from 0 in the order of each sequence's least ``order`` value, then by text.

    Numbers are dense without one task holding all rows: ranges are sorted and
    counted apart, and a range's offset is the sum of the counts before it.
    """
    first = df.where(F.col(sequence).isNotNull()).groupBy(sequence).agg(F.min(order).alias("_first"))
    return dense_numbers(first, ["_first", sequence]).select(sequence, F.col("idx"))


def dense_numbers(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``idx`` 0, 1, 2, … in the order of unique ``keys``."""
    sorted_ = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(sorted_.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "numbers")
    # one row per partition
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("_before", before).select("_part", "_before")
    # the low 33 bits of a monotonically increasing id count the rows of a partition
    return placed.join(offsets, "_part").withColumn("idx", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_at", "_before")


def mapping(numbers: DataFrame) -> DataFrame:
    """Of (accession, sequence, idx): (query_idx, query_fasta_id, accessions, sequence_length), the accessions sorted and joined by ;."""
    per = numbers.groupBy("idx").agg(F.concat_ws(";", F.array_sort(F.collect_set("accession"))).alias("accessions"), F.max(F.length("sequence")).cast("long").alias("sequence_length"))
    return per.select(F.col("idx").alias("query_idx"), F.concat(F.lit("Q"), F.col("idx").cast("string")).alias("query_fasta_id"), "accessions", "sequence_length")


def query_mapping(index: DataFrame, queries: DataFrame) -> DataFrame:
    """The mapping of queries (accession, sequence) by an index (sequence, idx); sequences meet by their hash."""
    q = queries.where("sequence is not null and accession is not null").select("accession", "sequence").distinct().withColumn("_h", F.xxhash64("sequence"))
    i = index.select(F.xxhash64("sequence").alias("_h"), F.col("sequence").alias("_s"), "idx")
    return mapping(q.join(i, "_h").where("sequence <=> _s"))


def distinct_pairs(df: DataFrame) -> DataFrame:
    """The distinct (sequence_query, sequence_reference) with both present: what is aligned, whatever model or layer met them."""
    return df.where("sequence_query is not null and sequence_reference is not null").select("sequence_query", "sequence_reference").distinct()


def numbered(rows: DataFrame, key: str, sequence: str, idx: str) -> DataFrame:
    """``rows`` (one per key) with the dense number of their sequence, null where it is missing.

    Sequences are joined by a 64-bit hash and then compared, so the long texts are no join key.
    """
    index = sequence_index(rows, sequence, key).select(F.xxhash64(sequence).alias("_h"), F.col(sequence).alias("_s"), F.col("idx").alias(idx))
    both = rows.withColumn("_h", F.xxhash64(sequence)).join(index, "_h", "left")
    return both.where(F.col("_s").eqNullSafe(F.col(sequence))).drop("_h", "_s")


def aligned(df: DataFrame, keys: tuple[str, str] = ("query_idx", "ref_idx")) -> DataFrame:
    """The rows with the twelve alignment metrics, null where a sequence is missing.

    ``keys`` number the distinct sequences of either side. Each distinct pair of
    numbers is aligned once, and the metrics are joined back by the numbers.
    """
    pairs = df.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()).select(*keys, "sequence_query", "sequence_reference").dropDuplicates(list(keys))
    pairs = spread(pairs, *keys).withColumn("_m", alignment("sequence_query", "sequence_reference"))
    return df.join(pairs.select(*keys, "_m.*"), list(keys), "left")
