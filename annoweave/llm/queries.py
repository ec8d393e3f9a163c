"""Queries of the nine problems over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from annoweave.functions.text import accession, letters, source_name, split_name
from annoweave.llm import boundaries, forest, mixture, near_duplicates, packing, quality, split_overlap, topn, winnowing
from annoweave.operators import knn
from annoweave.runtime import materialise, table

PAIR = ["accession", "embedding_type_id"]


def _with_limits(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "query_embedding").select(accession("accession").alias("accession"), F.col("embedding_type_id").cast("long").alias("embedding_type_id"), "sequence")
    m = table(spark, d, "model_limits").withColumn("embedding_type_id", F.col("embedding_type_id").cast("long"))
    return q.where(F.col("sequence").isNotNull() & F.col("accession").isNotNull()).join(m, "embedding_type_id")


def _split(spark: SparkSession, d: str) -> DataFrame:
    return boundaries.split_oversized(_with_limits(spark, d), PAIR, "sequence", "piece_limit", "piece_overlap")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return boundaries.boundary_rows(_split(spark, d), PAIR)


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return boundaries.pieces(_split(spark, d), PAIR)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_results").select(accession("accession").alias("accession"), "reliability_index", "distance", "result_id")
    return topn.top_n(r, "accession", "reliability_index", "distance", "result_id", 5).select("accession", "result_id")


def _references(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (ref_idx, text); the rows are made distinct before any text is rewritten."""
    r = table(spark, d, "raw_results").where(F.col("ref_idx").isNotNull() & F.col("sequence_reference").isNotNull())
    return r.select("ref_idx", F.col("sequence_reference").alias("text")).distinct().select("ref_idx", letters("text").alias("text")).distinct()


def _distinct_references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Members (ref_idx, text, text_id) and the distinct texts; shorter ones than a shingle share nothing."""
    refs = materialise(_references(spark, d).where(F.length("text") >= 8).withColumn("text_id", F.xxhash64("text")), "refs")
    return refs, materialise(near_duplicates.distinct_texts(refs, "text"), "texts")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    refs, texts = _distinct_references(spark, d)
    return near_duplicates.record_pairs(refs, materialise(near_duplicates.similar_texts(texts, "text"), "links"), "ref_idx")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every (ref_idx, text) with its group, named by the least key of its texts; a key is the MD5 of the letters."""
    refs, texts = _distinct_references(spark, d)
    of = near_duplicates.classes(texts, "text")
    keyed = of.join(texts.select("text_id", F.md5("text").alias("text_key")), "text_id")
    named = keyed.groupBy("class_id").agg(F.min("text_key").alias("group_key"), F.count(F.lit(1)).alias("group_texts"))
    return refs.select("ref_idx", "text_id").join(keyed, "text_id").join(named, "class_id").select("ref_idx", "text_key", "group_key", "group_texts")


def _held_out(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (accession, split, source) of evaluation splits."""
    s = table(spark, d, "query_split").select(accession("accession").alias("accession"), split_name("split").alias("split"), source_name("source").alias("source"))
    return s.where(F.col("split").isin("test", "validation") & F.col("accession").isNotNull()).distinct()


def _overlap_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Records (accession, text) of evaluation splits and (ref_idx, text) of the training material, with their hashes."""
    wanted = _held_out(spark, d).select("accession").distinct()
    q = table(spark, d, "raw_results").where(F.col("sequence_query").isNotNull()).select(accession("accession").alias("accession"), F.col("sequence_query").alias("text")).distinct()
    q = q.join(wanted, "accession", "left_semi").select("accession", letters("text").alias("text")).distinct()
    return materialise(split_overlap.hashed(q, "text"), "evaluation"), materialise(split_overlap.hashed(_references(spark, d), "text"), "training")


def _overlaps(q: DataFrame, r: DataFrame) -> DataFrame:
    """Distinct (accession, ref_idx): equal records of eight letters or more, and similar ones."""
    q, r = (x.where(F.length("text") >= 8) for x in (q, r))
    sides = q.select("text_id", "text", F.lit(True).alias("l")).union(r.select("text_id", "text", F.lit(False)))
    texts = materialise(sides.groupBy("text_id", "text").agg(F.max("l").alias("evaluation"), F.max(~F.col("l")).alias("training")), "texts")
    near = split_overlap.near_overlaps(texts, "text", "evaluation", "training")
    near = near.join(q.select("accession", F.col("text_id").alias("a")), "a").join(r.select("ref_idx", F.col("text_id").alias("b")), "b").select("accession", "ref_idx")
    return split_overlap.exact_overlaps(q, r, ["accession", "ref_idx"]).union(near).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(*_overlap_sides(spark, d))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Per split and source: held-out accessions, those found in training exactly (in any length), and exactly or almost."""
    q, r = _overlap_sides(spark, d)
    exact = split_overlap.exact_overlaps(q, r, ["accession", "ref_idx"]).withColumn("exact", F.lit(True))
    both = exact.union(_overlaps(q, r).withColumn("exact", F.lit(False))).groupBy("accession", "ref_idx").agg(F.max("exact").alias("exact"))
    leaks = both.groupBy("accession").agg(F.max("exact").alias("exact"), F.count(F.lit(1)).alias("references"))
    out = _held_out(spark, d).join(leaks, "accession", "left")
    return out.groupBy("split", "source").agg(
        F.countDistinct("accession").alias("accessions"),
        F.countDistinct(F.when(F.col("exact"), F.col("accession"))).alias("exact_accessions"),
        F.countDistinct(F.when(F.col("references") > 0, F.col("accession"))).alias("overlapping_accessions"),
        F.coalesce(F.sum("references"), F.lit(0)).alias("overlaps"),
    )


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return packing.cut_items(_with_limits(spark, d), PAIR, "sequence", "batch_capacity")


def p4_batches(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_batches(_sized(spark, d), "embedding_type_id")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p4_batches(spark, d), "embedding_type_id")


#: Runs that p4_limits checks: most segments of a batch, loss-bearing tokens as a
#: share of the capacity, slack. In the second the limits on loss and segments bind before the capacity.
PACKINGS = {"capacity": (256, 1.0, 0.0), "all": (24, 0.9, 0.1)}


def p4_limits(spark: SparkSession, d: str) -> DataFrame:
    """Whether the batches keep every limit, hold every item once, and are nearly as few as can be."""
    sized = _sized(spark, d)
    each = [packing.fill_limits(packing.fill_batches(sized, "embedding_type_id", n, share), "embedding_type_id", n, share, slack).withColumn("run", F.lit(name)) for name, (n, share, slack) in PACKINGS.items()]
    return reduce(DataFrame.unionByName, each)


#: Of the searches that are no pN_found every vector with an id divisible by this is a query, against all vectors.
ASKED = 20


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "query_embedding").where(F.col("vec_id").isNotNull() & F.col("embedding_type_id").isNotNull())
    # of several deliveries of a vec_id the latest counts
    at = F.coalesce(F.col("created_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    q = q.select("vec_id", *[F.col(c).cast("long").alias(c) for c in ("embedding_type_id", "layer_index")], "embedding", at.alias("at"))
    return forest.usable(q, "embedding_type_id", "embedding")


SPACE = ["embedding_type_id", "layer_index"]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    near = forest.nearest(_vectors(spark, d), "vec_id", SPACE, "embedding", 5, least=0.9, order=F.col("at"))
    return near.select(F.least("vec_id", "neighbour").alias("vec_id_a"), F.greatest("vec_id", "neighbour").alias("vec_id_b")).distinct()


def p5_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The five most similar vectors of every vector whose id is divisible by 20, among all."""
    return forest.nearest(_vectors(spark, d), "vec_id", SPACE, "embedding", 5, asked=F.col("vec_id") % ASKED == 0, order=F.col("at"))


def p5_exact(spark: SparkSession, d: str) -> DataFrame:
    """The same by exact search in blocks."""
    v = _vectors(spark, d)
    latest = v.groupBy("vec_id").agg(F.max_by(F.struct(*SPACE, "embedding"), F.struct("at", F.xxhash64("embedding"))).alias("v")).select("vec_id", "v.*")
    asked = latest.where(F.col("vec_id") % ASKED == 0).withColumn("accession", F.col("vec_id").cast("string"))
    # one more than wanted, since every vector is its own nearest or one of its copies
    hits = knn.blocked(asked, latest.withColumnRenamed("vec_id", "sequence_id"), 6)
    hits = hits.select(F.col("accession").cast("long").alias("vec_id"), F.col("ref_sequence_id").alias("neighbour"), F.round(1 - F.col("distance"), 6).alias("similarity")).where("vec_id != neighbour")
    first = Window.partitionBy("vec_id").orderBy(F.col("similarity").desc(), "neighbour")
    return hits.withColumn("_rn", F.row_number().over(first)).where("_rn <= 5").drop("_rn")


def p5_recall(spark: SparkSession, d: str) -> DataFrame:
    """Recall of p5_neighbours against p5_exact per model and layer."""
    mine = p5_neighbours(spark, d).select("vec_id", "neighbour", F.lit(1).alias("hit"))
    both = p5_exact(spark, d).join(mine, ["vec_id", "neighbour"], "left")
    space = _vectors(spark, d).select("vec_id", *SPACE).distinct()
    out = both.join(space, "vec_id").groupBy(*SPACE).agg(F.countDistinct("vec_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"), F.count("hit").alias("found"))
    return out.withColumn("recall", F.round(F.col("found") / F.col("neighbours"), 4))


def p5_recall_reached(spark: SparkSession, d: str) -> DataFrame:
    return p5_recall(spark, d).select(*SPACE, "queries", "neighbours", (F.col("recall") >= 0.9).alias("recall_at_least_90_percent"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return winnowing.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_passages"), "item_id", "passage")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Per evaluation item: the documents that give it away and the longest span."""
    hit = _leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("span").alias("longest_span"))
    items = table(spark, d, "eval_passages").select("item_id", "suite", "split")
    return items.join(hit, "item_id", "left").select("item_id", "suite", "split", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("longest_span", F.lit(0)).alias("longest_span"))


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", "text", source_name("source").alias("source"))
    targets = table(spark, d, "mix_targets").select(source_name("source").alias("source"), "target_share", "max_repeats")
    return mixture.mixture(docs, "doc_id", "text", "source", targets)


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[0]


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[1]


def p8_limits(spark: SparkSession, d: str) -> DataFrame:
    """Whether every source keeps its budget and cap and reaches its share of the whole."""
    r = p8_report(spark, d)
    # no subset of few documents need come nearer than the longest of them is long
    longest = F.coalesce("longest", F.lit(0))
    near = F.abs(F.col("actual_share") - F.col("reachable_share")) <= F.greatest(F.lit(0.001), F.coalesce(F.try_divide(longest, F.sum("tokens_used").over(Window.partitionBy())), F.lit(0.0)))
    return r.select(
        "source",
        "target_share",
        "max_repeats",
        "documents",
        F.round("reachable_share", 6).alias("reachable_share"),
        # within a thousandth or, of a source of few documents, within the length of one
        F.col("tokens_used").between(F.col("budget") - F.greatest(F.lit(0.001) * F.col("budget"), longest), F.col("budget")).alias("budget_met"),
        (F.col("most_repeats") <= F.col("max_repeats")).alias("cap_kept"),
        near.alias("share_reached"),
    )


def p9_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "common_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_quality(spark, d).where(~F.col("is_prose")).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        p1_found,
        p1_pieces,
        p2_found,
        p3_found,
        p3_groups,
        p4_batches,
        p4_report,
        p4_limits,
        p5_found,
        p5_neighbours,
        p5_exact,
        p5_recall,
        p5_recall_reached,
        p6_found,
        p6_report,
        p7_found,
        p7_report,
        p8_mixture,
        p8_report,
        p8_limits,
        p9_found,
        p9_quality,
    )
    return {f.__name__: f for f in every}
