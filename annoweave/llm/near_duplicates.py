"""Near-duplicate sequences: candidates from banded samples, exact verification, groups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from annoweave.llm import weighted_sampling as ws
from annoweave.llm.portions import portions
from annoweave.runtime import free, materialise, spread

#: Share of residues that both sequences must share, and the least weighted
#: Jaccard of a candidate that is looked at further.
SHARED, LEAST_WEIGHTED = 0.8, 0.1
#: Distinct texts of a bucket that meet in one task; a larger bucket is split
#: into blocks that meet pairwise in different tasks, so no link is lost.
BUCKET_BLOCK = 512


def _blocks(n: Column) -> Column:
    return F.ceil(n / F.lit(BUCKET_BLOCK)).cast("int")


def candidate_pairs(rows: DataFrame, key: str, left: str | None = None, right: str | None = None) -> DataFrame:
    """Distinct (a, b) of texts that share a bucket.

    ``rows`` has (key, bucket) and, for a join of two sides, the boolean columns
    ``left`` and ``right``; without them a < b over all. Buckets of one text (of
    one side) are dropped before anything meets. Bucket sizes come from a
    pre-aggregated count.
    """
    is_left, is_right = (F.col(left), F.col(right)) if left else (F.lit(True), F.lit(True))
    size = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"), F.count_if(is_left).alias("_l"), F.count_if(is_right).alias("_r"))
    size = size.where((F.col("_n") > 1) & (F.col("_l") > 0) & (F.col("_r") > 0)).select("bucket", _blocks(F.col("_n")).alias("_b"))
    placed = rows.join(size, "bucket").withColumn("_i", F.pmod(F.xxhash64(key), F.col("_b")).cast("int"))
    a = placed.where(is_left).select(F.col(key).alias("a"), "bucket", "_i", F.explode(F.expr("sequence(0, _b - 1)")).alias("_j"))
    b = placed.where(is_right).select(F.col(key).alias("b"), "bucket", F.explode(F.expr("sequence(0, _b - 1)")).alias("_i"), F.col("_i").alias("_j"))
    met = a.join(b, ["bucket", "_i", "_j"])
    met = met.where(F.col("a") != F.col("b")) if left else met.where(F.col("a") < F.col("b"))
    return met.select("a", "b").distinct()


def verified(pairs: DataFrame, a_texts: DataFrame, b_texts: DataFrame, key: str, text: str, idf: ws.Idf, shared: float = SHARED) -> DataFrame:
    """The pairs of which at least ``shared`` of the residues of both are shared, with their weighted Jaccard."""
    held = pairs.sparkSession.sparkContext.broadcast((idf.codes, idf.values, idf.default))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = ws.Idf.__new__(ws.Idf)
        own.codes, own.values, own.default = held.value
        for big in batches:
            for lo, hi in portions(big["ta"].str.len() + big["tb"].str.len(), ws.LETTERS):
                pdf = big.iloc[lo:hi]
                j, x, y = ws.compare(pdf["ta"].tolist(), pdf["tb"].tolist(), own)
                ok = (j >= LEAST_WEIGHTED) & (x >= shared) & (y >= shared)
                yield pdf.loc[ok, ["a", "b"]].assign(weighted_jaccard=j[ok])

    wide = pairs.join(a_texts.select(F.col(key).alias("a"), F.col(text).alias("ta")), "a").join(b_texts.select(F.col(key).alias("b"), F.col(text).alias("tb")), "b")
    return wide.select("a", "b", "ta", "tb").mapInPandas(run, pairs.select("a", "b").withColumn("weighted_jaccard", F.lit(0.0)).schema)


def distinct_texts(members: DataFrame, text: str) -> DataFrame:
    """The distinct texts with a 64-bit key; texts below a shingle's length share nothing and are left out, null ones too."""
    return members.where(F.length(text) >= ws.K).select(text).distinct().withColumn("text_id", F.xxhash64(text))


def _met(texts: DataFrame, text: str, exact: bool, keep: tuple[str, ...] = ()) -> tuple[ws.Idf, DataFrame]:
    """The weights, and (text_id, kept columns, bucket): texts in one bucket are candidates.

    Buckets are bands of samples or, if ``exact``, the shingles themselves: a pair
    that shares residues shares one, so none is missed, at the cost of a row per shingle.
    """
    spread_ = spread(texts, "text_id")
    idf = ws.document_frequencies(spread_, text)
    rows = ws.shingle_rows(spread_, "text_id", text, keep) if exact else ws.sketch(spread_, "text_id", text, idf, keep)
    return idf, materialise(rows, "sketch")


def similar_texts(texts: DataFrame, text: str, exact: bool = False) -> DataFrame:
    """Links (a, b, weighted_jaccard), a < b, between similar distinct texts.

    Texts are upper-case letters; equal texts must have been merged (see
    :func:`distinct_texts`). No texts, no links. Every link comes out, so M texts
    that are all alike give M (M - 1) / 2 rows; :func:`classes` needs no such number.
    Bands miss a pair with the chance that the README states; ``exact`` misses none.
    """
    idf, rows = _met(texts, text, exact)
    return verified(candidate_pairs(rows, "text_id"), texts, texts, "text_id", text, idf)


def classes(texts: DataFrame, text: str, exact: bool = False) -> DataFrame:
    """(text_id, class_id) of every distinct text: the connected classes of the similar ones.

    Every text is first compared with one representative of each of its buckets,
    which joins most of a class by as many comparisons as it has texts. What is
    left are candidates in different classes; all of them are compared. So a pair
    is skipped only if its texts are in one class already.
    """
    idf, rows = _met(texts, text, exact)
    lead = rows.groupBy("bucket").agg(F.min("text_id").alias("a"), F.max("text_id").alias("_last")).where("a < _last").select("bucket", "a")
    star = materialise(rows.join(lead, "bucket").where("text_id != a").select("a", F.col("text_id").alias("b")).distinct(), "stars")
    ok = materialise(verified(star, texts, texts, "text_id", text, idf).select("a", "b"), "links")
    of = texts.select("text_id").join(components(ok).withColumnRenamed("node", "text_id"), "text_id", "left").select("text_id", F.coalesce("component", "text_id").alias("c"))
    mixed = materialise(rows.join(of, "text_id"), "mixed")
    per = mixed.select("bucket", "c").distinct()
    meet = per.join(per.withColumnRenamed("c", "d"), "bucket").where("c < d")
    rest = mixed.join(meet, ["bucket", "c"]).select("bucket", "c", "d", F.col("text_id").alias("x")).join(mixed.select("bucket", F.col("c").alias("d"), F.col("text_id").alias("y")), ["bucket", "d"])
    rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    more = verified(rest, texts, texts, "text_id", text, idf).select("a", "b")
    whole = components(ok.union(more)).withColumnRenamed("node", "text_id")
    return texts.select("text_id").join(whole, "text_id", "left").select("text_id", F.coalesce("component", "text_id").alias("class_id"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; the component is its least node.

    Alternates large-star and small-star rounds over written tables until the
    edges stand still, so a component of any size is never gathered in one task
    beyond the neighbours of one node.
    """
    edges = materialise(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        old, edges = edges, materialise(small, "edges")
        free(old)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def record_pairs(members: DataFrame, links: DataFrame, record: str) -> DataFrame:
    """Distinct pairs of different records whose texts are equal or linked; ``members`` has (record, text_id).

    Records of a text are split into blocks that meet in different tasks, so a
    text that a third of all records hold is no single task.
    """
    m = members.select(F.col(record).alias("x"), "text_id").distinct()
    many = m.groupBy("text_id").agg(_blocks(F.count(F.lit(1))).alias("_b"))
    placed = materialise(m.join(many, "text_id").withColumn("_i", F.pmod(F.xxhash64("x"), F.col("_b")).cast("int")), "records")
    same = candidate_pairs(m.withColumnRenamed("text_id", "bucket"), "x")
    ends = placed.select("text_id", "_b").distinct()
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cross = links.select("a", "b").join(ends.toDF("a", "_p"), "a").join(ends.toDF("b", "_q"), "b").select("a", "b", each("_p").alias("_i"), "_q").withColumn("_j", each("_q"))
    cross = cross.join(placed.select(F.col("text_id").alias("a"), "_i", "x"), ["a", "_i"]).join(placed.select(F.col("text_id").alias("b"), F.col("_i").alias("_j"), F.col("x").alias("y")), ["b", "_j"])
    cross = cross.where("x != y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return same.union(cross).distinct().toDF(f"{record}_a", f"{record}_b")
