"""Mixing sources to target shares of tokens (problem 8).

Method: subset-sum budget fitting. Documents are counted by exact token length;
a source's budget is met by whole passes over it, a proportional part of every
length, and a bounded-knapsack dynamic programme over the lengths that are left
for the last tokens. Which documents of a length are taken is decided by a
seeded hash.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from annoweave.runtime import materialise

#: Path of the public tokenizer's ranks; a parameter of :func:`count_tokens`.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the tokenizer's published split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tokens that are left to the dynamic programme, and hash buckets of a length.
LAST, BUCKETS = 32_768, 256


def count_tokens(docs: DataFrame, doc_id: str, text: str, keep: list[str], ranks: str = RANKS) -> DataFrame:
    """(doc_id, kept columns, n_tokens); a null text counts no tokens.

    ``ranks`` is a file of the driver, which is sent to the executors once, or else one that they all have.
    """
    name = os.path.basename(ranks)
    if sent := os.path.exists(ranks):
        docs.sparkSession.sparkContext.addFile(ranks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken
        from pyspark import SparkFiles

        with open(SparkFiles.get(name) if sent else ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoder = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        for pdf in batches:
            n = [len(encoder.encode_ordinary(t)) if t is not None else 0 for t in pdf[text]]
            yield pdf[[doc_id, *keep]].assign(n_tokens=np.array(n, dtype=np.int64))

    schema = docs.select(doc_id, *keep).withColumn("n_tokens", F.lit(0).cast("long")).schema
    return docs.select(doc_id, *keep, text).mapInPandas(run, schema)


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the tokens come closest to ``budget`` from below."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0:
        return np.zeros(len(counts), dtype=np.int64)
    want = counts * (budget / total)
    take = np.floor(want).astype(np.int64)
    rest = budget - int((lengths * take).sum())
    # one more of each length, largest remainder first, until the programme can do the rest
    order = np.argsort(-(want - take), kind="stable")
    while rest > LAST:
        able = order[(take < counts)[order]]
        upto = int(np.searchsorted(np.cumsum(lengths[able]), rest - LAST // 2, side="right"))
        if not upto:
            break
        take[able[:upto]] += 1
        rest = budget - int((lengths * take).sum())
    # bounded knapsack: bit t of ``reach`` says whether t tokens can be had
    reach, full, steps = 1, (1 << (rest + 1)) - 1, []
    left = counts - take
    for i in np.argsort(-left * (lengths <= rest), kind="stable"):
        most = min(int(left[i]), rest // max(1, int(lengths[i])))
        size = 1
        while most > 0 and not reach >> rest & 1:
            n = min(size, most)
            steps.append((i, n, reach))
            reach |= (reach << int(lengths[i]) * n) & full
            most -= n
            size *= 2
        if reach >> rest & 1:
            break
    target = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> target & 1:
            take[i] += n
            target -= int(lengths[i]) * n
    return take


def plan(sized: DataFrame, targets: DataFrame, source: str, total_tokens: int | None = None) -> DataFrame:
    """Per source of ``targets``: share, repeats, what there is, and the budget.

    The total defaults to the most that no source's cap forbids, counted over
    sources that have documents; a source without any gets the budget 0, and the
    shares of the others are raised in proportion.
    """
    have = sized.groupBy(source).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"), F.max("n_tokens").alias("longest"))
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = targets.join(have, source, "left").select(source, "target_share", "max_repeats", *[count(c) for c in ("documents", "tokens", "longest")])
    ready = (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    every = _window()  # the rows are the few sources of the targets
    out = rows.withColumn("_reachable", F.sum(F.when(ready, F.col("target_share"))).over(every)).withColumn("_most", F.min(F.when(ready, F.col("tokens") * F.col("max_repeats") / F.col("target_share"))).over(every))
    # the bound is a total at the given shares; raised shares need the same tokens
    most = F.floor(F.col("_most") * F.col("_reachable"))
    total = F.least(most, F.lit(total_tokens)) if total_tokens is not None else most
    share = F.when(ready, F.col("target_share") / F.col("_reachable")).otherwise(0.0)
    return out.select(source, "target_share", "max_repeats", "documents", "tokens", "longest", share.alias("reachable_share"), F.coalesce(F.floor(total * share + 1e-6), F.lit(0)).cast("long").alias("budget"))


def mixture(docs: DataFrame, doc_id: str, text: str, source: str, targets: DataFrame, total_tokens: int | None = None, seed: int = 1, ranks: str = RANKS) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (doc_id, source, n_tokens, repeats) and the report per source.

    ``targets`` has (source, target_share, max_repeats), one row per source: a
    table whose size does not grow with the documents. Documents of other or
    null sources, with null or empty text or null id take no part. Null caps
    and shares count as 0. Only ids, sources and lengths are shuffled.
    """
    known = targets.select(F.col(source).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))
    wanted = docs.select(F.col(doc_id).alias("doc"), F.col(source).alias("source"), F.col(text).alias("text"))
    wanted = wanted.where((F.length("text") > 0) & F.col("doc").isNotNull()).join(known.select("source"), "source", "left_semi")
    sized = materialise(count_tokens(wanted, "doc", "text", ["source"], ranks).where("n_tokens > 0").withColumn("rank", F.xxhash64("doc", F.lit(seed))), "tokens")
    budgets = materialise(plan(sized, known, "source", total_tokens), "budgets")
    bucket = F.pmod("rank", F.lit(BUCKETS)).alias("bucket")
    # counts by length and hash bucket; a source's lengths are few, however many its documents
    counts = materialise(sized.groupBy("source", "n_tokens", bucket).agg(F.count(F.lit(1)).alias("n")), "counts")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n_tokens", ignore_index=True)
        tokens = int((pdf["n_tokens"] * pdf["n"]).sum())
        budget, cap = int(pdf["budget"].iloc[0]), int(pdf["max_repeats"].iloc[0])
        passes = min(cap, budget // tokens)
        rest = budget - passes * tokens if passes < cap else 0
        take = fit_counts(pdf["n_tokens"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), rest)
        return pdf[["source", "n_tokens"]].assign(passes=passes, take=take)

    lengths = counts.groupBy("source", "n_tokens").agg(F.sum("n").alias("n")).join(budgets.select("source", "max_repeats", "budget"), "source")
    fitted = lengths.groupBy("source").applyInPandas(run, "source string, n_tokens long, passes long, take long")
    # whole buckets before the one in which the count is met
    before = F.sum("n").over(_window("source", "n_tokens").orderBy("bucket").rowsBetween(-(2**31), -1))
    placed = counts.withColumn("before", F.coalesce(before, F.lit(0))).join(fitted, ["source", "n_tokens"])
    cut = placed.select("source", "n_tokens", "bucket", "passes", F.greatest(F.lit(0), F.least("n", F.col("take") - F.col("before"))).alias("more"), "n").where("passes > 0 or more > 0")
    rows = sized.withColumn("bucket", bucket).join(cut, ["source", "n_tokens", "bucket"])
    sure = rows.where("more = 0 or more = n").select("doc", "source", "n_tokens", (F.col("passes") + F.when(F.col("more") > 0, 1).otherwise(0)).alias("repeats"))
    nth = F.row_number().over(_window("source", "n_tokens", "bucket").orderBy("rank", "doc"))
    part = rows.where("more > 0 and more < n").withColumn("nth", nth).select("doc", "source", "n_tokens", (F.col("passes") + F.when(F.col("nth") <= F.col("more"), 1).otherwise(0)).alias("repeats"))
    chosen = sure.union(part).where("repeats > 0").select(F.col("doc").alias(doc_id), "source", "n_tokens", F.col("repeats").cast("long").alias("repeats"))
    used = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("documents_used"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens_used"), F.max("repeats").alias("most_repeats"))
    report = budgets.join(used, "source", "left")
    whole = F.sum("tokens_used").over(_window())  # one row per source of the targets
    report = report.withColumn("actual_share", F.round(F.coalesce(F.col("tokens_used") / whole, F.lit(0.0)), 6)).na.fill(0, ["documents_used", "tokens_used", "most_repeats"])
    return chosen, report


def _window(*cols: str):
    from pyspark.sql import Window

    return Window.partitionBy(*cols)
