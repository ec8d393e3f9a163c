"""Filling fixed-capacity batches with sequences (problem 4).

Method: vector bin packing by the dot-product heuristic. An item asks for
tokens, one segment and loss-bearing tokens; a batch has a limit on each. The
open batch takes, again and again, the fitting item whose demand has the largest
dot product with the room that is left (all in shares of the limits).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from annoweave.runtime import materialise, spread

#: Items of a packing block. A block wastes at most about one part-filled batch.
BLOCK = 8192


def pack(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: int) -> np.ndarray:
    """Batch number of each item; every item must fit an empty batch by itself."""
    kinds, kind_of = np.unique(np.stack([tokens, loss], 1), axis=0, return_inverse=True)
    kind_of = kind_of.ravel()
    by_kind = np.argsort(kind_of, kind="stable")
    starts = np.searchsorted(kind_of[by_kind], np.arange(len(kinds)))
    left = np.bincount(kind_of, minlength=len(kinds))
    t, ls = kinds[:, 0].astype(float), kinds[:, 1].astype(float)
    gone = np.zeros(len(kinds), dtype=np.int64)
    out = np.empty(len(tokens), dtype=np.int64)
    alive = np.arange(len(kinds))
    placed, batch = 0, -1
    room = (0.0, 0, 0.0)
    while placed < len(tokens):
        at, al = t[alive], ls[alive]
        ok = (at <= room[0]) & (al <= room[2]) if room[1] else np.zeros(len(alive), dtype=bool)
        if not ok.any():
            batch += 1
            room = (float(capacity), max_segments, float(max_loss))
            alive = alive[left[alive] > 0]
            continue
        score = np.where(ok, at * (room[0] / capacity**2) + al * (room[2] / max_loss**2), -1.0)
        k = alive[int(np.argmax(score))]
        out[by_kind[starts[k] + gone[k]]] = batch
        gone[k] += 1
        left[k] -= 1
        placed += 1
        room = (room[0] - t[k], room[1] - 1, room[2] - ls[k])
        if not left[k]:
            alive = alive[alive != k]
    return out


def cut_items(items: DataFrame, keys: list[str], sequence: str, capacity: str) -> DataFrame:
    """Items with sizes; one longer than ``capacity`` is cut into full chunks and a rest.

    Loss-bearing tokens are determined residues (all but ``X``). Equal items
    (same keys, same residues) count once, whatever their layout; null sequences
    and such without residues, and null or non-positive capacities, give no item.
    Only sizes and a hash are shuffled, never sequences.
    """
    text = F.upper(F.regexp_replace(F.col(sequence), r"[^A-Za-z]", ""))
    chunk = F.expr("substring(_text, int(_i * _cap) + 1, int(_cap))")
    sized = (
        items.select(*keys, text.alias("_text"), F.col(capacity).cast("long").alias("_cap"))
        .where((F.length("_text") > 0) & (F.col("_cap") > 0))
        .withColumn("_id", F.xxhash64("_text"))
        .withColumn("_i", F.explode(F.expr("sequence(0L, (length(_text) - 1) div _cap)")))
        .select(
            *keys,
            F.col("_id").alias("content_id"),
            F.col("_i").alias("chunk_no"),
            F.length(chunk).cast("long").alias("tokens"),
            F.length(F.regexp_replace(chunk, "X", "")).cast("long").alias("loss_tokens"),
            F.col("_cap").alias("capacity"),
        )
    )
    return sized.distinct()


def fill_batches(sized: DataFrame, group: str, max_segments: int = 256, loss_share: float = 1.0) -> DataFrame:
    """``sized`` (see :func:`cut_items`) with ``batch_block`` and ``batch_no``.

    A batch is one (group, batch_block, batch_no). Groups are spread over blocks
    of about 8192 items by a hash, so a group with a third of all rows is packed
    by many tasks; no batch mixes groups. ``max_segments`` and ``loss_share``
    (of the capacity) are the other two limits; a chunk with more loss-bearing
    tokens than the limit gets a batch of its own, and the others keep it. An empty table gives
    no rows.
    """
    sized = materialise(sized, "items")
    blocks = sized.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("_blocks"))
    rest = [c for c in sized.columns if c != group]
    placed = sized.join(blocks, group).withColumn("batch_block", F.pmod(F.xxhash64(*[F.col(c) for c in rest]), F.col("_blocks"))).drop("_blocks")
    # a block is costly and small, so blocks are not merged into few tasks by their bytes
    placed = spread(placed, group, "batch_block")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(rest, ignore_index=True)
        cap = int(pdf["capacity"].iloc[0])
        most = max(int(cap * loss_share), 1)
        tokens, loss = pdf["tokens"].to_numpy(), pdf["loss_tokens"].to_numpy()
        alone = loss > most
        batch = np.empty(len(pdf), dtype=np.int64)
        batch[~alone] = pack(tokens[~alone], loss[~alone], cap, max(1, max_segments), most)
        batch[alone] = np.arange(alone.sum()) + (batch[~alone].max() + 1 if not alone.all() else 0)
        pdf["batch_no"] = batch
        return pdf

    schema = placed.withColumn("batch_no", F.lit(0).cast("long")).schema
    return placed.groupBy(group, "batch_block").applyInPandas(run, schema)


def batch_sums(batches: DataFrame, group: str) -> DataFrame:
    """Per batch: its items, tokens, loss-bearing tokens, and capacity."""
    sums = [F.count(F.lit(1)).alias("segments"), F.sum("tokens").alias("tokens"), F.sum("loss_tokens").alias("loss_tokens"), F.max("capacity").alias("capacity")]
    return batches.groupBy(group, "batch_block", "batch_no").agg(*sums)


def fill_report(batches: DataFrame, group: str) -> DataFrame:
    """Per group: batches, items, tokens, room used and the least number of batches possible."""
    return (
        batch_sums(batches, group)
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("batches"),
            F.sum("segments").alias("items"),
            F.sum("tokens").alias("tokens"),
            F.max("capacity").alias("capacity"),
        )
        .withColumn("least_batches", F.ceil(F.col("tokens") / F.col("capacity")))
        .withColumn("fill", F.round(F.col("tokens") / (F.col("batches") * F.col("capacity")), 4))
    )


def fill_limits(batches: DataFrame, group: str, max_segments: int, loss_share: float, slack: float) -> DataFrame:
    """Per group what was packed, and whether every limit holds.

    ``full`` says that there are at most two batches a block, and the share
    ``slack``, above the least number that any of the three limits allows.
    """
    sums = batch_sums(batches, group)
    alone = F.col("segments") == 1
    most = F.greatest(F.floor(F.col("capacity") * F.lit(float(loss_share))), F.lit(1))
    least = F.greatest(F.ceil(F.sum("tokens") / F.max("capacity")), F.ceil(F.sum("segments") / F.lit(max_segments)), F.ceil(F.sum("loss_tokens") / F.max(most)))
    distinct = batches.groupBy(group).agg(F.countDistinct("accession", "content_id", "chunk_no").alias("distinct_items"))
    return (
        sums.groupBy(group)
        .agg(
            F.sum("segments").alias("items"),
            F.sum("tokens").alias("tokens"),
            F.sum("loss_tokens").alias("loss_tokens"),
            F.min(F.col("tokens") <= F.col("capacity")).alias("within_capacity"),
            F.min(F.col("segments") <= max_segments).alias("within_segments"),
            F.min((F.col("loss_tokens") <= most) | alone).alias("within_loss"),
            (F.count(F.lit(1)) <= least * F.lit(1 + slack) + 2 * F.countDistinct("batch_block")).alias("full"),
        )
        .join(distinct, group)
    )
