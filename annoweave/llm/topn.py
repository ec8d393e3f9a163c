"""Top N items within every group (problem 2).

Method: a mergeable aggregation. Every partition keeps a heap of N items per
group, reduced again whenever enough rows have gathered; only the heaps are
shuffled, and the same reduction merges them. A group with a third of all rows
therefore sends at most N rows per input partition (and flush).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

#: Rows that gather before they are reduced, and heap rows above which a
#: partition passes its heaps on instead of keeping them (bounds memory only).
GATHER, HELD = 200_000, 1_000_000


def _reduce(t: pa.Table, n: int) -> pa.Table:
    """The N best distinct ids of each group; columns group, score, cost, id."""
    if not t.num_rows:
        return t
    group = t["group"].combine_chunks().dictionary_encode()
    group = (group.combine_chunks() if isinstance(group, pa.ChunkedArray) else group).indices.to_numpy()
    score = t["score"].to_numpy()
    cost = t["cost"].to_numpy(zero_copy_only=False).astype(float)  # a null becomes NaN, which sorts last
    key = t["id"].to_numpy()
    order = np.lexsort((key, cost, -score, group))
    g, k = group[order], key[order]
    # an id counts once: equal deliveries are neighbours, others are found by their first place
    first = np.zeros(len(order), dtype=bool)
    first[np.unique(g.astype(np.int64) * (len(k) + 1) + np.unique(k, return_inverse=True)[1], return_index=True)[1]] = True
    order, g = order[first], g[first]
    starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    return t.take(pa.array(order[rank < n]))


def _heaps(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, gathered, rows = None, [], 0
        for b in batches:
            gathered.append(b)
            rows += b.num_rows
            if rows >= GATHER:
                t = pa.Table.from_batches(gathered)
                held = _reduce(t if held is None else pa.concat_tables([held, t]), n)
                gathered, rows = [], 0
                if held.num_rows > HELD:
                    yield from held.combine_chunks().to_batches(10_000)
                    held = None
        parts = [*([held] if held is not None else []), *([pa.Table.from_batches(gathered)] if gathered else [])]
        if parts:
            yield from _reduce(pa.concat_tables(parts), n).combine_chunks().to_batches(10_000)

    return run


def _merge(n: int):
    """The final merge of rows in the order of their groups: groups that are complete are passed on, so memory holds few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, gathered, rows = None, [], 0
        for b in batches:
            gathered.append(b)
            rows += b.num_rows
            if rows >= GATHER:
                t = pa.Table.from_batches(gathered)
                best = _reduce(t if held is None else pa.concat_tables([held, t]), n)
                # the last group may go on in the next batch
                open_ = pa.compute.equal(best["group"], t["group"][t.num_rows - 1])
                yield from best.filter(pa.compute.invert(open_)).combine_chunks().to_batches(10_000)
                held, gathered, rows = best.filter(open_), [], 0
        parts = [*([held] if held is not None else []), *([pa.Table.from_batches(gathered)] if gathered else [])]
        if parts:
            yield from _reduce(pa.concat_tables(parts), n).combine_chunks().to_batches(10_000)

    return run


def top_n(df: DataFrame, group: str, score: str, cost: str, item: str, n: int) -> DataFrame:
    """The ``n`` best items of every group as (group, score, cost, item).

    Order: score descending, then cost ascending with a missing (null or NaN)
    cost after every number, then item id ascending, which makes it total. Rows
    with null or NaN score, null group or null id take no part. An id counts
    once in a group, with its best row. Groups with fewer items give all; an
    empty table or ``n`` below 1 gives no rows. Other columns are not carried.
    """
    slim = df.select(F.col(group).alias("group"), F.col(score).cast("double").alias("score"), F.col(cost).cast("double").alias("cost"), F.col(item).cast("long").alias("id"))
    slim = slim.where(F.col("group").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score") & F.col("id").isNotNull())
    if n < 1:
        return slim.where(F.lit(False)).toDF(group, score, cost, item)
    best = slim.mapInArrow(_heaps(n), slim.schema).repartition("group").sortWithinPartitions("group").mapInArrow(_merge(n), slim.schema)
    return best.toDF(group, score, cost, item)
