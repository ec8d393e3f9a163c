"""Exact k nearest reference vectors of every query vector, per model and layer.

Query blocks meet reference blocks in a grid: each cell is one matrix product,
and the best k of a query are kept as reference blocks pass. The grid never
broadcasts either side and multiplies neither on its way, so it stands at any
size; work is |Q| x |R| per model and layer, as exact search is. Two kernels
with one result: ``blocked`` (single precision chooses, double decides) and
``declarative`` (double alone).

Common rules: null layers are a layer of their own; vectors that are null,
empty, all zero, hold non-finite numbers or differ in length from the other side
never match; distances are rounded to 10 decimals before they are ranked, and
ties go to the smaller reference id; a threshold applies before the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from annoweave.functions import vectors as V
from annoweave.runtime import free, materialise, width

QUERY_BLOCK, REFERENCE_BLOCK = 4096, 8192
SPACE = ["embedding_type_id", "layer_index"]
_SCHEMA = "accession string, ref_sequence_id long, distance double, embedding_type_id int, layer_index int"


def _usable(df: DataFrame, key: str) -> DataFrame:
    """(key, space, vector, dimension); a key stored twice under a model and layer counts once."""
    slim = df.select(F.col(key).alias("key"), F.col("embedding_type_id").cast("int").alias("embedding_type_id"), F.col("layer_index").cast("int").alias("layer_index"), F.col("embedding").alias("v"))
    slim = slim.where(F.col("key").isNotNull() & F.col("embedding_type_id").isNotNull() & V.is_vector("v"))
    return slim.withColumn("dim", F.size("v"))


def _space(layer: str = "layer_index"):
    return F.coalesce(F.col(layer), F.lit(-1))


def _limit(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("accession", "embedding_type_id", F.coalesce("layer_index", F.lit(-1))).orderBy("distance", "ref_sequence_id")
    return hits.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= k).drop("_rn")


def _least(d: np.ndarray, k: int) -> np.ndarray:
    """Per row a number that ``k`` of its distances do not exceed: the k-th least, or a little more."""
    groups = d.shape[1] // 32
    if groups >= 8 * k:  # the k-th of the groups' least is enough, and partitioning whole rows costs more than their product
        least = d[:, :groups].copy()
        for i in range(1, 32):
            np.minimum(least, d[:, i * groups : (i + 1) * groups], out=least)
        d = least
    take = min(k, d.shape[1])
    return np.partition(d, take - 1, axis=1)[:, take - 1 : take]


def _candidates(distances, n: int, hidden: tuple[np.ndarray, np.ndarray] | None, k: int, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of all that are as near as the ``k`` nearest of their row, give or take ``margin``.

    ``distances`` gives those of some rows (a slice) to all columns; ``hidden`` are the (rows, columns), by row, of pairs that must not meet.
    """
    rows, cols, dist = [], [], []
    for lo in range(0, n, 128):
        d = distances(slice(lo, lo + 128))
        if hidden is not None:
            here = slice(*np.searchsorted(hidden[0], [lo, lo + 128]))
            d[hidden[0][here] - lo, hidden[1][here]] = np.inf
        row, col = np.divmod(np.flatnonzero(d <= _least(d, k) + d.dtype.type(margin)), d.shape[1])
        near = d[row, col]
        fine = np.isfinite(near)
        rows.append(row[fine] + lo)
        cols.append(col[fine])
        dist.append(near[fine])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dist)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _near_cosine(a: np.ndarray, b: np.ndarray, hidden: tuple[np.ndarray, np.ndarray] | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of the candidates for the ``k`` nearest of every row.

    A product in single precision with a bound on its error chooses them; their
    distances are then computed in double precision.
    """
    a, b = _unit(a), _unit(b)
    high, low = -a.astype(np.float32), b.astype(np.float32).T.copy()
    row, col, _ = _candidates(lambda some: high[some] @ low, len(a), hidden, k, 2.4e-7 * (a.shape[1] + 8))
    exact = np.empty(len(row))
    for lo in range(0, len(row), 20_000):
        exact[lo : lo + 20_000] = 1 - np.einsum("ij,ij->i", a[row[lo : lo + 20_000]], b[col[lo : lo + 20_000]])
    return row, col, exact


def _near_cosine_double(a: np.ndarray, b: np.ndarray, hidden: tuple[np.ndarray, np.ndarray] | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by a product in double precision alone."""
    a, bt = _unit(a), _unit(b).T.copy()
    return _candidates(lambda some: 1 - a[some] @ bt, len(a), hidden, k, 1e-9)


def _near_euclidean(a: np.ndarray, b: np.ndarray, hidden: tuple[np.ndarray, np.ndarray] | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    aa, bb, bt = (a**2).sum(1)[:, None], (b**2).sum(1), b.T.copy()
    return _candidates(lambda some: np.sqrt(np.maximum(aa[some] + bb - 2 * (a[some] @ bt), 0)), len(a), hidden, k, 1e-9)


def _pack(key: str, number: str):
    """One row per block: its keys, its vectors as bytes, and what is hidden from which of its rows."""

    def run(table: pa.Table) -> pa.Table:
        def whole(name: str) -> pa.Array:
            return pa.concat_arrays(table.column(name).chunks)

        out = {c: table.column(c).slice(0, 1) for c in ("embedding_type_id", "layer", "dim", "block")}
        out[key] = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), whole("key"))
        out[f"{key}_v"] = [whole("v").flatten().to_numpy(zero_copy_only=False).astype(number).tobytes()]
        if "layer_index" in table.column_names:
            out["layer_index"] = table.column("layer_index").slice(0, 1)
        if "hidden" in table.column_names:
            lists = whole("hidden")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            out["hidden_row"] = [np.repeat(np.arange(len(sizes)), sizes).astype("<i8").tobytes()]
            out["hidden_id"] = [lists.flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()]
        return pa.table(out)

    return run


def _cells(k: int, near, threshold: float | None, numbers: tuple[str, str]):
    """The best ``k`` of every query of a task over all reference blocks that come by."""

    def nearest(row: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((ids, dist, row))
        row, ids, dist = row[order], ids[order], dist[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        return row[keep], ids[keep], dist[keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[tuple, tuple] = {}
        for x in (x for batch in batches for x in batch.itertuples(index=False)):
            a = np.frombuffer(x.accession_v, numbers[0]).reshape(-1, x.dim).astype(np.float64)
            b = np.frombuffer(x.sequence_id_v, numbers[1]).reshape(-1, x.dim).astype(np.float64)
            ids, hidden = np.asarray(x.sequence_id), None
            if hasattr(x, "hidden_id"):
                order = np.argsort(ids)
                row, some = np.frombuffer(x.hidden_row, "<i8"), np.frombuffer(x.hidden_id, "<i8")
                at = order[np.minimum(np.searchsorted(ids, some, sorter=order), len(ids) - 1)]
                there = ids[at] == some
                hidden = row[there], at[there]
            row, col, dist = near(a, b, hidden, k)
            # candidates are all as near as the k-th, so that ties are settled by id and not by chance
            dist = np.round(dist, 10)
            if threshold is not None:
                ok = dist <= threshold
                row, col, dist = row[ok], col[ok], dist[ok]
            found, block = (row, ids[col], dist), (x.embedding_type_id, x.layer, x.dim, x.block)
            if block in best:
                found = tuple(np.concatenate(y) for y in zip(best[block][0], found))
            best[block] = nearest(*found), np.asarray(x.accession), None if pd.isna(x.layer_index) else int(x.layer_index)
        for (model, *_), ((row, ids, dist), keys, layer) in best.items():
            yield pd.DataFrame({"accession": keys[row], "ref_sequence_id": ids, "distance": dist}).assign(embedding_type_id=int(model), layer_index=layer)

    return run


def _search(queries: DataFrame, references: DataFrame, k: int, near, threshold: float | None, masked: DataFrame | None) -> DataFrame:
    """Both sides as packed blocks; every pair of blocks of a model and layer meets once.

    Each side is written to the shuffle once, whatever the number of blocks of
    the other: the join is of partitions, which are read again by many tasks. A
    task holds the query blocks of its partition while reference blocks pass.

    A masked search runs at once and in steps, since its mask comes with much
    that leads to it: both sides and their blocks are working tables, so that a
    step's shuffle files go before the next begins, and only the hits stay.
    """
    spark = queries.sparkSession
    if k < 1:
        return spark.createDataFrame([], _SCHEMA)
    q, r = _usable(queries, "accession"), _usable(references, "sequence_id")
    r = r.withColumn("key", F.col("key").cast("long"))
    if masked is not None:
        hidden = masked.where("accession is not null and ref_sequence_id is not null").groupBy(F.col("accession").alias("key")).agg(F.collect_set(F.col("ref_sequence_id").cast("long")).alias("hidden"))
        q = q.join(hidden, "key", "left")
    q, r = (x.withColumn("layer", _space()) for x in (q, r))
    steps = masked is not None
    if steps:
        q, r = materialise(q, "queries"), materialise(r, "references")
    where = ["embedding_type_id", "layer", "dim"]
    nq = q.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_BLOCK)).cast("int").alias("nq"))
    nr = r.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / F.lit(REFERENCE_BLOCK)).cast("int").alias("nr"))
    grid = nq.join(nr, where)
    if steps:
        grid = materialise(grid, "grid")
    blocks, numbers = [], []
    for side, key, n in ((q, "accession", "nq"), (r, "sequence_id", "nr")):
        number = "<f4" if side.schema["v"].dataType.elementType.typeName() == "float" else "<f8"
        # one row per model, layer and dimension of both sides; without the hint all vectors are shuffled for them
        x = side.join(F.broadcast(grid), where).withColumn("block", F.pmod(F.xxhash64("key"), F.col(n)).cast("int")).drop("nq", "nr")
        x = x.drop("layer_index") if side is r else x
        schema = f"embedding_type_id int, layer int, dim int, block int, {key} array<{x.schema['key'].dataType.simpleString()}>, {key}_v binary"
        schema += ", layer_index int" * ("layer_index" in x.columns) + ", hidden_row binary, hidden_id binary" * ("hidden" in x.columns)
        x = x.groupBy(*where, "block").applyInArrow(_pack(key, number), schema)
        if steps:
            x = materialise(x, "blocks")
            free(side)
        blocks.append(x)
        numbers.append(number)
    tasks = max(width(spark), spark.sparkContext.defaultParallelism)
    qb = blocks[0].repartition(tasks, *where, "block")
    # few partitions of references, since each leaves k hits of every query to be merged
    rb = blocks[1].repartition(max(1, -(-4 * spark.sparkContext.defaultParallelism // tasks)), *where, "block").drop("block")
    hits = _limit(rb.join(qb.hint("shuffle_replicate_nl"), where).mapInPandas(_cells(k, near, threshold, tuple(numbers)), _SCHEMA), k)
    if steps:
        hits = materialise(hits, "hits")
        for x in (*blocks, grid):
            free(x)
    return hits


def blocked(queries: DataFrame, references: DataFrame, k: int = 1, metric: str = "cosine", threshold: float | None = None, masked: DataFrame | None = None) -> DataFrame:
    """Hits (accession, ref_sequence_id, distance, embedding_type_id, layer_index).

    ``masked`` has (accession, ref_sequence_id) pairs that must not meet; they
    travel with the query. The number of blocks follows the counts per model and
    layer, one row each.
    """
    return _search(queries, references, k, _near_cosine if metric == "cosine" else _near_euclidean, threshold, masked)


def declarative(queries: DataFrame, references: DataFrame, k: int = 1, metric: str = "cosine", threshold: float | None = None, masked: DataFrame | None = None) -> DataFrame:
    """The same hits as :func:`blocked`, all distances in double precision."""
    return _search(queries, references, k, _near_cosine_double if metric == "cosine" else _near_euclidean, threshold, masked)
