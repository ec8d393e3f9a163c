"""Most similar vectors for every vector (problem 5).

Method: a hash-prefix forest. Per tree every vector gets a long string of bits;
the strings of a tree, sorted, are its array. A query descends to its longest
prefix match and ascends, prefix by prefix, until enough rows share the prefix;
all of them are candidates. Only of rows that no bit of a long string tells apart
those within ``SPAN`` times as many places are looked at. Every tree is ascended by
the same rule, and the candidates of all trees are merged.

What is shuffled once per tree is the string, an id and an eight-bit code of the
vector, never the vector: codes rank the candidates (their cosine is off by about
0.001), and the best of them are verified with the vectors themselves. The sorted
arrays are built by a range partitioning, so an array of any size is a row of
partitions, each of at least ``RANGE_SPANS * SPAN`` times the candidates wanted. A
row near a partition's border meets the neighbouring partition's rows in a second,
small pass over the borders.

The bits are signs of random projections, other ones in every tree, so nothing is
fitted and every tree errs by itself. The candidates of a query grow as the square
root of the vectors of its space (README has the recall measured), a partition
with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from annoweave.llm.topn import top_n
from annoweave.runtime import materialise

TREES, BITS = 10, 62
#: Candidates of a query and tree: at least the first, else a factor times the root of the vectors of its space.
CANDIDATES, FACTOR, NEAR_FACTOR = 256, 8.0, 3.0
#: Rows with the very same string, and those across a border, are looked at within so many times the candidates wanted.
SPAN = 4
#: Candidates that are compared at a time.
CHUNK = 65_536
#: Rows of a range partition: so many at least, else a multiple of the longest span.
RANGE_ROWS, RANGE_SPANS = 40_000, 4
#: Candidates beyond k that are verified, and what a code's cosine may be off.
SLACK, MARGIN = 8, 0.02
_SEED = 7


def wanted(n: int, factor: float = FACTOR) -> int:
    """Candidates that a query wants of a tree, among ``n`` vectors."""
    return max(CANDIDATES, int(factor * n**0.5))


def planes(dim: int, tree: int) -> np.ndarray:
    """The random projections of one tree for vectors of one length."""
    return np.random.default_rng([_SEED, dim, tree]).standard_normal((dim, BITS)).astype(np.float32)


def hash_strings(unit: np.ndarray, tree: int) -> np.ndarray:
    """Bit strings as integers, the first bit in the highest place."""
    bits = unit @ planes(unit.shape[1], tree) > 0
    return bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def codes(unit: np.ndarray) -> np.ndarray:
    """Vectors as signed bytes, each scaled by its largest component."""
    return np.rint(unit * (127 / np.abs(unit).max(1, keepdims=True))).astype(np.int8)


def prefix_intervals(h: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a sorted array, the rows that share its longest prefix held by at least ``want``."""
    want = min(want, len(h))

    def at(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = (BITS - depth).astype(np.int64)
        low = (h >> shift) << shift
        return np.searchsorted(h, low, "left"), np.searchsorted(h, low + (np.int64(1) << shift), "left")

    good, bad = np.zeros(len(h), dtype=np.int64), np.full(len(h), BITS + 1, dtype=np.int64)
    while (bad - good > 1).any():
        mid = (good + bad) // 2
        lo, hi = at(mid)
        ok = hi - lo >= want
        good, bad = np.where(ok, mid, good), np.where(ok | (bad - good <= 1), bad, mid)
    return at(good)


def search_array(h: np.ndarray, code: np.ndarray, ask: np.ndarray, k: int, want: int, least: float = -1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, neighbour row, cosine of the codes) of the ``k`` best candidates of every asked row of a sorted array.

    Only candidates with a cosine of ``least`` or more count.
    """
    lo, hi = prefix_intervals(h, want)
    at = np.arange(len(h))
    half = SPAN * want // 2
    # rows of one interval are looked at together, in stretches of neighbours where the strings are all the same
    alike = (hi - lo > 2 * half) & (h[lo] == h[hi - 1]) if len(h) else np.empty(0, bool)
    stretch = np.where(alike, at // 256, -1)
    order = np.lexsort((stretch, hi, lo))
    order = order[ask[order]]
    same = (lo[order][1:] == lo[order][:-1]) & (hi[order][1:] == hi[order][:-1]) & (stretch[order][1:] == stretch[order][:-1])
    cut = np.flatnonzero(np.append(True, ~same)) if len(order) else np.empty(0, np.int64)
    qs, ns, ss = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.float32)]
    for block in np.split(order, cut[1:]):
        if not len(block):
            continue
        first, end = lo[block[0]], hi[block[0]]
        if stretch[block[0]] >= 0:
            first, end = max(first, block.min() - half), min(end, block.max() + half + 1)
        own = code[block].astype(np.float32)
        own /= np.sqrt(np.einsum("ij,ij->i", own, own))[:, None]
        for a in range(first, end, CHUNK):
            x = code[a : min(a + CHUNK, end)].astype(np.float32)
            x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
            for some in range(0, len(block), 256):
                part = block[some : some + 256]
                sim = own[some : some + 256] @ x.T
                here = np.flatnonzero((part >= a) & (part < a + len(x)))
                sim[here, part[here] - a] = -2
                row, col = _best(sim, k, least)
                qs.append(part[row])
                ns.append(a + col)
                ss.append(sim[row, col])
    return np.concatenate(qs), np.concatenate(ns), np.concatenate(ss)


def _best(sim: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` largest entries of every row that reach ``least``."""
    if least > -1:
        row, col = np.nonzero(sim >= least)
        order = np.lexsort((-sim[row, col], row))
        row, col = row[order], col[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        return row[keep], col[keep]
    take = min(k, sim.shape[1])
    col = np.argpartition(-sim, take - 1, axis=1)[:, :take].ravel()
    row = np.repeat(np.arange(len(sim)), take)
    real = sim[row, col] > -2
    return row[real], col[real]


#: Rows of the sorted arrays: ``st`` numbers space and tree; and what a search
#: gives, which is hits (a, b, similarity) and border rows (border and the rest).
_HASHED = "st int, h long, vid long, ask boolean, code binary"
_FOUND = f"a long, b long, similarity double, border int, {_HASHED}"
_ROW = pa.schema([("st", pa.int32()), ("h", pa.int64()), ("vid", pa.int64()), ("ask", pa.bool_()), ("code", pa.binary())])
_OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64()), ("border", pa.int32()), *_ROW])


def _unit(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    """Unit vectors of rows of one length."""
    part = batch["embedding"].take(pa.array(rows))
    x = part.flatten().to_numpy().astype(np.float32).reshape(len(rows), -1)
    return x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True).astype(np.float32)


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        space = b["space"].to_numpy()
        for s in np.unique(space):
            rows = np.flatnonzero(space == s)
            x = _unit(b, rows)
            head = b.take(pa.array(rows))
            packed = pa.array([r.tobytes() for r in codes(x)], pa.binary())
            for tree in range(TREES):
                st = pa.array(np.full(len(rows), s * TREES + tree, np.int32))
                yield pa.RecordBatch.from_arrays([st, pa.array(hash_strings(x, tree)), head["vid"], head["ask"], packed], schema=_ROW)


def _matrix(code: pa.Array) -> np.ndarray:
    """The codes of rows of one length, without copying them."""
    ends = np.frombuffer(code.buffers()[1], np.int32)[code.offset : code.offset + len(code) + 1]
    return np.frombuffer(code.buffers()[2], np.int8)[ends[0] : ends[-1]].reshape(len(code), -1)


def _search(k: int, want: dict[int, int], least: float, borders: bool):
    """Searches all rows of a partition; ``borders`` says that it is one of a row of partitions, not a set of borders."""

    def found(part: pa.Table) -> Iterator[pa.RecordBatch]:
        vid = part["vid"].to_numpy()
        q, n, s = search_array(part["h"].to_numpy(), _matrix(part["code"].combine_chunks()), part["ask"].to_numpy(), k, want[part["st"][0].as_py() // TREES], least)
        for lo in range(0, len(q), 50_000):
            cols = [pa.array(vid[q[lo : lo + 50_000]]), pa.array(vid[n[lo : lo + 50_000]]), pa.array(s[lo : lo + 50_000].astype(np.float64))]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.nulls(len(cols[0]), f.type) for f in list(_OUT)[3:]]], schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = list(batches)
        if not sum(b.num_rows for b in rows):
            return
        t = pa.Table.from_batches(rows).combine_chunks()
        key = [t["st"].to_numpy()] if borders else [t["st"].to_numpy(), t["border"].to_numpy()]
        cut = np.flatnonzero(np.any([x[1:] != x[:-1] for x in key], axis=0)) + 1
        for a, z in zip([0, *cut], [*cut, t.num_rows]):
            part = t.slice(a, z - a)
            yield from found(part)
            if borders:
                here, most = TaskContext.get().partitionId(), SPAN * want[int(key[0][a]) // TREES]
                ends = ([(here - 1, part.slice(0, most))] if a == 0 else []) + ([(here, part.slice(max(0, z - a - most)))] if z == t.num_rows else [])
                for border, edge in ends:
                    n = edge.num_rows
                    cols = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()), pa.array(np.full(n, border, np.int32))]
                    yield from pa.Table.from_arrays([*cols, *[edge[f.name] for f in _ROW]], schema=_OUT).combine_chunks().to_batches(10_000)

    return run


def usable(vectors: DataFrame, model: str, vector: str) -> DataFrame:
    """Rows whose vector has its model's length (the commonest one), only finite numbers, and not all zero."""
    sized = vectors.withColumn("_size", F.size(vector))
    counts = sized.where("_size > 0").groupBy(model, "_size").count()
    length = counts.groupBy(model).agg(F.max_by("_size", F.struct("count", "_size")).alias("_length"))
    ok = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists(vector, lambda x: x != 0)
    return sized.where("_size > 0").where(ok).join(length, model).where("_size = _length").drop("_size", "_length")


def _candidates(vectors: DataFrame, counts: dict[int, int], k: int, least: float, factor: float) -> DataFrame:
    """(a, b, similarity of the codes) of distinct vectors: of every asked one the best candidates of all trees."""
    want = {s: wanted(n, factor) for s, n in counts.items()}
    most = k + SLACK
    rows = max(RANGE_ROWS, RANGE_SPANS * SPAN * max(want.values(), default=0))
    parts = max(1, -(-sum(counts.values()) * TREES // rows))
    order = ["st", "h", "vid"]
    arrays = vectors.mapInArrow(_hash_rows, _HASHED).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    first = materialise(arrays.mapInArrow(_search(most, want, least, True), _FOUND), "hits")
    edges = first.where("border is not null").select("border", "st", "h", "vid", "ask", "code")
    edges = edges.repartition("border", "st").sortWithinPartitions("st", "border", "h", "vid")
    more = edges.mapInArrow(_search(most, want, least, False), _FOUND)
    hits = first.where("border is null").select("a", "b", "similarity").union(more.select("a", "b", "similarity"))
    return top_n(hits.withColumn("cost", F.lit(0.0)), "a", "similarity", "cost", "b", most).select("a", "b")


def _verified(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(a, b, similarity) of vectors, rounded to six decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.diff(b["va"].offsets.to_numpy())
            sim = np.empty(b.num_rows)
            for d in np.unique(dims):
                rows = pa.array(np.flatnonzero(dims == d))
                x, y = (b[c].take(rows).flatten().to_numpy().astype(np.float64).reshape(len(rows), -1) for c in ("va", "vb"))
                sim[dims == d] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(np.round(sim, 6))], names=["a", "b", "similarity"])

    v = vectors.select("vid", "embedding")
    wide = pairs.join(v.toDF("a", "va"), "a").join(v.toDF("b", "vb"), "b").select("a", "b", "va", "vb")
    return wide.mapInArrow(run, "a long, b long, similarity double")


def nearest(
    vectors: DataFrame,
    item: str,
    space: list[str],
    vector: str,
    k: int,
    least: float | None = None,
    asked: Column | None = None,
    order: Column | None = None,
    factor: float | None = None,
) -> DataFrame:
    """The ``k`` most similar other vectors of the same space: (item, neighbour, similarity).

    ``vectors`` must be usable (see :func:`usable`); null items are left out, null
    space columns are a space of their own. Of several rows of an item the one
    with the greatest ``order`` counts (without it any). ``asked`` says for which items neighbours are
    wanted (all by default); all vectors are searched. With ``least`` only
    neighbours of that cosine or more come out, which takes fewer candidates.
    Equal vectors are merged before the search and are each other's neighbours at
    1.0, least id first, so a group of copies of any size costs one entry. A
    space of one vector gives no rows; ``k`` is 1 at least. Similarities are
    rounded to six decimals.
    """
    spark = vectors.sparkSession
    key = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in space])
    rows = vectors.where(F.col(item).isNotNull()).select(
        F.col(item).cast("long").alias("item"),
        key.alias("name"),
        F.coalesce(asked if asked is not None else F.lit(True), F.lit(False)).alias("ask"),
        (order if order is not None else F.lit(0)).alias("at"),
        F.col(vector).alias("embedding"),
    )
    rows = rows.withColumn("vid", F.xxhash64("name", "embedding"))
    # ids alone are grouped to the latest row of an item; vectors meet once, by the hash that they are merged by
    items = materialise(rows.groupBy("item").agg(F.max_by(F.struct("vid", "name", "ask"), F.struct("at", "vid")).alias("r")).select("item", "r.*"), "items")
    per = sorted((r["name"], r["n"]) for r in items.groupBy("name").agg(F.countDistinct("vid").alias("n")).collect())
    number = {name: i for i, (name, _) in enumerate(per)}
    counts = {number[name]: n for name, n in per}
    named = spark.createDataFrame(list(number.items()), "name string, space int")
    used = items.groupBy("vid", "name").agg(F.max("ask").alias("ask")).join(F.broadcast(named), "name").select("vid", "space", "ask")
    distinct = materialise(rows.select("vid", "embedding").dropDuplicates(["vid"]).join(used, "vid"), "vectors")
    bound = -1.0 if least is None else least - MARGIN
    pairs = _candidates(distinct, counts, k, bound, factor or (FACTOR if least is None else NEAR_FACTOR))
    best = top_n(_verified(pairs, distinct).withColumn("cost", F.lit(0.0)), "a", "similarity", "cost", "b", k)
    # copies: the k + 1 least ids of every distinct vector are enough for any member's answer
    zero = items.select("vid", "item", F.lit(0.0).alias("z"))
    copies = materialise(top_n(zero, "vid", "z", "z", "item", k + 1).select("vid", "item"), "copies")
    near = best.select(F.col("a").alias("owner"), F.col("b").alias("vid"), "similarity").join(copies, "vid").select("owner", "item", "similarity")
    near = near.union(copies.select(F.col("vid").alias("owner"), "item", F.lit(1.0)))
    if least is not None:
        near = near.where(F.col("similarity") >= least)
    # at most (k + 1) * (k + 1) entries each
    answer = near.groupBy("owner").agg(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("s"), F.col("item").alias("n")))).alias("near"))
    out = items.where("ask").select("item", F.col("vid").alias("owner")).join(answer, "owner")
    out = out.select("item", F.explode(F.slice(F.filter("near", lambda x: x["n"] != F.col("item")), 1, k)).alias("x"))
    return out.select(F.col("item").alias(item), F.col("x.n").alias("neighbour"), (-F.col("x.s")).alias("similarity"))
