"""Redundancy: cluster tables, the mask they give, and a native clustering.

An external cluster table (cluster, identifier, side) is the contract. The
native clustering aligns sequences that share as many k-mers as identity and
coverage imply, and each joins the longest sequence that it matches at both.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoweave.functions.align import RESIDUES, metrics
from annoweave.runtime import free, materialise, spread

#: Most residues of a seed that a pair shares for certain; most of one, and its chance, where that is not certain.
LONGEST, SEED, CHANCE = 7, 6, 0.99
#: Residues of the k-mers that tell pairs apart before they are aligned.
SHORT = 4
#: Residues that are cut into seeds at once; seeds of a task; pairs of places that it counts at once.
STRETCH, PART, EVENTS = 1_000_000, 2_000_000, 3_000_000
#: A sample of at least so many texts shows the seeds that more than FREQUENT texts have, HOT at most.
SAMPLE, FREQUENT, HOT = 8_000, 50, 500_000
#: A text whose seeds lead to more texts than this meets them by an index of short k-mers, if such texts have no more residues in all.
WIDE, WIDE_RESIDUES = 2_000, 400_000


def mask(clusters: DataFrame) -> DataFrame:
    """(accession, ref_sequence_id) that share a cluster: the pairs a search must not return.

    The side column tells queries (q) from references (r), so a query whose
    accession is a number is no reference. Queries without a cluster are not masked.
    """
    c = clusters.where("cluster is not null and identifier is not null").select("cluster", "identifier", "side").distinct()
    q = c.where("side = 'q'").select("cluster", F.col("identifier").alias("accession"))
    r = c.where("side = 'r'").select("cluster", F.expr("try_cast(identifier as bigint)").alias("ref_sequence_id")).where("ref_sequence_id is not null")
    return q.join(r, "cluster").select("accession", "ref_sequence_id").distinct()


def members(clusters: DataFrame, accession: str) -> DataFrame:
    """Identifiers in the clusters of one query; none if it has no cluster."""
    own = clusters.where((F.col("side") == "q") & (F.col("identifier") == accession)).select("cluster").distinct()
    return clusters.join(own, "cluster", "left_semi").select("identifier", "side").distinct()


def sizes(clusters: DataFrame) -> DataFrame:
    """Members per cluster and side; counts, so that a huge cluster is no huge row."""
    return clusters.groupBy("cluster").agg(F.count_if(F.col("side") == "q").alias("queries"), F.count_if(F.col("side") == "r").alias("references"))


def _differences(columns: np.ndarray, identity: float) -> np.ndarray:
    """Most columns without a match in accepted alignments of so many columns."""
    return np.floor((1 - identity) * columns + 1e-9).astype(np.int64)


def _columns(n: int, identity: float, coverage: float) -> np.ndarray:
    """Columns that an accepted alignment of a joining sequence of ``n`` residues can have."""
    least = max(1, int(np.ceil(coverage * n - 1e-9)))
    return np.arange(least, max(least, int(n / identity)) + 1)


def seed_length(n: int, identity: float, coverage: float, most: int = LONGEST) -> int:
    """Residues of a run that a joining sequence of ``n`` residues shares with its representative.

    The larger of two: the run that every accepted pair has (up to ``most``), since d
    differences leave d + 1 runs at most; and the longest run (up to SEED) that a pair
    at the threshold has with CHANCE, if its differences fall independently.
    """
    columns = _columns(n, identity, coverage)
    d = _differences(columns, identity)
    sure = int((-(-(columns - d) // (d + 1))).min())
    for k in range(SEED, sure, -1):
        none = [1.0] * k  # chance of no run of k in so many columns; more columns only help
        for j in range(k, min(int(columns[0]), 500) + 1):
            none.append(1 - identity**k if j == k else none[-1] - (1 - identity) * identity**k * none[j - k - 1])
        if 1 - none[-1] >= CHANCE:
            return k
    return min(most, sure)


def _certain(n: int, k: int, identity: float, coverage: float) -> int:
    """Places of a joining sequence whose k-mer every accepted representative has: a difference spoils k at most. Below 1: none is certain."""
    columns = _columns(n, identity, coverage)
    return int((columns - k + 1 - k * _differences(columns, identity)).min())


def least_shared(n: int, k: int, identity: float, coverage: float) -> int:
    """The same where a pair is known to share one at least."""
    return max(1, _certain(n, k, identity, coverage))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts by about STRETCH residues, which bounds the memory of their k-mers."""
    for whole in batches:
        for _, some in whole.groupby((whole["n"].cumsum() - whole["n"]) // STRETCH):
            yield some.reset_index(drop=True)


def _kmers(texts: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of ``texts`` and code of the k-mer at every place."""
    raw = np.frombuffer("".join(texts["sequence"]).encode(), dtype=np.uint8).astype(np.int64) - 65
    own = np.repeat(np.arange(len(texts)), texts["n"])
    m = max(0, len(raw) - k + 1)
    code = np.zeros(m, dtype=np.int64)
    for i in range(k):
        code = code * 26 + raw[i : m + i]
    inside = own[:m] == own[len(raw) - m :]
    return own[:m][inside], code[inside]


def _counted(own: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, places) of the different k-mers of every row, by code and row."""
    key, places = np.unique(code << 20 | own, return_counts=True)
    return key & 0xFFFFF, key >> 20, places


def _packed(columns: list[np.ndarray]) -> bytes:
    """Whole numbers byte by byte, so that small ones take little."""
    planes = b"".join(np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return np.array([len(c) for c in columns], dtype="<i8").tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, columns: int) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, dtype="<i8", count=columns)
    planes, out, at = np.frombuffer(pa.decompress(blob[8 * columns :], decompressed_size=int(sizes.sum()) * 8, codec="zstd"), dtype=np.uint8), [], 0
    for n in sizes:
        out.append(np.ascontiguousarray(planes[at : at + 8 * n].reshape(8, -1).T).view("<i8").ravel())
        at += 8 * n
    return out


class _Seeds:
    """How the texts of one clustering seed: ``classes`` (k, least length of a text whose seeds have k residues), identity and coverage,
    and ``hot`` (seed, about how many texts have it) of frequent seeds."""

    def __init__(self, classes: list[tuple[int, int]], identity: float, coverage: float, hot: list[tuple[int, float]]):
        self.classes, self.identity, self.coverage = classes, identity, coverage
        self.hot, self.often = np.array([x for x, _ in hot], dtype=np.int64), np.array([y for _, y in hot], dtype=np.float64)

    def each(self, lengths: pd.Series, f) -> np.ndarray:
        values = {n: f(int(n), self.identity, self.coverage) for n in lengths.unique()}
        return lengths.map(values).to_numpy(dtype=np.int64)

    def frequency(self, seed: np.ndarray) -> np.ndarray:
        """Of hot seeds; 0 of all others."""
        if not len(self.hot):
            return np.zeros(len(seed))
        at = np.minimum(np.searchsorted(self.hot, seed), len(self.hot) - 1)
        return np.where(self.hot[at] == seed, self.often[at], 0)

    def passed(self, texts: pd.DataFrame, k: int, own: np.ndarray, often: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of these hot seeds of joining texts go unused, the shared places that are still certain, and which texts are wide.

        Of T places that a pair shares for certain, any T - 1 can be passed over
        and one is left; the most frequent ones are. A text is wide if the rest
        still leads to more than WIDE others, but shorter k-mers tell them apart.
        """
        need = self.each(texts["n"], lambda n, i, c: least_shared(n, k, i, c))
        order = np.lexsort((-often, own))
        o, p = own[order], places[order]
        total = np.cumsum(p)
        first = np.searchsorted(o, o)  # where the row begins
        unused = np.zeros(len(own), dtype=bool)
        unused[order] = total - np.where(first > 0, total[first - 1], 0) < need[o]
        rest = np.bincount(own, weights=often * ~unused, minlength=len(texts))
        wide = (rest > WIDE) & (self.each(texts["n"], lambda n, i, c: _certain(n, SHORT, i, c)) >= 2 * SHORT)
        return unused, need - np.bincount(own, weights=places * unused, minlength=len(texts)).astype(np.int64), wide

    def wide(self, texts: pd.DataFrame) -> pd.DataFrame:
        out = [texts[:0]]
        for k, _ in self.classes:
            mine = texts[texts["k"] == k].reset_index(drop=True)
            own, code = _kmers(mine, k)
            hot = self.frequency(code * 16 + k) > 0
            own, code, places = _counted(own[hot], code[hot])
            out.append(mine[self.passed(mine, k, own, self.frequency(code * 16 + k), places)[2]])
        return pd.concat(out)

    def packed(self, texts: pd.DataFrame, parts: int, apart: bool) -> Iterator[tuple[int, bytes]]:
        """The seeds of all texts by part; of those of its own k a text uses all but the ones passed over. Wide texts use none if they go ``apart``."""
        for k, shortest in self.classes:
            some = texts[texts["n"] >= max(k, shortest)].reset_index(drop=True)
            own, code, places = _counted(*_kmers(some, k))
            seed = code * 16 + k
            often, joins = self.frequency(seed), (some["k"] == k).to_numpy()
            hot = np.flatnonzero((often > 0) & joins[own])
            unused, need, wide = self.passed(some, k, own[hot], often[hot], places[hot])
            use = joins[own]
            use[hot[unused]] = False
            if apart:
                use &= ~wide[own]
            part = (_mix(seed) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            ids, n = some["id"].to_numpy(), some["n"].to_numpy()
            for p in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[p] : bounds[p + 1]]
                who, local = np.unique(own[at], return_inverse=True)
                yield int(p), _packed([np.diff(seed[at], prepend=0), local * 2 + use[at], places[at], np.diff(ids[who], prepend=0), n[who], need[who]])


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(rep, id, shared, need) of the texts that share seeds of one part: places of ``id``, which uses the seed and is not longer."""
    every: list[list[np.ndarray]] = [[] for _ in range(6)]
    rows = 0
    for blob in itertools.chain.from_iterable(b["blob"] for b in batches):
        seed, mark, places, ids, n, need = _unpacked(blob, 6)
        for to, x in zip(every, (np.cumsum(seed), (mark >> 1) + rows, mark & 1, places, np.cumsum(ids), np.stack([n, need]))):
            to.append(x)
        rows += len(ids)
    seed, own, use, places, ids = (np.concatenate(x) for x in every[:5])
    n, need = np.concatenate(every[5], axis=1)
    order = np.argsort(seed, kind="stable")
    seed, own, use, places = seed[order], own[order], use[order], places[order]
    new = np.flatnonzero(np.diff(seed, prepend=-1))
    size = np.diff(np.append(new, len(seed)))
    group = np.repeat(np.arange(len(new)), size)
    asks = np.flatnonzero((use > 0) & (size[group] > 1))
    done = np.cumsum(size[group[asks]])
    lo = 0
    while lo < len(asks):
        hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + EVENTS, side="right")))
        a = asks[lo:hi]
        many = size[group[a]]
        left = np.repeat(a, many)
        right = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(new[group[a]], many)
        fit = (n[own[right]] >= n[own[left]]) & (left != right)
        left, right = left[fit], right[fit]
        pair, at = np.unique(own[right] * rows + own[left], return_inverse=True)
        rep, sid = pair // rows, pair % rows
        yield pd.DataFrame({"rep": ids[rep], "id": ids[sid], "shared": np.bincount(at, weights=places[left], minlength=len(pair)).astype(np.int64), "need": need[sid]})
        lo = hi


def _near_wide(wide: pd.DataFrame, seeds: _Seeds):
    """Pairs of a text and a wide one that share as many short k-mers as they must."""
    least = seeds.each(wide["n"], lambda n, i, c: _certain(n, SHORT, i, c))
    w, code, places = _counted(*_kmers(wide, SHORT))
    has = np.zeros(26**SHORT, dtype=bool)
    has[code] = True
    wn, wid = wide["n"].to_numpy(), wide["id"].to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _stretches(batches):
            own, mine = _kmers(texts, SHORT)
            own, mine, _ = _counted(own[has[mine]], mine[has[mine]])
            lo = np.searchsorted(code, mine)
            many = np.searchsorted(code, mine, side="right") - lo
            n, ids = texts["n"].to_numpy(), texts["id"].to_numpy()
            ends = np.cumsum(many)
            for block in np.split(np.arange(len(texts)), np.arange(256, len(texts), 256)):  # counts of 256 texts at a time
                here = np.flatnonzero((own >= block[0]) & (own <= block[-1]))
                m = many[here]
                at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo[here], m)
                count = np.bincount(np.repeat(own[here] - block[0], m) * len(wide) + w[at], weights=places[at], minlength=len(block) * len(wide)).reshape(len(block), len(wide))
                x, y = np.nonzero((count >= least) & (n[block][:, None] >= wn) & (ids[block][:, None] != wid))
                yield pd.DataFrame({"rep": ids[block][x], "id": wid[y]})

    return run


def accepts(identity: float, coverage: float):
    """Whether a joining sequence matches a longer one, in a function of two columns."""
    plain = set(RESIDUES)

    @F.pandas_udf("boolean")
    def matched(short: pd.Series, long: pd.Series) -> pd.Series:
        out = np.zeros(len(short), dtype=bool)
        open_ = []
        for i, (s, r) in enumerate(zip(short, long)):
            if s in r and plain.issuperset(s):
                out[i] = True  # the best score there is, which only the whole run of equal residues has
                continue
            certain = _certain(len(s), SHORT, identity, coverage)
            if certain > 0 and len(s) >= SHORT:
                mine, theirs = (_kmers(pd.DataFrame({"sequence": [x], "n": [len(x)]}), SHORT)[1] for x in (s, r))
                if np.isin(mine, theirs).sum() < certain:
                    continue
            open_.append(i)
        if open_:
            m = metrics(short.iloc[open_], long.iloc[open_], sides=(("_sw", True),))
            out[open_] = (m["identity_sw"] >= identity) & (m["alignment_length_sw"] * (1 - m["gaps_percentage_sw"]) >= coverage * m["length_query"])
        return pd.Series(out)

    return matched


def _candidates(texts: DataFrame, identity: float, coverage: float) -> DataFrame:
    """(rep, id) of the texts (id, n, k, sequence) that share what an accepted pair must share; ``id`` is not longer."""
    spark = texts.sparkSession
    classes = [(r["k"], r["n"]) for r in texts.groupBy("k").agg(F.min("n").alias("n")).collect()]  # LONGEST rows at most
    total = texts.agg(F.sum("n").alias("residues"), F.count(F.lit(1)).alias("texts")).first()
    if not classes:
        return spark.createDataFrame([], "rep long, id long")
    parts = max(1, -(-total["residues"] // PART))
    share = min(1.0, max(SAMPLE, min(total["texts"] // 8, 6 * SAMPLE)) / total["texts"])
    cold = _Seeds(classes, identity, coverage, [])

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _stretches(batches):
            for k, shortest in classes:
                own, code = _kmers(some[some["n"] >= max(k, shortest)], k)
                seed, c = np.unique(_counted(own, code)[1] * 16 + k, return_counts=True)
                yield pd.DataFrame({"seed": seed, "c": c})

    # which seeds count as frequent decides about time alone, so a sample of the texts may tell
    few = texts.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    often = few.mapInPandas(sampled, "seed long, c long").groupBy("seed").agg(F.sum("c").alias("c")).where(F.col("c") >= max(4, int(FREQUENT * share)))
    counted = materialise(often.orderBy(F.desc("c"), "seed").limit(HOT), "often")  # the sample's shuffle files go before the seeds come
    hot = sorted((r["seed"], r["c"] / share) for r in counted.collect())
    free(counted)
    seeds = _Seeds(classes, identity, coverage, hot)

    def all_wide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _stretches(batches):
            yield seeds.wide(some)[["id", "n", "sequence"]]

    apart, wide = False, None
    if hot:
        found = materialise(texts.mapInPandas(all_wide, "id long, n int, sequence string"), "wide")
        residues = found.agg(F.sum("n")).first()[0]
        if residues and residues <= WIDE_RESIDUES:
            apart, wide = True, found.toPandas()
        free(found)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _stretches(batches):
            yield pd.DataFrame(seeds.packed(some, parts, apart), columns=["part", "blob"])

    met = texts.mapInPandas(run, "part int, blob binary").groupBy("part").applyInPandas(_meet, "rep long, id long, shared long, need long")
    pairs = met.groupBy("rep", "id").agg(F.sum("shared").alias("shared"), F.first("need").alias("need")).where("shared >= need").select("rep", "id")
    return pairs.union(texts.mapInPandas(_near_wide(wide, cold), "rep long, id long")) if apart else pairs


def cluster(sequences: DataFrame, identity: float, coverage: float) -> DataFrame:
    """(cluster, identifier, side) of ``sequences`` (identifier, side, sequence).

    Equal sequences share a cluster. A cluster is named by a key of its longest
    sequence, which each of its members matches itself. Identity 0 switches clustering off: no rows. Coverage is the
    aligned part of the shorter (joining) sequence.
    """
    if identity <= 0:
        return sequences.select(F.lit("").alias("cluster"), "identifier", "side").where(F.lit(False))
    rows = sequences.where("identifier is not null and sequence is not null").select("identifier", "side", F.upper(F.regexp_replace("sequence", "[^A-Za-z]", "")).alias("sequence"))
    rows = materialise(rows.where("sequence != ''").withColumn("sid", F.xxhash64("sequence")), "sequences")

    @F.pandas_udf("int")
    def own(lengths: pd.Series) -> pd.Series:
        return lengths.map({n: seed_length(n, identity, coverage) for n in lengths.unique()})

    texts = spread(rows.select("sid", "sequence"), "sid").groupBy("sid").agg(F.first("sequence").alias("sequence")).withColumn("n", F.length("sequence")).withColumn("k", own("n"))
    texts = materialise(texts.withColumn("id", F.monotonically_increasing_id()), "texts")
    members = materialise(rows.select("identifier", "side", "sid").distinct(), "members")
    free(rows)
    pairs = materialise(_candidates(texts, identity, coverage), "pairs")  # its seeds are off the disk before sequences are joined
    tr = texts.select(F.col("id").alias("rep"), F.col("sid").alias("rep_sid"), F.col("sequence").alias("sr"), F.col("n").alias("nr"))
    both = pairs.join(tr, "rep").join(texts.select("id", "sid", F.col("sequence").alias("ss"), "n"), "id").where("nr > n or (nr = n and rep_sid < sid)")
    ok = spread(both, F.xxhash64("rep", "id")).where(accepts(identity, coverage)("ss", "sr"))
    edges = materialise(ok.select("sid", F.col("rep_sid").alias("rep"), "nr"), "edges")
    parent = edges.join(representatives(edges).withColumnRenamed("sid", "rep"), "rep", "left_semi").groupBy("sid").agg(F.max_by("rep", F.struct("nr", -F.col("rep"))).alias("rep"))
    free(texts)
    return members.join(parent, "sid", "left").select(F.coalesce("rep", "sid").cast("string").alias("cluster"), "identifier", "side")


def representatives(edges: DataFrame) -> DataFrame:
    """Of accepted pairs (sid, rep, …), ``rep`` before ``sid`` in one order, the ``sid`` of all representatives.

    A sequence is a representative if it matches none before it. Every other one
    joins a representative that it matches itself, never one by way of a third.
    Each round settles what hangs on settled sequences alone, so there are as
    many rounds as the longest chain of pairs has links.
    """
    left = edges.select("sid", "rep").distinct()
    found = left.select(F.col("rep").alias("sid")).distinct().join(left.select("sid"), "sid", "left_anti")
    found = materialise(found, "representatives")
    new = found
    while True:
        joined = left.join(new.withColumnRenamed("sid", "rep"), "rep", "left_semi").select("sid").distinct()
        open_ = left.join(joined, "sid", "left_anti")
        # pairs with a sequence that has joined say nothing; without any other its partner represents itself
        rest = materialise(open_.join(joined.withColumnRenamed("sid", "rep"), "rep", "left_anti"), "pairs")
        new = materialise(open_.select("sid").distinct().join(rest.select("sid"), "sid", "left_anti"), "representatives")
        if new.isEmpty():
            return found
        old, found, left = found, materialise(found.union(new), "representatives"), rest
        free(old)
