"""Consistent weighted samples of residue shingles (problems 3 and 6).

Improved consistent weighted sampling (Ioffe): for a shingle of weight S the
variates r, c ~ Gamma(2, 1) and b ~ U(0, 1) are functions of shingle and sample
number; with t = floor(ln S / r + b) the sample is the shingle (and its t) with
the least ln c - r (t + 1 - b). Two texts agree in a sample with a probability
equal to their weighted Jaccard similarity. Weights are TF-IDF: occurrences
times ln(1 + N / df), with df counted over all texts and floored at a share of N,
so that the table of exceptions has a size bound (mean length / share).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from annoweave.llm.portions import portions
from annoweave.runtime import materialise

#: Residues of a shingle (a fixed value of the task), samples of a band, bands,
#: and the share of N at which df is floored.
K, ROWS, BANDS, DF_SHARE = 8, 2, 40, 0.002
#: Most entries of the table of frequent shingles, which the driver and every task hold (16 bytes each).
LISTED = 4_000_000
_SEED, _TABLE = 20_240_229, 1 << 16
#: Shingles that are sampled at a time, so that the arrays stay in cache.
_CHUNK = 150_000
#: Letters of the texts that are worked on at a time.
LETTERS = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All shingles of texts as 40-bit codes, exact for A-Z.

    Case does not matter; signs other than letters fall together, so a caller
    who wants them ignored removes them first. Returns codes, the text each belongs to, its place in the joined texts, and
    the texts' starts in there.
    """
    raw = np.frombuffer("".join(texts).encode("ascii", "replace"), dtype=np.uint8)
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(lens) - lens
    per = np.maximum(lens - K + 1, 0)
    own = np.repeat(np.arange(len(texts)), per)
    place = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + starts[own]
    code = np.zeros(len(own), dtype=np.int64)
    letter = (raw.astype(np.int64) - 65) & 31
    for i in range(K):
        code = (code << 5) | letter[place + i]
    return code, own, place, starts


def counted(code: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, code) in order, with their counts."""
    key, n = np.unique((own.astype(np.uint64) << np.uint64(40)) | code.astype(np.uint64), return_counts=True)
    return (key & np.uint64((1 << 40) - 1)).astype(np.int64), (key >> np.uint64(40)).astype(np.int64), n


class Idf:
    """ln(1 + N / df) with df floored; only shingles above the floor are listed."""

    def __init__(self, codes: np.ndarray, df: np.ndarray, n_texts: int, floor: float):
        order = np.argsort(codes)
        self.codes = codes[order]
        self.values = np.log1p(n_texts / np.maximum(df[order], floor))
        self.default = float(np.log1p(n_texts / floor)) if n_texts else 1.0

    def __call__(self, code: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(code), self.default)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.values[at], self.default)


def document_frequencies(texts: DataFrame, text: str) -> Idf:
    """Counts every shingle over all texts; brings home those above the floor.

    The floor is ``DF_SHARE`` of the texts (2 at least), so no more than mean
    length / DF_SHARE shingles can pass it, however many texts there are. Where
    that would be more than ``LISTED``, the floor is doubled until it is not.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text].tolist()
            for lo, hi in portions(map(len, texts), LETTERS):
                code, own, *_ = shingles(texts[lo:hi])
                code, _, _ = counted(code, own)
                code, n = np.unique(code, return_counts=True)
                yield pd.DataFrame({"code": code, "n": n})

    total = texts.count()
    floor = max(2.0, DF_SHARE * total)
    hot = materialise(texts.select(text).mapInPandas(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") > floor), "frequencies")
    # how many pass the floor, twice the floor, and so on
    levels = {r["x"]: r["k"] for r in hot.groupBy(F.floor(F.log2(F.col("n") / floor) - 1e-9).alias("x")).agg(F.count(F.lit(1)).alias("k")).collect()}
    raised = next(i for i in range(64) if sum(k for x, k in levels.items() if x >= i) <= LISTED)
    floor *= 2**raised
    hot = hot.where(F.col("n") > floor).toPandas()
    return Idf(hot["code"].to_numpy(np.int64), hot["n"].to_numpy(np.int64), total, floor)


def _variates() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    g = np.random.default_rng(_SEED)
    r = g.gamma(2.0, 1.0, _TABLE).astype(np.float32)
    c = np.log(g.gamma(2.0, 1.0, _TABLE)).astype(np.float32)
    b = g.random(_TABLE).astype(np.float32)
    odd = g.integers(1 << 62, (1 << 63) - 1, ROWS * BANDS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return r, c, b, odd


def signatures(texts: list[str], idf: Idf) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the texts that have a shingle, and their bucket of every band."""
    r, c, b, odd = _variates()
    code, own, n = counted(*shingles(texts)[:2])
    present, starts = np.unique(own, return_index=True)
    out = np.empty((len(present), BANDS), dtype=np.int64)
    ends = np.append(starts[1:], len(own))
    lo = 0
    while lo < len(present):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _CHUNK)))
        a, z = starts[lo], ends[hi - 1]
        mixed = mix(code[a:z])
        ln_s = np.log(n[a:z] * idf(code[a:z])).astype(np.float32)
        first = starts[lo:hi] - a
        sizes = ends[lo:hi] - starts[lo:hi]
        for band in range(BANDS):
            sig = np.full(hi - lo, band + 1, dtype=np.uint64)
            for j in range(band * ROWS, (band + 1) * ROWS):
                at = ((mixed * odd[j]) >> np.uint64(48)).astype(np.int32)
                rr, bb = r[at], b[at]
                t = np.floor(ln_s / rr + bb)
                la = c[at] - rr * (t + 1 - bb)
                low = np.minimum.reduceat(la, first)
                hit = np.flatnonzero(la == np.repeat(low, sizes))
                hit = hit[np.unique(np.searchsorted(first, hit, side="right"), return_index=True)[1]]
                sig = mix(sig * np.uint64(0x9E3779B97F4A7C15) + mixed[hit] + mix((t[hit].astype(np.int64) + 4096).astype(np.uint64)))
            out[lo:hi, band] = sig.view(np.int64)
        lo = hi
    return present, out


def sketch(texts: DataFrame, key: str, text: str, idf: Idf, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row (key, kept columns, bucket) per text and band."""
    spark = texts.sparkSession
    table = spark.sparkContext.broadcast((idf.codes, idf.values, idf.default))
    cols = [key, *keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Idf.__new__(Idf)
        own.codes, own.values, own.default = table.value
        for pdf in batches:
            texts = pdf[text].tolist()
            for lo, hi in portions(map(len, texts), LETTERS):
                present, sig = signatures(texts[lo:hi], own)
                if len(present):
                    yield pdf[cols].iloc[np.repeat(present + lo, BANDS)].assign(bucket=sig.ravel())

    schema = texts.select(*cols).withColumn("bucket", F.lit(0).cast("long")).schema
    return texts.select(*cols, text).mapInPandas(run, schema)


def shingle_rows(texts: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row (key, kept columns, bucket) per text and distinct shingle; the bucket is the shingle."""
    cols = [key, *keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text].tolist()
            for lo, hi in portions(map(len, texts), LETTERS):
                code, own, _ = counted(*shingles(texts[lo:hi])[:2])
                yield pdf[cols].iloc[own + lo].assign(bucket=code)

    schema = texts.select(*cols).withColumn("bucket", F.lit(0).cast("long")).schema
    return texts.select(*cols, text).mapInPandas(run, schema)


def compare(a: list[str], b: list[str], idf: Idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted Jaccard, and the shares of a's and b's residues that lie in common shingles."""
    sides = []
    for texts in (a, b):
        code, own, place, starts = shingles(texts)
        sides.append((code, own, place, starts, np.array([len(t) for t in texts], dtype=np.int64), (own.astype(np.uint64) << np.uint64(40)) | code.astype(np.uint64)))
    shared = []
    for (code, own, place, starts, lens, key), other in ((sides[0], sides[1][5]), (sides[1], sides[0][5])):
        hit = np.isin(key, other)
        edge = np.zeros(int(lens.sum()) + 1, dtype=np.int32)
        np.add.at(edge, place[hit], 1)
        np.add.at(edge, place[hit] + K, -1)
        covered = np.append(0, np.cumsum(np.cumsum(edge[:-1]) > 0))
        shared.append((covered[starts + lens] - covered[starts]) / np.maximum(lens, 1))
    ka, na = np.unique(sides[0][5], return_counts=True)
    kb, nb = np.unique(sides[1][5], return_counts=True)
    both, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)

    def total(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = n * idf((keys & np.uint64((1 << 40) - 1)).astype(np.int64))
        return np.bincount((keys >> np.uint64(40)).astype(np.int64), weights=w, minlength=len(a))

    least = total(both, np.minimum(na[ia], nb[ib]))
    most = total(ka, na) + total(kb, nb) - least
    return least / np.maximum(most, 1e-12), shared[0], shared[1]
