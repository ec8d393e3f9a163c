"""Evaluation passages inside training text (problem 7).

Method: winnowing. Words are hashed, every run of ``GRAM`` words gets a hash, and
of each window of ``WINDOW`` consecutive runs the least is kept. A shared span of
at least WINDOW + GRAM - 1 words (ten) shares a kept hash for certain. Kept
hashes of documents are joined with those of the passages, and every hit is
extended to both sides, word by word, to the whole common span.

One plan serves any number of passages. A bit map of the passages' hashes, whose
size has a bound, goes to every task, so of the documents only those that may
hold a passage leave the scan, once, with the hashes of their words: texts are
read and cut into words once and never shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from annoweave.llm.portions import portions
from annoweave.llm.weighted_sampling import mix
from annoweave.runtime import materialise

#: GRAM + WINDOW - 1 is the least span found for certain (a fixed value of the task).
SPAN, GRAM = 10, 5
WINDOW = SPAN - GRAM + 1
#: Most bits of the map of the passages' hashes (16 MB), bits for each hash up to
#: there, and how many of them are set. One hash in 65,000 passes by chance; a full
#: map lets every hash pass, which costs time but loses nothing.
MAP_BITS, BITS_A_HASH, PROBES = 1 << 27, 64, 4
#: Parts into which the documents of one hash are split where they meet the passages.
SALT = 16
#: Characters of documents that are worked on at a time.
CHARS = 500_000
_WORD = re.compile(r"[^\W_]+")
#: The Unicode blocks of combining marks.
_ACCENTS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+")


def words(text: str) -> list[str]:
    """Longest runs of letters or digits, without case and accents."""
    if text.isascii():
        return _WORD.findall(text.lower())
    plain = _ACCENTS.sub("", unicodedata.normalize("NFKD", text)).casefold()
    return _WORD.findall(_ACCENTS.sub("", unicodedata.normalize("NFKD", plain)))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Stable 64-bit hashes of all words, and the number of words of each text."""
    split = [words(t) for t in texts]
    count = np.array([len(w) for w in split], dtype=np.int64)
    flat = np.array([w for ws in split for w in ws], dtype=object)
    return (pd.util.hash_array(flat, categorize=True) if len(flat) else np.empty(0, np.uint64)), count


def _grams(h: np.ndarray) -> np.ndarray:
    n = len(h) - GRAM + 1
    if n < 1:
        return np.empty(0, np.uint64)
    g = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        g = g * np.uint64(0x9E3779B97F4A7C15) + mix(h[i : i + n])
    return mix(g)


def winnow(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kept fingerprints of texts: (text number, word place in the joined words, hash).

    Texts of fewer words than SPAN have none. The rightmost of equal least
    hashes is kept, as usual, so that long repetitions keep few.
    """
    g = _grams(h)
    m = len(g) - WINDOW + 1
    if m < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    own = np.repeat(np.arange(len(count)), count)
    low, at = g[:m].copy(), np.zeros(m, dtype=np.int64)
    for i in range(1, WINDOW):
        nxt = g[i : i + m]
        less = nxt <= low
        low[less], at[less] = nxt[less], i
    place = (np.arange(m) + at)[own[np.arange(m)] == own[np.arange(m) + SPAN - 1]]
    place = np.unique(place)
    return own[place], place, g[place]


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest stretch in which two rows of word hashes agree place by place."""
    ends = np.flatnonzero(np.concatenate([[True], a != b, [True]]))
    return int(np.diff(ends).max()) - 1


_PRINTS = "id long, words binary, prints array<struct<place: int, g: long>>"


def _prints(texts: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """(id, word hashes, fingerprints) of (id, t); with ``bits`` only of texts of which a fingerprint is in the map, and only those."""
    held = texts.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo, hi in portions(pdf["t"].str.len(), CHARS):
                part = pdf.iloc[lo:hi]
                h, count = word_hashes(part["t"].tolist())
                own, place, g = winnow(h, count)
                if held is not None:
                    hit = in_map(held.value, g)
                    own, place, g = own[hit], place[hit], g[hit]
                start = np.cumsum(count) - count
                rows, first = np.unique(own, return_index=True)
                ids, out = part["id"].to_numpy(), []
                for n, a, z in zip(rows, first, np.append(first[1:], len(own))):
                    pairs = [{"place": x, "g": y} for x, y in zip((place[a:z] - start[n]).tolist(), g[a:z].view(np.int64).tolist())]
                    out.append((ids[n], h[start[n] : start[n] + count[n]].tobytes(), pairs))
                yield pd.DataFrame(out, columns=["id", "words", "prints"])

    return texts.mapInPandas(run, _PRINTS)


def _probes(g: np.ndarray, bits: int) -> np.ndarray:
    """The places in a map of so many bits (a power of two) of every hash."""
    return np.stack([mix(g + np.uint64(i)) for i in range(PROBES)], 1) & np.uint64(bits - 1)


def in_map(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Whether all bits of each hash are set."""
    at = _probes(g, 64 * len(bits))
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).all(1)


def _bit_map(passages: DataFrame) -> np.ndarray:
    """The map of the passages' fingerprints; no more rows than it has words of 64 bits reach the driver."""
    g = passages.select(F.explode("prints.g").alias("g"))
    size = 1 << max(6, min(MAP_BITS.bit_length() - 1, int(BITS_A_HASH * g.count()).bit_length()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = np.unique(_probes(pdf["g"].to_numpy(np.int64).view(np.uint64), size))
            yield pd.DataFrame({"w": (at >> np.uint64(6)).view(np.int64), "b": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    words = g.mapInPandas(run, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return bits


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every document the words that lie against each passage that it meets."""
    for pdf in batches:
        for d, words, want in zip(pdf["d"], pdf["words"], pdf["want"]):
            h = np.frombuffer(words, np.uint64)
            for lo in range(0, len(want), 1000):
                rows = []
                for x in want[lo : lo + 1000]:
                    a, z = max(0, x["shift"]), min(len(h), x["shift"] + x["n"])
                    rows.append((d, x["i"], a - x["shift"], h[a:z].tobytes()))
                yield pd.DataFrame(rows, columns=["d", "i", "at", "part"])


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        span = []
        for at, part, words in zip(pdf["at"], pdf["part"], pdf["words"]):
            x = np.frombuffer(part, np.uint64)
            span.append(longest_run(x, np.frombuffer(words, np.uint64)[at : at + len(x)]))
        yield pdf[["d", "i"]].assign(span=span)


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str) -> DataFrame:
    """(doc_id, item_id, span): the longest common run of words, if it has ten or more.

    Null texts and passages, null ids, and texts of fewer than ten words match
    nothing; a passage that quotes another counts for itself. Other columns are
    not carried.
    """
    known = lambda df, key, col: df.select(F.col(key).cast("long").alias("id"), F.col(col).alias("t")).where(F.col("t").isNotNull() & F.col("id").isNotNull())
    p = materialise(_prints(known(items, item_id, passage)), "passages")
    met = materialise(_prints(known(docs, doc_id, text), _bit_map(p)), "leaky")
    a = met.select(F.col("id").alias("d"), F.explode("prints").alias("x")).select("d", "x.place", "x.g", F.pmod(F.xxhash64("d"), F.lit(SALT)).alias("salt"))
    b = p.select(F.col("id").alias("i"), (F.octet_length("words") / 8).cast("int").alias("n"), F.explode("prints").alias("x"))
    b = b.select("i", "n", F.col("x.place").alias("from"), "x.g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("salt"))
    # a hit fixes how document and passage lie against each other; hits of one shift are one comparison
    pairs = a.join(b, ["g", "salt"]).select("d", "i", "n", (F.col("place") - F.col("from")).alias("shift")).distinct()
    want = pairs.groupBy("d").agg(F.collect_list(F.struct("i", "n", "shift")).alias("want"))
    parts = met.select(F.col("id").alias("d"), "words").join(want, "d").mapInPandas(_stretches, "d long, i long, at int, part binary")
    spans = parts.join(p.select(F.col("id").alias("i"), "words"), "i").mapInPandas(_spans, "d long, i long, span long")
    return spans.where(F.col("span") >= SPAN).groupBy("d", "i").agg(F.max("span").alias("span")).toDF(doc_id, item_id, "span")
