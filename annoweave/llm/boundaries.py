"""Splitting oversized sequences at natural boundaries (problem 1).

Method: pointer doubling. Every boundary is joined to its farthest legal
successor (overlap included) by a merge join of two sorted position arrays; the
successor table is then squared until it stands still, and every squaring marks
the cuts that lie twice as many hops from the start. All sequences of an Arrow
batch are done at once in one number line, so a chain of n cuts costs log2(n)
array operations and no shuffle: a sequence never leaves its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from annoweave.llm.portions import portions

#: Fixed rule of the data: so many undetermined residues in a row are a boundary.
UNDETERMINED_RUN = 5
#: Letters and marks that are worked on at a time.
LETTERS = 4_000_000

_LONGS = T.ArrayType(T.LongType())
CUTS = T.StructType([T.StructField("boundaries", _LONGS), T.StructField("reach", _LONGS), T.StructField("cuts", _LONGS)])


def residues(col: Column | str) -> Column:
    """The letters of a sequence, case kept."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"[^A-Za-z]", "")


def natural_boundaries(sequences: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Residues of every sequence, and its natural boundaries as (sequence number, residues before), in order.

    A boundary needs a residue on either side: one or more ``*`` or ``-``, or at
    least five ``X`` in a row. White space, digits and any other sign are layout.
    """
    raw = np.frombuffer("".join(sequences).encode("ascii", "replace"), dtype=np.uint8)
    raw = np.where((raw >= 97) & (raw <= 122), raw - 32, raw)
    own = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
    letter = (raw >= 65) & (raw <= 90)
    kept = letter | (raw == ord("*")) | (raw == ord("-"))
    raw, own, letter = raw[kept], own[kept], letter[kept]
    lengths = np.bincount(own[letter], minlength=len(sequences))
    before = np.cumsum(letter) - letter - (np.cumsum(lengths) - lengths)[own]
    # a run of X ends where the next sign is another or of another sequence
    x = np.flatnonzero(raw == ord("X"))
    new = np.append(True, (np.diff(x) > 1) | (np.diff(own[x]) > 0)) if len(x) else np.empty(0, bool)
    first = x[new]
    last = x[np.append(np.flatnonzero(new)[1:] - 1, len(x) - 1)] if len(x) else first
    long = (last - first + 1 >= UNDETERMINED_RUN) & (before[first] > 0)
    marks = np.flatnonzero(~letter)
    who = np.concatenate([own[marks], own[last[long]]])
    at = np.concatenate([before[marks], before[last[long]] + 1])
    inside = (at > 0) & (at < lengths[who])
    found = np.unique(np.stack([who[inside], at[inside]], 1), axis=0)
    return lengths, found[:, 0], found[:, 1]


def greedy_cuts(lengths: np.ndarray, who: np.ndarray, at: np.ndarray, limit: np.ndarray, overlap: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Cuts of every sequence (0 and the end included), all in parallel, and the successor table.

    ``who`` and ``at`` are the natural boundaries in order. The table has a row
    (sequence, boundary, farthest legal successor) for the start and every boundary.
    """
    m = len(lengths)
    if not m:
        return [], *[np.empty(0, np.int64)] * 3
    lengths, limit = lengths.astype(np.int64), limit.astype(np.int64)
    overlap = np.clip(overlap.astype(np.int64), 0, limit - 1)
    step = limit - overlap
    base = np.concatenate([[0], np.cumsum(lengths + 2 * limit + 2)[:-1]]).astype(np.int64)
    # natural nodes: the start, the boundaries and the end of each sequence
    owner = np.concatenate([np.arange(m), who, np.arange(m)])
    place = np.concatenate([np.zeros(m, np.int64), at, lengths])
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    # hard nodes: where no boundary is within reach, a grid of steps up to the next one
    last = np.append(owner[1:] != owner[:-1], True)
    nxt = np.append(place[1:], 0)
    first_reach = place + np.where(place == 0, limit[owner], step[owner])
    count = np.where(last | (nxt <= first_reach), 0, -(-(nxt - first_reach) // step[owner]))
    hard_owner = np.repeat(owner, count)
    hard = np.repeat(first_reach, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * step[hard_owner]
    natural = np.concatenate([~last, np.zeros(len(hard), bool)])
    line = np.concatenate([base[owner] + place, base[hard_owner] + hard])
    own = np.concatenate([owner, hard_owner])
    order = np.argsort(line, kind="stable")
    line, own, natural = line[order], own[order], natural[order]
    nat = base[owner] + place
    pos = line - base[own]
    reach = pos + np.where(pos == 0, limit[own], step[own])
    # the join of every node to its farthest legal successor
    far = nat[np.searchsorted(nat, base[own] + np.minimum(reach, lengths[own]), side="right") - 1]
    target = np.where(far > line, far, base[own] + reach)
    target = np.where(pos == lengths[own], line, target)
    succ = np.searchsorted(line, target)
    table = own[natural], pos[natural], target[natural] - base[own[natural]]
    # pointer doubling
    taken = pos == 0
    while True:
        taken[succ[taken]] = True
        squared = succ[succ]
        if np.array_equal(squared, succ):
            break
        succ = squared
    cut, who = pos[taken], own[taken]
    return np.split(cut, np.searchsorted(who, np.arange(1, m))), *table


@F.pandas_udf(CUTS)
def _cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for seq, limit, overlap in batches:
        out = []
        for lo, hi in portions(seq.str.len(), LETTERS):
            lengths, who, at = natural_boundaries(seq.iloc[lo:hi].tolist())
            cuts, owner, start, reach = greedy_cuts(lengths, who, at, limit.iloc[lo:hi].to_numpy(), overlap.iloc[lo:hi].to_numpy())
            ends = np.searchsorted(owner, np.arange(1, hi - lo))
            out += zip(np.split(start, ends), np.split(reach, ends), cuts)
        yield pd.DataFrame(out, columns=["boundaries", "reach", "cuts"])


def split_oversized(items: DataFrame, keys: list[str], sequence: str, limit: str, overlap: str) -> DataFrame:
    """One row per oversized item: keys, residues, overlap, ``boundaries``, ``reach``, ``cuts``.

    ``boundaries`` are the nodes of the successor table: the start and every natural
    boundary; ``reach`` is the farthest place at which a piece that starts there may end.

    An item is oversized if it has more residues than ``limit``. Equal items
    (same keys, same residues and marks, whatever the layout) count once. Null
    sequences, sequences without residues and null or non-positive limits are
    never oversized; a null overlap is 0 and one of ``limit`` or more is
    ``limit - 1``. Columns besides the named ones are dropped, so their names
    cannot clash. The filter runs before the only shuffle, which therefore holds
    oversized items alone.
    """
    clean = F.regexp_replace(F.regexp_replace(F.col(sequence), r"[^A-Za-z*\-]", ""), r"^[*\-]+|[*\-]+$", "")
    big = (
        items.select(*keys, F.upper(clean).alias("_clean"), F.col(limit).cast("long").alias("_limit"), F.coalesce(F.col(overlap).cast("long"), F.lit(0)).alias("_overlap"))
        .where((F.col("_limit") > 0) & (F.length("_clean") > F.col("_limit")) & (F.length(residues("_clean")) > F.col("_limit")))
        .distinct()
    )
    out = big.withColumn("_c", _cuts("_clean", "_limit", "_overlap"))
    return out.select(*keys, residues("_clean").alias("residues"), F.least(F.greatest("_overlap", F.lit(0)), F.col("_limit") - 1).alias("overlap"), "_c.boundaries", "_c.reach", "_c.cuts")


def boundary_rows(split: DataFrame, keys: list[str]) -> DataFrame:
    """One distinct row per key and node of the successor table: the start (0) and the natural boundaries."""
    return split.select(*keys, F.explode("boundaries").alias("boundary_at")).distinct()


def pieces(split: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered pieces: number, start, end, whether the end is natural, residues."""
    cut = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.size("cuts") - 1),
            lambda i: F.struct(
                i.cast("long").alias("piece_no"),
                F.when(i == 1, F.lit(0).cast("long")).otherwise(F.element_at("cuts", i) - F.col("overlap")).alias("start_at"),
                F.element_at("cuts", i + 1).alias("end_at"),
            ),
        )
    )
    return (
        split.withColumn("_p", cut)
        .select(
            *keys,
            "_p.piece_no",
            "_p.start_at",
            "_p.end_at",
            (F.array_contains("boundaries", F.col("_p.end_at")) | (F.col("_p.end_at") == F.length("residues"))).alias("natural_end"),
            F.expr("substring(residues, int(_p.start_at) + 1, int(_p.end_at - _p.start_at))").alias("piece"),
        )
    )
