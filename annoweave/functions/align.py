"""Global and local pairwise alignment with affine gaps, many pairs at once.

A gap of length n costs open + (n - 1) * extend. All pairs of a batch advance
row by row together: the vertical gap is carried, the horizontal one is a running
maximum along the row (an opened gap never pays to be opened again from itself).
Ties in the traceback: diagonal before a gap in the reference, before a gap in the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from annoweave.schema import METRICS

#: Order of the residues, and the published substitution scores
#: (BLOSUM62, lower triangle, one row per residue).
RESIDUES = "ARNDCQEGHILKMFPSTWYV"
SCORES = """
4
-1 5
-2 0 6
-2 -2 1 6
0 -3 -3 -3 9
-1 1 0 0 -3 5
-1 0 0 2 -4 2 5
0 -2 0 -1 -3 -2 -2 6
-2 0 1 -1 -3 0 0 -2 8
-1 -3 -3 -3 -1 -3 -3 -4 -3 4
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4
"""
#: Ambiguous residues stand for the mean of two; any other letter scores OTHER.
AMBIGUOUS, OTHER = {"B": "ND", "Z": "QE"}, -1
OPEN, EXTEND = 10, 1
#: Cells (pairs x query x reference) of a batch, which bounds its memory.
CELLS = 12_000_000
#: Cells of the trace that are kept whole; a larger one is made again in stretches of
#: sqrt(rows), so a pair of any length needs memory of n ** 1.5 and twice the time.
TRACE = 64_000_000


def matrix() -> np.ndarray:
    """Scores by letter number (A = 0); 26 is padding."""
    m = np.full((27, 27), OTHER, dtype=np.int32)
    at = {r: ord(r) - 65 for r in RESIDUES}
    for i, line in enumerate(SCORES.split("\n")[1:-1]):
        for j, s in enumerate(line.split()):
            m[at[RESIDUES[i]], at[RESIDUES[j]]] = m[at[RESIDUES[j]], at[RESIDUES[i]]] = int(s)
    for letter, pair in AMBIGUOUS.items():
        k = ord(letter) - 65
        mean = np.trunc((m[at[pair[0]]] + m[at[pair[1]]]) / 2).astype(np.int32)
        m[k], m[:, k] = mean, mean
    for letter, pair in AMBIGUOUS.items():
        k = ord(letter) - 65
        m[k, k] = (m[at[pair[0]], at[pair[0]]] + m[at[pair[1]], at[pair[1]]]) // 2 - 1
    return m


def _letters(texts: list[str], width: int) -> np.ndarray:
    out = np.full((len(texts), width), 26, dtype=np.int8)
    for i, t in enumerate(texts):
        raw = np.frombuffer(t.encode("ascii", "replace"), dtype=np.uint8)
        out[i, : len(raw)] = np.where((raw >= 65) & (raw <= 90), raw - 65, 23)
    return out


def align(queries: list[str], references: list[str], local: bool, gap_open: int = OPEN, gap_extend: int = EXTEND) -> np.ndarray:
    """Per pair: score, alignment length, identical, positive, gaps."""
    n, m = max(map(len, queries), default=0), max(map(len, references), default=0)
    size = len(queries)
    out = np.zeros((size, 5), dtype=np.int64)
    lq, lr = np.array([len(q) for q in queries]), np.array([len(r) for r in references])
    if not local:
        edge = np.where(lq + lr > 0, -(gap_open + (lq + lr - 1) * gap_extend), 0)
        empty = (lq == 0) | (lr == 0)
        out[empty, 0], out[empty, 1], out[empty, 4] = edge[empty], (lq + lr)[empty], (lq + lr)[empty]
    if not n or not m or not size:
        return out
    # scores of short sequences fit 16 bits, which halves the traffic
    kind = np.int16 if (n + m) * 12 < 30_000 and gap_open < 1000 else np.int32
    score_of, low = matrix().astype(kind), kind(-30_000 if kind is np.int16 else -(1 << 28))
    go, ge = kind(gap_open), kind(gap_extend)
    a, b = _letters(queries, n), _letters(references, m)
    rows = np.arange(size)
    profile = score_of.astype(np.int8)[:, b]  # letter of the query, pair, place in the reference
    slope = (np.arange(m + 1) * gap_extend).astype(kind)
    border = lambda k: kind(0 if local or k == 0 else -(gap_open + (k - 1) * gap_extend))
    h = np.tile(np.array([border(k) for k in range(m + 1)], dtype=kind), (size, 1))
    e = np.full((size, m + 1), low // 2, dtype=kind)
    f, base, diagonal, opened = (np.full((size, m + 1), low // 2, dtype=kind) for _ in range(4))
    bit = np.empty((size, m + 1), dtype=bool)
    best, end_i, end_j = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    final = np.zeros(size, np.int64)
    inside = np.arange(m + 1)[None, :] <= lr[:, None]

    def advance(i: int, code: np.ndarray) -> None:
        """Row i from the one before, in place. Bits of ``code``: 1 from the diagonal, 2 from the
        vertical gap, 4 vertical gap goes on, 8 horizontal gap goes on, 16 local stop."""
        np.subtract(e, ge, out=e)
        np.subtract(h, go, out=opened)
        np.greater(e, opened, out=bit)
        np.left_shift(bit.view(np.uint8), 2, out=code)
        np.maximum(e, opened, out=e)
        e[:, 0] = border(i)
        np.add(h[:, :-1], profile[a[:, i - 1], rows], out=diagonal[:, 1:])
        np.maximum(diagonal, e, out=base)
        if local:
            np.maximum(base, 0, out=base)
        np.add(base, slope, out=opened)
        np.maximum.accumulate(opened, axis=1, out=opened)
        np.subtract(opened[:, :-1], slope[1:] + (go - ge), out=f[:, 1:])
        np.maximum(base, f, out=h)
        np.equal(h, diagonal, out=bit)
        np.bitwise_or(code, bit.view(np.uint8), out=code)
        np.equal(h, e, out=bit)
        np.bitwise_or(code, np.left_shift(bit.view(np.uint8), 1), out=code)
        np.equal(f[:, 1:], f[:, :-1] - ge, out=bit[:, 1:])
        bit[:, 0] = False
        np.bitwise_or(code, np.left_shift(bit.view(np.uint8), 3), out=code)
        if local:
            np.less_equal(h, 0, out=bit)
            np.bitwise_or(code, np.left_shift(bit.view(np.uint8), 4), out=code)

    # the whole trace is kept if it is small; else only every so many rows, from
    # which the trace is made again, stretch by stretch, when the way back needs it
    stretch = n if (n + 1) * (m + 1) * size <= TRACE else max(1, int(np.ceil(np.sqrt(n))))
    trace = np.zeros((stretch, size, m + 1), dtype=np.uint8)
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(1, n + 1):
        if stretch < n and (i - 1) % stretch == 0:
            kept.append((h.copy(), e.copy()))
        advance(i, trace[(i - 1) % stretch])
        if local:
            here = np.where(inside, h, kind(-1))
            j = here.argmax(1)
            top = here[rows, j]
            better = (top > best) & (i <= lq)
            best[better], end_i[better], end_j[better] = top[better], i, j[better]
        done = lq == i
        final[done] = h[rows, lr][done]
    if local:
        out[:, 0] = best
        i, j = end_i.copy(), end_j.copy()
    else:
        ok = (lq > 0) & (lr > 0)
        out[ok, 0] = final[ok]
        i, j = np.where(ok, lq, 0), np.where(ok, lr, 0)
    state = np.zeros(size, np.int8)  # 0 match, 1 in a vertical gap, 2 in a horizontal gap
    for lo in range((n - 1) // stretch * stretch, -1, -stretch):
        if stretch < n:
            h[...], e[...] = kept[lo // stretch]
            for x in range(lo + 1, min(lo + stretch, n) + 1):
                advance(x, trace[x - 1 - lo])
        while True:
            code = np.where(i > lo, trace[np.clip(i - 1 - lo, 0, stretch - 1), rows, j], 0).astype(np.uint8)
            live = ((i > 0) | (j > 0)) if not local else ((i > 0) & (j > 0) & ~((code & 16).astype(bool) & (state == 0)))
            # what has left this stretch waits for the one before it
            live &= (i > lo) | (lo == 0)
            if not live.any():
                break
            forced_up, forced_left = live & (j == 0), live & (i == 0)
            at = state.copy()
            at[(state == 0) & ((code & 3) == 2)] = 1
            at[(state == 0) & ((code & 3) == 0)] = 2
            at[forced_up], at[forced_left] = 1, 2
            up, left = live & (at == 1), live & (at == 2)
            match = live & (at == 0)
            x, y = a[rows, np.maximum(i - 1, 0)], b[rows, np.maximum(j - 1, 0)]
            out[:, 1] += live
            out[:, 2] += match & (x == y)
            out[:, 3] += match & ((x == y) | (score_of[x, y] > 0))
            out[:, 4] += up | left
            after = np.where(up, np.where((code & 4) > 0, 1, 0), np.where(left, np.where((code & 8) > 0, 2, 0), 0))
            state = np.where(live, after, state).astype(np.int8)
            i = i - (match | up)
            j = j - (match | left)
    return out


def metrics(queries: pd.Series, references: pd.Series, sides: tuple = (("", False), ("_sw", True))) -> pd.DataFrame:
    """The twelve metrics of every pair; null where a sequence is null. Shares lie in [0, 1].

    ``sides`` (suffix, whether local) can leave out one of the two alignments, whose metrics are null then.
    """
    names = ["identity", "similarity", "alignment_score", "gaps_percentage", "alignment_length"]
    out = {c: np.full(len(queries), np.nan) for side in ("", "_sw") for c in (n + side for n in names)}
    ok = np.flatnonzero((queries.notna() & references.notna()).to_numpy())
    q, r = queries.to_numpy(dtype=object), references.to_numpy(dtype=object)
    # pairs of like size share a batch, so little is spent on padding
    ok = np.array(sorted(ok, key=lambda i: (int(np.log2(len(q[i]) + 1) * 3), len(r[i]))), dtype=np.int64)
    lo = 0
    while lo < len(ok):
        hi, wide, high = lo, 1, 1
        while hi < len(ok):
            wide, high = max(wide, len(q[ok[hi]]) + 1), max(high, len(r[ok[hi]]) + 1)
            if hi > lo and (hi - lo + 1) * wide * high > CELLS:
                break
            hi += 1
        part = ok[lo:hi]
        for side, local in sides:
            got = align([q[i].upper() for i in part], [r[i].upper() for i in part], local)
            length = np.maximum(got[:, 1], 1)
            for name, v in zip(names, (got[:, 2] / length, got[:, 3] / length, got[:, 0], got[:, 4] / length, got[:, 1])):
                out[name + side][part] = v
        lo = hi
    frame = pd.DataFrame(out)
    frame["length_query"] = [len(x) if isinstance(x, str) else None for x in q]
    frame["length_reference"] = [len(x) if isinstance(x, str) else None for x in r]
    return frame


def _frames(batches: Iterator[tuple[pd.Series, pd.Series]], **conf) -> Iterator[pd.DataFrame]:
    for q, r in batches:
        frame = metrics(q, r, **conf)
        for c in ("length_query", "length_reference"):
            frame[c] = frame[c].astype("Int32")
        yield frame


@F.pandas_udf(METRICS)
def alignment(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Struct of the twelve metrics of a query and a reference sequence."""
    yield from _frames(batches)


@F.pandas_udf(METRICS)
def local_alignment(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The same without the global alignment, whose metrics are null."""
    yield from _frames(batches, sides=(("_sw", True),))
