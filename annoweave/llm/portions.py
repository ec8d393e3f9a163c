"""Cutting a batch of texts into portions of bounded size, and choosing a share of rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, functions as F


def portions(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges (from, to) of rows whose sizes add up to ``most`` at most; a larger row is alone."""
    lo, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if i >= lo:
        yield lo, i + 1


def sampled(share: Column, seed: int, *cols: str) -> Column:
    """Whether a row falls into a share (0 to 1) of all, by 64 bits of a hash: no share is too small for it."""
    return (F.xxhash64(*cols, F.lit(seed)).cast("double") / F.lit(2.0**64) + 0.5) < share
