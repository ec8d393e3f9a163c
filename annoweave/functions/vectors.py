"""Vector expressions in DOUBLE, for plans that Catalyst should see through."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def is_vector(a: Column | str) -> Column:
    """Not null or empty, only finite numbers, and not all zero (whose direction is undefined)."""
    fine = F.forall(_c(a), lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(_c(a)) > 0) & fine & F.exists(_c(a), lambda x: x != 0), F.lit(False))


def euclidean(a: Column | str, b: Column | str) -> Column:
    squares = F.zip_with(_c(a), _c(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def reliability(distance: Column | str, metric: str) -> Column:
    """1 - d for cosine, 0.5 / (0.5 + d) for euclidean, 1 / (1 + d) otherwise."""
    d = _c(distance)
    if metric == "cosine":
        return 1 - d
    return 0.5 / (0.5 + d) if metric == "euclidean" else 1 / (1 + d)
