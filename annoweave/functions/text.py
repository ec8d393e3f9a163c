"""Column expressions that bring identifiers and sequences to one form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def accession(col: Column | str) -> Column:
    """One-record form: without the ``accession_`` prefix, every ``|`` as ``_``."""
    return F.translate(F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"^accession_", ""), "|", "_")


def letters(col: Column | str) -> Column:
    """Only the letters of a sequence, in upper case; layout, marks and digits go."""
    return F.upper(F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"[^A-Za-z]", ""))


def split_name(col: Column | str) -> Column:
    """train, test or validation for any spelling or abbreviation; else null."""
    c = F.lower(F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"[^A-Za-z]", ""))
    return (
        F.when(c.startswith("tr"), "train")
        .when(c.startswith("te") | c.startswith("ts"), "test")
        .when(c.startswith("v") | c.startswith("dev"), "validation")
    )


def source_name(col: Column | str) -> Column:
    """A source without case and outer blanks; blank counts as null."""
    c = F.lower(F.trim(F.col(col) if isinstance(col, str) else col))
    return F.when(c != "", c)


def safe_name(col: Column | str) -> Column:
    """File-safe name: trimmed, lower case, blanks and odd characters as ``_``; ``model`` if nothing is left."""
    c = F.lower(F.trim(F.col(col) if isinstance(col, str) else col))
    c = F.regexp_replace(F.regexp_replace(c, r"\s+", "_"), r"[^a-z0-9._-]", "_")
    return F.when(c.isNull() | (c == ""), "model").otherwise(c)
