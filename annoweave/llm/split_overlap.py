"""Records of evaluation splits that occur in the training material (problem 6).

Method: hashes of canonicalised records (letters only, one case; layout, marks
and digits gone) are joined, evaluation against training, which finds all equal
records. "Almost equal" cannot show in a hash of a whole record, so the second
tier hashes the canonical record's parts: banded consistent samples of its
shingles (see weighted_sampling) are joined in the same way and the meetings
verified exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from annoweave.llm import near_duplicates as nd


def hashed(records: DataFrame, text: str) -> DataFrame:
    """The records with the two 64-bit hashes of their canonical text that the exact tier joins."""
    return records.withColumn("text_id", F.xxhash64(text)).withColumn("check", F.xxhash64(F.reverse(text)))


def exact_overlaps(evaluation: DataFrame, training: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct ``keys`` of both sides' records with equal canonical texts, of any length.

    Both sides are :func:`hashed`. Only keys and hashes are shuffled. Records
    without a letter are equal to nothing.
    """
    left = evaluation.where(F.length("text") > 0).select(*[c for c in keys if c in evaluation.columns], "text_id", "check").distinct()
    right = training.where(F.length("text") > 0).select(*[c for c in keys if c in training.columns], "text_id", "check").distinct()
    return left.join(right, ["text_id", "check"]).select(*keys).distinct()


def near_overlaps(texts: DataFrame, text: str, left: str, right: str, exact: bool = False) -> DataFrame:
    """(a, b) of similar different texts, ``a`` of the left side, ``b`` of the right.

    ``texts`` has distinct texts of a shingle's length or more with text_id and
    two flags; one text may be on both sides. No texts on a side, no rows.
    """
    idf, rows = nd._met(texts, text, exact, keep=(left, right))
    pairs = nd.candidate_pairs(rows, "text_id", left, right)
    return nd.verified(pairs, texts, texts, "text_id", text, idf).select("a", "b")
