"""FASTA sources: a tolerant parser, header scan, file discovery, folder batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from annoweave.functions.text import accession

#: Letters that a first sequence line may hold, file endings by
#: priority, and the mark after an identifier.
ALPHABET = "ACDEFGHIKLMNPQRSTVWYBXZJOU"
ENDINGS = ("pep", "faa", "fa", "fasta")
_RESIDUES = re.compile(f"[{ALPHABET}]+", re.IGNORECASE)


def records(lines: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(identifier, sequence) in file order.

    The identifier is the first word of the header, ``unknown`` if there is none.
    Until a line holds nothing but residue letters it continues the header;
    afterwards every line is sequence, blanks removed, upper case. Text before
    the first ``>`` opens a record of its own; residues there belong to none. A
    record may have an empty sequence.
    """
    header: list[str] | None = None
    body: list[str] = []
    for line in lines:
        if line.startswith(">"):
            if header is not None:
                yield _identifier(header), "".join(body)
            header, body = [line[1:]], []
            continue
        line = line.strip()
        if not line:
            continue
        if body or _RESIDUES.fullmatch(line):
            body.append(re.sub(r"\s+", "", line).upper())
        else:
            header = [*(header or []), line]
    if header is not None:
        yield _identifier(header), "".join(body)


def _identifier(header: list[str]) -> str:
    words = " ".join(header).split()
    return words[0] if words else "unknown"


def read(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(path, position, identifier, sequence) of all records; ``.gz`` files too.

    Files are split between records, so a large one is read by many tasks through
    Spark's own file systems; a record must fit a row. ``position`` grows along a
    file. ``limit`` keeps the first records in order of path and position.
    """
    meta = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    chunks = spark.read.text(path, lineSep="\n>").select(*meta, F.col("value").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, int], int] = {}
        for pdf in batches:
            rows = []
            for p, block, text in zip(pdf["path"], pdf["block"], pdf["text"]):
                n = seen.get((p, block), 0)
                seen[p, block] = n + 1
                # the separator took the mark of every record but a file's first
                whole = text if block == 0 and n == 0 else ">" + text
                # a record has a byte at least, so records of a block never reach the next one's start
                rows += [(p, block + n, name, seq) for name, seq in records(whole.split("\n"))]
            yield pd.DataFrame(rows, columns=["path", "position", "identifier", "sequence"])

    out = chunks.mapInPandas(run, "path string, position long, identifier string, sequence string")
    return out.orderBy("path", "position").limit(limit) if limit else out


def parse(texts: DataFrame, text: str) -> DataFrame:
    """(identifier, sequence, position) of whole FASTA texts held in a column, other columns kept."""
    keep = [c for c in texts.columns if c != text]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, n, name, seq) for i, t in enumerate(pdf[text]) if t is not None for n, (name, seq) in enumerate(records(t.splitlines()))]
            got = pd.DataFrame(rows, columns=["_i", "position", "identifier", "sequence"])
            yield pd.concat([pdf[keep].iloc[got["_i"]].reset_index(drop=True), got.drop(columns="_i")], axis=1)

    schema = texts.select(*keep).withColumn("position", F.lit(0).cast("long")).withColumn("identifier", F.lit("")).withColumn("sequence", F.lit("")).schema
    return texts.mapInPandas(run, schema)


def header_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct accessions of header lines; a splittable scan."""
    lines = spark.read.text(path).where(F.col("value").startswith(">"))
    return lines.select(accession(F.regexp_extract("value", r"^>\s*(\S+)", 1)).alias("accession")).where("accession != ''").distinct()


def priority(name: Column) -> Column:
    """Rank of a file name by its ending, compressed ones after all plain ones; null for other files."""
    out = F.when(F.lit(False), 0)
    for i, e in enumerate(ENDINGS + tuple(f"{e}.gz" for e in ENDINGS)):
        out = out.when(name.endswith("." + e), i)
    return out


def base_name(name: Column) -> Column:
    return F.regexp_replace(name, r"\.(pep|faa|fa|fasta)(\.gz)?$", "")


def chosen_files(files: DataFrame) -> DataFrame:
    """Of (folder, name): per folder and base name the file with the best ending."""
    ranked = files.withColumn("_p", priority(F.col("name"))).where("_p is not null")
    return ranked.groupBy("folder", base_name(F.col("name")).alias("base")).agg(F.min_by("name", F.struct("_p", "name")).alias("name"))


def folder_batches(files: DataFrame) -> DataFrame:
    """Proteomes per folder (distinct base names) and the batch the folder belongs to.

    Fewer than 10, more than 10 and fewer than 20, or the rest, which holds
    exactly 10 as well as 20 and more.
    """
    n = files.where(priority(F.col("name")).isNotNull()).groupBy("folder").agg(F.countDistinct(base_name(F.col("name"))).alias("proteomes"))
    return n.withColumn("batch", F.when(F.col("proteomes") < 10, "lt10").when((F.col("proteomes") > 10) & (F.col("proteomes") < 20), "gt10lt20").otherwise("rest"))


def not_yet_run(wanted: DataFrame, existing: DataFrame, prefix: str) -> DataFrame:
    """Wanted prefixes of which no experiment folder (prefix_timestamp) exists."""
    done = existing.select(F.regexp_replace("name", r"_\d{14}$", "").alias(prefix)).distinct()
    return wanted.join(done, prefix, "left_anti")


def parameter_row(path: str, index: int) -> tuple[str, str, str]:
    """Line ``index`` (from 1) of a tab-separated job list: input, output, further arguments."""
    with open(path, encoding="utf-8") as f:
        return parameters(f, index)


def parameters(lines: Iterable[str], index: int) -> tuple[str, str, str]:
    line = next(islice(lines, max(index, 1) - 1, None), None)
    if line is None or index < 1:
        raise IndexError(f"the job list has no line {index}")
    first, second, rest, *_ = [*line.rstrip("\n").split("\t", 2), "", ""]
    return first, second, rest
