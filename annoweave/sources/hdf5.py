"""Vectors in HDF5 trees: accession group, type group, layer group, ``embedding``.

The library is optional (h5py); where it is missing, :func:`read` says so. Vectors
travel as parquet otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_COLUMNS = ["accession", "sequence", "embedding_type_id", "layer_index", "embedding"]


def _number(name: str, prefix: str) -> int | None:
    """The number behind ``prefix``; None for another or malformed name."""
    tail = name.removeprefix(prefix)
    return int(tail) if tail != name and tail.isdigit() else None


def _text(value: Any) -> str:
    value = value[()] if hasattr(value, "shape") or not isinstance(value, (str, bytes)) else value
    return value.decode() if isinstance(value, bytes) else str(value)


def vectors(tree: Mapping[str, Any]) -> Iterator[tuple[str, str, int, int | None, list[float]]]:
    """(accession, sequence, type, layer, vector) of a tree.

    Accessions without a sequence, groups of other or malformed names, and layers
    without a vector are left out. A type group that holds a vector itself is
    one without layers.
    """
    for name, group in tree.items():
        if "sequence" not in group:
            continue
        accession, sequence = name.removeprefix("accession_"), _text(group["sequence"])
        for key in group:
            kind = _number(key, "type_")
            if kind is None:
                continue
            if "embedding" in group[key]:
                yield accession, sequence, kind, None, [float(x) for x in group[key]["embedding"][()]]
            for sub in group[key]:
                layer = _number(sub, "layer_")
                if layer is not None and "embedding" in group[key][sub]:
                    yield accession, sequence, kind, layer, [float(x) for x in group[key][sub]["embedding"][()]]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The query vectors of all ``.h5`` files below a folder that every executor sees; a file is one task."""
    try:
        import h5py  # noqa: F401
    except ImportError:
        raise ImportError("reading HDF5 needs h5py; convert the vectors to parquet where there is none") from None
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.h5").option("recursiveFileLookup", True).load(path).select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import h5py
        from urllib.parse import unquote, urlparse

        for pdf in batches:
            for p in pdf["path"]:
                with h5py.File(unquote(urlparse(p).path), "r") as tree:
                    rows = []
                    for row in vectors(tree):
                        rows.append(row)
                        if len(rows) == 1000:
                            yield pd.DataFrame(rows, columns=_COLUMNS).astype({"layer_index": "Int32"})
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=_COLUMNS).astype({"layer_index": "Int32"})

    return files.repartition("path").mapInPandas(run, "accession string, sequence string, embedding_type_id int, layer_index int, embedding array<float>")


def write(vectors_: DataFrame, path: str) -> int:
    """Writes vectors as one tree on the driver, row by row; the number written. What is there stays."""
    import h5py

    n = 0
    with h5py.File(path, "a") as tree:
        for r in vectors_.select(*_COLUMNS).toLocalIterator():
            group = tree.require_group(f"accession_{r['accession'].replace('|', '_')}")
            if "sequence" not in group:
                group["sequence"] = r["sequence"]
            here = group.require_group(f"type_{r['embedding_type_id']}")
            here = here if r["layer_index"] is None else here.require_group(f"layer_{r['layer_index']}")
            if "embedding" not in here:
                here["embedding"], n = r["embedding"], n + 1
                here.attrs["shape"] = (len(r["embedding"]),)
    return n
