"""The plug-in surface for embedding models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from annoweave.runtime import width


class Embedder(Protocol):
    """A model: sequences and one layer in, one vector per sequence out."""

    def __call__(self, sequences: list[str], layer: int | None) -> np.ndarray: ...


#: Makers of embedders by model name; a maker runs once per task, so it may load weights.
REGISTRY: dict[str, Callable[[], Embedder]] = {}


def register(model: str, make: Callable[[], Embedder]) -> None:
    REGISTRY[model] = make


def composition() -> Embedder:
    """A model without weights: hashed residue pairs, different for every layer."""

    def run(sequences: list[str], layer: int | None) -> np.ndarray:
        out = np.zeros((len(sequences), 64), dtype=np.float32)
        for i, s in enumerate(sequences):
            raw = np.frombuffer(s.upper().encode("ascii", "replace"), dtype=np.uint8).astype(np.int64)
            if len(raw) > 1:
                np.add.at(out[i], (raw[:-1] * (31 + 2 * (layer or 0)) + raw[1:] * 7) % 64, 1)
        return out

    return run


register("composition", composition)


def embed(tasks: DataFrame, batch: int = 64, makers: dict[str, Callable[[], Embedder]] | None = None) -> DataFrame:
    """Vectors of (accession, sequence, embedding_type_id, model_name, layer_index).

    Rows are ranged by model and layer over all tasks, so a task loads few models
    however many there are, and a batch never mixes models; metadata travels with
    the row, never by position. A null layer is a layer of its own. A model
    without a maker stops the job; makers are those of the registry by default.
    """
    makers = dict(REGISTRY if makers is None else makers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[str, Embedder] = {}
        for pdf in batches:
            for (model, layer), part in pdf.groupby(["model_name", "layer_index"], sort=True, dropna=False):
                if model not in makers:
                    raise ValueError(f"no embedder is registered for {model}")
                if model not in made:
                    made[model] = makers[model]()
                for lo in range(0, len(part), batch):
                    some = part.iloc[lo : lo + batch]
                    vectors = made[model](some["sequence"].tolist(), None if pd.isna(layer) else int(layer))
                    out = some[["accession", "sequence", "embedding_type_id", "layer_index"]].assign(embedding=list(vectors))
                    yield out.astype({"layer_index": "Int32"})

    need = tasks.select("accession", "sequence", "embedding_type_id", "model_name", "layer_index").where("sequence is not null")
    spark = tasks.sparkSession
    n = max(width(spark), spark.sparkContext.defaultParallelism)
    order = ["model_name", "layer_index", F.xxhash64("accession")]
    ranged = need.repartitionByRange(n, *order).sortWithinPartitions("model_name", "layer_index")
    return ranged.mapInPandas(run, "accession string, sequence string, embedding_type_id int, layer_index int, embedding array<float>")
