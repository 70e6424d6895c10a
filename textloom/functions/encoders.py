"""A slot for any text encoder: the model is loaded once per task and fed Arrow batches."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import SparkSession, functions as F

# The encoders travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

Encoder = Callable[[list[str]], np.ndarray]


def text_encoder(load: Callable[[], Encoder]):
    """Column function from text to ``array<float>``.

    ``load`` runs on the executor and returns a function from a list of texts to one vector per text.
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for texts in batches:
            vectors = np.asarray(encoder(texts.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(vectors), index=texts.index)

    return encode


@dataclass(frozen=True)
class GramEncoder:
    """Counts of a text's runs of ``size`` characters, hashed to ``dims`` cells: an encoder without weights."""

    dims: int = 64
    size: int = 3
    seed: int = 42

    def cell(self, gram: str) -> int:
        return int(hashlib.md5(f"{self.seed}:{gram}".encode()).hexdigest()[:15], 16) % self.dims

    def __call__(self, texts: list[str]) -> np.ndarray:
        known: dict[str, int] = {}
        out = np.zeros((len(texts), self.dims), np.float32)
        for row, text in enumerate(texts):
            text = text.lower()
            for i in range(len(text) - self.size + 1):
                gram = text[i : i + self.size]
                if gram not in known:
                    known[gram] = self.cell(gram)
                out[row, known[gram]] += 1
        return out


def share_encoder(spark: SparkSession, encoder: Encoder) -> Callable[[], Encoder]:
    """``load`` for ``text_encoder`` of an encoder that is sent to the executors once."""
    shared: Broadcast = spark.sparkContext.broadcast(encoder)
    return lambda: shared.value
