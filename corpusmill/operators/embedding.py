"""Embeddings by an adapter, in batches of texts of like length."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]
QUERY_PREFIX = "Represent this sentence for searching relevant passages: "


@lru_cache(maxsize=200_000)
def _hash(word: str) -> int:
    return int(hashlib.md5(word.encode("utf-8", "replace")).hexdigest()[:8], 16)


def hashed_words(dimension: int = 64) -> Encoder:
    """A deterministic encoder without a model: signed counts of words by the first 32 bits of their MD5, of unit norm."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension))
        for row, text in zip(out, texts):
            for w in text.lower().split():
                h = _hash(w)
                row[h % dimension] += 1 if h >> 31 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm == 0, 1, norm)).astype(np.float32)

    return encode


def embed(df: DataFrame, key: str, text: str, encode: Encoder | None = None, batch: int = 64, by_length: bool = False, model: str = "", queries: bool = False) -> DataFrame:
    """(key, embedding). `by_length` sorts texts by length first, which saves padding with neural encoders.

    Queries get a prefix with models that want one. Null texts have a null embedding.
    """
    encode = encode or hashed_words()
    prefix = QUERY_PREFIX if queries and "bge" in model else ""
    slim = df.select(key, F.col(text).alias("_text"))
    if by_length:
        slim = slim.repartitionByRange(F.length("_text")).sortWithinPartitions(F.length("_text"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.iloc[at : at + batch]
                vectors = encode([prefix + (t or "") for t in part["_text"]])
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": [None if t is None else v for t, v in zip(part["_text"], vectors)]})

    return slim.mapInPandas(run, f"{key} {kind}, embedding array<float>")
