"""Embedding of text columns. Embedders are narrow: nothing is shuffled."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.functions.slabs import slabs
from pagemill.functions.tokens import words

# Texts of a slab: more than elsewhere, since each slab hashes its distinct words anew.
EMBED_ROWS = 2048


class Embedder(Protocol):
    name: str
    dim: int

    def embed(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame: ...


def hashed_words(lists: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words of a column of word lists, and the number per list.

    The bucket of a word is the first 32 bits of its MD5 modulo ``dim``. Every distinct
    word of a batch is hashed once; empty words are dropped.
    """
    lengths = np.asarray(lists.value_lengths().fill_null(0))
    encoded = lists.flatten().dictionary_encode()
    distinct = encoded.dictionary.cast(pa.binary()).to_pylist()
    digests = (hashlib.md5(w, usedforsecurity=False).digest()[:4] for w in distinct)
    table = np.array([int.from_bytes(d, "big") % dim for d in digests], dtype=np.int64)
    kept = np.array([bool(w) for w in distinct], dtype=bool)
    codes = np.asarray(encoded.indices)
    used = kept[codes]
    owner = np.repeat(np.arange(len(lengths)), lengths)[used]
    return table[codes[used]], np.bincount(owner, minlength=len(lengths))


def bucket_counts(buckets: np.ndarray, lengths: np.ndarray, dim: int) -> np.ndarray:
    """One row of ``dim`` counts per list."""
    cells = np.repeat(np.arange(len(lengths)), lengths) * dim + buckets
    return np.bincount(cells, minlength=len(lengths) * dim).reshape(len(lengths), dim)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(length > 0, length, 1.0)


def _as_lists(matrix: np.ndarray) -> pa.Array:
    values = pa.array(matrix.astype(np.float32).ravel())
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), values)


@dataclass(frozen=True)
class HashEmbedder:
    """Token counts hashed into ``dim`` buckets: lexical, reproducible, needs no model.

    The JVM splits the text; an Arrow function hashes the distinct words of a slab of texts and
    counts them into a dense matrix.
    """

    dim: int = 384
    normalize: bool = True
    name: str = "token-hash"

    def embed(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        dim, normalize = self.dim, self.normalize

        @F.arrow_udf("array<float>")
        def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for lists in batches:
                sizes = 8 * np.asarray(lists.value_lengths().fill_null(0))
                for first, rows in slabs(sizes.tolist(), EMBED_ROWS):
                    counts = bucket_counts(*hashed_words(lists.slice(first, rows), dim), dim).astype(np.float64)
                    yield _as_lists(_unit_rows(counts) if normalize else counts)

        return df.withColumn(output, count(words(F.col(text))))


@dataclass(frozen=True)
class ModelEmbedder:
    """Adapter for a model: ``load()`` runs once per Python worker and returns a function
    from a list of texts to a matrix of ``dim`` columns."""

    load: Callable[[], Callable[[list[str]], np.ndarray]]
    dim: int
    name: str
    normalize: bool = True

    def embed(self, df: DataFrame, text: str, output: str = "embedding") -> DataFrame:
        load, normalize = self.load, self.normalize

        @F.pandas_udf("array<float>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in batches:
                matrix = np.asarray(model(texts.fillna("").tolist()), dtype=np.float64)
                yield pd.Series(list(_unit_rows(matrix) if normalize else matrix))

        return df.withColumn(output, encode(F.col(text)))


def sparse_weights(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The non-zero cells of a vector column as rows ``(bucket, weight)``."""
    others = [c for c in df.columns if c != vector]
    # An inner explode would make the optimizer compute the vector twice, see the README.
    cells = df.select(*others, F.posexplode_outer(vector).alias("bucket", "weight"))
    return cells.where(F.col("weight") != 0)


def memory_megabytes(vectors: Column, dim: int) -> Column:
    """Size of a number of single-precision vectors."""
    return vectors * dim * 4 / 1024.0 / 1024.0
