"""Semantic chunking: break a document where neighbouring sentences differ most.

Sentences are widened by a buffer of neighbours, represented by integer token counts,
and compared by cosine distance. A document is broken after every sentence whose
distance to the next lies above a percentile of the document's own distances.

Nothing is shuffled: a document is one input row, its sentences, distances and breaks
are arrays of that row, and chunks are exploded from it at the end. Copies of a
document and documents of one source are independent rows, so there are no hot keys.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.config import ChunkingConfig
from pagemill.operators.chunking import with_chunk_id
from pagemill.operators.embedding import ModelEmbedder, bucket_counts, hashed_words
from pagemill.functions.tokens import sentences, sentences_with, words

TOKEN_DIM = 384
# Sentences whose token counts are held in memory at a time; few enough for the CPU cache.
SLAB = 128
# Texts given to an embedding model at a time.
MODEL_BATCH = 256


def split_sentences(df: DataFrame, key: str, text: str, abbreviations: Sequence[str] = ()) -> DataFrame:
    """One row per sentence; a full stop behind one of the abbreviations, given or learned, ends none."""
    listed = sentences_with(F.col(text), abbreviations)
    exploded = df.select(key, F.posexplode(listed).alias("sentence_no", "sentence"))
    return exploded.withColumn("sentence_length", F.length("sentence"))


def _around(values: Column, i: Column, buffer: int) -> Column:
    first = F.greatest(i - buffer, F.lit(0))
    last = F.least(i + buffer, F.size(values) - 1)
    return F.slice(values, first + 1, last - first + 1)


def _groups(sentence_list: Column, buffer: int) -> Column:
    return F.transform(
        sentence_list, lambda _, i: F.array_join(_around(sentence_list, i, buffer), "")
    )


def sentence_groups(df: DataFrame, key: str, text: str, buffer: int) -> DataFrame:
    """Each sentence together with ``buffer`` sentences on either side."""
    listed = df.select(key, sentences(F.col(text)).alias("_s"))
    groups = _groups(F.col("_s"), buffer)
    return listed.select(key, F.posexplode(groups).alias("sentence_no", "sentence_group"))


def _slab_distances(buckets: np.ndarray, lengths: np.ndarray, first: int, last: int, buffer: int) -> np.ndarray:
    """Distances between sentences ``first .. last`` and the next, from token counts.

    Counts are integers, so every sum is exact and the result does not depend on order.
    """
    counts = bucket_counts(buckets, lengths, TOKEN_DIM)
    running = np.concatenate([np.zeros((1, TOKEN_DIM), np.int64), np.cumsum(counts, axis=0)])
    at = np.arange(first, last + 2)
    wide = running[np.minimum(at + buffer + 1, len(lengths))] - running[np.maximum(at - buffer, 0)]
    square = (wide * wide).sum(axis=1)
    length = np.where(square > 0, square, 1).astype(np.float64)
    dot = (wide[:-1] * wide[1:]).sum(axis=1)
    return 1.0 - dot / np.sqrt(length[:-1] * length[1:])


def _document_distances(buckets: np.ndarray, lengths: np.ndarray, buffer: int) -> np.ndarray:
    """All neighbour distances of one document, a bounded slab of sentences at a time."""
    pairs = len(lengths) - 1
    ends = np.concatenate([[0], np.cumsum(lengths)])
    found = [np.empty(0)]
    for first in range(0, pairs, SLAB):
        last = min(first + SLAB, pairs) - 1
        low, high = max(0, first - buffer), min(len(lengths), last + buffer + 2)
        part = buckets[ends[low] : ends[high]]
        found.append(_slab_distances(part, lengths[low:high], first - low, last - low, buffer))
    return np.concatenate(found)


def _distances(sentence_list: Column, buffer: int) -> Column:
    """Array of the distances between each sentence of a document and the next one.

    The JVM splits the text into the words of its sentences.
    """

    @F.arrow_udf("array<double>")
    def distances(documents: pa.Array) -> pa.Array:
        sentences_of = np.asarray(documents.value_lengths())
        buckets, lengths = hashed_words(documents.flatten(), TOKEN_DIM)
        sentence_end = np.concatenate([[0], np.cumsum(sentences_of)])
        bucket_end = np.concatenate([[0], np.cumsum(lengths)])
        found = []
        for start, end in zip(sentence_end, sentence_end[1:]):
            part = buckets[bucket_end[start] : bucket_end[end]]
            found.append(_document_distances(part, lengths[start:end], buffer))
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0), *found]))

    return distances(F.transform(sentence_list, words))


def _model_distances(groups: Column, embedder: ModelEmbedder) -> Column:
    """The same from an embedding model, applied to the sentence groups of each document."""
    load = embedder.load

    @F.pandas_udf("array<double>")
    def distances(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for documents in batches:
            texts = list(itertools.chain.from_iterable(documents))
            # All texts of a batch of documents go to the model in full batches; only the dot product with
            # the next text and the squares are kept.
            dots, squares, previous = [], [], np.empty((0, embedder.dim))
            for start in range(0, len(texts), MODEL_BATCH):
                part = np.asarray(encode(texts[start : start + MODEL_BATCH]), dtype=np.float64)
                vectors = np.concatenate([previous, part])
                squares.append((part * part).sum(axis=1))
                dots.append((vectors[:-1] * vectors[1:]).sum(axis=1))
                previous = part[-1:]
            square = np.concatenate([np.empty(0), *squares])
            length = np.sqrt(np.where(square > 0, square, 1.0))
            dot = np.concatenate([np.empty(0), *dots])
            gaps = 1.0 - dot / (length[:-1] * length[1:])
            ends = np.cumsum([len(d) for d in documents])
            # The gap between two documents belongs to neither.
            yield pd.Series([gaps[end - len(d) : max(end - 1, 0)] for d, end in zip(documents, ends)])

    return distances(groups)


def _with_distances(
    df: DataFrame, text: str, buffer: int, embedder: ModelEmbedder | None = None
) -> DataFrame:
    """Add ``_s``, the sentences, and ``_d``, their neighbour distances, to each document."""
    listed = df.where(F.length(text) > 0).withColumn("_s", sentences(F.col(text)))
    if embedder is None:
        return listed.withColumn("_d", _distances(F.col("_s"), buffer))
    return listed.withColumn("_d", _model_distances(_groups(F.col("_s"), buffer), embedder))


def neighbour_distances(df: DataFrame, key: str, text: str, buffer: int) -> DataFrame:
    found = _with_distances(df.select(key, text), text, buffer)
    # An inner explode would add a filter on the array, which the optimizer pushes down by
    # computing the distances a second time.
    exploded = found.select(key, F.posexplode_outer("_d").alias("sentence_no", "distance"))
    return exploded.where(F.col("sentence_no").isNotNull())


def _percentile_cut(sorted_values: Column, percentile: Column) -> Column:
    """The order statistic a value has to exceed to lie above the interpolated percentile."""
    position = F.floor((F.size(sorted_values) - 1) * percentile / F.lit(100))
    return F.get(sorted_values, position.cast("int"))


def _breaks(distances: Column, percentile: Column) -> Column:
    """Positions of the sentences after which a document is broken."""
    cut = _percentile_cut(F.array_sort(distances), percentile)
    # Repeated into an array so that it is computed once and not for every element.
    cuts = F.array_repeat(cut, F.size(distances))
    above = F.zip_with(distances, cuts, lambda d, c: d > c)
    return F.filter(F.transform(above, lambda a, i: F.when(a, i)), lambda i: i.isNotNull())


def semantic_breakpoints(
    df: DataFrame, key: str, text: str, buffer: int, percentile: int
) -> DataFrame:
    """One row per document: the cut value and the sentences after which it is broken."""
    found = _with_distances(df.select(key, text), text, buffer)
    return found.select(
        key,
        _percentile_cut(F.array_sort("_d"), F.lit(percentile)).alias("cut"),
        _breaks(F.col("_d"), F.lit(percentile)).alias("break_after"),
    )


def semantic_chunks(
    df: DataFrame, key: str, text: str, config: ChunkingConfig, embedder: ModelEmbedder | None = None
) -> DataFrame:
    """Chunks are whole sentences in order; together they are the text again.

    Sentences are compared by token counts unless an embedding model is given.
    """
    inherited = [c for c in df.columns if c != text]
    breaks = _breaks(F.col("_d"), F.lit(config.breakpoint_percentile_threshold))
    located = _with_distances(df, text, config.buffer_size, embedder).select(
        *inherited,
        "_s",
        F.concat(F.array(F.lit(0)), F.transform(breaks, lambda b: b + 1)).alias("_starts"),
    )

    def chunk(start: Column, i: Column) -> Column:
        end = F.coalesce(F.get("_starts", i + 1), F.size("_s"))
        return F.array_join(F.slice("_s", start + 1, end - start), "")

    chunks = located.select(
        *inherited, F.posexplode(F.transform("_starts", chunk)).alias("chunk_index", "chunk")
    )
    return with_chunk_id(chunks, key).select(
        "*",
        F.length("chunk").alias("chunk_length"),
        F.lit("semantic").alias("chunking_method"),
        F.lit(config.breakpoint_percentile_threshold).alias("semantic_threshold"),
        F.lit(config.buffer_size).alias("buffer_size"),
        F.lit(embedder.name if embedder else "token-hash").alias("embedding_model"),
        F.lit("model" if embedder else "built-in").alias("embedding_provider"),
    )


def threshold_sweep(
    df: DataFrame, key: str, text: str, buffer: int, percentiles: list[int]
) -> DataFrame:
    """Number and mean size of the chunks each percentile would give.

    Distances are computed once, and the chunks of a document add up to its text, so
    only one small row per document and percentile is aggregated.
    """
    found = _with_distances(df.select(key, text), text, buffer).select(
        F.length(text).alias("chars"), F.array_sort("_d").alias("_sorted")
    )
    each = found.select(
        "chars", "_sorted", F.explode(F.array(*[F.lit(p) for p in percentiles])).alias("threshold")
    )
    above = F.filter(
        "_sorted", lambda d: d > _percentile_cut(F.col("_sorted"), F.col("threshold"))
    )
    return (
        each.groupBy("threshold")
        .agg(F.sum(F.size(above) + 1).alias("num_chunks"), F.sum("chars").alias("chars"))
        .select("threshold", "num_chunks", (F.col("chars") / F.col("num_chunks")).alias("avg_size"))
    )
