"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell of source, language and topic. The cell sums are raked, margin after margin, until
their shares agree with the targets; the ratio of raked to present tokens, scaled to a token budget, is the
probability with which the documents of a cell are sampled, by hash of the document.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pagemill.llm.columns import lookup, whole_text
from pagemill.llm.hashing import RangeHash, lower_ascii, text_buffers, word_spans
from pagemill.llm.tokens import CachedEncoder, encoder
from pagemill.session import delete_path, scratch_path, written

TOPICS = 8
# Shorter words, mostly grammar, say more about the language than about the topic.
TOPIC_WORD_BYTES = 8
MARGINS = ("source", "lang", "topic")
# Without given targets a margin aims at its present shares to these powers: 1 keeps them, 0 makes them equal.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 1.0}
BUDGET = 0.7
TOLERANCE = 1e-3
# Raking goes on to the tolerance. It gives up, with a warning, after so many rounds, or where the error has not
# fallen by a hundredth in so many: then the targets cannot be met together.
ROUNDS = 500
STALLED = 20
# Cells that one task rakes.
TASK_CELLS = 100_000
# Stands for a missing source or language.
MISSING = "(none)"
HASH_BITS = 52


def _token_counts(coder: CachedEncoder, texts: pa.Array) -> np.ndarray:
    return np.diff(coder.encode(texts.to_pylist())[1])


def _topics(batches: Iterator[pa.RecordBatch], tokenizer: str | None) -> Iterator[pa.RecordBatch]:
    """Number of words, or of tokens, and topic of each text: the most frequent of ``TOPICS`` groups of hashed long words,
    or of all its words where none is long."""
    coder = encoder(tokenizer) if tokenizer else None
    for batch in batches:
        rest = batch.drop_columns(["text"])
        for row, data, offsets in text_buffers(batch.column("text")):
            lowered = lower_ascii(data)
            starts, ends = word_spans(lowered, offsets)
            before, n = np.searchsorted(starts, offsets), len(offsets) - 1
            owner = np.repeat(np.arange(n), np.diff(before))
            long = ends - starts >= TOPIC_WORD_BYTES
            has_long = np.bincount(owner[long], minlength=n) > 0
            telling = np.flatnonzero(long | ~has_long[owner])
            words = RangeHash(lowered).of(starts[telling], ends[telling])
            group = (words >> np.uint64(32)).astype(np.int64) % TOPICS
            counts = np.bincount(owner[telling] * TOPICS + group, minlength=n * TOPICS).reshape(n, TOPICS)
            part = rest.slice(row, n)
            sizes = _token_counts(coder, batch.column("text").slice(row, n)) if coder else np.diff(before)
            # argmax takes the smallest topic of a tie.
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(sizes, pa.int64()), pa.array(counts.argmax(axis=1), pa.int32())],
                names=[*part.schema.names, "n_tokens", "topic"],
            )


def profile(df: DataFrame, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``doc_id, row, source, lang, n_tokens, topic`` of every row; ``row`` tells rows of one id apart."""
    plain = df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(F.col(id_column), whole_text(text)).alias("row"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in ("source", "lang")],
        whole_text(text).alias("text"),
    )
    return plain.mapInArrow(
        lambda batches: _topics(batches, tokenizer),
        "doc_id long, row long, source string, lang string, n_tokens long, topic int",
    )


def tempered_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """``margin, share``: present token shares to a power, as shares again."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
    raised = sums.select(margin, F.pow("t", F.lit(power)).alias("t")).where("t > 0")
    total = raised.agg(F.sum("t")).scalar()
    return raised.select(margin, (F.col("t") / total).alias("share"))


def _few(cells: DataFrame, rows: int) -> DataFrame:
    """In as few tasks as so many rows ask for; with one, its windows need no shuffle."""
    return cells.coalesce(max(1, -(-rows // TASK_CELLS)))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Add ``weight`` to the cells so that its shares along each margin are the targets.

    Weights sum to 1 after the first round. A cell whose margin value has no target gets no weight. A round is one
    job that adjusts all margins and is written to the shared folder; the driver sees its largest change. Targets of margins
    that cannot be met together are met as nearly as the rounds reach, the last margin exactly, and a warning names
    the error that is left.
    """
    spark, keep = cells.sparkSession, cells.columns
    for margin, target in targets.items():
        cells = cells.join(target.select(margin, F.col("share").alias(f"_{margin}")), margin, "left")
    shares = [f"_{margin}" for margin in targets]
    start = cells.select(*keep, *shares, F.col("tokens").cast("double").alias("weight"), F.lit(0.0).alias("change"))
    current = written(start, "raked")
    schema, rows, path = current.schema, current.count(), None
    errors = []
    for _ in range(rounds):
        raked = _few(current, rows).withColumn("change", F.lit(0.0))
        for margin in targets:
            present = F.sum("weight").over(Window.partitionBy(margin))
            factor = F.when(present > 0, F.coalesce(f"_{margin}", F.lit(0.0)) / present).otherwise(F.lit(0.0))
            moved = F.when(F.col("weight") > 0, F.abs(F.col("factor") - 1)).otherwise(F.lit(0.0))
            raked = raked.withColumn("factor", factor).select(
                *keep, *shares, (F.col("weight") * F.col("factor")).alias("weight"), F.greatest("change", moved).alias("change")
            )
        following = scratch_path(spark, "raked")
        raked.write.parquet(following)
        if path:
            delete_path(spark, path)
        path = following
        current = spark.read.schema(schema).parquet(path)
        errors.append(_few(current, rows).agg(F.max("change")).first()[0] or 0.0)
        if errors[-1] <= tolerance or (len(errors) > STALLED and min(errors[-STALLED:]) > 0.99 * min(errors[:-STALLED])):
            break
    if errors and errors[-1] > tolerance:
        warnings.warn(
            f"targets are not met: after {len(errors)} rounds a share is off by {errors[-1]:.2g} of itself, "
            f"more than {tolerance:g}",
            RuntimeWarning,
            stacklevel=2,
        )
    return current.select(*keep, "weight")


def probabilities(raked: DataFrame, budget: float) -> DataFrame:
    """Add ``probability``: the ratio of weight to tokens, scaled to sample ``budget`` of all tokens.

    No probability exceeds 1; what such cells cannot give is shared among the others. A cell without
    tokens gets 1, since its documents weigh nothing.
    """
    rows = raked.count()
    ratio = _few(raked, rows).withColumn("ratio", F.col("weight") / F.nullif(F.col("tokens"), F.lit(0)))
    scale, wanted, given = None, 0, 0
    # Every step fills at least one more cell, and mostly a few steps are enough.
    for _ in range(rows + 1):
        full = F.lit(False) if scale is None else F.col("ratio") * scale >= 1
        total, kept, rest = ratio.agg(
            F.sum("tokens"), F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))
        ).first()  # one row
        wanted, given = budget * (total or 0), kept or 0
        following = (wanted - given) / rest if rest else scale
        if following is None or (scale is not None and following <= scale * (1 + 1e-9)):
            given += (rest or 0) * (scale or 0)
            break
        scale = following
    if given < wanted * (1 - 1e-6):
        warnings.warn(
            f"the budget is not met: cells with a target hold {given:.0f} of {wanted:.0f} tokens", RuntimeWarning, stacklevel=2
        )
    return ratio.withColumn(
        "probability", F.least(F.lit(1.0), F.coalesce(F.col("ratio") * F.lit(scale or 1.0), F.lit(1.0)))
    ).drop("ratio")


def mix_sources(
    df: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    budget: float = BUDGET,
    id_column: str = "doc_id",
    text: str = "text",
    powers: dict[str, float] = POWERS,
    seed: int = 7,
    tokenizer: str | None = None,
) -> DataFrame:
    """``doc_id, row, source, lang, topic, n_tokens, probability, kept`` for every row of ``df``.

    Tokens are those of the vocabulary at the path ``tokenizer``, or white-space separated words without one.

    ``targets`` maps margins (``source``, ``lang``, ``topic``) to tables of the margin and its ``share``; without
    them, present shares to the given powers. A row is kept if the hash of its id and text falls below the
    probability of its cell.

    A NULL source or language is the value ``(none)``. NULL and empty texts weigh nothing; texts without
    words are in topic 0. Targets, or a budget, that cannot be met end in a warning. Repeated rows share one decision.
    Other columns are passed over, and an empty table gives no rows.
    """
    rows = written(profile(df, id_column, text, tokenizer), "profile")
    cells = written(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    targets = targets or {m: written(tempered_targets(cells, m, powers[m]), "targets") for m in MARGINS}
    weighed = written(probabilities(rake(cells, targets), budget), "weights").select(*MARGINS, "probability")
    judged = lookup(rows, weighed, MARGINS, ["row"])
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("row")), 64 - HASH_BITS) / float(1 << HASH_BITS)
    return judged.select(
        "doc_id", "row", *MARGINS, "n_tokens", "probability", (place < F.col("probability")).alias("kept")
    )
