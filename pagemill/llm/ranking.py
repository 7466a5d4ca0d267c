"""Ranked search of all documents for a set of items by blocked matrix products.

Documents become sparse rows of the terms that any item holds; a bitmap of fixed size keeps the others out. Rows are
dealt to blocks, items to tiles, and every block meets every tile in one group: the tile's terms are cut into
vocabulary tiles, a dense tile of impacts times the dense tile of weights is one product in float64, and as all
numbers are whole and every partial sum stays below 2^53, sums are exact. Sums over vocabulary tiles are int64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.llm.columns import is_member, member_bitmap, whole_text
from pagemill.llm.hashing import RangeHash, lower_ascii, text_buffers
from pagemill.session import written

# Fixed values of the weighting.
IMPACT, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 75
# No impact reaches this.
MOST_IMPACT = 1_000_000
EXACT = 1 << 53
# Bits of the bitmap of item terms.
BITMAP_BITS = 1 << 21
# Sizes of blocks and tiles: distinct terms of all rows, items, terms and rows of one dense tile.
BLOCK_TERMS = 1 << 20
ITEM_TILE = 256
VOCABULARY_TILE = 2048
ROW_TILE = 1024

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def _terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``first row, bytes, row, start, end`` of all terms of consecutive pieces of a text column."""
    for first, data, offsets in text_buffers(column):
        inside = _WORD[data]
        border = np.zeros(len(data) + 1, dtype=bool)
        border[offsets] = True
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | border[1:-1]
        end[:-1] &= ~inside[1:] | border[1:-1]
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        row = np.searchsorted(offsets, start, side="right") - 1
        yield first, lower_ascii(data), np.append(row, len(offsets) - 1), start, end


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as strings."""
    length = end - start
    offsets = np.zeros(len(start) + 1, dtype=np.int32)
    np.cumsum(length, out=offsets[1:])
    place = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[place]))


def _bits(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (RangeHash(data).of(start, end) % np.uint64(BITMAP_BITS)).astype(np.int64)


def _term_rows(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Columns of ``batches`` but the text, number of terms, distinct terms that pass the bitmap, their counts.

    Without a bitmap all terms pass, and the rows also hold the bits of their terms.
    """
    for batch in batches:
        text = batch.column("text")
        rest = batch.drop_columns(["text"])
        for first, data, row, start, end in _terms(text):
            rows, row = int(row[-1]), row[:-1]
            counts = np.bincount(row, minlength=rows)
            bits = _bits(data, start, end)
            if bitmap is not None:
                passed = is_member(bitmap, bits)
                row, start, end, bits = row[passed], start[passed], end[passed], bits[passed]
            words = _strings(data, start, end).dictionary_encode()
            code = np.asarray(words.indices, dtype=np.int64)
            width = max(len(words.dictionary), 1)
            pair, index, times = np.unique(row * width + code, return_index=True, return_counts=True)
            offsets = np.searchsorted(pair, np.arange(rows + 1) * width).astype(np.int32)
            found = [pa.array(counts, pa.int64()), words.dictionary.take(pa.array(pair % width)), pa.array(times, pa.int64())]
            found[1:] = [pa.ListArray.from_arrays(pa.array(offsets), c) for c in found[1:]]
            names = ["n", "terms", "tfs"]
            if bitmap is None:
                found.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(bits[index])))
                names.append("bits")
            part = rest.slice(first, rows)
            yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*part.schema.names, *names])


def _vocabulary_tiles(terms: np.ndarray, items: np.ndarray, weights: np.ndarray, n_items: int) -> Iterator[tuple[int, int]]:
    """Ranges of terms, at most ``VOCABULARY_TILE`` wide, in which no item's sum can reach 2^53.

    ``weights`` of an item and a term are sorted by term. A single term that is too heavy is a range of its own.
    """
    bound = weights.astype(np.float64) * MOST_IMPACT
    begin, n_terms = 0, int(terms[-1]) + 1 if len(terms) else 0
    while begin < n_terms:
        end = min(begin + VOCABULARY_TILE, n_terms)
        while end > begin + 1:
            a, b = np.searchsorted(terms, [begin, end])
            if np.bincount(items[a:b], bound[a:b], n_items).max(initial=0.0) < EXACT:
                break
            end = begin + (end - begin) // 2
        yield begin, end
        begin = end


def tile_scores(
    docs: pa.Table, vocabulary: pa.Array, terms: np.ndarray, items: np.ndarray, weights: np.ndarray, n_items: int
) -> np.ndarray:
    """Scores of some documents for all items of a tile; ``weights`` of ``terms`` and ``items`` come sorted by term."""
    held = docs["terms"].combine_chunks()
    size = np.asarray(held.value_lengths(), dtype=np.int64)
    row = np.repeat(np.arange(len(held)), size)
    column = pc.fill_null(pc.index_in(held.flatten(), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    tf = np.asarray(docs["tfs"].combine_chunks().flatten(), dtype=np.int64)
    impact = IMPACT * tf // (1000 * tf + SATURATION * np.repeat(np.asarray(docs["m"], dtype=np.int64), size))
    order = np.argsort(column, kind="stable")
    row, column, impact = row[order], column[order], impact[order]
    scores = np.zeros((len(held), n_items), dtype=np.int64)
    for begin, end in _vocabulary_tiles(terms, items, weights, n_items):
        a, b = np.searchsorted(column, [begin, end])
        c, d = np.searchsorted(terms, [begin, end])
        # A term that is too heavy for float64 stands alone and is multiplied as whole numbers.
        kind = np.float64 if float(weights[c:d].max(initial=0)) * MOST_IMPACT < EXACT else np.int64
        left, right = (np.zeros(shape, dtype=kind) for shape in ((len(held), end - begin), (end - begin, n_items)))
        left[row[a:b], column[a:b] - begin] = impact[a:b]
        right[terms[c:d] - begin, items[c:d]] = weights[c:d]
        scores += (left @ right).astype(np.int64)
    return scores


class _Top:
    """The ``k`` best documents of every item so far, equal scores by ascending document."""

    def __init__(self, n_items: int, k: int):
        self.k, self.border = k, np.ones(n_items, dtype=np.int64)
        self.item, self.doc, self.named, self.score = (np.empty(0, dtype=t) for t in (int, np.int64, bool, np.int64))

    def add(self, docs: np.ndarray, named: np.ndarray, scores: np.ndarray) -> None:
        # What equals the k-th score may still win by its document.
        row, item = np.nonzero(scores >= self.border)
        item = np.concatenate([self.item, item])
        doc, named = np.concatenate([self.doc, docs[row]]), np.concatenate([self.named, named[row]])
        score = np.concatenate([self.score, scores[row, item[len(self.item) :]]])
        order = np.lexsort((doc, named, -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order], side="left")
        kept = order[rank < self.k]
        self.item, self.doc, self.named, self.score = item[kept], doc[kept], named[kept], score[kept]
        last = kept[rank[rank < self.k] == self.k - 1]
        self.border[item[last]] = score[last]


_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _rank_block(k: int):
    """The best documents of one block for every item of one tile."""
    def run(docs: pa.Table, items: pa.Table) -> pa.Table:
        if not docs.num_rows or not items.num_rows:
            return _FOUND.empty_table()
        words = items["term"].combine_chunks().dictionary_encode()
        term = np.asarray(words.indices, dtype=np.int64)
        number, item = np.unique(np.asarray(items["item"]), return_inverse=True)
        order = np.argsort(term, kind="stable")
        term, item, weight = term[order], item[order], np.asarray(items["weight"], dtype=np.int64)[order]
        top = _Top(len(number), k)
        for first in range(0, docs.num_rows, ROW_TILE):
            part = docs.slice(first, ROW_TILE)
            scores = tile_scores(part, words.dictionary, term, item, weight, len(number))
            top.add(np.asarray(part["doc"]), part["named"].to_numpy(), scores)
        columns = [pa.array(number[top.item]), pa.array(top.doc, mask=~top.named), pa.array(top.score)]
        return pa.table(columns, schema=_FOUND)

    return run


def _each(n: int) -> Column:
    """The row once for every number below ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def rank_documents(
    documents: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 for every item.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, lower-cased in A-Z. Equal scores are
    ordered by ascending document, NULL first. A score is a sum of whole weights (rarity of the term) times whole
    impacts (how often the document holds it, against its length); repeated terms of an item count again.

    NULL and empty texts have no term: such documents are found by no item, such items find nothing. Every row of
    ``documents`` is one document, repeated ones too. Rows of ``items`` that repeat id and text are one item; equal ids
    with other texts are ranked each by itself. Very long texts are whole rows of counts. Other columns are passed
    over; empty tables give no rows.
    """
    spark = documents.sparkSession
    named = items.select(F.col(item_id).alias("item_id"), whole_text(text).alias("text")).distinct()
    numbered = written(named.withColumn("item", F.monotonically_increasing_id()), "items")
    counts = "n long, terms array<string>, tfs array<long>"
    asked = written(
        numbered.select("item", "text").mapInArrow(
            lambda batches: _term_rows(batches, None), f"item long, {counts}, bits array<long>"
        ),
        "item_terms",
    )
    bits = asked.select(F.explode("bits").alias("bit"))
    bitmap = spark.sparkContext.broadcast(member_bitmap(bits, BITMAP_BITS))
    texts = documents.select(F.col(doc_id).cast("long").alias("doc"), whole_text(text).alias("text"))
    sketch = written(
        texts.mapInArrow(lambda batches: _term_rows(batches, bitmap.value), f"doc long, {counts}"), "document_terms"
    )
    n_documents, n_terms, n_postings = sketch.agg(
        F.count_if(F.col("n") > 0), *[F.coalesce(F.sum(c), F.lit(0)) for c in (F.col("n"), F.size("terms"))]
    ).first()

    df = sketch.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rarity = F.floor(1000 * F.log(F.lit(2.0 * n_documents + 2.0) / (2 * F.col("df") + 1)))
    terms = asked.select("item", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    weights = terms.select("item", F.col("t.terms").alias("term"), F.col("t.tfs").alias("times")).join(df, "term")
    tiles = math.ceil(asked.count() / ITEM_TILE) or 1
    cores = spark.sparkContext.defaultParallelism
    blocks = math.ceil(n_postings / min(BLOCK_TERMS, max(n_postings // cores, BLOCK_TERMS >> 4))) or 1
    # Every block of documents meets every tile of items; both are dealt as rows.
    asking = weights.select(
        "item", "term", (F.col("times") * rarity).alias("weight"),
        F.pmod(F.xxhash64("item"), F.lit(tiles)).alias("tile"),
        _each(blocks).alias("block"),
    ).where("weight > 0")
    held = sketch.where(F.size("terms") > 0).select(
        F.coalesce("doc", F.lit(0)).alias("doc"),
        F.col("doc").isNotNull().alias("named"),
        F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_documents}L) div {max(n_terms, 1)}L").alias("m"),
        "terms", "tfs",
        F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block"),
    )
    held = held.select("*", _each(tiles).alias("tile"))
    sides = held.groupBy("block", "tile").cogroup(asking.groupBy("block", "tile"))
    found = sides.applyInArrow(_rank_block(k), "item long, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
