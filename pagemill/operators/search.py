"""Exact nearest-neighbour search by squared Euclidean distance as a join of two tables of blocks.

Vectors are packed, without a shuffle, into rows that hold a matrix of bounded size and the identifiers of its
vectors. Packs of queries of checked size are broadcast by a join that hands them to the first row of each partition of
the store, so that the store is scanned where it lies, in batches of plain rows. A larger query side is dealt, with the
store, to the cells of a grid, in which every pack of the store meets every pack of the queries. A task turns each pair
of matrices into at most ``k`` identifiers per query. The candidates are ranked per query and part of the store first and per query then, and what
else the store holds is joined to the winners at the end.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pagemill.functions.text import UNKNOWN, preview

# A query side up to this size is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# Bounds of one pack of vectors.
PACK_ROWS = 2048
PACK_BYTES = 4 * 1024 * 1024
# Winners, at most k per query, are broadcast to fetch their payload up to this many.
WINNER_ROWS = 200_000
ROW_TILE = 2048
QUERY_TILE = 1024
# Groups of rows, at least, whose least scores bound the k-th score of a tile.
GROUPS = 128
# Bytes of either side that a cell of a grid holds, about, and cells that there are at least.
CELL_BYTES = 32 * 1024 * 1024
CELLS_PER_CORE = 2
# Slots that a large query side is dealt to at most.
MOST_SLOTS = 64
# Bytes of the query vectors whose best rows a task holds at the same time: all of a broadcast, so that a query has at
# most k candidates per task.
OPEN_BYTES = BROADCAST_BYTES
# Parts of the store in the first of two rankings.
RANK_PARTS = 64
# Names of the working columns.
QUERY, SCORE = "_query_no", "score"
# Scores are compared after rounding to this many decimals, then by identifier.
SCORE_DECIMALS = 9


def _matrix(vectors: pa.Array) -> np.ndarray:
    lengths = np.asarray(vectors.value_lengths())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError(f"expected vectors of {lengths[0]} dimensions, found {sorted(set(lengths.tolist()))}")
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)


def pack_type(df: DataFrame, ids: Sequence[str]) -> list[T.StructField]:
    """The columns ``rows`` and ``matrix`` of a pack."""
    kinds = T.StructType([T.StructField(name, df.schema[name].dataType) for name in ids])
    return [T.StructField("rows", T.ArrayType(kinds)), T.StructField("matrix", T.BinaryType())]


def _by_id(part: pa.Table, ids: Sequence[str]) -> pa.Table:
    """Sorted by identifier, so that a row number breaks ties."""
    return part.take(pc.sort_indices(part, [(name, "ascending") for name in ids]))


def one_pack(part: pa.Table, ids: Sequence[str], vector: str) -> list[pa.Array]:
    """Identifiers and matrix of some rows, sorted by identifier."""
    part = _by_id(part, ids)
    named = pa.StructArray.from_arrays([part[name].combine_chunks() for name in ids], names=list(ids))
    rows = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), named)
    return [rows, pa.array([_matrix(part[vector].combine_chunks()).tobytes()], pa.binary())]


def within_k_copies(part: pa.Table, ids: Sequence[str], vector: str, k: int) -> pa.Table:
    """Rows sorted by identifier, less those that follow ``k`` rows with the same vector.

    These score the same for every query and come before it, so it is never among the ``k`` best.
    """
    part = _by_id(part, ids)
    if part.num_rows <= k:
        return part
    words = _matrix(part[vector].combine_chunks()).view(np.uint64)
    # Rows with different sums differ; if any two are equal, all are compared in full.
    odd = 2 * np.arange(words.shape[1], dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    if len(np.unique((words * odd).sum(axis=1, dtype=np.uint64))) == len(words):
        return part
    _, group = np.unique(words.view(f"V{8 * words.shape[1]}").ravel(), return_inverse=True)
    order = np.argsort(group, kind="stable")
    grouped = group[order]
    kept = np.sort(order[np.arange(len(order)) - np.searchsorted(grouped, grouped) < k])
    return part.take(pa.array(kept))


def rows_per_pack(block: pa.Table, vector: str, most: int) -> int:
    """As many rows as a pack may hold, by rows and bytes."""
    return max(1, min(most, PACK_BYTES // (8 * max(1, len(block[vector][0])))))


def pack_vectors(df: DataFrame, ids: Sequence[str], vector: str, pack_rows: int, most: int | None = None) -> DataFrame:
    """Rows that lie together as packs; nothing is shuffled, and rows without a vector are left out.

    Of ``most`` best rows that are looked for, those that cannot be one are left out, see :func:`within_k_copies`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = pa.Table.from_batches([batch])
            block = block.filter(pc.is_valid(block[vector]))
            size = rows_per_pack(block, vector, pack_rows) if block.num_rows else 1
            for start in range(0, block.num_rows, size):
                part = block.slice(start, size)
                pack = one_pack(part if most is None else within_k_copies(part, ids, vector, most), ids, vector)
                yield pa.RecordBatch.from_arrays(pack, names=["rows", "matrix"])

    return df.select(*ids, vector).mapInArrow(run, T.StructType(pack_type(df, ids)))


def unpack(rows: pa.Array, matrix: pa.Array, at: int) -> tuple[pa.Table, np.ndarray]:
    """Identifiers and vectors of one pack."""
    named = rows.slice(at, 1).flatten()
    ids = pa.table(named.flatten(), names=[field.name for field in named.type])
    return ids, np.frombuffer(matrix[at].as_buffer(), dtype=np.float64).reshape(len(named), -1)


def _candidates(
    store: np.ndarray, queries: np.ndarray, k: int, border: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, score)`` of all rows within the k-th smallest score and ``border``.

    A matrix product finds the candidates with a margin for its rounding error; their
    scores are then computed from the differences, free of cancellation. Ties at the
    border are all kept, so the caller's order decides between them.
    """
    square = (store * store).sum(axis=1)
    query_square = (queries * queries).sum(axis=1)
    # Scores less the query's own square, as one product: only a comparison passes over all pairs once more.
    rough = np.column_stack([-2.0 * queries, np.ones(len(queries))]) @ np.column_stack([store, square]).T
    # Vectors with a NaN are nobody's neighbours, and make no other row one or none.
    margin = 1e-8 * (1.0 + square.max(initial=0.0, where=np.isfinite(square)) + query_square)
    limit = border - query_square + margin
    found = np.flatnonzero(rough <= limit[:, None])
    if k < store.shape[0] and len(found) > 2 * k * len(queries):
        # The border is far off, as it is at first. Of so many groups of rows, the k-th least minimum is not below the
        # block's k-th score, and is near it.
        groups = min(store.shape[0], max(GROUPS, 4 * k))
        whole = store.shape[0] // groups * groups
        least = np.fmin.reduce(rough[:, :whole].reshape(len(queries), -1, groups), axis=1)
        kth = np.partition(least, k - 1, axis=1)[:, k - 1]
        found = np.flatnonzero(rough <= np.fmin(limit, kth + margin)[:, None])
    query, row = np.divmod(found, max(1, store.shape[0]))
    score = np.empty(len(query))
    for start in range(0, len(query), ROW_TILE):
        part = slice(start, start + ROW_TILE)
        gap = store[row[part]] - queries[query[part]]
        score[part] = (gap * gap).sum(axis=1)
    return query, row, score


class Best:
    """The ``k`` best rows per query of everything seen so far, ties broken by identifier.

    Holds identifiers and scores of at most ``k`` rows per query. The worst of them bounds what a further block
    has to offer, so later blocks add few candidates.
    """

    def __init__(self, query_ids: pa.Table, queries: np.ndarray, k: int, threshold: float | None):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.threshold = np.inf if threshold is None else threshold
        self.border = np.full(len(queries), self.threshold)
        self.rows: pa.Table | None = None

    def add(self, ids: pa.Table, store: np.ndarray) -> None:
        """Rows in the order of their identifiers, so that a row number breaks ties."""
        if store.shape[1] != self.queries.shape[1]:
            raise ValueError(f"expected vectors of {self.queries.shape[1]} dimensions, found {store.shape[1]}")
        for first in range(0, len(store), ROW_TILE):
            block = store[first : first + ROW_TILE]
            for start in range(0, len(self.queries), QUERY_TILE):
                tile = slice(start, start + QUERY_TILE)
                query, row, score = _candidates(block, self.queries[tile], self.k, self.border[tile])
                query, row, score = self._cut(query, row, score)
                if len(query):
                    found = pa.table({QUERY: query + start, SCORE: score})
                    taken = ids.take(pa.array(row + first))
                    self._merge(pa.table([*found.columns, *taken.columns], names=[*found.column_names, *_numbered(taken)]))

    def _cut(self, query: np.ndarray, row: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, ...]:
        """At most ``k`` rows per query, still as numbers."""
        kept = score <= self.threshold
        query, row, score = query[kept], row[kept], score[kept]
        order = np.lexsort((row, np.round(score, SCORE_DECIMALS), query))
        query, row, score = query[order], row[order], score[order]
        best = np.arange(len(query)) - np.searchsorted(query, query, side="left") < self.k
        return query[best], row[best], score[best]

    def _merge(self, found: pa.Table) -> None:
        rows = found if self.rows is None else pa.concat_tables([self.rows, found])
        keys = {QUERY: rows[QUERY], SCORE: pc.round(rows[SCORE], SCORE_DECIMALS)}
        keys |= {name: rows[name] for name in rows.column_names[2:]}
        order = pc.sort_indices(pa.table(keys), [(name, "ascending") for name in keys])
        query = np.asarray(rows[QUERY].take(order))
        position = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        self.rows = rows.take(order.filter(pa.array(position < self.k))).combine_chunks()
        last = position == self.k - 1
        worst = np.asarray(rows[SCORE].take(order))[last]
        # A little above the worst score, for scores that are equal after rounding.
        self.border[query[last]] = np.minimum(worst + 10.0**-SCORE_DECIMALS, self.threshold)

    def result(self, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
        """``names`` are those of the query's identifiers, the store's identifiers and the score."""
        if self.rows is not None:
            asked = self.query_ids.take(self.rows[QUERY])
            columns = [*asked.columns, *self.rows.columns[2:], self.rows[SCORE]]
            yield from pa.table(columns, names=list(names)).to_batches()


def _numbered(ids: pa.Table) -> list[str]:
    """Names for identifiers that clash with nothing."""
    return [f"id{n}" for n in range(ids.num_columns)]


def best_of_pairs(pairs: DataFrame, schema: T.StructType, k: int, threshold: float | None) -> DataFrame:
    """Candidates from rows that hold a pack of the store and, in ``asked`` and ``vectors``, a pack of queries.

    ``pack`` tells packs of queries apart. Their best rows so far are kept while a task meets them again.
    """
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        held = 0
        for batch in batches:
            packs = batch.column("pack").to_pylist()
            for at, pack in enumerate(packs):
                if pack not in best:
                    asked, queries = unpack(batch.column("asked"), batch.column("vectors"), at)
                    if held + queries.nbytes > OPEN_BYTES:
                        for each in best.values():
                            yield from each.result(names)
                        best.clear()
                        held = 0
                    held += queries.nbytes
                    # A copy: the batch goes, the queries stay.
                    best[pack] = Best(asked, queries.copy(), k, threshold)
                best[pack].add(*unpack(batch.column("rows"), batch.column("matrix"), at))
        for each in best.values():
            yield from each.result(names)

    return pairs.select("pack", "asked", "vectors", "rows", "matrix").mapInArrow(run, schema)


def with_queries(store: DataFrame, packs: DataFrame, ids: Sequence[str], vector: str) -> DataFrame:
    """Rows of the store as ``row, vector``, the first of each partition once with each of the broadcast packs of queries.

    All other rows have NULL there. Nothing is shuffled, and the join keeps the order of a partition.
    """
    # The number of a row inside of its partition is in the low bits.
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = store.select(
        F.struct(*ids).alias("row"), F.col(vector).alias("vector"), F.when(place == 0, F.lit(0)).alias("_slot")
    )
    packs = packs.withColumn("_slot", F.pmod(F.xxhash64("asked"), F.lit(1)).cast("int"))
    return rows.join(F.broadcast(packs), "_slot", "left").select("pack", "asked", "vectors", "row", "vector")


def best_of_rows(rows: DataFrame, schema: T.StructType, n_queries: int, k: int, threshold: float | None) -> DataFrame:
    """Candidates from the rows of :func:`with_queries`, for that many queries.

    A task holds all queries and one batch of plain rows; only a pack of them at a time becomes a matrix of doubles.
    """
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[Best] = []
        first, begun = None, False
        for batch in batches:
            asks = pc.is_valid(batch.column("pack"))
            for at in np.flatnonzero(np.asarray(asks)).tolist():
                asked, queries = unpack(batch.column("asked"), batch.column("vectors"), at)
                # A copy: the batch goes, the queries stay.
                best.append(Best(asked, queries.copy(), k, threshold))
                # It came once with each pack, and may come over more batches than one.
                first = batch.slice(at, 1) if first is None else first
            others = batch if asks.true_count == 0 else batch.filter(pc.invert(asks))
            if not others.num_rows:
                continue
            if sum(len(each.queries) for each in best) != n_queries:
                raise ValueError("all queries have to come before the rows of a partition")
            if not begun and first is not None:
                meet_rows(best, first)
            begun = True
            meet_rows(best, others)
        if not begun and first is not None:
            meet_rows(best, first)
        for each in best:
            yield from each.result(names)

    return rows.mapInArrow(run, schema)


def meet_rows(best: Sequence[Best], batch: pa.RecordBatch) -> None:
    """Show the rows of a batch, a pack of them at a time, to all queries."""
    named = batch.column("row")
    ids = [f"id{n}" for n in range(named.type.num_fields)]
    block = pa.table([*named.flatten(), batch.column("vector")], names=[*ids, "vector"])
    if block["vector"].null_count:
        block = block.filter(pc.is_valid(block["vector"]))
    size = rows_per_pack(block, "vector", PACK_ROWS) if block.num_rows else 1
    for start in range(0, block.num_rows if best else 0, size):
        part = within_k_copies(block.slice(start, size), ids, "vector", best[0].k)
        matrix = _matrix(part["vector"].combine_chunks())
        for each in best:
            each.add(part.select(ids), matrix)


def query_packs(queries: DataFrame, ids: Sequence[str], vector: str, tile_rows: int) -> tuple[DataFrame, int, int]:
    """Packs of queries with a number each, the number of queries, and the bytes of their matrices."""
    rows, dim = queries.agg(F.count(vector), F.max(F.size(vector))).first()
    size = 8 * rows * (dim or 0)
    parts = max(1, math.ceil(size / PACK_BYTES))
    packs = pack_vectors(queries.repartition(parts, *ids), ids, vector, tile_rows)
    packs = packs.select(
        F.monotonically_increasing_id().alias("pack"), F.col("rows").alias("asked"), F.col("matrix").alias("vectors")
    )
    return packs, rows, size


def meet(store: DataFrame, packs: DataFrame, size: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every pack of the store with every pack of queries.

    Queries of up to ``broadcast_bytes`` are broadcast. Beyond that they are dealt to slots and the store to
    blocks, and each slot meets each block: queries are copied to all blocks, the store to all slots.
    """
    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(rows: str, n: int) -> Column:
        return F.pmod(F.xxhash64(rows), F.lit(n)).cast("int")

    slots = max(1, min(MOST_SLOTS, math.ceil(size / max(broadcast_bytes, 1))))
    left, right = store.select("*", each(slots).alias("_slot")), packs.withColumn("_slot", dealt("asked", slots))
    if size <= broadcast_bytes:
        return left.join(F.broadcast(right), "_slot")
    blocks = max(1, 2 * int(store.sparkSession.conf.get("spark.sql.shuffle.partitions")) // slots)
    left = left.withColumn("_block", dealt("rows", blocks))
    right = right.select("*", each(blocks).alias("_block")).hint("shuffle_merge")
    return left.join(right, ["_block", "_slot"])


def cells(size: int, stored: int, tasks: int) -> tuple[int, int]:
    """Slots of queries and blocks of the store of so many bytes: small enough for a task, enough for ``tasks``.

    The store is copied to all slots and the queries to all blocks; as near to the fewest bytes as that allows.
    """
    slots, blocks = (max(1, math.ceil(each / CELL_BYTES)) for each in (size, stored))
    if slots * blocks < tasks:
        slots = max(slots, round(math.sqrt(tasks * max(size, 1) / max(stored, 1))))
        blocks = max(blocks, math.ceil(tasks / slots))
    return slots, blocks


def in_cells(store: DataFrame, packs: DataFrame, slots: int, blocks: int) -> DataFrame:
    """Packs of the store and of queries, each once in every cell that it belongs to, and the rows of a cell together.

    Every cell has one row without a pack of the store, and that is joined with the cell's queries. So a pack crosses to
    Python once for a cell, not once for each of its partners.
    """
    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(rows: str, n: int) -> Column:
        return F.pmod(F.xxhash64(rows), F.lit(n)).cast("int")

    left = store.select("rows", "matrix", dealt("rows", blocks).alias("_block"), each(slots).alias("_slot"))
    cell = [(F.col("id") / slots).cast("int").alias("_block"), (F.col("id") % slots).cast("int").alias("_slot")]
    left = left.unionByName(store.sparkSession.range(slots * blocks).select(*cell), allowMissingColumns=True)
    right = packs.select("pack", "asked", "vectors", dealt("asked", slots).alias("_slot_asked"), each(blocks).alias("_block_asked"))
    here = (F.col("_block") == F.col("_block_asked")) & (F.col("_slot") == F.col("_slot_asked")) & F.col("rows").isNull()
    return left.join(right.hint("shuffle_merge"), here, "left").select(
        "_block", "_slot", "pack", "asked", "vectors", "rows", "matrix"
    )


def best_of_cells(rows: DataFrame, schema: T.StructType, k: int, threshold: float | None) -> DataFrame:
    """Candidates from the rows of :func:`in_cells`: in a cell, all its packs of the store meet all its queries.

    A task holds one cell, whichever side of it comes first.
    """
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[Best] = []
        store: list[tuple[pa.Table, np.ndarray]] = []
        cell, done = None, set()
        for batch in batches:
            places = zip(*(batch.column(name).to_pylist() for name in ("_block", "_slot", "pack")), strict=True)
            for at, (block, slot, pack) in enumerate(places):
                if (block, slot) != cell:
                    for each in best:
                        yield from each.result(names)
                    best, store = [], []
                    done.add(cell)
                    cell = (block, slot)
                    if cell in done:
                        raise ValueError("the rows of a cell have to come together")
                if pack is not None:
                    best.append(Best(*unpack(batch.column("asked"), batch.column("vectors"), at), k, threshold))
                    for part in store:
                        best[-1].add(*part)
                elif batch.column("rows")[at].is_valid:
                    store.append(unpack(batch.column("rows"), batch.column("matrix"), at))
                    for each in best:
                        each.add(*store[-1])
        for each in best:
            yield from each.result(names)

    return rows.mapInArrow(run, schema)


def _ranked(found: DataFrame, keys: Sequence[str], ids: Sequence[str], k: int) -> DataFrame:
    ranking = Window.partitionBy(*keys).orderBy(F.round("score", SCORE_DECIMALS), *ids)
    return found.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)


def hit_schema(
    store: DataFrame, queries: DataFrame, ids: Sequence[str], query_ids: Sequence[str]
) -> T.StructType:
    fields = [*[queries.schema[q] for q in query_ids], *[store.schema[i] for i in ids]]
    return T.StructType([*fields, T.StructField(SCORE, T.DoubleType())])


def ranked_hits(found: DataFrame, query_ids: Sequence[str], ids: Sequence[str], k: int) -> DataFrame:
    """The ``k`` best candidates per query.

    Ranked inside parts of the store first, so that a query with very many candidates is ranked by many tasks.
    """
    part = F.pmod(F.xxhash64(*ids), F.lit(RANK_PARTS)).alias("_part")
    partly = _ranked(found.select("*", part), [*query_ids, "_part"], ids, k).drop("rank", "_part")
    return _ranked(partly, query_ids, ids, k)


def with_payload(
    winners: DataFrame, store: DataFrame, query_ids: Sequence[str], ids: Sequence[str], vector: str, few: bool
) -> DataFrame:
    """What else the store holds, joined to the winners."""
    names = [*query_ids, *[c for c in store.columns if c != vector], SCORE, "rank"]
    payload = [c for c in store.columns if c != vector and c not in ids]
    if not payload:
        return winners.select(*names)
    keyed = store.select(*[F.col(i).alias(f"_store_{n}") for n, i in enumerate(ids)], *payload)
    match = functools.reduce(
        lambda x, y: x & y, [F.col(f"_store_{n}") == winners[i] for n, i in enumerate(ids)]
    )
    return keyed.join(F.broadcast(winners) if few else winners, match).select(*names)


def nearest(
    store: DataFrame,
    queries: DataFrame,
    k: int,
    ids: Sequence[str],
    query_ids: Sequence[str],
    vector: str = "embedding",
    query_vector: str = "embedding",
    threshold: float | None = None,
    tile_rows: int = PACK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` nearest store rows of every query: ``query_ids, rank, score`` and all
    store columns except the vector. ``ids`` identifies a store row and breaks ties.

    The store is read once, and once more if it has other columns to return; such a store should be a written table. A
    threshold is applied before the ranking; as both use the score, the rows are the
    same as if it came after, and less is shuffled.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    queries = queries.select(*query_ids, query_vector)
    packs, rows, size = query_packs(queries, query_ids, query_vector, tile_rows)
    schema = hit_schema(store, queries, ids, query_ids)
    if size <= broadcast_bytes:
        # Plain rows go to the queries: packs would be batches of many megabytes, in one more worker a task.
        found = best_of_rows(with_queries(store, packs, ids, vector), schema, rows, k, threshold)
    else:
        stored, dim = store.agg(F.count(vector), F.max(F.size(vector))).first()
        dealt = cells(size, 8 * stored * (dim or 0), CELLS_PER_CORE * store.sparkSession.sparkContext.defaultParallelism)
        found = best_of_cells(in_cells(pack_vectors(store, ids, vector, PACK_ROWS, k), packs, *dealt), schema, k, threshold)
    winners = ranked_hits(found, query_ids, ids, k)
    return with_payload(winners, store, query_ids, ids, vector, rows * k <= WINNER_ROWS)


def score_statistics(hits: DataFrame, query_ids: Sequence[str]) -> DataFrame:
    return hits.groupBy(*query_ids).agg(
        F.min("score").alias("best"),
        F.max("score").alias("worst"),
        (F.max("score") - F.min("score")).alias("score_range"),
        F.avg("score").alias("average"),
        F.count(F.lit(1)).alias("hits"),
    )


def hit_display(hits: DataFrame, query_ids: Sequence[str], content: str, max_length: int = 150) -> DataFrame:
    """What a reader of the results sees, with a default for missing metadata."""
    return hits.select(
        *query_ids,
        "rank",
        F.coalesce(F.col("file_name"), F.lit(UNKNOWN)).alias("source"),
        F.coalesce(F.col("page").cast("string"), F.lit(UNKNOWN)).alias("page"),
        F.coalesce(F.col("parser"), F.lit(UNKNOWN)).alias("parser"),
        F.length(content).alias("content_length"),
        preview(F.col(content), max_length).alias("preview"),
        "score",
    )
