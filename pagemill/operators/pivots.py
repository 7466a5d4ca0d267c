"""Exact search that skips what the triangle inequality rules out.

The store is written as packs of vectors by nearest pivot and distance from it, with the nearest and the farthest
vector of every pivot and pack. A query first scans the pivots next to it until it has ``k`` rows; their k-th distance bounds
what can still win. A pivot, or a pack of it, is then scanned only if the ring of its distances comes within that bound of the
query's own distance from the pivot. In the worst case, of vectors without any clusters, everything is
scanned and the answer is the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pagemill.operators import search
from pagemill.session import written

PIVOTS = 64
# Pivots are picked from so many vectors, spread over the store by hash.
SAMPLE_ROWS = 4096
# Vectors of one pack, and queries that are asked together: small, so that packs are narrow rings.
RING_ROWS = 512
ASK_ROWS = 64
# Distances are sums of rounded numbers.
SLACK = 1e-7


@dataclass(frozen=True)
class PivotIndex:
    """``pivots(pivot, center, held, near, far)`` has one row per pivot; ``packs(pivot, near, far, rows, matrix)``."""

    spark: SparkSession
    path: str
    ids: tuple[str, ...]
    fields: T.StructType
    packed: T.StructType

    def pivots(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/pivots")

    def packs(self, pivots: Sequence[int]) -> DataFrame:
        """Packs of some pivots; the folders of others are not read."""
        return self.spark.read.schema(self.packed).parquet(f"{self.path}/packs").where(F.col("pivot").isin(list(pivots)))


def _spread_out(count: int):
    """Vectors far apart: the next one is always the farthest from those before."""
    def run(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by("place")
        vectors = search._matrix(sample["center"].combine_chunks())
        chosen, gap = [0], ((vectors - vectors[0]) ** 2).sum(axis=1)
        while len(chosen) < min(count, len(vectors)) and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
        return pa.table({"pivot": pa.array(range(len(chosen)), pa.int32()), "center": pa.array(list(vectors[chosen]))})

    return run


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances of all rows of a block to a bounded number of others, free of cancellation."""
    found = np.empty((len(left), len(right)))
    for n, row in enumerate(right):
        found[:, n] = np.sqrt(((left - row) ** 2).sum(axis=1))
    return found


def _to_pivots(df: DataFrame, pivots: DataFrame, ids: Sequence[str], vector: str, nearest_only: bool) -> DataFrame:
    """``ids, pivot, gap`` with the distance to every pivot; or the nearest pivot only, with the vector."""
    # One pack, of at most as many vectors as there are pivots.
    centers = search.pack_vectors(pivots.coalesce(1), ["pivot"], "center", 1 << 20)
    centers = centers.select(F.lit(0).cast("long").alias("pack"), F.col("rows").alias("asked"), F.col("matrix").alias("vectors"))
    pairs = search.meet(search.pack_vectors(df, ids, vector, search.PACK_ROWS), centers, 0)
    kinds = [df.schema[i] for i in ids]
    fields = [*kinds, T.StructField("pivot", T.IntegerType()), T.StructField("gap", T.DoubleType())]
    if nearest_only:
        fields.append(T.StructField("vector", T.ArrayType(T.DoubleType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                named, centers = search.unpack(batch.column("asked"), batch.column("vectors"), at)
                rows, vectors = search.unpack(batch.column("rows"), batch.column("matrix"), at)
                gap, number = _distances(vectors, centers), np.asarray(named["pivot"])
                if nearest_only:
                    best = gap.argmin(axis=1)
                    offsets = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))
                    more = [pa.array(number[best]), pa.array(gap[np.arange(len(best)), best]), lists]
                else:
                    rows = rows.take(pa.array(np.repeat(np.arange(len(vectors)), len(number))))
                    more = [pa.array(np.tile(number, len(vectors))), pa.array(gap.ravel())]
                names = [f.name for f in fields]
                yield from pa.table([*rows.columns, *more], names=names).to_batches()

    return pairs.select("asked", "vectors", "rows", "matrix").mapInArrow(run, T.StructType(fields))


def _ringed(assigned: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Packs of vectors of one pivot and of similar distance from it, as the rows are sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = pa.Table.from_batches([batch])
            pivot = np.asarray(block["pivot"])
            cuts = [0, *(np.flatnonzero(np.diff(pivot)) + 1), len(pivot)] if len(pivot) else []
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                for start in range(first, last, search.rows_per_pack(block, "vector", RING_ROWS)):
                    part = block.slice(start, min(search.rows_per_pack(block, "vector", RING_ROWS), last - start))
                    gap = np.asarray(part["gap"])
                    ring = [pa.array([x]) for x in (gap.min(), gap.max())]
                    pack = search.one_pack(part, ids, "vector")
                    names = ["pivot", "near", "far", "rows", "matrix"]
                    yield pa.RecordBatch.from_arrays([part["pivot"].combine_chunks().slice(0, 1), *ring, *pack], names=names)

    fields = [assigned.schema["pivot"], *[T.StructField(n, T.DoubleType()) for n in ("near", "far")]]
    fields += search.pack_type(assigned, ids)
    return assigned.select("pivot", "gap", "vector", *ids).mapInArrow(run, T.StructType(fields))


def build_index(
    store: DataFrame, path: str, ids: Sequence[str], vector: str = "embedding", pivots: int = PIVOTS
) -> PivotIndex:
    """Write the vectors of ``store`` by pivot; rows without a vector are left out.

    Only the pivots come from a sample, of ``SAMPLE_ROWS`` rows. Rows are dealt by ranges of pivot and distance, so a pivot with
    a third of all rows is written by many tasks.
    """
    spark = store.sparkSession
    vectors = store.where(F.size(vector) > 0)
    place = F.xxhash64(*ids)
    sample = vectors.orderBy(place, *ids).limit(SAMPLE_ROWS)
    sample = sample.select(place.alias("place"), F.col(vector).cast("array<double>").alias("center"))
    chosen = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_spread_out(pivots), "pivot int, center array<double>")
    centers = written(chosen, "centers")
    assigned = _to_pivots(vectors, centers, ids, vector, nearest_only=True)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["pivot", "gap", *ids]
    sorted_rows = assigned.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    ringed = _ringed(sorted_rows, ids)
    ringed.write.partitionBy("pivot").parquet(f"{path}/packs")
    held = spark.read.schema(ringed.schema).parquet(f"{path}/packs").groupBy("pivot").agg(
        F.sum(F.size("rows")).alias("held"), F.min("near").alias("near"), F.max("far").alias("far")
    )
    centers.join(held, "pivot").write.parquet(f"{path}/pivots")
    return PivotIndex(spark, path, tuple(ids), T.StructType([store.schema[i] for i in ids]), ringed.schema)


def _scan(
    index: PivotIndex, known: DataFrame, wanted: DataFrame, query_ids: Sequence[str], k: int, threshold: float | None
) -> DataFrame:
    """Candidates of the queries ``known(query_ids, vector, home, home_gap)`` in the rings ``wanted(query_ids, pivot, low, high)``.

    A query is packed once, with others next to the same pivot, and the pack carries the rings that any of them wants. So
    queries travel as often as in a full scan, however many pivots they ask.
    """
    ring = F.struct("pivot", "low", "high")
    asked = written(known.join(wanted.groupBy(*query_ids).agg(F.collect_list(ring).alias("rings")), list(query_ids)), "scan")
    # Bounded: one number per pivot.
    pivots = [row[0] for row in asked.select(F.explode("rings.pivot")).distinct().collect()]
    rows, dim = asked.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    places = max(pivots, default=-1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = pa.Table.from_batches([batch])
            home = np.asarray(block["home"])
            cuts = [0, *(np.flatnonzero(np.diff(home)) + 1), len(home)] if len(home) else []
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                for start in range(first, last, ASK_ROWS):
                    part = block.slice(start, min(ASK_ROWS, last - start))
                    rings = part["rings"].combine_chunks().flatten()
                    pivot, low, high = (np.asarray(rings.field(n)) for n in range(3))
                    # By pivot, the lowest and the highest distance that a query of the pack looks at.
                    lows, highs = np.full(places, np.inf), np.full(places, -np.inf)
                    np.minimum.at(lows, pivot, low)
                    np.maximum.at(highs, pivot, high)
                    edges = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (lows, highs)]
                    pack = search.one_pack(part, query_ids, "vector")
                    yield pa.RecordBatch.from_arrays([*edges, *pack], names=["lows", "highs", "asked", "vectors"])

    packed = [T.StructField(n, f.dataType) for n, f in zip(("asked", "vectors"), search.pack_type(asked, query_ids), strict=True)]
    edges = [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("lows", "highs")]
    size = 8 * rows * (dim or 0) + 16 * places * -(-rows // ASK_ROWS)
    order = ["home", "home_gap", *query_ids]
    dealt = asked.repartitionByRange(max(1, -(-size // search.PACK_BYTES)), *order).sortWithinPartitions(*order)
    packs = dealt.select("home", "rings", "vector", *query_ids).mapInArrow(run, T.StructType([*edges, *packed]))
    met = search.meet(index.packs(pivots), packs.withColumn("pack", F.monotonically_increasing_id()), size)
    pairs = met.where((F.col("far") >= F.get("lows", "pivot")) & (F.col("near") <= F.get("highs", "pivot")))
    fields = [*[asked.schema[q] for q in query_ids], *index.fields, T.StructField(search.SCORE, T.DoubleType())]
    return search.best_of_pairs(pairs, T.StructType(fields), k, threshold)


def query_gaps(index: PivotIndex, queries: DataFrame, query_ids: Sequence[str], k: int, vector: str = "embedding") -> DataFrame:
    """``query_ids, pivot, gap, held, near, far, home``: every query with every pivot; the home pivots hold ``k`` rows together."""
    pivots = index.pivots()
    gaps = _to_pivots(queries.select(*query_ids, vector), pivots, query_ids, vector, nearest_only=False)
    nearest_first = Window.partitionBy(*query_ids).orderBy("gap", "pivot").rowsBetween(Window.unboundedPreceding, -1)
    joined = gaps.join(F.broadcast(pivots.drop("center")), "pivot")
    return joined.withColumn("home", F.coalesce(F.sum("held").over(nearest_first), F.lit(0)) < k)


def scanned_rows(gaps: DataFrame) -> DataFrame:
    """Pivots that are scanned, by a query's bound; rows of others are never looked at."""
    slack = SLACK * (1 + F.col("gap") + F.col("bound"))
    reach = F.col("bound") + slack
    return gaps.where(
        F.col("home") | (F.col("gap") - F.col("far") <= reach) & (F.col("near") - F.col("gap") <= reach)
    ).withColumns({"low": F.col("gap") - reach, "high": F.col("gap") + reach})


def nearest_pruned(
    index: PivotIndex,
    queries: DataFrame,
    k: int,
    query_ids: Sequence[str],
    vector: str = "embedding",
    threshold: float | None = None,
) -> DataFrame:
    """The hits of :func:`search.nearest` over the store of the index: ``query_ids``, its identifiers, ``rank, score``.

    An empty store has no pivot and gives no hits. Queries without a vector have none.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    ids = list(index.ids)
    known = queries.where(F.size(vector) > 0).select(*query_ids, F.col(vector).cast("array<double>").alias("vector"))
    known = written(known, "asked")
    gaps = written(query_gaps(index, known, query_ids, k, "vector"), "gaps")
    nearest = gaps.groupBy(*query_ids).agg(F.min(F.struct("gap", "pivot")).alias("n"))
    known = known.join(nearest, list(query_ids)).select(
        *query_ids, "vector", F.col("n.pivot").alias("home"), F.col("n.gap").alias("home_gap")
    )
    edge = F.lit(float("inf"))
    homes = gaps.where("home").select(*query_ids, "pivot", (-edge).alias("low"), edge.alias("high"))
    found = written(_scan(index, known, homes, query_ids, k, threshold), "home_hits")
    # The k-th distance at home; a query with fewer rows there is not bound by it.
    kth = search.ranked_hits(found, query_ids, ids, k).where(F.col("rank") == k)
    bounds = kth.select(*query_ids, F.sqrt(search.SCORE).alias("kth"))
    bound = F.least(F.coalesce("kth", edge), F.lit(float("inf") if threshold is None else threshold**0.5))
    open_gaps = gaps.join(bounds, list(query_ids), "left").withColumn("bound", bound)
    rest = scanned_rows(open_gaps).where("not home").select(*query_ids, "pivot", "low", "high")
    more = _scan(index, known, rest, query_ids, k, threshold)
    return search.ranked_hits(found.union(more), query_ids, ids, k).select(*query_ids, *ids, search.SCORE, "rank")
