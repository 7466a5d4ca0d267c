"""Connected components of a distributed list of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pagemill.llm.columns import lookup
from pagemill.session import delete_path, scratch_path

MAX_ROUNDS = 60
# Links that one task contracts.
TASK_LINKS = 1 << 18


def _smallest(edges: DataFrame) -> DataFrame:
    """``u, v, m`` with the smallest neighbour ``m`` of ``u``, itself included."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return lookup(edges, least, ["u"], ["v"], "inner")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    found = _smallest(links)
    kept = found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        found.select("u", F.col("m").alias("v"))
    )
    return kept.where("u <> v").distinct()


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node of some links to the smallest node that they connect it with."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        # Every root takes the smallest root next to it, then paths are cut short.
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task, a bounded number, as the stars they amount to."""
    parts = [b for b in batches if b.num_rows]
    if parts:
        found = _forest(*(np.concatenate([np.asarray(b.column(n)) for b in parts]) for n in ("u", "v")))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["u", "v"])


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every linked node; the component is its smallest node.

    Links are dealt to as many tasks as their number asks for, and each task contracts its own to stars. If that takes more
    than one task, rounds of large and small stars follow: each links all neighbours of a node to the smallest one.
    No step gathers the neighbours of a node, a round's links are written to the shared
    folder, and the driver sees a count and a checksum.
    """
    spark = links.sparkSession
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    current = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    schema, before, path = current.schema, None, None
    for _ in range(MAX_ROUNDS):
        following = scratch_path(spark, "links")
        current.write.parquet(following)
        if path:
            delete_path(spark, path)
        path = following
        current = spark.read.schema(schema).parquet(path)
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        tasks = -(-state[0] // TASK_LINKS)
        if tasks <= 1:
            settled = current.coalesce(1).mapInArrow(_contract, schema)
            break
        if state == before:
            # Now every link leads from a node to the smallest of its component.
            settled = current
            break
        before = state
        stars = current.repartition(tasks, "v").mapInArrow(_contract, schema)
        current = _small_star(_large_star(stars))
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    roots = settled.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return settled.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
