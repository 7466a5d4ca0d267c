"""Search with pruning: the same hits as the full scan, and fewer rows looked at where there are clusters."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.operators import pivots, search


def frame(spark, matrix, name="id"):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} int, embedding array<float>")


def hits(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 6)) for r in df.collect())


def clustered(seed, clusters=12, each=60, dim=6):
    generator = np.random.default_rng(seed)
    centers = generator.normal(0, 20, (clusters, dim))
    return np.concatenate([c + generator.normal(0, 0.5, (each, dim)) for c in centers]), centers


@pytest.mark.parametrize(
    ("kind", "threshold"), [("clustered", None), ("clustered", 1.5), ("even", None), ("copies", 1.5), ("few", None)]
)
def test_pruned_hits_equal_the_full_scan(spark, tmp_path, monkeypatch, kind, threshold):
    monkeypatch.setattr(pivots, "RING_ROWS", 16)
    monkeypatch.setattr(pivots, "ASK_ROWS", 3)
    generator = np.random.default_rng(7)
    store = {
        "clustered": clustered(1)[0],
        "even": generator.normal(0, 1, (300, 6)),
        "copies": np.repeat(generator.integers(0, 3, (4, 6)).astype(float), 50, axis=0),
        "few": generator.normal(0, 1, (3, 6)),
    }[kind]
    queries = np.concatenate([store[::37], generator.normal(0, 5, (5, 6))])
    left, right = frame(spark, [*store, None]).repartition(4), frame(spark, [*queries, None], "query_id")
    index = pivots.build_index(left, str(tmp_path / "index"), ["id"], pivots=12)
    for k in (1, 5):
        want = hits(search.nearest(left, right, k, ["id"], ["query_id"], threshold=threshold))
        assert hits(pivots.nearest_pruned(index, right, k, ["query_id"], threshold=threshold)) == want


def looked_at(index, queries, k):
    """Rows of the pivots that a search would scan, per query."""
    gaps = pivots.query_gaps(index, queries, ["query_id"], k).cache()
    found = pivots.nearest_pruned(index, queries, k, ["query_id"]).where(F.col("rank") == k)
    bound = found.select("query_id", F.sqrt("score").alias("bound"))
    return pivots.scanned_rows(gaps.join(bound, "query_id")).groupBy("query_id").agg(F.sum("held").alias("n"))


def test_clusters_that_cannot_win_are_not_scanned(spark, tmp_path):
    store, centers = clustered(2)
    index = pivots.build_index(frame(spark, store), str(tmp_path / "index"), ["id"], pivots=12)
    assert index.pivots().agg(F.sum("held")).first()[0] == len(store)
    rows = [r["n"] for r in looked_at(index, frame(spark, centers, "query_id"), 4).collect()]
    assert len(rows) == 12 and max(rows) <= len(store) / 4


def test_folders_of_other_pivots_are_not_read(spark, tmp_path):
    store, _ = clustered(3)
    index = pivots.build_index(frame(spark, store), str(tmp_path / "index"), ["id"], pivots=12)
    filters = re.search(r"PartitionFilters: \[(.*?)\]", index.packs([1, 2])._jdf.queryExecution().executedPlan().toString())
    assert "pivot" in filters[1]
    assert {r[0] for r in index.packs([1, 2]).select("pivot").distinct().collect()} == {1, 2}


def test_empty_store_and_bad_k(spark, tmp_path):
    empty, query = frame(spark, [None]), frame(spark, [[1.0, 2.0]], "query_id")
    index = pivots.build_index(empty, str(tmp_path / "index"), ["id"])
    assert pivots.nearest_pruned(index, query, 3, ["query_id"]).collect() == []
    with pytest.raises(ValueError):
        pivots.nearest_pruned(index, query, 0, ["query_id"])


def test_a_query_is_packed_once_whatever_its_pivots(spark, tmp_path, monkeypatch):
    sizes = []
    meet = search.meet

    def watched(store, packs, size, *more, **named):
        # Vectors of the queries, not of the pivots.
        if "lows" in packs.columns:
            sizes.append((size, packs.select(F.explode("asked.query_id")).count()))
        return meet(store, packs, size, *more, **named)

    monkeypatch.setattr(search, "meet", watched)
    generator = np.random.default_rng(5)
    store = generator.normal(0, 1, (400, 16))
    index = pivots.build_index(frame(spark, store), str(tmp_path / "index"), ["id"], pivots=16)
    asked = frame(spark, store[::4], "query_id")
    assert hits(pivots.nearest_pruned(index, asked, 4, ["query_id"])) == hits(search.nearest(frame(spark, store), asked, 4, ["id"], ["query_id"]))
    # Nearly every query asks nearly every pivot here.
    assert len(sizes) == 2 and all(n <= 100 and size <= 2 * 8 * 16 * 100 for size, n in sizes)
