"""Searches inside a store: every row of it asks, and every row of it is searched."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.operators import search
from pagemill.plans.oracles import ORACLES
from pagemill.plans.queries import QUERIES
from tests.compare import connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def scores(duck):
    """Identifiers in order, and the squared distances of all pairs."""
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    vectors = np.array([row[1] for row in rows], dtype=float)
    return [row[0] for row in rows], np.array([((vectors - v) ** 2).sum(axis=1) for v in vectors])


def ranked(ids, distances, k):
    """``(query_id, rank, vec_id, score)`` of the ``k`` nearest rows of every row."""
    order = np.lexsort((np.tile(ids, (len(ids), 1)), distances.round(9)), axis=1)[:, :k]
    return [
        (query, rank, ids[at], distances[n, at])
        for n, query in enumerate(ids)
        for rank, at in enumerate(order[n], 1)
    ]


def same_hits(found, want):
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    assert [row[:3] for row in found] == [row[:3] for row in want]
    assert np.allclose([row[3] for row in found], [row[3] for row in want], atol=2e-6)


@pytest.mark.parametrize("name", ["knn_l2", "knn_l2_blocks"])
def test_every_row_asks_all_rows(spark, scores, name):
    same_hits(QUERIES[name](spark, FOLDER).collect(), ranked(*scores, 4))


def test_every_row_asks_all_copies(spark, scores):
    ids, distances = scores
    assert ids == list(range(len(ids)))
    hits = QUERIES["knn_ties"](spark, FOLDER).collect()
    same_hits(hits, ranked(ids, distances[:, [n % 10 for n in ids]], 4))


def test_every_row_asks_all_rows_within_the_threshold(spark, scores):
    want = [row for row in ranked(*scores, 4) if row[3] <= 1.3]
    assert len(want) > 2 * len(scores[0])
    same_hits(QUERIES["knn_threshold"](spark, FOLDER).collect(), want)


def test_statistics_of_the_hits_of_every_row(spark, scores):
    ids, distances = scores
    best = np.sort(distances, axis=1)[:, :5]
    rows = QUERIES["knn_score_stats"](spark, FOLDER).orderBy("query_id").collect()
    assert [(r["query_id"], r["hits"]) for r in rows] == [(n, 5) for n in ids]
    want = np.stack([best[:, 0], best[:, -1], best[:, -1] - best[:, 0], best.mean(axis=1)], axis=1)
    found = [[r["best"], r["worst"], r["score_range"], r["average"]] for r in rows]
    assert np.allclose(found, want, atol=2e-6)


@pytest.mark.parametrize("name", ["knn_l2", "knn_l2_blocks", "knn_ties", "knn_threshold", "knn_score_stats"])
def test_every_row_asks_in_the_sql_twin(duck, scores, name):
    asked = duck.execute(f"SELECT DISTINCT query_id FROM ({ORACLES[name]}) ORDER BY 1").fetchall()
    assert [row[0] for row in asked] == scores[0]


def vectors(spark, matrix, name="id"):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} int, embedding array<float>")


def test_packs_cross_once_for_a_cell_and_every_pair_meets(spark, monkeypatch):
    store, queries = np.random.default_rng(1).random((300, 3)), np.random.default_rng(2).random((90, 3))
    left, right = vectors(spark, store).repartition(3), vectors(spark, queries, "query_id")
    packs = search.query_packs(right, ["query_id"], "embedding", 7)[0].persist()
    stored = search.pack_vectors(left, ["id"], "embedding", 50).persist()
    met = search.in_cells(stored, packs, 3, 4)
    assert met.where("rows IS NOT NULL").count() == 3 * stored.count()
    assert met.where("asked IS NOT NULL").count() == 4 * packs.count()
    schema = search.hit_schema(left, right, ["id"], ["query_id"])
    # As many candidates as there are rows: every pair is among them, once.
    pairs = search.best_of_cells(met, schema, 300, None)
    assert pairs.count() == pairs.distinct().count() == 300 * 90
    with pytest.raises(Exception, match="come together"):
        search.best_of_cells(met.orderBy(F.xxhash64("_block", "_slot", "rows", "asked")).coalesce(1), schema, 3, None).count()


def test_cells_are_small_and_enough():
    mb = 1 << 20
    for size, stored, tasks in ((26 * mb, 26 * mb, 12), (1, 500 * mb, 12), (9000 * mb, 3000 * mb, 12), (0, 0, 5)):
        slots, blocks = search.cells(size, stored, tasks)
        assert slots * blocks >= tasks
        assert size / slots <= search.CELL_BYTES and stored / blocks <= search.CELL_BYTES
    # A search of a store in itself copies either side about as often.
    assert search.cells(26 * mb, 26 * mb, 16) == (4, 4) and search.cells(1, 500 * mb, 16) == (1, 16)


@pytest.mark.parametrize("k", [1, 4, 30])
def test_of_equal_vectors_the_first_stay(spark, k):
    generator = np.random.default_rng(4)
    store = generator.integers(0, 2, (200, 3)).astype(float)
    ids = generator.permutation(200)
    part = pa.table({"id": ids, "v": pa.array(list(store))})
    kept = search.within_k_copies(part, ["id"], "v", k)["id"].to_pylist()
    place = {n: sorted(ids[(store == store[at]).all(axis=1)]).index(n) for at, n in enumerate(ids)}
    assert kept == sorted(n for n in ids if place[n] < k)
    want = []
    for q in range(200):
        order = sorted((((v - store[q]) ** 2).sum(), n) for n, v in enumerate(store))[:k]
        want += [(q, rank, n) for rank, (_, n) in enumerate(order, 1)]
    left, right = vectors(spark, store), vectors(spark, store, "query_id")
    for size in (search.BROADCAST_BYTES, 0):
        found = search.nearest(left, right, k, ["id"], ["query_id"], tile_rows=40, broadcast_bytes=size)
        assert sorted((r["query_id"], r["rank"], r["id"]) for r in found.collect()) == want


@pytest.mark.parametrize("rows", [5, 129, 1000])
@pytest.mark.parametrize("k", [1, 4, 300])
def test_candidates_are_few_and_hold_the_best(rows, k):
    generator = np.random.default_rng(6)
    store, queries = generator.normal(size=(rows, 8)) + 5, generator.normal(size=(20, 8)) + 5
    query, row, score = search._candidates(store, queries, k, np.full(20, np.inf))
    exact = ((store[None] - queries[:, None]) ** 2).sum(axis=2)
    assert np.array_equal(score, exact[query, row])
    for n in range(20):
        assert set(np.argsort(exact[n])[:k]) <= set(row[query == n])
    if k == 4 and rows == 1000:
        assert len(query) < 3 * k * 20


def test_a_vector_with_nan_costs_others_no_hit(spark):
    generator = np.random.default_rng(11)
    store = generator.normal(size=(600, 4))
    store[[3, 200, 599], 1] = np.nan
    whole = [n for n in range(600) if not np.isnan(store[n]).any()]
    want = []
    for q in whole:
        order = sorted((((store[n] - store[q]) ** 2).sum(), n) for n in whole)[:3]
        want += [(q, rank, n) for rank, (_, n) in enumerate(order, 1)]
    left, right = vectors(spark, store).coalesce(1), vectors(spark, store[whole], "query_no")
    right = right.select(F.element_at(F.lit(whole), F.col("query_no") + 1).alias("query_id"), "embedding")
    for size in (search.BROADCAST_BYTES, 0):
        found = search.nearest(left, right, 3, ["id"], ["query_id"], broadcast_bytes=size).collect()
        assert sorted((r["query_id"], r["rank"], r["id"]) for r in found) == want


def test_copies_stay_where_they_are(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["knn_ties"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Ten keys would be ten tasks, however many copies there are.
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(original" not in plan
