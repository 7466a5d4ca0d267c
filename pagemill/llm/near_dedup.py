"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

A document is its set of word shingles. Documents with equal sets are one class; a class posts
itself under coordinate-value pairs of its MinHash signature. Two classes that agree in enough coordinates share
one of the rarest values of either (prefix filter in order of rarity), so only those are posted and long lists, which
boilerplate makes, are skipped. Lists are merged into pairs in two steps. First every class meets the one smaller
class that is the center of most of its lists, which connects a group of copies of any size by as many pairs as it
has members. What is left are lists with classes that are not connected yet. Overlapping lists form clusters; in a cluster, only classes
outside of its largest connected part look for partners, in cells of two blocks of bounded size. A cell posts its classes
again, merges the lists of its values into counts of equal coordinates, and confirms on the full sets what reaches the threshold and is
not connected. It returns a spanning set of links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pagemill.llm.columns import is_member, lookup, member_bitmap, whole_text
from pagemill.llm.components import components
from pagemill.llm.hashing import lower_ascii, mix, shingles, text_buffers, word_hashes
from pagemill.session import written

SHINGLE_WORDS = 3
MIN_SIMILARITY = 85  # percent
COORDINATES = 64
# The match threshold lies so many standard deviations below what a pair at the least similarity has on average.
DEVIATIONS = 4.3
# Bounds of one block of a cluster; a cell compares two blocks.
BLOCK_DOCUMENTS = 256
BLOCK_SHINGLES = 1 << 18
COLUMN_TILE = 4096
# Steps from a class to the center of its center.
JUMPS = 2
# Bits of the bitmap of documents whose sets are needed.
BITMAP_BITS = 1 << 24

_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) << np.uint64(32))


def _sets(text: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for row, data, offsets in text_buffers(text):
        yield row, shingles(*word_hashes(lower_ascii(data), offsets), size)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest value of every coordinate's hash over each non-empty set."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    found = np.empty((len(sets), COORDINATES), dtype=np.uint64)
    for k in range(COORDINATES):
        found[:, k] = np.minimum.reduceat(joined * _FACTORS[k] + _OFFSETS[k], starts)
    # The coordinate becomes part of the value, so that postings need one column.
    return mix(found + mix(_FACTORS))


def _arrays(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *[len(r) for r in rows]]).astype(np.int32)
    values = np.concatenate([*rows, np.empty(0, dtype=np.uint64)]).astype(np.uint64).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _digests(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and a 128-bit digest of each set."""
    return [
        pa.array([len(s) for s in sets], pa.int64()),
        pa.array(np.array([s.sum(dtype=np.uint64) for s in sets]).view(np.int64)),
        pa.array(np.array([mix(s ^ np.uint64(77)).sum(dtype=np.uint64) for s in sets]).view(np.int64)),
    ]


KEYS = ["n_shingles", "digest_a", "digest_b"]


def _sketch(size: int) -> Callable:
    """Per document the size and digest of its set and, if any, the posted values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, sets in _sets(batch.column("text"), size):
                full = [s for s in sets if len(s)]
                values = iter(signatures(full) if full else [])
                posted = [next(values) if len(s) else s for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(sets)), *_digests(sets), _arrays(posted)], names=["doc_id", *KEYS, "posted"]
                )

    return run


def _shingle_sets(bitmap: np.ndarray, size: int) -> Callable:
    """Digest and set of the documents whose bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(is_member(bitmap, np.asarray(batch.column("bit")))))
            ids = batch.column("doc_id")
            for row, sets in _sets(batch.column("text"), size):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(sets)), *_digests(sets), _arrays(sets)], names=["rep", *KEYS, "shingles"]
                )

    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a block of sets with another, by merging the lists of shared members."""
    sizes = [len(s) for s in left] + [len(s) for s in right]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, count = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    number = np.cumsum(count > 1) - 1
    column = number[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMN_TILE):
        a, b = np.searchsorted(column, [first, first + COLUMN_TILE])
        tile = np.zeros((len(sizes), COLUMN_TILE), dtype=np.float32)
        tile[owner[a:b], column[a:b] - first] = 1
        total += tile[: len(left)] @ tile[len(left) :].T
    return total


def _linked(left: list[dict], right: list[dict], min_matches: int, similarity: int) -> np.ndarray:
    """Which pairs of two blocks are not connected yet, collide often enough and are confirmed on their full sets."""
    labels = [np.array([r["label"] for r in side]) for side in (left, right)]
    candidates = labels[0][:, None] != labels[1][None, :]
    # A value holds its coordinate, so shared values are equal coordinates.
    candidates &= _overlaps([r["posted"] for r in left], [r["posted"] for r in right]) >= min_matches
    rows, columns = np.flatnonzero(candidates.any(axis=1)), np.flatnonzero(candidates.any(axis=0))
    result = np.zeros_like(candidates)
    if len(rows) and len(columns):
        x, y = [left[i]["shingles"] for i in rows], [right[j]["shingles"] for j in columns]
        common = _overlaps(x, y)
        union = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None, :] - common
        result[np.ix_(rows, columns)] = 100 * common >= similarity * union
    return result & candidates


def _spanning(nodes: list[int], linked: np.ndarray) -> list[tuple[int, int]]:
    """One link for each node but the smallest of every group of linked nodes."""
    found, seen = [], np.zeros(len(nodes), dtype=bool)
    for root in np.argsort(nodes, kind="stable"):
        front = [] if seen[root] else [root]
        seen[root] = True
        while front:
            new = np.flatnonzero(linked[front.pop()] & ~seen)
            seen[new] = True
            front.extend(new)
            found.extend((nodes[i], nodes[root]) for i in new)
    return found


def _cell_links(members: list[dict], min_matches: int, similarity: int) -> list[tuple[int, int]]:
    left = [m for m in members if m["block"] == members[0]["cell_low"]]
    right = [m for m in members if m["block"] == members[0]["cell_high"]]
    if members[0]["cell_low"] == members[0]["cell_high"]:
        return _spanning([m["rep"] for m in left], _linked(left, left, min_matches, similarity))
    every = np.zeros((len(left) + len(right),) * 2, dtype=bool)
    if left and right:
        every[: len(left), len(left) :] = _linked(left, right, min_matches, similarity)
        every |= every.T
    return _spanning([m["rep"] for m in left + right], every)


CELL = ["cluster", "cell_low", "cell_high"]


def _search_cells(min_matches: int, similarity: int) -> Callable:
    """Rows come sorted by cell; one cell is held at a time."""
    def links_of(rows: list[dict]) -> pa.RecordBatch:
        links = _cell_links(rows, min_matches, similarity) if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([x[n] for x in links], pa.int64()) for n in (0, 1)], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            plain = batch.drop_columns(["posted", "shingles"]).to_pylist()
            lists = {n: batch.column(n) for n in ("posted", "shingles")}
            for i, row in enumerate(plain):
                for name, column in lists.items():
                    row[name] = column[i].values.to_numpy()
                if cell != (cell := tuple(row[c] for c in CELL)) and rows:
                    yield links_of(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield links_of(rows)

    return run


def least_matches(similarity: int) -> int:
    """Equal coordinates that a pair of this similarity has but for about one pair in 100,000."""
    share = similarity / 100
    return math.floor(COORDINATES * share - DEVIATIONS * math.sqrt(COORDINATES * share * (1 - share)))


def prefix_postings(classes: DataFrame, min_matches: int) -> DataFrame:
    """``rep, value``: the rarest values of each class, as many as the match threshold needs."""
    postings = classes.select("rep", F.explode("posted").alias("value"))
    frequency = postings.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    common = lookup(postings, frequency, ["value"], ["rep"], "inner")
    ranked = common.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("values"))
    # Values of a single class are the rarest; they need not be posted.
    left = COORDINATES - min_matches + 1 - (COORDINATES - F.size("values"))
    return ranked.where(left > 0).select("rep", F.explode(F.slice("values", F.lit(1), left)).alias("p")).select(
        "rep", "p.value"
    )


def center_pairs(posted: DataFrame) -> DataFrame:
    """``a, b``: each class with one smaller one, that which is the center of most of its lists.

    The center of a list is its smallest class, so a list of any length yields no more pairs than it has members.
    """
    centers = posted.groupBy("value").agg(F.min("rep").alias("center"), F.max("rep").alias("other"))
    centers = centers.where("center < other").select("value", "center")
    touching = lookup(posted, centers, ["value"], ["rep"], "inner").where("rep <> center")
    counted = touching.groupBy("rep", "center").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by("center", F.struct(-F.col("n"), F.col("center")))
    return counted.groupBy(F.col("rep").alias("a")).agg(best.alias("b"))


def center_labels(links: DataFrame) -> DataFrame:
    """``rep, label`` of the classes linked to a center; equal labels are connected.

    Every class has one link at most, to a smaller one, so a label is found by steps upward. A label that would need more
    steps only leaves some connected pairs to be looked at.
    """
    step = links.select(F.col("a").alias("label"), F.col("b").alias("above"))
    labels = links.select(F.col("a").alias("rep"), F.col("b").alias("label"))
    for _ in range(JUMPS):
        labels = lookup(labels, step, ["label"], ["rep"]).select("rep", F.coalesce("above", "label").alias("label"))
    return labels


def colliding(pairs: DataFrame, classes: DataFrame, min_matches: int) -> DataFrame:
    """The pairs of classes and centers with enough equal coordinates, counted on a byte of each: equal values have equal bytes."""
    marks = classes.select("rep", F.transform("posted", lambda v: F.shiftright(v, 56).cast("tinyint")).alias("marks"))
    met = pairs.join(marks.select(F.col("rep").alias("a"), F.col("marks").alias("x")), "a")
    met = lookup(met, marks.select(F.col("rep").alias("b"), F.col("marks").alias("y")), ["b"], ["a"], "inner")
    equal = F.zip_with("x", "y", lambda x, y: (x == y).cast("int"))
    return met.where(F.aggregate(equal, F.lit(0), lambda n, e: n + e) >= min_matches).select("a", "b")


def sets_of(documents: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``rep, shingles`` of the classes in ``wanted``. No text is shuffled, and no sets but those asked for.

    A bitmap of a fixed number of bits passes over most other documents; what it lets through falls in the join.
    """
    def bit(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(BITMAP_BITS)).alias("bit")

    wanted = wanted.select("rep").distinct()
    bitmap = documents.sparkSession.sparkContext.broadcast(member_bitmap(wanted.select(bit("rep")), BITMAP_BITS))
    found = documents.select("doc_id", "text", bit("doc_id")).mapInArrow(
        lambda batches: _shingle_sets(bitmap.value, size)(batches),
        "rep long, n_shingles long, digest_a long, digest_b long, shingles array<long>",
    )
    # Equal ids with other texts are told apart by the class they were sketched to.
    asked = classes.select("rep", *KEYS).join(wanted, "rep", "left_semi")
    return found.join(asked, ["rep", *KEYS], "left_semi").dropDuplicates(["rep"]).select("rep", "shingles")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs of classes and centers whose full sets are similar enough; a class is in one pair, a center in many."""
    met = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
    met = lookup(met, sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), ["b"], ["a"], "inner")
    common, total = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    return met.where(common * (100 + similarity) >= total * similarity).select("a", "b")


def open_clusters(posted: DataFrame, labels: DataFrame) -> DataFrame:
    """``rep, cluster, label, inside`` of classes in lists with more than one label.

    Lists that share a class or a label are one cluster; ``inside`` are those of its most frequent label, who are connected.
    """
    labelled = posted.join(labels, "rep", "left").select("value", "rep", F.coalesce("label", "rep").alias("label"))
    lists = labelled.groupBy("value").agg(F.min("label").alias("first"), F.max("label").alias("last"))
    members = lookup(labelled, lists.where("first < last").select("value", "first"), ["value"], ["rep"], "inner")
    members = written(members.select("rep", "label", "first"), "open")
    named = components(members.select("label", "first").distinct(), "label", "first")
    # Of a label that meets no other there is nothing to compare; each class is in the cluster of its label.
    classes = members.select("rep", "label").distinct()
    placed = lookup(classes, named.select(F.col("node").alias("label"), F.col("component").alias("cluster")), ["label"], ["rep"], "inner")
    sizes = placed.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("most"))
    return lookup(placed, most, ["cluster"], ["rep"], "inner").select(
        "rep", "cluster", "label", (F.col("label") == F.col("most")).alias("inside")
    )


def cells_of(members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of a cluster copied to the cells they are compared in: blocks of outsiders with each other and with blocks of insiders.

    Insiders are copied once per block of outsiders, so a large connected group with a few others beside it costs little.
    """
    known = members.join(classes.select("rep", "n_shingles", "posted"), "rep")
    known = written(known, "members")
    blocks = lambda who: F.ceil(
        F.greatest(F.count_if(who) / BLOCK_DOCUMENTS, F.sum(F.when(who, F.col("n_shingles")).otherwise(0)) / BLOCK_SHINGLES)
    ).cast("int")
    outside = ~F.col("inside")
    sizes = known.groupBy("cluster").agg(blocks(outside).alias("n_out"), blocks(F.col("inside")).alias("n_in"))
    placed = lookup(known, sizes, ["cluster"], ["rep"], "inner").where("n_out > 0")
    # Blocks of insiders have numbers after those of outsiders.
    own = F.when(outside, F.pmod(F.xxhash64("rep"), F.col("n_out"))).otherwise(
        F.col("n_out") + F.pmod(F.xxhash64("rep"), F.col("n_in"))
    )
    last = F.when(outside, F.col("n_out") + F.col("n_in")).otherwise(F.col("n_out")) - 1
    with_sets = placed.select("*", own.cast("int").alias("block"), last.alias("last")).join(sets, "rep")
    return with_sets.select(
        "rep", "cluster", "label", "block", "posted", "shingles", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    ).select(
        "rep", "cluster", "label", "block", "posted", "shingles",
        F.least("block", "other").alias("cell_low"), F.greatest("block", "other").alias("cell_high"),
    )


def find_links(documents: DataFrame, classes: DataFrame, size: int, similarity: int) -> DataFrame:
    """``a, b``: links that connect all classes whose sets are similar enough."""
    min_matches = least_matches(similarity)
    posted = written(prefix_postings(classes, min_matches), "posted")
    pairs = written(colliding(center_pairs(posted), classes, min_matches), "pairs")
    sets = written(sets_of(documents, classes, pairs.select(F.explode(F.array("a", "b")).alias("rep")), size), "sets")
    to_centers = written(confirmed(pairs, sets, similarity), "links")
    members = written(open_clusters(posted, center_labels(to_centers)), "clusters")
    cells = cells_of(members, classes, sets_of(documents, classes, members, size))
    dealt = cells.repartition(*CELL).sortWithinPartitions(*CELL, "block", "rep")
    return to_centers.union(dealt.mapInArrow(_search_cells(min_matches, similarity), "a long, b long"))


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    similarity: int = MIN_SIMILARITY,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every id of ``df``.

    Documents are linked where their sets of distinct windows of ``size`` words have a Jaccard
    similarity of at least ``similarity`` percent; the component is named by its smallest id, the row that stays.

    NULL, empty and blank texts have an empty set and are linked with nothing. Rows without an
    id are linked with nothing, have no component and stay. Rows with the same id are one
    document: if their texts differ, the one whose set comes first by digest stands for the id. A very long text is one set
    of a task. Other columns are passed over, and an empty table gives no rows.
    """
    documents = df.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    sketch = written(
        documents.mapInArrow(
            _sketch(size), "doc_id long, n_shingles long, digest_a long, digest_b long, posted array<long>"
        ),
        "sketch",
    )
    sets = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = written(
        sets.groupBy(*KEYS).agg(F.min("doc_id").alias("rep"), F.first("posted").alias("posted")), "classes"
    )
    links = find_links(documents.where("doc_id is not null"), classes, size, similarity)
    named = components(links, "a", "b").select(F.col("node").alias("rep"), "component")
    answers = classes.select(*KEYS, "rep").join(named, "rep", "left")
    answers = answers.select(*KEYS, F.coalesce("component", "rep").alias("component_id"))
    ids = sketch.select("doc_id", *KEYS)
    linked = lookup(ids.where("n_shingles > 0 and doc_id is not null"), answers, KEYS, ["doc_id"])
    alone = ids.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return linked.select(*columns).union(alone.select(*columns)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
