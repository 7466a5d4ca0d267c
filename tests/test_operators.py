import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pagemill.config import MARKDOWN_SEPARATORS, PLAIN_SEPARATORS, ChunkingConfig
from pagemill.operators import abbreviations, chunking, documents, failures, numbering, search, semantic, stats
from pagemill.operators.embedding import HashEmbedder, ModelEmbedder, sparse_weights
from pagemill.operators.numbering import number_rows

TEXTS = st.text(alphabet="ab .\n#é😀", max_size=120)


# ---------------------------------------------------------------- numbering


def test_ten_million_rows_are_numbered_and_the_plan_does_not_grow(spark):
    def plan_size(df):
        return len(re.sub(r"[#\d]+", "", df._jdf.queryExecution().optimizedPlan().toString()))

    rows = lambda n: spark.range(0, n, 1, 8).select(F.xxhash64("id").alias("o"), F.expr("if(id % 3 > 0, 'hot', string(id % 1000))").alias("g"))
    small, large = (number_rows(rows(n), ["o"], ["g"], "n", "total") for n in (1000, 10_000_000))
    assert plan_size(small) == plan_size(large)
    # Numbers of a group are 1 to its size, in the order of the key.
    found = large.groupBy("g").agg(
        F.count("n").alias("rows"), F.count_distinct("n").alias("numbers"), F.max("n").alias("last"), F.max("total").alias("total"),
        (F.max_by("n", "o") == F.max("n")).alias("sorted"), F.sum("n").alias("sum"),
    ).collect()
    assert sum(r["rows"] for r in found) == 10_000_000
    for r in found:
        assert r["rows"] == r["numbers"] == r["last"] == r["total"] and r["sorted"]
    hot = large.where("g = 'hot' and n in (1, 1000, 4000000)").orderBy("n")
    keys = spark.range(10_000_000).where("id % 3 > 0").select(F.xxhash64("id").alias("o"))
    for r in hot.collect():
        assert keys.where(F.col("o") <= r["o"]).count() == r["n"]


def test_a_hot_group_is_spread_over_ranges(spark):
    df = spark.range(0, 90_000, 1, 4).select(F.lit("hot").alias("g"), F.xxhash64("id").alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = numbering.sorted_places(df, ["g"], ["o"]).groupBy("_range").count().toPandas()["count"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and sizes.max() < 2 * sizes.mean()


def test_rows_that_share_a_key_get_consecutive_numbers(spark):
    df = spark.createDataFrame([(k, n) for n, k in enumerate([3, 1, 1, None, 1, 2, None])], "k int, n int")
    got = sorted((r["k"] is not None, r["k"] or 0, r["row_no"], r["t"]) for r in number_rows(df, ["k"], total="t").collect())
    assert [r[2] for r in got] == [1, 2, 3, 4, 5, 6, 7] and {r[3] for r in got} == {7}


def test_numbering_with_a_hot_group(spark):
    generator = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 50}", generator.random(), i) for i in range(4000)]
    rows += [(None, float(i), i) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, o double, i int").repartition(7)
    got = number_rows(df, ["o"], ["g"], "n", "total").toPandas()
    want = df.toPandas()
    want["n"] = want.groupby("g", dropna=False)["o"].rank(method="first").astype(int)
    want["total"] = want.groupby("g", dropna=False)["o"].transform("size")
    key = ["g", "o", "i", "n", "total"]
    same = lambda f: f[key].fillna("-").sort_values(key[:3]).reset_index(drop=True).astype(str)
    pd.testing.assert_frame_equal(same(got), same(want))


def test_numbering_without_groups_and_on_empty_input(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = number_rows(df, ["k"]).toPandas()
    assert (got["row_no"] == got["k"] + 1).all()
    assert number_rows(df.limit(0), ["k"]).count() == 0


def test_blank_page_keeps_its_number(spark):
    pages = spark.createDataFrame([("f", 1, "a"), ("f", 2, "  "), ("f", 3, "c")], "f string, o int, t string")
    got = documents.pages_to_documents(pages, "f", "o", "t", "p").orderBy("page").collect()
    assert [(r.page, r.total_pages) for r in got] == [(1, 3), (3, 3)]


# ---------------------------------------------------------------- fixed and recursive chunks


def chunk_lists(df):
    rows = df.orderBy("i", "chunk_index").collect()
    found = {}
    for r in rows:
        assert r.chunk_index == len(found.setdefault(r.i, []))
        assert r.chunk_length == len(r.chunk)
        found[r.i].append(r.chunk)
    return found


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=15), st.integers(2, 30), st.integers(0, 29))
def test_windows_equal_recursive_splitting_by_character(spark, texts, size, overlap):
    overlap = min(overlap, size - 1)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = chunk_lists(chunking.char_window_chunks(df, "t", size, overlap))
    for i, text in enumerate(texts):
        want = chunking.split_text(text, [""], size, overlap)
        naive, at = [], 0
        while True:
            naive.append(text[at : at + size].strip())
            if at + size >= len(text):
                break
            at += size - overlap
        assert got.get(i, []) == want == [c for c in naive if c]


def naive_split(text, separators, size, overlap):
    """Straight from the definition, on lists of pieces."""
    for level, separator in enumerate(separators):
        if separator == "" or separator in text:
            break
    else:
        return [text]
    if separator == "":
        pieces = list(text)
    else:
        head, *rest = text.split(separator)
        pieces = [p for p in [head, *[separator + r for r in rest]] if p]
    finer = separators[level + 1 :]

    def merge(small):
        chunks, window = [], []
        for piece in small:
            if window and sum(map(len, window)) + len(piece) > size:
                chunks.append("".join(window))
                while window and (
                    sum(map(len, window)) > overlap or sum(map(len, window)) + len(piece) > size
                ):
                    window.pop(0)
            window.append(piece)
        return chunks + (["".join(window)] if window else [])

    result, small = [], []
    for piece in pieces:
        if len(piece) < size:
            small.append(piece)
        else:
            result += merge(small) + (naive_split(piece, finer, size, overlap) if finer else [piece])
            small = []
    return result + merge(small)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([MARKDOWN_SEPARATORS, PLAIN_SEPARATORS, [".", " "]]), st.integers(2, 25), st.integers(0, 24))
def test_recursive_split_against_the_definition(text, separators, size, overlap):
    overlap = min(overlap, size - 1)
    got = chunking.split_text(text, separators, size, overlap)
    want = [c.strip() for c in naive_split(text, separators, size, overlap)]
    assert got == [c for c in want if c]
    at = 0
    for chunk in got:
        at = text.index(chunk, max(0, at - len(chunk) - overlap))
    if "" in separators:
        assert all(len(c) <= size for c in got)
    letters = [c for c in text if not c.isspace()]
    assert set(letters) == {c for chunk in got for c in chunk if not c.isspace()}


def test_markdown_headings_open_chunks(spark):
    text = "# T\n\nintro text\n## One\nbody one\n## Two\nbody two"
    assert chunking.split_text(text, MARKDOWN_SEPARATORS, 20, 0) == ["# T\n\nintro text", "## One\nbody one", "## Two\nbody two"]


def test_recursive_chunks_inherit_columns(spark):
    df = spark.createDataFrame([(0, "x y", "m"), (1, None, "n"), (2, " ", "o")], "i int, t string, meta string")
    rows = chunking.recursive_chunks(df, "t", 10, 2, PLAIN_SEPARATORS).collect()
    assert [(r.i, r.meta, r.chunk) for r in rows] == [(0, "m", "x y")]


def test_configuration_is_checked():
    with pytest.raises(ValueError):
        ChunkingConfig(chunk_size=10, chunk_overlap=10)


def test_structure_chunks_keep_sections_apart(spark):
    blocks = [("heading", 1, "H1"), ("paragraph", 0, "a" * 5), ("paragraph", 0, "b" * 5), ("heading", 2, "H2"), ("paragraph", 0, "c" * 30)]
    df = spark.createDataFrame([(0, blocks), (1, [])], "i int, layout array<struct<kind:string,level:int,text:string>>")
    rows = chunking.structure_chunks(df, "layout", 10).orderBy("i", "chunk_index").collect()
    assert [(r.chunk, r.heading) for r in rows] == [("H1\naaaaa", "H1"), ("bbbbb", "H1"), ("H2", "H2"), ("c" * 30, "H2")]


# ---------------------------------------------------------------- semantic chunks


def brute_distances(text, buffer):
    import hashlib
    import re

    parts = re.findall(r"(?s).*?[.!?][\t-\r ]+|.+", text)
    vectors = []
    for i in range(len(parts)):
        vector = np.zeros(384)
        for token in re.split(r"[\W_]+", "".join(f" {p} " for p in parts[max(0, i - buffer) : i + buffer + 1]).lower()):
            if token:
                vector[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 384] += 1
        vectors.append(vector)
    gaps = []
    for a, b in zip(vectors, vectors[1:]):
        lengths = (a @ a or 1.0) * (b @ b or 1.0)
        gaps.append(1 - (a @ b) / np.sqrt(lengths))
    return parts, gaps


def sentence_text(generator, n):
    words = ["alpha", "beta", "gamma", "delta", "...", "42"]
    return " ".join(" ".join(generator.choices(words, k=generator.randint(1, 6))) + generator.choice(".!?") for _ in range(n))


@pytest.mark.parametrize("buffer", [0, 1, 3])
def test_semantic_chunks_against_brute_force(spark, buffer):
    generator = random.Random(buffer)
    texts = [sentence_text(generator, n) for n in (1, 2, 3, 30, 300)] + ["one sentence only", "?! ... !!! . x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    config = ChunkingConfig(use_semantic_chunking=True, buffer_size=buffer, breakpoint_percentile_threshold=90)
    got_distances = semantic.neighbour_distances(df, "i", "t", buffer).orderBy("i", "sentence_no").toPandas()
    chunks = chunk_lists(semantic.semantic_chunks(df, "i", "t", config))
    for i, text in enumerate(texts):
        parts, gaps = brute_distances(text, buffer)
        mine = got_distances[got_distances.i == i].distance.to_numpy()
        np.testing.assert_allclose(mine, gaps, atol=1e-12)
        cut = np.percentile(mine, 90) if len(mine) else 0
        want, current = [], ""
        for n, part in enumerate(parts):
            current += part
            if n < len(mine) and mine[n] > cut:
                want.append(current)
                current = ""
        assert chunks[i] == want + [current]
        assert "".join(chunks[i]) == text


def test_distances_do_not_depend_on_the_slab(monkeypatch):
    generator = np.random.default_rng(1)
    lengths = generator.integers(0, 6, 700)
    buckets = generator.integers(0, 384, lengths.sum())
    whole = {}
    for slab in (1, 7, 128, 10_000):
        monkeypatch.setattr(semantic, "SLAB", slab)
        whole[slab] = semantic._document_distances(buckets, lengths, 2)
    assert all((v == whole[1]).all() for v in whole.values())


def test_sentence_groups_of_wider_buffers(spark):
    df = spark.createDataFrame([(0, "a. b. c. d.")], "i int, t string")
    rows = semantic.sentence_groups(df, "i", "t", 2).orderBy("sentence_no").collect()
    assert [r.sentence_group for r in rows] == ["a. b. c. ", "a. b. c. d.", "a. b. c. d.", "b. c. d."]


def letter_model():
    def load():
        def encode(texts):
            return np.array([[t.count(c) for c in "abcdefg. "] for t in texts], dtype=float)

        return encode

    return ModelEmbedder(load, 9, "letters", normalize=False)


def test_semantic_chunks_from_a_model(spark, monkeypatch):
    generator = random.Random(9)
    texts = [sentence_text(generator, n) for n in (1, 2, 40, 90)] + [""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    config = ChunkingConfig(use_semantic_chunking=True, breakpoint_percentile_threshold=85)
    monkeypatch.setattr(semantic, "SLAB", 7)
    rows = semantic.semantic_chunks(df, "i", "t", config, letter_model())
    chunks = chunk_lists(rows)
    for i, text in enumerate(texts[:4]):
        parts, _ = brute_distances(text, 1)
        groups = ["".join(parts[max(0, n - 1) : n + 2]) for n in range(len(parts))]
        vectors = np.array([[g.count(c) for c in "abcdefg. "] for g in groups], dtype=float)
        gaps = [1 - (a @ b) / np.sqrt((a @ a) * (b @ b)) for a, b in zip(vectors, vectors[1:])]
        assert "".join(chunks[i]) == text
        if gaps:
            sizes = np.round(np.array(gaps), 9)
            assert len(chunks[i]) - 1 == (sizes > np.round(np.percentile(gaps, 85), 9)).sum()
    assert 4 not in chunks
    assert {(r.embedding_model, r.embedding_provider) for r in rows.collect()} == {("letters", "model")}


def test_a_model_gets_full_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(semantic, "MODEL_BATCH", 64)
    calls = str(tmp_path / "calls")

    def load():
        def encode(texts):
            with open(calls, "a") as file:
                file.write(f"{len(texts)}\n")
            return np.array([[len(t), 1.0] for t in texts])

        return encode

    df = spark.createDataFrame([(i, "One. Two is. Three is it. Four. Five.") for i in range(100)], "i int, t string").coalesce(1)
    model = ModelEmbedder(load, 2, "lengths", normalize=False)
    rows = semantic.semantic_chunks(df, "i", "t", ChunkingConfig(use_semantic_chunking=True), model).collect()
    assert {r["i"] for r in rows} == set(range(100))
    sizes = [int(x) for x in open(calls).read().split()]
    assert sum(sizes) == 500 and len(sizes) <= 500 // 64 + 1


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(2, 40))
def test_separators_kept_or_left_out(text, size):
    kept = chunking.split_text(text, MARKDOWN_SEPARATORS, size, 0)
    bare = chunking.split_text(text, MARKDOWN_SEPARATORS, size, 0, keep_separator=False)
    plain = lambda chunks: "".join(chunks).replace(".", "").replace("#", "").replace(" ", "").replace("\n", "")
    assert plain(kept) == plain(bare) and len(bare) <= len(kept)
    assert sum(map(len, bare)) <= sum(map(len, kept))


def test_model_vectors_are_never_shuffled(spark):
    df = spark.createDataFrame([(0, "a. b. c.")], "i int, t string")
    config = ChunkingConfig(use_semantic_chunking=True)
    chunks = semantic.semantic_chunks(df, "i", "t", config, letter_model())
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("EvalPython") == 1


# ---------------------------------------------------------------- embedding


def test_hash_embedder(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, ""), (2, None)], "i int, t string")
    rows = {r.i: np.array(r.embedding) for r in HashEmbedder(16).embed(df, "t").collect()}
    assert np.isclose((rows[0] ** 2).sum(), 1) and sorted(np.round(rows[0][rows[0] > 0], 4)) == [0.4472, 0.8944]
    assert not rows[1].any() and not rows[2].any()
    counts = HashEmbedder(16, normalize=False).embed(df, "t").where("i = 0").select("i", "embedding")
    assert sorted(r.weight for r in sparse_weights(counts).collect()) == [1.0, 2.0]


def test_model_embedder_loads_the_model_in_the_worker(spark):
    def load():
        return lambda texts: np.array([[len(t), 0.0, 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), (None,)], "t string")
    rows = ModelEmbedder(load, 3, "lengths", normalize=False).embed(df, "t").collect()
    assert [list(r.embedding) for r in rows] == [[3.0, 0.0, 1.0], [0.0, 0.0, 1.0]]


def test_heading_paths_follow_the_levels(spark):
    layout = [("paragraph", 0, "intro"), ("heading", 1, "A"), ("paragraph", 0, "a"), ("heading", 2, "B"), ("heading", 4, "C"),
              ("paragraph", 0, "c"), ("heading", 3, "D"), ("heading", None, "E"), ("heading", 2, "F"), ("heading", 1, "G")]
    df = spark.createDataFrame([(1, layout), (2, [])], "i int, layout array<struct<kind:string,level:int,text:string>>")
    rows = chunking.structure_chunks(df, "layout", 100, paths=True).orderBy("chunk_index").collect()
    assert [r["heading_path"] for r in rows] == [
        [], ["A"], ["A", "B"], ["A", "B", "C"], ["A", "B", "D"], ["A", "B", "D", "E"], ["A", "F"], ["G"],
    ]
    assert [r["heading"] for r in rows] == [None, "A", "B", "C", "D", "E", "F", "G"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=150), st.integers(1, 12), st.integers(0, 11))
def test_chunks_by_words_hold_at_most_so_many(text, size, overlap):
    overlap = min(overlap, size - 1)
    units = chunking.unit_finder("words")(text)
    chunks = chunking.split_text(text, ["\n\n", "\n", " ", ""], size, overlap, units=units)
    assert all(len(c.split()) <= size + 1 for c in chunks)
    if not overlap:
        assert "".join("".join(chunks).split()) == "".join(text.split())
    # One unit per character is the same as counting characters.
    every = chunking.Units(list(range(len(text))))
    assert chunking.split_text(text, ["\n", " ", ""], size, overlap, units=every) == chunking.split_text(text, ["\n", " ", ""], size, overlap)


def test_chunks_by_tokens_of_a_vocabulary(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    text = "The quick brown fox, ünïcode and 中文. " * 40 + "\n" + "x" * 300
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "i int, t string")
    rows = chunking.recursive_chunks(df, "t", 25, 5, ["\n", ". ", " ", ""], count=path).collect()
    assert {r["i"] for r in rows} == {1} and len(rows) > 10
    # A chunk begins and ends at borders of the whole text's tokens, which may be split otherwise at its ends.
    assert all(len(tokenizer.encode(r["chunk"], add_special_tokens=False).ids) <= 25 + 4 for r in rows)


def test_learned_abbreviations_do_not_end_sentences(spark):
    lines = ["We met Dr. Smith there. He left.", "Das ist z. B. gut. Es ist so.", "See Dr. Jones now. It was late.", "Auch z. B. dies hier. Gut so."]
    plain = ["the cat sat there", "a dog ran now and it was late", "see the sun", "it is so good and gut"] * 30
    df = spark.createDataFrame([(n, f"{lines[n % 4]} {plain[n]}.") for n in range(120)], "i int, t string")
    learned = abbreviations.learn_abbreviations(df, "t")
    assert {"dr", "z", "b"} <= set(learned) and not {"there", "late", "left", "so"} & set(learned)
    found = semantic.split_sentences(df.where("i < 2"), "i", "t", learned).orderBy("i", "sentence_no").collect()
    assert [r["sentence"].strip() for r in found] == [
        "We met Dr. Smith there.", "He left.", "the cat sat there.", "Das ist z. B. gut.", "Es ist so.", "a dog ran now and it was late.",
    ]
    assert "".join(r["sentence"] for r in found if r["i"] == 0) == df.first()["t"]
    assert semantic.split_sentences(df.where("i = 0"), "i", "t").count() == 4


# ---------------------------------------------------------------- search


def vectors(spark, matrix, name="id"):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} int, embedding array<float>")


def hit_rows(df):
    return [(r.query_id, r["rank"], r.id, round(r.score, 6)) for r in df.orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("k", [1, 3, 50])
@pytest.mark.parametrize("threshold", [None, 3.0])
def test_search_in_one_and_many_tiles_equals_brute_force(spark, monkeypatch, k, threshold):
    generator = np.random.default_rng(5)
    store = generator.integers(0, 3, (40, 4)).astype(float)  # many exact ties
    queries = generator.integers(0, 3, (7, 4)).astype(float)
    left, right = vectors(spark, store).repartition(5), vectors(spark, queries, "query_id")
    want = []
    for q, query in enumerate(queries):
        scored = sorted((((s - query) ** 2).sum(), i) for i, s in enumerate(store))
        kept = [x for x in scored[:k] if threshold is None or x[0] <= threshold]
        want += [(q, rank, i, round(score, 6)) for rank, (score, i) in enumerate(kept, 1)]
    monkeypatch.setattr(search, "ROW_TILE", 9)
    for rows, size in ((search.PACK_ROWS, search.BROADCAST_BYTES), (2, search.BROADCAST_BYTES), (2, 0), (2, 64)):
        found = search.nearest(
            left, right, k, ["id"], ["query_id"], threshold=threshold, tile_rows=rows, broadcast_bytes=size
        )
        assert hit_rows(found) == want


def test_broadcast_queries_meet_plain_rows(spark):
    generator = np.random.default_rng(8)
    store, queries = generator.integers(0, 3, (60, 4)), generator.integers(0, 3, (9, 4))
    # The first row of each partition, which comes with the queries, has a vector in one of them only.
    gone = {0, 40}
    rows = [(i, None if i in gone else [float(x) for x in v]) for i, v in enumerate(store)]
    left = spark.createDataFrame(rows, "id int, embedding array<float>").coalesce(1).repartitionByRange(3, "id").sortWithinPartitions("id")
    want = []
    for q, query in enumerate(queries):
        scored = sorted((float(((v - query) ** 2).sum()), i) for i, v in enumerate(store) if i not in gone)
        want += [(q, rank, i, score) for rank, (score, i) in enumerate(scored[:3], 1)]
    for batch in (1, 2, 7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            found = search.nearest(left, vectors(spark, queries, "query_id"), 3, ["id"], ["query_id"], tile_rows=2)
            assert hit_rows(found) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    asked = vectors(spark, queries, "query_id")
    rows = search.with_queries(left, search.query_packs(asked, ["query_id"], "embedding", 2)[0], ["id"], "embedding")
    schema = search.hit_schema(left, asked, ["id"], ["query_id"])
    with pytest.raises(Exception, match="queries have to come before"):
        search.best_of_rows(rows.where("pack IS NULL"), schema, 9, 3, None).collect()


def test_equal_vectors_need_little_memory():
    rows, queries = 10_000, 1024
    ids = np.random.default_rng(3).permutation(rows)
    block = pa.table({"id": np.sort(ids)})
    tracemalloc.start()
    best = search.Best(pa.table({"query_id": np.arange(queries)}), np.ones((queries, 4)), 3, None)
    best.add(block, np.ones((rows, 4)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20 and pa.total_allocated_bytes() < 300 << 20
    assert best.rows.num_rows == 3 * queries and set(best.rows["id0"].to_pylist()) == {0, 1, 2}


def test_search_moves_no_text_and_no_vector(spark):
    store = spark.range(100).select("id", F.lit("some text").alias("chunk"), F.array(F.lit(1.0), F.rand(1)).alias("embedding"))
    query = spark.range(3).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"))
    found = search.nearest(store, query, 2, ["id"], ["query_id"])
    assert set(found.columns) == {"query_id", "id", "chunk", "score", "rank"} and found.count() == 6
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"(?:Exchange|Window|Sort) .*", plan)
    assert exchanges and not any("chunk" in x or "embedding" in x for x in exchanges)


def test_a_query_side_beyond_the_bound_is_dealt_to_a_grid(spark):
    store = vectors(spark, np.random.default_rng(1).random((300, 3)))
    queries = vectors(spark, np.random.default_rng(2).random((90, 3)), "query_id")
    plans = {}
    for size in (search.BROADCAST_BYTES, 100):
        found = search.nearest(store, queries, 2, ["id"], ["query_id"], tile_rows=7, broadcast_bytes=size)
        plans[size] = found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() == 180
    assert "strategy=broadcast" in plans[search.BROADCAST_BYTES] and "strategy=shuffle" not in plans[search.BROADCAST_BYTES]
    assert "strategy=broadcast" not in plans[100] and "strategy=merge" in plans[100].replace("shuffle_merge", "merge")


def test_search_skips_missing_vectors_and_checks_dimensions(spark):
    store = spark.createDataFrame([(0, [1.0, 0.0]), (1, None)], "id int, embedding array<float>")
    query = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, embedding array<float>")
    assert hit_rows(search.nearest(store, query, 4, ["id"], ["query_id"])) == [(0, 1, 0, 0.0)]
    assert search.nearest(store, query.limit(0), 4, ["id"], ["query_id"]).count() == 0
    wrong = spark.createDataFrame([(0, [1.0])], "query_id int, embedding array<float>")
    with pytest.raises(Exception, match="expected vectors of 1 dimensions"):
        search.nearest(store, wrong, 4, ["id"], ["query_id"]).collect()
    with pytest.raises(ValueError):
        search.nearest(store, query, 0, ["id"], ["query_id"])


def test_far_from_the_origin_no_precision_is_lost(spark):
    base = np.full((3, 8), 1000.0)
    base[1, 0] += 0.25
    base[2, 0] += 0.5
    found = search.nearest(vectors(spark, base), vectors(spark, base[:1], "query_id"), 3, ["id"], ["query_id"])
    assert hit_rows(found) == [(0, 1, 0, 0.0), (0, 2, 1, 0.0625), (0, 3, 2, 0.25)]


# ---------------------------------------------------------------- statistics and failures


def test_statistics_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "chunk_length int")
    assert tuple(stats.value_statistics(empty, F.col("chunk_length")).first()) == (0, 0, 0.0, 0, 0)
    assert [tuple(r)[1:] for r in stats.size_histogram(empty, F.col("chunk_length")).collect()] == [(0, 0.0)] * 4


def test_histogram_borders(spark):
    df = spark.createDataFrame([(n,) for n in (1, 500, 501, 1000, 1001, 1500, 1501, 9999)], "n int")
    assert [r.chunks for r in stats.size_histogram(df, F.col("n")).collect()] == [2, 2, 2, 2]


def test_comparison_uses_population_deviation(spark):
    sizes = [3, 5, 10, 11]
    df = spark.createDataFrame([(n,) for n in sizes], "chunk_length int")
    row = stats.chunking_comparison({"a": df, "b": df}).where("method = 'a'").first()
    assert np.isclose(row.std_size, np.std(sizes)) and np.isclose(row.cv, np.std(sizes) / np.mean(sizes))


def test_first_non_empty_sample(spark):
    rows = [("f", 1, " "), ("f", 2, " second "), ("f", 3, "third"), ("g", 1, " ")]
    df = spark.createDataFrame(rows, "source string, page int, text string")
    got = {r.file_name: (r.page_count, r.sample_content) for r in stats.file_summary(df, "source", "page", "text").collect()}
    # Blank pages are no documents, so a file without any other is not in the summary but counts as processed.
    assert got == {"f": (2, "second")}
    assert stats.conversion_summary(df, "source", "text").first().files_processed == 2


def test_retry_keeps_the_balance(spark):
    rows = [(f"p{i}", None if i % 3 else ("nested async" if i % 2 else "boom"), ["x"] if i % 3 else []) for i in range(30)] + [("empty", None, [])]
    parsed = spark.createDataFrame(rows, "file_path string, error string, pages array<string>")
    outcomes = failures.outcome(parsed, F.size("pages"))
    good, bad = failures.quarantine(outcomes)
    assert good.count() + bad.count() == 31
    assert bad.where(F.col("error") == failures.NO_CONTENT).count() == 1
    retried = failures.retryable(bad, "nested async").select("file_path", F.array(F.lit("x")).alias("pages")).limit(2)
    merged, left = failures.retry_merge(good, bad, retried)
    assert merged.count() == good.count() + 2 and left.count() == bad.count() - 2


def test_run_statistics_of_only_failures(spark):
    df = spark.createDataFrame([("failed", 0)], "status string, n int")
    row = failures.run_statistics(df, F.col("n")).first()
    assert (row.total_files, row.failed, row.avg_pages_per_success) == (1, 1, None)


def test_head_and_rest_of_a_short_table(spark):
    df = spark.createDataFrame([(1, "x" * 301), (2, "y")], "k int, t string")
    rows = stats.head_and_rest(df, "k", 3, "t").collect()
    assert [(r.head, r.more) for r in rows] == [("x" * 300 + "...", 0), ("y", 0)]
