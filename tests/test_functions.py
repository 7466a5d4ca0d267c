from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pagemill.functions import formats, slabs as slab_module, text as tx, tokens, vectors
from pagemill.operators import chunking
from pagemill.operators.embedding import HashEmbedder
from pagemill.sources import parsing
from pagemill.sources.files import file_type


def values(spark, rows, expression, type_="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_one_decimal_rounds_the_binary_value_like_python(spark):
    numbers = [i / 100 for i in range(0, 2000)] + [0.35, 0.45, 1.25, 2.675, 1e6 + 0.05, -0.04, -1.25, 123456.75]
    assert values(spark, numbers, formats.one_decimal, "double") == [f"{x:.1f}" for x in numbers]


def test_one_decimal_on_random_doubles(spark):
    import random

    generator = random.Random(7)
    numbers = [generator.choice([generator.random() * 10**e, round(generator.random() * 10**e, 2)]) for e in range(8) for _ in range(300)]
    assert values(spark, numbers, formats.one_decimal, "double") == [f"{x:.1f}" for x in numbers]


def test_file_size_steps(spark):
    sizes = [0, 1, 512, 1023, 1024, 1280, 1048576, 5 * 1024**3, 7 * 1024**4, 3000 * 1024**4]
    assert values(spark, sizes, formats.file_size, "bigint") == [
        "0 B", "1.0 B", "512.0 B", "1023.0 B", "1.0 KB", "1.2 KB", "1.0 MB", "5.0 GB", "7.0 TB", "3000.0 TB",
    ]


def test_duration_thresholds(spark):
    seconds = [0.0, 59.9, 60.0, 90.0, 3599.0, 3600.0, 9000.0]
    assert values(spark, seconds, formats.duration, "double") == ["0.0s", "59.9s", "1.0m", "1.5m", "60.0m", "1.0h", "2.5h"]


def test_timestamps(spark):
    moments = [datetime(2024, 5, 6, 7, 8, 9), datetime(2024, 5, 6, 7, 8, 9, 120)]
    assert values(spark, moments, formats.iso_timestamp, "timestamp") == [m.isoformat() for m in moments]
    assert values(spark, moments[:1], formats.compact_timestamp, "timestamp") == ["20240506_070809"]


@pytest.mark.parametrize("blank", ["", " ", " ", "\n\t", " 　", "\x1c", None])
def test_blank_text(spark, blank):
    assert values(spark, [blank, "x"], tx.has_content) == [False, True]


def test_empty_markdown_falls_through(spark):
    df = spark.createDataFrame([("", "t"), (None, "t"), ("m", "t"), (" ", "t")], "md string, text string")
    got = [r[0] for r in df.select(tx.choose_content(F.col("md"), F.col("text"))).collect()]
    assert got == ["t", "t", "m", " "]


def test_previews_differ_in_order(spark):
    text = "#" * 100 + "a" * 100
    assert values(spark, [text], lambda c: tx.preview(c, 150)) == ["a" * 100]
    assert values(spark, [text], lambda c: tx.preview_cut_first(c, 150)) == ["a" * 50]


def test_ascii_safe(spark):
    assert values(spark, ["🚀 go ⚠️ ⚠ éé x"], tx.ascii_safe) == ["[>>] go [WARN] [?] [?] x"]


def test_redaction_shows_nothing_by_default(spark):
    assert values(spark, ["secret-key", "", None], tx.redact) == ["...", None, None]


def test_error_classes(spark):
    errors = ["Invalid API Key given", "Daily QUOTA", "rate Limit", "boom", None]
    assert values(spark, errors, tx.error_class) == ["credentials", "quota", "quota", "other", None]


def test_file_types(spark):
    assert values(spark, ["a/b.PDF", "c.html", "d.txt", "e"], file_type) == ["PDF Document", "HTML Document", None, None]


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab .!?\n\té😀\x0b", max_size=40), min_size=1, max_size=20))
def test_sentences_concatenate_to_the_text(spark, texts):
    got = values(spark, texts, lambda c: F.array_join(tokens.sentences(c), ""))
    assert got == texts


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, b array<float>")
    row = df.select(
        vectors.l2_normalize(F.col("a")).alias("unit"),
        vectors.l2_normalize(F.col("b")).alias("zero"),
        vectors.cosine_distance(F.col("a"), F.col("b")).alias("to_zero"),
        vectors.squared_l2(F.col("a"), F.col("b")).alias("l2"),
    ).first()
    assert row.unit == [0.6, 0.8] and row.zero == [0.0, 0.0] and row.to_zero == 1.0 and row.l2 == 25.0


def test_slabs_are_bounded_and_cover_all_rows(monkeypatch):
    monkeypatch.setattr(slab_module, "SLAB_ROWS", 3)
    monkeypatch.setattr(slab_module, "SLAB_BYTES", 10)
    assert list(slab_module.slabs([])) == []
    assert list(slab_module.slabs([0, 0, 0, 0, 50, 4, 6, 1])) == [(0, 3), (3, 1), (4, 1), (5, 2), (7, 1)]


def test_python_functions_answer_row_by_row_across_slabs(spark):
    n = 1300
    df = spark.range(n, numPartitions=1).select("id", F.concat(F.lit("a b"), F.col("id")).alias("t"))
    chunks = chunking.recursive_chunks(df, "t", 2, 0, [" "]).collect()
    assert sorted((r["id"], r["chunk"]) for r in chunks) == sorted((i, c) for i in range(n) for c in ("a", f"b{i}"))
    found = {r["id"]: r["embedding"] for r in HashEmbedder(8, normalize=False).embed(df, "t").collect()}
    assert len(found) == n and all(sum(v) == 2 for v in found.values())
    alone = HashEmbedder(8, normalize=False).embed(df.where("id in (3, 700, 1299)"), "t").collect()
    assert all(found[r["id"]] == r["embedding"] for r in alone)


def test_pages_of_a_batch_are_not_held_together(spark):
    class Live(str):
        """A text that knows how many like it there are."""
        count = 0

        def __del__(self):
            Live.count -= 1

    def parser(content, path):
        Live.count += 1
        return [{"text": Live(Live.count)}]

    files = spark.range(4000, numPartitions=1).select(
        F.col("id").cast("string").alias("file_path"), F.lit("x").cast("binary").alias("content")
    )
    rows = parsing.parse_files(files, [("p", parser)], F.lit(None).cast("timestamp")).collect()
    assert len({r["file_path"] for r in rows}) == 4000
    assert max(int(r["pages"][0]["text"]) for r in rows) <= 3 * slab_module.SLAB_ROWS
