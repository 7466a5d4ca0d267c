import pytest

LONG = " ".join(f"word{n % 997}" for n in range(60_000))
LINE = "a line that repeats in many documents and is long enough to count"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    texts = [None, "", " \t\n ", LONG, LONG, "short", "x" * 5000, "naïve ünïcode … 中文 text\nÀÉ", LINE]
    rows = [(n, t, None if n % 3 else "en", None if n % 2 else "src", n) for n, t in enumerate(texts)]
    rows += [rows[3], rows[5], (None, "no id here at all", None, None, None), (None, None, None, None, None)]
    rows += [(7, "another text for an id that is there", "en", "src", 1)]
    rows += [(100 + n, f"{LINE}\nown text {n} of document\n{LINE.upper()} ", "fr", "hot", 5) for n in range(8)]
    extra = [(*r, 1, 2, "k", [1], "x", 3, 4, "row") for r in rows]
    names = ["key", "_salt", "input", "words", "doc", "row", "n", "kept"]
    kinds = ["int", "int", "string", "array<int>", "string", "int", "int", "string"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"{a} {b}" for a, b in zip(names, kinds, strict=True)
    )
    return spark.createDataFrame(extra, schema)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
