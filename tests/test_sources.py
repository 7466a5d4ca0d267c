import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.config import ChunkingConfig, EmbeddingConfig, RunConfig
from pagemill.operators.documents import parsed_to_documents
from pagemill.operators.embedding import HashEmbedder, ModelEmbedder
from pagemill.plans.attempts import Round, attempt_summary, run_rounds
from pagemill.plans.ingest import ingest, query_table, search_texts
from pagemill.session import scratch_path, shared_folder, spread, written
from pagemill.sources import files, parsing, store
from pagemill.sources.folder_source import Folder
from pagemill.streaming.folder import arriving_files, parse_arriving

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
    "<h2>Risk &amp; rules</h2><p>First <b>para</b><br>graph.<ul><li>one<li>two</ul>"
    "<script>var x = '</p>';</script><!-- no --><img src='a.png'>tail</body></html>"
)


@pytest.fixture
def folder(tmp_path):
    docs = tmp_path / "docs"
    (docs / "sub").mkdir(parents=True)
    (docs / "b.HTML").write_text(PAGE)
    (docs / "a.html").write_text("<p>plain words about risk</p>")
    (docs / "empty.html").write_text("<html><body> </body></html>")
    (docs / "note.txt").write_text("text")
    (docs / "latin.htm").write_bytes(b"<p>caf\xe9</p>")
    (docs / "sub" / "c.html").write_text(PAGE)
    return docs


def test_discovery(spark, folder):
    listing = files.file_listing(files.discover_files(spark, str(folder), [".html"])).orderBy("file_no").collect()
    assert [(r.file_no, r.file_name) for r in listing] == [(1, "a.html"), (2, "b.HTML"), (3, "empty.html")]
    assert listing[0].size_bytes == 29 and listing[0].size_text == "29.0 B"


def test_missing_folder_is_empty(spark, tmp_path):
    assert files.discover_files(spark, str(tmp_path / "none")).count() == 0
    assert files.load_contents(spark, str(tmp_path / "none"), [".pdf"]).count() == 0


def test_discovery_never_reads_content(spark, folder):
    plan = files.discover_files(spark, str(folder), [".html"])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_text_source(spark, folder):
    row = files.load_text(spark, str(folder / "note.txt")).first()
    assert row.page_content == "text" and row.source.endswith("/note.txt")


def test_bytes_that_are_not_utf8(spark, folder):
    row = files.load_contents(spark, str(folder), [".htm"]).first()
    assert bytes(row.content) == b"<p>caf\xe9</p>"
    assert parsing.layout_parser(bytes(row.content))[0]["text"] == "caf\ufffd"


def test_no_file_is_left_out(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for name, content in (("a.html", "<p>a</p>"), ("zero.html", ""), ("_x.html", "<p>x</p>"), (".y.html", "<p>y</p>"), ("_z.html", "")):
        (docs / name).write_text(content)
    listed = {r.path.rsplit("/", 1)[1]: r.size_bytes for r in files.discover_files(spark, str(docs), [".html"]).collect()}
    assert listed == {"a.html": 8, "zero.html": 0, "_x.html": 8, ".y.html": 8, "_z.html": 0}
    loaded = {r.file_path.rsplit("/", 1)[1]: bytes(r.content) for r in files.load_contents(spark, str(docs), [".html"]).collect()}
    assert {k: len(v) for k, v in loaded.items()} == listed and loaded["_x.html"] == b"<p>x</p>"
    run = ingest(spark, RunConfig(docs_folder=str(docs), output_folder=str(tmp_path / "out"), test_retrieval=False))
    stats = store.load_config(spark, run.paths["config"])["processing_stats"]
    assert (stats["total_files"], stats["successful"], stats["failed"]) == (5, 3, 2)
    failed = {r.file_path.rsplit("/", 1)[1]: r.error for r in spark.read.parquet(run.paths["failed_files"]).collect()}
    assert failed == {"zero.html": "No content extracted", "_z.html": "No content extracted"}
    out = str(tmp_path / "stream")
    parse_arriving(spark, str(docs), out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).groupBy("status").count().orderBy("status").collect() == [("failed", 2), ("ok", 3)]


def test_batch_and_stream_agree_on_a_hundred_thousand_names(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    sizes = {}
    for n in range(100_000):
        name = f"{'_.'[n % 2] if n % 10 == 0 else ''}f{n}.{'html' if n % 4 else 'TXT'}"
        sizes[name] = n % 7
        (docs / name).write_bytes(b"x" * (n % 7))
    wanted = {k: v for k, v in sizes.items() if k.endswith(".html")}
    listed = files.discover_files(spark, str(docs), [".html"]).collect()
    assert len(listed) == len(wanted) and {r.path.rsplit("/", 1)[1]: r.size_bytes for r in listed} == wanted
    out, seen = str(tmp_path / "out"), []
    for _ in range(2):
        query = (
            arriving_files(spark, str(docs), [".html"]).select("file_path", F.octet_length("content").alias("n"))
            .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start(out)
        )
        query.awaitTermination()
        found = {r.file_path.rsplit("/", 1)[1]: r.n for r in spark.read.parquet(out).collect()}
        seen.append(spark.read.parquet(out).count())
        if len(seen) == 1:
            assert found == wanted
            (docs / "moved.html").write_text("later")
    assert seen == [len(wanted), len(wanted) + 1] and found["moved.html"] == 5


def test_only_the_wanted_files_are_read(spark, folder):
    (folder / "locked.html").symlink_to(folder / "nowhere")
    only = spark.createDataFrame([(f"file:{folder}/a.html",), (f"file:{folder}/gone.html",)], "file_path string")
    assert [r.file_path.rsplit("/", 1)[1] for r in files.load_contents(spark, str(folder), [".html"], only).collect()] == ["a.html"]
    missing = spark.createDataFrame([(f"file:{folder}/gone.html", 5)], "path string, size_bytes bigint")
    assert [r.content for r in files.read_files(missing).collect()] == [None]


def test_a_store_that_tasks_cannot_open_is_listed_by_spark(spark, folder):
    assert not Folder.can_open("viewfs://store/in") and Folder.can_open("s3a://bucket/in") and Folder.can_open("/tmp/x")
    with pytest.raises(ValueError):
        Folder("viewfs://store/in")
    visible = files._visible(spark, str(folder), [".html"]).select("path").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in visible) == ["a.html", "b.HTML", "empty.html"]


def test_binary_parser_reads_bytes(spark, tmp_path):
    def pages(content, path):
        if not content.startswith(b"%FAKE\xe2\xe3"):
            raise ValueError(f"no such format: {path.rsplit('/', 1)[1]}")
        return [{"md": part.decode("latin-1")} for part in content[7:].split(b"\x00")]

    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.pdf").write_bytes(b"%FAKE\xe2\xe3one\x00two \xe9\x00 ")
    (docs / "b.PDF").write_bytes(b"other")
    config = RunConfig(docs_folder=str(docs), output_folder=str(tmp_path / "out"), file_suffixes=(".pdf",), test_retrieval=False)
    run = ingest(spark, config, [("fake", pages)])
    found = spark.read.parquet(run.paths["documents"]).orderBy("page").collect()
    assert [(d.page_content, d.page, d.total_pages, d.parser, d.result_type) for d in found] == [
        ("one", 1, 3, "fake", "markdown"), ("two é", 2, 3, "fake", "markdown"),
    ]
    assert spark.read.parquet(run.paths["failed_files"]).first().error == "fake: no such format: b.PDF"


def test_failures_are_tried_again_in_the_run(spark, tmp_path):
    def first(content, path):
        if b"later" in content:
            raise RuntimeError("nested async")
        if b"never" in content:
            raise RuntimeError("quota exceeded")
        return parsing.layout_parser(content)

    docs = tmp_path / "docs"
    docs.mkdir()
    for name in ("now", "later", "never"):
        (docs / f"{name}.html").write_text(f"<p>{name}</p>")
    config = RunConfig(docs_folder=str(docs), output_folder=str(tmp_path / "out"), test_retrieval=False)
    run = ingest(spark, config, [("first", first)], retry_parsers=[("second", parsing.text_parser)], retry_marker="nested async")
    stats = store.load_config(spark, run.paths["config"])["processing_stats"]
    assert (stats["total_files"], stats["successful"], stats["failed"], stats["total_pages"]) == (3, 2, 1, 2)
    assert 0 < stats["processing_time"] <= stats["total_time"]
    assert [r.error for r in spark.read.parquet(run.paths["failed_files"]).collect()] == ["first: quota exceeded"]
    kinds = {r.parser: r.result_type for r in spark.read.parquet(run.paths["documents"]).collect()}
    assert kinds == {"first": "markdown", "second": "text"}


def test_parsers_that_hang_or_crash_cost_one_file(spark, tmp_path):
    def parser(content, path):
        if b"hang" in content:
            while True:
                pass
        if b"crash" in content:
            os._exit(3)
        if b"raise" in content:
            raise ValueError("cannot read")
        return parsing.layout_parser(content)

    rows = [(f"d/{n}", f"<p>{n}</p>".encode()) for n in ("a", "hang", "b", "crash", "c", "raise", "hang2", "d")]
    df = spark.createDataFrame(rows, "file_path string, content binary").coalesce(1)
    parsed = written(parsing.parse_files(df, [("p", parser)], F.current_timestamp(), seconds_per_file=0.7), "parsed")
    got = {r.file_name: r.error or r.status for r in parsed.collect()}
    slow, gone = "took more than 0.7 s", "the parser's process ended"
    assert got == {"a": "ok", "b": "ok", "c": "ok", "d": "ok", "hang": slow, "hang2": slow, "crash": gone, "raise": "p: cannot read"}


def test_rounds_read_only_what_still_fails(spark, tmp_path):
    def picky(word):
        def run(content, path):
            if word in content:
                raise RuntimeError("busy")
            return parsing.layout_parser(content)

        return run

    contents = {f"d/{n}": f"<p>{n}</p>".encode() for n in ("x", "one", "onetwo", "onetwothree")}
    asked = []

    def load(only):
        names = sorted(contents) if only is None else sorted(r.file_path for r in only.collect())
        asked.append(names)
        return spark.createDataFrame([(n, contents[n]) for n in names], "file_path string, content binary")

    rounds = [Round([("a", picky(b"one"))]), Round([("b", picky(b"two"))], "busy"), Round([("c", picky(b"three"))], "busy"), Round([("d", picky(b"three"))], "other")]
    found = run_rounds(load, rounds, str(tmp_path / "attempts"), F.current_timestamp())
    assert asked == [["d/one", "d/onetwo", "d/onetwothree", "d/x"], ["d/one", "d/onetwo", "d/onetwothree"], ["d/onetwo", "d/onetwothree"]]
    summary = {r["round"]: (r.attempted, r.parsed, r.failed) for r in attempt_summary(found.ledger).collect()}
    assert summary == {1: (4, 1, 3), 2: (3, 1, 2), 3: (2, 1, 1)}
    last = {r.file_name: (r.status, r.loader_used, r.error) for r in found.outcomes.collect()}
    assert last == {"x": ("ok", "a", None), "one": ("ok", "b", None), "onetwo": ("ok", "c", None), "onetwothree": ("failed", None, "c: busy")}
    assert spark.read.parquet(str(tmp_path / "attempts")).count() == 9


def test_store_describes_the_embedder_that_ran(spark, folder, tmp_path):
    model = ModelEmbedder(lambda: lambda texts: np.ones((len(texts), 8)), dim=8, name="tiny-model")
    config = RunConfig(docs_folder=str(folder), output_folder=str(tmp_path / "out"), test_retrieval=False)
    run = ingest(spark, config, embedder=model)
    found = store.describe_vector_store(spark, run.paths["vector_store"]).first()
    chunks = spark.read.parquet(run.paths["chunks"]).count()
    assert tuple(found)[:7] == ("tiny-model", 8, True, 1500, 300, chunks, 1)
    assert store.load_config(spark, run.paths["config"])["config"]["embedding"]["model_name"] == "tiny-model"
    with pytest.raises(ValueError):
        store.load_vector_store(spark, run.paths["vector_store"], HashEmbedder())
    wrong = str(tmp_path / "wrong")
    store.save_vector_store(spark.createDataFrame([(1, [1.0, 2.0])], "id int, embedding array<float>"), wrong, HashEmbedder(8), key="id")
    with pytest.raises(ValueError, match="dimensions"):
        store.load_vector_store(spark, wrong, HashEmbedder(8))


def test_layout_parser():
    [page] = parsing.layout_parser(PAGE.encode())
    assert [(b["kind"], b["level"], b["text"]) for b in page["layout"]] == [
        ("heading", 2, "Risk & rules"),
        ("paragraph", 0, "First para graph."),
        ("list_item", 0, "one"),
        ("list_item", 0, "two"),
        ("paragraph", 0, "tail"),
    ]
    assert page["md"].startswith("## Risk & rules\n\nFirst") and "- two" in page["md"]
    assert page["images"] == ["a.png"]


def test_tables_become_grids():
    html = b"""<p>before<table><tr><th>h1<th rowspan=2>h2</tr><tr><td>a<br>b</td></tr><tr><td colspan=3>wide</tr>
      <tr><td rowspan=0>down<td><table><tr><td>in</td><td>side</table><td>z</tr><tr><td>1</table>after
      <table><tr><td> </table><table></table><table><td>open"""
    [page] = parsing.layout_parser(html)
    first, second = json.loads(page["structured_data"])
    assert first == {"header": True, "rows": [["h1", "h2", ""], ["a b", "h2", ""], ["wide"] * 3, ["down", "in side", "z"], ["down", "1", ""]]}
    assert second == {"header": False, "rows": [["open"]]}
    assert [b["kind"] for b in page["layout"]] == ["paragraph", "table", "paragraph", "table"]
    assert page["md"].split("\n\n")[1].startswith("| h1 | h2 |  |\n| --- | --- | --- |\n| a b | h2 |  |")
    assert parsing.layout_parser(b"<p>no table")[0]["structured_data"] is None


def test_head_without_end_tag():
    [page] = parsing.layout_parser(b"<head><title>t</title><body><p>seen")
    assert page["text"] == "seen"


def test_fallback_and_failure_capture(spark):
    def picky(content, path):
        if b"bad" in content:
            raise ValueError("cannot read")
        return parsing.layout_parser(content)

    def hopeless(content, path):
        if b"worse" in content:
            raise RuntimeError("gave up")
        return parsing.text_parser(content)

    rows = [("d/ok", b"<p>fine</p>"), ("d/f", b"<p>bad</p>"), ("d/w", b"bad worse"), ("d/e", b""), ("d/n", None)]
    df = spark.createDataFrame(rows, "file_path string, content binary")
    parsed = parsing.parse_files(df, [("picky", picky), ("simple", hopeless)], F.lit("2024-01-02 03:04:05").cast("timestamp"))
    got = {r.file_name: (r.status, r.loader_used, r.error) for r in parsed.collect()}
    assert got["ok"] == ("ok", "picky", None)
    assert got["f"] == ("ok", "simple", None)
    assert got["w"] == ("failed", None, "picky: cannot read; simple: gave up")
    assert got["e"] == ("failed", None, "No content extracted")
    assert got["n"][0] == "failed" and got["n"][2]
    documents = parsed_to_documents(parsed.where("status = 'ok'")).orderBy("source_file").collect()
    assert [(d.page, d.total_pages, d.has_layout, d.processed_at) for d in documents] == [
        (1, 1, None, "2024-01-02T03:04:05"), (1, 1, True, "2024-01-02T03:04:05"),
    ]


def test_store_refuses_another_embedder(spark, tmp_path):
    path = str(tmp_path / "store")
    vectors = HashEmbedder(8).embed(spark.createDataFrame([("1", "a b")], "chunk_id string, chunk string"), "chunk")
    store.save_vector_store(vectors, path, EmbeddingConfig(dim=8))
    assert store.load_vector_store(spark, path, EmbeddingConfig(dim=8)).first() == vectors.first()
    with pytest.raises(ValueError):
        store.load_vector_store(spark, path, EmbeddingConfig(dim=16))


def test_a_killed_save_leaves_the_old_version(spark, tmp_path):
    path, embedding = str(tmp_path / "store"), EmbeddingConfig(dim=2)
    rows = lambda ids, x: spark.createDataFrame([(f"c{i}", [float(i), x]) for i in ids], "chunk_id string, embedding array<float>")
    seen = lambda **version: {r.chunk_id: r.embedding[1] for r in store.load_vector_store(spark, path, embedding, **version).collect()}
    assert store.save_vector_store(rows(range(200), 1.0), path, embedding) == 1
    broken = rows(range(200), 2.0).withColumn("chunk_id", F.expr("if(chunk_id = 'c150', raise_error('killed'), chunk_id)"))
    for save in (store.save_vector_store, store.upsert_vectors):
        with pytest.raises(Exception, match="killed"):
            save(broken, path, embedding)
        assert set(seen().values()) == {1.0} and len(seen()) == 200
    # As if the process ended after the rows and before the manifest.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(store, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            store.upsert_vectors(rows(range(5), 3.0), path, embedding)
    assert set(seen().values()) == {1.0}
    assert store.upsert_vectors(rows([7, 500], 4.0), path, embedding) == 2
    assert seen() == {f"c{i}": 4.0 if i in (7, 500) else 1.0 for i in [*range(200), 500]}
    assert len(seen(version=1)) == 200 and store.describe_vector_store(spark, path).first()["total_chunks"] == 201
    folders = set(store.describe_vector_store(spark, path).first()["folders"].values())
    assert len(folders) == 2 and len(store.drop_unused(spark, path)) == 1 and len(seen()) == 201
    assert store.save_vector_store(rows([1], 5.0), path, embedding) == 3 and seen() == {"c1": 5.0}
    with pytest.raises(ValueError, match="differ"):
        store.upsert_vectors(rows([1], 5.0).withColumn("more", F.lit(1)), path, embedding)


def test_an_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    path, embedding = str(tmp_path / "store"), EmbeddingConfig(dim=2)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("chunk_id"), F.array(F.lit(0.0), F.lit(1.0)).alias("embedding"))
    store.save_vector_store(rows, path, embedding)
    store.upsert_vectors(rows.where("chunk_id in ('3', '5')"), path, embedding)
    found = store.describe_vector_store(spark, path).first()
    assert sum(f.startswith("2-") for f in found["folders"].values()) == 2 and found["total_chunks"] == 1000


def test_shared_folder_is_the_sessions(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_spread_leaves_large_scans_alone(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread(many) is many
    assert spread(spark.range(0, 100, 1, 2)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("method", ["recursive", "semantic", "structure"])
def test_complete_run(spark, folder, tmp_path, method):
    config = RunConfig(
        docs_folder=str(folder),
        output_folder=str(tmp_path / "out"),
        chunking=ChunkingConfig(chunk_size=20, chunk_overlap=5, use_semantic_chunking=method == "semantic", use_structure=method == "structure"),
        test_queries=("risk rules", "plain words"),
    )
    run = ingest(spark, config)
    assert run.completed
    table = {name: lambda n=name: spark.read.parquet(run.paths[n]) for name in run.paths}
    assert table["documents"]().count() == 2
    assert [r.error for r in table["failed_files"]().collect()] == ["No content extracted"]
    chunks = table["chunks"]()
    assert chunks.count() == chunks.select("chunk_id").distinct().count() > 2 - (method == "semantic")
    assert {r.chunking_method for r in chunks.collect()} == {method}
    hits = table["hits"]().where("rank = 1").orderBy("query_id").collect()
    assert [h.source for h in hits] == ["b.HTML", "a.html"]
    saved = store.load_config(spark, run.paths["config"])
    assert saved["config"]["chunking"]["chunk_size"] == 20
    assert saved["processing_stats"]["total_files"] == 3 and saved["processing_stats"]["failed"] == 1
    report = "\n".join(r.value for r in spark.read.text(run.paths["report"]).collect())
    assert "- a.html (1 pages)" in report and "- empty.html: No content extracted" in report
    assert "- **Files Processed**: 2/3" in report and "Chunk Size**: 20" in report
    assert "- **Parser**: layout, text" in report and "- **chunking.chunk_overlap**: 5" in report
    vectors = store.load_vector_store(spark, run.paths["vector_store"], config.embedding)
    found = search_texts(vectors, query_table(spark, ["plain words"]), HashEmbedder(), k=1)
    assert found.first().file_name == "a.html"


def test_run_stops_where_nothing_is_left(spark, tmp_path):
    empty = tmp_path / "docs"
    empty.mkdir()
    config = RunConfig(docs_folder=str(empty), output_folder=str(tmp_path / "out"))
    assert ingest(spark, config).stopped_at == "discover"
    (empty / "x.html").write_text(" ")
    assert ingest(spark, config).stopped_at == "parse"


def test_stream_parses_only_new_files(spark, tmp_path):
    docs, out, checkpoint = tmp_path / "docs", str(tmp_path / "out"), str(tmp_path / "cp")
    docs.mkdir()
    for n in (1, 2):
        (docs / f"f{n}.html").write_text(f"<p>page {n}</p>")
        parse_arriving(spark, str(docs), out, checkpoint).awaitTermination()
        names = [r.file_name for r in spark.read.parquet(out).orderBy("file_name").collect()]
        assert names == [f"f{i}.html" for i in range(1, n + 1)]


def test_redacted_config_has_no_secret_fields():
    assert not [k for k in str(RunConfig().to_dict()).split("'") if "api_key" in k or "token_secret" in k]
