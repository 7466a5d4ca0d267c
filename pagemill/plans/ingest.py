"""The complete run: discover, parse, convert, chunk, embed, search, save.

Every stage is a DataFrame function; the run writes each stage's table once and goes on
from the written table, so no stage is computed twice and a lost executor costs at most
one stage's tasks. A stage without rows ends the run.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.config import ChunkingConfig, EmbeddingConfig, RunConfig
from pagemill.operators import chunking, documents, failures, search, semantic, stats
from pagemill.operators.embedding import Embedder, HashEmbedder, ModelEmbedder
from pagemill.plans.attempts import Round, run_rounds
from pagemill.session import written
from pagemill.sources import files, parsing, report, store

CHUNK_KEY = "chunk_id"
PARSED_LIST = ("file_path", "file_name", "n_pages", "loader_used")


@dataclass
class RunResult:
    session_id: str
    completed: bool = False
    stopped_at: str | None = None
    paths: dict[str, str] = field(default_factory=dict)


def chunk_documents(
    df: DataFrame, text: str, key: str, config: ChunkingConfig, model: ModelEmbedder | None = None
) -> DataFrame:
    """Chunk with the method the configuration asks for.

    Structure chunks need the column ``layout``; documents without blocks are one block, their text.
    """
    if config.use_semantic_chunking:
        return semantic.semantic_chunks(df.drop("layout"), key, text, config, model)
    if config.use_structure:
        plain = F.array(F.struct(F.lit("paragraph").alias("kind"), F.lit(0).alias("level"), F.col(text).alias("text")))
        blocks = F.when(F.size("layout") > 0, F.col("layout")).otherwise(plain)
        listed = df.withColumn("layout", blocks).drop(text)
        chunks = chunking.structure_chunks(listed, "layout", config.chunk_size)
        method = "structure"
    else:
        chunks = chunking.recursive_chunks(
            df.drop("layout"), text, config.chunk_size, config.chunk_overlap, config.separators, config.keep_separator
        )
        method = "recursive"
    return chunking.with_chunk_id(chunks, key).withColumn("chunking_method", F.lit(method))


def retry_failed(
    outcomes: DataFrame,
    load: Callable[[DataFrame], DataFrame],
    parsers: Sequence[tuple[str, parsing.Parser]],
    marker: str,
    processed_at: Column,
) -> tuple[DataFrame, DataFrame]:
    """Parse the failures whose error holds ``marker`` again; those that succeed replace their outcome.

    Returns all outcomes, and the outcomes of the second attempt; a file that fails again keeps its first
    error. ``outcomes`` should be a written table; ``load`` gives the contents of the files in a table of ``file_path``.
    """
    failed = failures.retryable(outcomes.where("status = 'failed'"), marker).select("file_path")
    again = written(parsing.parse_files(load(failed), parsers, processed_at), "retried")
    results, still_failed = failures.retry_merge(
        outcomes.where("status = 'ok'"), outcomes.where("status = 'failed'"), again.where("status = 'ok'")
    )
    return results.unionByName(still_failed), again


def search_texts(
    vectors: DataFrame,
    queries: DataFrame,
    embedder: Embedder,
    k: int = 4,
    threshold: float | None = None,
) -> DataFrame:
    """Hits for a table ``(query_id, query)`` of question texts."""
    embedded = embedder.embed(queries, "query")
    return search.nearest(vectors, embedded, k, [CHUNK_KEY], ["query_id"], threshold=threshold)


def query_table(spark: SparkSession, texts: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts, 1)), "query_id int, query string")


def ingest(
    spark: SparkSession,
    config: RunConfig,
    parsers: Sequence[tuple[str, parsing.Parser]] = tuple(parsing.HTML_PARSERS),
    embedder: Embedder | None = None,
    retry_parsers: Sequence[tuple[str, parsing.Parser]] = (),
    retry_marker: str = "",
    seconds_per_file: float | None = None,
    more_rounds: Sequence[Round] = (),
) -> RunResult:
    """Run all stages. Failures whose error holds ``retry_marker`` are parsed again with ``retry_parsers``.

    ``more_rounds`` follow; a parser that takes more than ``seconds_per_file`` has failed.
    """
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    # A model given by the caller also finds the semantic breaks.
    model = embedder if isinstance(embedder, ModelEmbedder) else None
    embedder = embedder or HashEmbedder(config.embedding.dim, config.embedding.normalize)
    # What is saved and reported is the embedder that ran.
    embedding = EmbeddingConfig(embedder.name, embedder.dim, embedder.normalize)
    config = replace(config, embedding=embedding)
    run = RunResult(f"session_{started:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}")
    folder = f"{config.output_folder.rstrip('/')}/{run.session_id}"

    def saved(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        store.save_table(df, path)
        run.paths[name] = path
        return store.load_table(spark, path)

    def stop(stage: str) -> RunResult:
        run.stopped_at = stage
        return run

    if files.discover_files(spark, config.docs_folder, config.file_suffixes).isEmpty():
        return stop("discover")
    began = time.perf_counter()
    rounds = [Round(parsers, seconds_per_file=seconds_per_file)]
    if retry_parsers:
        rounds.append(Round(retry_parsers, retry_marker, seconds_per_file))
    rounds += more_rounds
    run.paths["attempts"] = f"{folder}/attempts"
    attempts = run_rounds(
        lambda only: files.load_contents(spark, config.docs_folder, config.file_suffixes, only),
        rounds, run.paths["attempts"], F.lit(started),
    )
    outcomes = saved("parsed", attempts.outcomes.drop("round"))
    parse_seconds = time.perf_counter() - began
    good = outcomes.where("status = 'ok'")
    if good.isEmpty():
        return stop("parse")
    docs = saved("documents", documents.parsed_to_documents(good))
    if docs.isEmpty():
        return stop("convert")
    chunks = saved(
        "chunks",
        chunk_documents(docs, "page_content", "document_key", config.chunking, model),
    )
    if chunks.isEmpty():
        return stop("chunk")

    run.paths["vector_store"] = f"{folder}/{config.store_name}"
    store.save_vector_store(
        embedder.embed(chunks, "chunk"), run.paths["vector_store"], embedder, config.chunking
    )
    vectors = store.load_vector_store(spark, run.paths["vector_store"], embedder)

    if config.test_retrieval:
        hits = search_texts(vectors, query_table(spark, config.test_queries), embedder, config.k)
        saved("hits", search.hit_display(hits, ["query_id"], "chunk"))

    seconds = (datetime.now(timezone.utc).replace(tzinfo=None) - started).total_seconds()
    # The time of the parse stage, retries included, is what files are averaged over.
    statistics = failures.run_statistics(outcomes, F.col("n_pages")).withColumns(
        {"processing_time": F.lit(parse_seconds), "total_time": F.lit(seconds)}
    )
    statistics = statistics.withColumn(
        "avg_time_per_success", F.try_divide("processing_time", "successful")
    )
    if config.save_results:
        saved("files_processed", good.select(*PARSED_LIST))
        saved("failed_files", failures.quarantine(outcomes)[1])
        run.paths["config"] = f"{folder}/config"
        row = store.config_row(config, run.session_id, started.isoformat(), statistics)
        store.save_config(row, run.paths["config"])
    if config.create_report:
        summary = stats.run_summary(statistics, docs, chunks, embedding.dim)
        run.paths["report"] = f"{folder}/report"
        lines = report.report_lines(
            summary, outcomes, config, run.session_id, f"{started:%Y-%m-%d %H:%M:%S}",
            ", ".join(name for each in rounds for name, _ in each.parsers),
        )
        report.save_report(lines, run.paths["report"])
    run.completed = True
    return run
