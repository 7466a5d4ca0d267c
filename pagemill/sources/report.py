"""The markdown report of a run as an ordered table of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.config import RunConfig

# Fixed value: the kind of vector store that a run writes.
STORE_KIND = "Parquet, exact search"


def settings(config: RunConfig) -> list[tuple[str, str]]:
    """All configuration values by dotted name."""
    def flat(prefix: str, values: dict) -> list[tuple[str, str]]:
        found = []
        for name, value in values.items():
            found += flat(f"{prefix}{name}.", value) if isinstance(value, dict) else [(prefix + name, repr(value))]
        return found

    return flat("", config.to_dict())


def report_lines(
    summary: DataFrame,
    outcomes: DataFrame,
    config: RunConfig,
    session: str,
    generated: str,
    parser: str = "layout, text",
) -> DataFrame:
    """``(section, sort_key, line_no, line)``; order by the first three to read it.

    ``summary`` is the one row of :func:`run_summary`; ``outcomes`` the parse results.
    File lines are a distributed table and never gathered.
    """

    def item(label: str, value: Column | str | int) -> Column:
        shown = value.cast("string") if isinstance(value, Column) else F.lit(str(value))
        return F.concat(F.lit(f"- **{label}**: "), shown)

    def total(name: str) -> Column:
        return F.format_number(name, 0)

    files = F.concat_ws("/", F.col("successful"), F.col("successful") + F.col("failed"))
    seconds = F.concat(F.format_string("%.2f", "processing_time"), F.lit(" seconds"))
    # The labels of the report.
    sections = {
        0: [
            F.lit("# Processing Report"),
            F.lit(f"Generated: {generated}"),
            F.lit("## Summary"),
            item("Session ID", session),
            item("Files Processed", files),
            item("Total Pages", total("total_pages")),
            item("Documents Created", total("documents")),
            item("Chunks Generated", total("chunks")),
            item("Processing Time", seconds),
        ],
        1: [F.when(F.col("successful") > 0, F.lit("## Successfully Processed Files"))],
        2: [F.when(F.col("failed") > 0, F.lit("## Failed Files"))],
        3: [
            F.lit("## Configuration"),
            item("Parser", parser),
            item("Chunking", F.concat(F.col("chunks").cast("string"), F.lit(" chunks"))),
            item("Embeddings", config.embedding.model_name),
            item("Vector Store", STORE_KIND),
            item("Chunk Size", f"{config.chunking.chunk_size} characters"),
            item("Chunk Overlap", f"{config.chunking.chunk_overlap} characters"),
        ],
        4: [F.lit("## Pipeline Configuration"), *[item(name, value) for name, value in settings(config)]],
    }
    fixed = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit("").alias("sort_key"),
            F.lit(number).alias("line_no"),
            line.alias("line"),
        )
        for section, lines in sections.items()
        for number, line in enumerate(lines)
    ]
    name, good = F.col("file_name"), F.col("status") == "ok"
    pages = F.concat(F.lit(" ("), F.col("n_pages").cast("string"), F.lit(" pages)"))
    per_file = outcomes.select(
        F.when(good, F.lit(1)).otherwise(F.lit(2)).alias("section"),
        F.col("file_path").alias("sort_key"),
        F.lit(1).alias("line_no"),
        F.concat(
            F.lit("- "), name, F.when(good, pages).otherwise(F.concat(F.lit(": "), F.col("error")))
        ).alias("line"),
    )
    return summary.select(F.inline(F.array(*fixed))).where("line IS NOT NULL").unionByName(per_file)


def save_report(lines: DataFrame, path: str) -> None:
    """Part files that, read in name order, are the report."""
    ordered = lines.orderBy("section", "sort_key", "line_no")
    ordered.select("line").write.mode("overwrite").text(path)
