"""Statistics, histograms and summaries. Every grouping is pre-aggregated on the map
side, so a file holding most of the rows costs no more than any other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.functions.text import basename, has_content, head, sample

# The size classes of the chunk histogram.
SIZE_CLASSES = ["Small (0-500)", "Medium (501-1000)", "Large (1001-1500)", "Extra Large (1500+)"]


def value_statistics(df: DataFrame, value: Column) -> DataFrame:
    """Count, sum, mean, min and max; all zero for an empty input."""
    return df.agg(
        F.count(value).alias("count"),
        F.coalesce(F.sum(value), F.lit(0)).alias("sum"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.min(value), F.lit(0)).alias("min"),
        F.coalesce(F.max(value), F.lit(0)).alias("max"),
    )


def size_histogram(df: DataFrame, length: Column) -> DataFrame:
    """Count and percentage per size class in one pass; empty classes are shown."""
    conditions = [
        length <= 500,
        (length > 500) & (length <= 1000),
        (length > 1000) & (length <= 1500),
        length > 1500,
    ]
    counts = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions)])
    total = sum((F.col(f"c{i}") for i in range(1, 4)), F.col("c0"))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("size_class"),
                F.col(f"c{i}").alias("chunks"),
                F.coalesce(F.try_divide(F.col(f"c{i}") * 100.0, total), F.lit(0.0)).alias("percent"),
            )
            for i, name in enumerate(SIZE_CLASSES)
        ]
    )
    return counts.select(F.inline(rows))


def expansion(chunks: DataFrame, document_key: str) -> DataFrame:
    return chunks.agg(
        F.count(F.lit(1)).alias("chunks"), F.count_distinct(document_key).alias("documents")
    ).withColumn("expansion_ratio", F.try_divide("chunks", "documents"))


def file_summary(pages: DataFrame, file: str, order_by: str, content: str, length: int = 200) -> DataFrame:
    """Pages, characters and the first non-empty sample of each file, from its non-blank pages.

    The order of the pages is enough: none is numbered, and only lengths and samples are shuffled.
    """
    text = sample(F.col(content), length)
    short = pages.where(has_content(F.col(content))).select(
        basename(F.col(file)).alias("file_name"), order_by, F.length(content).alias("chars"), text.alias("text")
    )
    seen = F.col("text") != ""
    return short.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("page_count"),
        F.sum("chars").alias("total_chars"),
        F.coalesce(F.min_by(F.when(seen, F.col("text")), F.when(seen, F.col(order_by))), F.lit("")).alias(
            "sample_content"
        ),
    )


def file_summary_by_loader(pages: DataFrame, file: str, order_by: str, content: str) -> DataFrame:
    """Documents, characters, whole-number mean, and loader and sample of the first page."""
    line = F.replace(sample(F.col(content), 150), F.lit("\n"), F.lit(" "))
    short = pages.where(has_content(F.col(content))).select(
        basename(F.col(file)).alias("file_name"), order_by, F.length(content).alias("chars"),
        F.struct("loader_used", line.alias("s")).alias("page"),
    )
    grouped = short.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("chars").alias("total_chars"),
        F.min_by("page", order_by).alias("_first"),
    )
    return grouped.select(
        "file_name",
        "documents",
        "total_chars",
        F.floor(F.col("total_chars") / F.col("documents")).alias("avg_chars"),
        F.coalesce(F.col("_first.loader_used"), F.lit("Unknown")).alias("loader_used"),
        F.col("_first.s").alias("sample"),
    )


def loader_usage(documents: DataFrame) -> DataFrame:
    loader = F.coalesce(F.col("loader_used"), F.lit("Unknown"))
    return documents.groupBy(loader.alias("loader_used")).agg(F.count(F.lit(1)).alias("documents"))


def conversion_summary(pages: DataFrame, file: str, content: str) -> DataFrame:
    """Files, and documents made of their non-blank pages. A file with only blank pages was processed too."""
    length = F.when(has_content(F.col(content)), F.length(content))
    return pages.select(F.col(file).alias("file"), length.alias("length")).agg(
        F.count_distinct("file").alias("files_processed"),
        F.count("length").alias("total_documents"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_content_length"),
        F.coalesce(F.avg("length"), F.lit(0.0)).alias("avg_content_length"),
    )


def chunking_comparison(methods: dict[str, DataFrame]) -> DataFrame:
    """Size statistics of several chunkings side by side (population deviation)."""
    tagged = [
        df.select(F.lit(name).alias("method"), F.col("chunk_length").cast("bigint").alias("n"))
        for name, df in methods.items()
    ]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.union(other)
    sums = rows.groupBy("method").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum("n").alias("_s"),
        F.sum(F.col("n") * F.col("n")).alias("_q"),
        F.min("n").alias("min_size"),
        F.max("n").alias("max_size"),
    )
    mean = F.col("_s") / F.col("chunks")
    # Whole-number sums give the same variance whatever order the rows arrive in.
    chunks, total = F.col("chunks").cast("decimal(38,0)"), F.col("_s").cast("decimal(38,0)")
    spread = chunks * F.col("_q") - total * F.col("_s")
    return sums.select(
        "method",
        "chunks",
        mean.alias("mean_size"),
        (F.sqrt(spread.cast("double")) / F.col("chunks")).alias("std_size"),
        "min_size",
        "max_size",
        F.try_divide(F.sqrt(spread.cast("double")), F.col("_s")).alias("cv"),
    )


def smallest_file(files: DataFrame) -> DataFrame:
    return files.agg(F.min(F.struct("size_bytes", "path")).alias("f")).select("f.path", "f.size_bytes")


def head_and_rest(df: DataFrame, order_by: str, n: int, text: str) -> DataFrame:
    """The first ``n`` rows for inspection and how many more there are."""
    rest = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.orderBy(order_by)
        .limit(n)
        .select(
            order_by,
            head(F.col(text)).alias("head"),
            F.length(text).alias("content_length"),
            F.greatest(rest - n, F.lit(0)).alias("more"),
        )
    )


def run_summary(statistics: DataFrame, documents: DataFrame, chunks: DataFrame, dim: int) -> DataFrame:
    """One row over all stages; the stage counts are scalar sub-queries."""
    def count(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return statistics.select(
        "successful",
        "failed",
        "total_pages",
        count(documents).alias("documents"),
        count(chunks).alias("chunks"),
        F.lit(dim).alias("embedding_dim"),
        "processing_time",
    )
