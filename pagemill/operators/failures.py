"""Failure capture, quarantine and retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the error of a file that parsed without a page.
NO_CONTENT = "No content extracted"


def outcome(df: DataFrame, n_pages: Column, error: str = "error") -> DataFrame:
    """Add ``status`` and the final ``error``: a file without pages has failed too."""
    empty = F.coalesce(n_pages, F.lit(0)) <= 0
    message = F.when(F.col(error).isNotNull(), F.col(error)).when(empty, F.lit(NO_CONTENT))
    return df.withColumn(error, message).withColumn(
        "status", F.when(F.col(error).isNull(), F.lit("ok")).otherwise(F.lit("failed"))
    )


def quarantine(df: DataFrame, stage: str = "parse") -> tuple[DataFrame, DataFrame]:
    """Split outcomes into good rows and the dead-letter table. ``df`` should be a
    materialised table: both sides read it."""
    good = df.where(F.col("status") == "ok").drop("status", "error")
    bad = df.where(F.col("status") == "failed").select(
        "file_path", F.lit(stage).alias("stage"), "error"
    )
    return good, bad


def retryable(failures: DataFrame, marker: str) -> DataFrame:
    return failures.where(F.col("error").contains(marker))


def retry_merge(
    results: DataFrame, failures: DataFrame, retried_ok: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Successful retries join the results and leave the failures; other failures stay.

    The anti-join is on the unique file path and Spark chooses its strategy.
    """
    still_failed = failures.join(retried_ok.select("file_path"), "file_path", "left_anti")
    return results.unionByName(retried_ok.select(*results.columns)), still_failed


def run_statistics(
    outcomes: DataFrame, n_pages: Column, seconds: Column | None = None
) -> DataFrame:
    """Counters of a parse run; averages are per successful file."""
    ok = F.col("status") == "ok"
    time = F.coalesce(F.sum(seconds), F.lit(0.0)) if seconds is not None else F.lit(0.0)
    counted = outcomes.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, n_pages)), F.lit(0)).alias("total_pages"),
        time.alias("processing_time"),
    )
    return counted.select(
        "*",
        F.try_divide("processing_time", "successful").alias("avg_time_per_success"),
        F.try_divide("total_pages", "successful").alias("avg_pages_per_success"),
    )
