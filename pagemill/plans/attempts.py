"""Parsing in rounds, with a written ledger of every attempt on every file.

A round parses the files that the rounds before have failed with, and reads the bytes of these alone. The number of
rounds is that of the given parsers, so it is bounded, and a round without files ends the work.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.operators import failures
from pagemill.sources import parsing

LEDGER = ["file_path", "file_name", "round", "status", "loader_used", "error", "n_pages", "processed_at"]


@dataclass(frozen=True)
class Round:
    """Parsers in the order in which they are tried, on the files whose last error holds ``marker``."""

    parsers: Sequence[tuple[str, parsing.Parser]]
    marker: str = ""
    # Seconds that all parsers together get for one file; None sets no limit.
    seconds_per_file: float | None = None


@dataclass(frozen=True)
class Attempts:
    """``ledger`` has one row per attempt, ``outcomes`` the last attempt of every file with its pages."""

    ledger: DataFrame
    outcomes: DataFrame


def run_rounds(
    load: Callable[[DataFrame | None], DataFrame],
    rounds: Sequence[Round],
    path: str,
    processed_at: Column,
) -> Attempts:
    """Parse in rounds and write each as a partition ``round=n`` of the table at ``path``.

    ``load`` gives ``file_path, content`` of the files in a table of ``file_path``, or of all files for None. A round
    is written before its failures are looked at, so that no parser runs twice, whatever reads the result.
    """
    outcomes: DataFrame | None = None
    for number, each in enumerate(rounds, 1):
        if outcomes is None:
            failed = None
        else:
            failed = failures.retryable(outcomes.where("status = 'failed'"), each.marker).select("file_path")
            if failed.isEmpty():
                break
        parsed = parsing.parse_files(load(failed), each.parsers, processed_at, each.seconds_per_file)
        where = f"{path}/round={number}"
        parsed.write.mode("overwrite").parquet(where)
        attempt = parsed.sparkSession.read.schema(parsed.schema).parquet(where).withColumn("round", F.lit(number))
        if outcomes is None:
            outcomes = ledger = attempt
        else:
            ledger = ledger.union(attempt)
            outcomes = outcomes.join(attempt.select("file_path"), "file_path", "left_anti").unionByName(attempt)
    if outcomes is None:
        raise ValueError("at least one round is needed")
    return Attempts(ledger.select(*LEDGER), outcomes)


def attempt_summary(ledger: DataFrame) -> DataFrame:
    """Per round, how many files were tried, parsed and failed."""
    ok = F.col("status") == "ok"
    return ledger.groupBy("round").agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("failed")
    )
